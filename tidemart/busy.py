"""Sales that reach every branch: several of a product, place and day, lines of a batch and of a stream, all six faults.

They are made from the order tables: orders fall on the first of their month, few products and customers share them, some
lines lose an id, their sales, quantity or ship date, and every third line comes from the stream. Registered queries run
the cleaning, the models and the incremental tables on them; the SQL says the same from the same tables.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart import oracles
from tidemart.config import DEFAULT
from tidemart.operators import silver as ops
from tidemart.plans import marts
from tidemart.plans.incremental import Gold
from tidemart.plans.intermediate import unified_sales
from tidemart.plans.staging import stg_sales
from tidemart.sources.adapter import ORDER, sales_view, slices_of, table
from tidemart.sources.scratch import Scratch, shared_dir, slices, stored_parts

PRODUCTS, CUSTOMERS = 10, 20
#: The column that a line loses if its number is a multiple, and what is left there.
FAULTS = {"order_id": (211, "' '"), "product_id": (223, "''"), "sales": (227, "0.0"), "quantity": (229, "0"), "ship_date": (233, "null")}
LOADS = (1, 2, 0)  #: remainders by three of the line numbers of each load; the last is the stream's


def busy_sales(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    rows = sales_view(spark, sf_dir, keyed)
    part = lambda k: F.split("row_id", "-")[k].cast("long")
    folded = lambda name, prefix, n: F.concat(F.lit(prefix), F.pmod(F.substring(name, len(prefix) + 1, 20).cast("long"), F.lit(n)).cast("string"))
    rows = rows.withColumns(
        {
            "order_date": F.trunc("order_date", "month"),
            "product_id": folded("product_id", "PROD-", PRODUCTS),
            "customer_id": folded("customer_id", "CUST-", CUSTOMERS),
            "_n": part(0) * 8 + part(1),
        }
    )
    lost = {name: F.when(F.col("_n") % n == 0, F.expr(value).cast(rows.schema[name].dataType)).otherwise(F.col(name)) for name, (n, value) in FAULTS.items()}
    return rows.withColumns(lost).drop("_n")


def load_of(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("_load", F.split(column, "-")[1].cast("int") % 3)


def cleaned(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """The lines of the batch and those of the stream, each under the name of its source: one pass over both."""
    rows = load_of(busy_sales(spark, sf_dir, keyed), "row_id")
    source = F.when(F.col("_load") == 0, "KAFKA").otherwise(DEFAULT.source_system)
    return ops.flag_places(ops.clean(rows, source_system=source).drop("_load"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified_sales(stg_sales(ops.deduplicate(ops.split_faults(cleaned(spark, sf_dir, keyed=True)).valid, (ORDER,))))


def loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The lines of all loads are deduplicated where the join leaves them, a range of orders at a time, and written once."""
    orders, within = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(ORDER)), (ORDER, "_load")
    valid = load_of(ops.split_faults(cleaned(spark, sf_dir, keyed=True)).valid, "source_row_id")
    some = slices(orders, F.col(ORDER), slices_of(spark, sf_dir))
    chosen = stored_parts((ops.latest_by_order_product(ops.latest_by_source_row(valid.where(x), within), within).drop(ORDER) for x in some), "valid")
    return [chosen.where(F.col("_load") == k).drop("_load") for k in LOADS]


_made: dict[tuple[str, str], Gold] = {}  #: tables by application and folder: two queries read them


def followed(spark: SparkSession, sf_dir: str) -> Gold:
    """The tables after three batches."""
    made = spark.sparkContext.applicationId, sf_dir
    if made not in _made:
        gold = Gold(spark, f"{shared_dir(spark)}/gold-{uuid.uuid4().hex}", buckets=8)
        with Scratch(spark):
            for k, batch in enumerate(loads(spark, sf_dir)):
                gold.apply(batch, f"load-{k}")
        _made[made] = gold
    return _made[made]


_number = "cast(split_part(row_id, '-', 1) as bigint) * 8 + cast(split_part(row_id, '-', 2) as bigint)"
_lost = ", ".join(f"case when n % {n} = 0 then {value} else {name} end as {name}" for name, (n, value) in FAULTS.items() if name != "product_id")
BUSY = f"""
select * exclude (n) replace (cast(date_trunc('month', order_date) as date) as order_date, {_lost},
  case when n % {FAULTS["product_id"][0]} = 0 then '' else 'PROD-' || cast(substring(product_id, 6) as bigint) % {PRODUCTS} end as product_id,
  'CUST-' || cast(substring(customer_id, 6) as bigint) % {CUSTOMERS} as customer_id)
from (select *, {_number} as n from sales_view)
"""
_source = "case when cast(split_part(row_id, '-', 2) as int) % 3 = 0 then 'KAFKA' else 'BATCH' end as source_system"


def renamed(sql: str, **names: str) -> str:
    """``sql`` with other views; names in quotes stay."""
    return re.sub(rf"(?<!')\b({'|'.join(names)})\b(?!')", lambda found: names[found.group()], sql)


def load_sql(k: int) -> str:
    """A load's rows: one a source row, then one a key."""
    rows = f"select * from busy_judged where cast(split_part(source_row_id, '-', 2) as int) % 3 = {k}"
    return renamed(oracles.SILVER, by_source=f"({renamed(oracles.BY_SOURCE, judged=f'({rows})')})")


FACT = """
select unified_sales_key, cast(strftime(sale_date, '%Y%m%d') as int) as date_key, product_id as product_key, store_id as store_key, customer_id as customer_key,
  quantity as quantity_sold, gross_amount as gross_sales_amount, discount_amount, net_amount as net_sales_amount, unit_price * quantity - estimated_profit as cost_amount,
  estimated_profit as profit_amount, profit_margin_pct, discount_rate as discount_pct, transaction_size_category, quantity_category, time_of_day, payment_method,
  data_source, data_quality_score, created_at, updated_at
from int_sales_unified where data_quality_score >= 80 and coalesce(customer_id, '') <> ''
"""

VIEWS = {
    "busy_sales": BUSY,
    "busy_cleaned": renamed(oracles.CLEANED, sales_view="busy_sales").replace("'||BATCH'", "'||' || source_system").replace("'BATCH' as source_system", _source),
    "busy_judged": renamed(oracles.JUDGED, cleaned="busy_cleaned"),
    "busy_by_source": renamed(oracles.BY_SOURCE, judged="busy_judged"),
    "busy_silver": renamed(oracles.SILVER, by_source="busy_by_source"),
    "busy_staged": renamed(oracles.STG_SALES, silver="busy_silver"),
    "busy_unified": renamed(oracles.UNIFIED, stg_sales="busy_staged"),
    "busy_fact": renamed(FACT, int_sales_unified="busy_unified"),
    **{f"load_{n}": load_sql(k) for n, k in enumerate(LOADS)},
    "after_1": oracles.merged("load_0", "load_1"),
    "after_2": oracles.merged("after_1", "load_2"),
    "followed_staged": renamed(oracles.STG_SALES, silver="after_2"),
    "followed_unified": renamed(oracles.UNIFIED, stg_sales="followed_staged"),
    "followed_fact": renamed(FACT, int_sales_unified="followed_unified"),
}
oracles.VIEWS.update(VIEWS)
_daily = lambda fact: f"select * exclude (daily_sales_key) from ({renamed(oracles.DAILY, fact_sales=fact)})"

REGISTERED: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "busy_rejections": (
        lambda s, d: ops.rejection_counts(ops.split_faults(cleaned(s, d)).rejected),
        "select rejection_reason, count(*) as row_count from busy_judged where rejection_reason is not null group by 1",
    ),
    "busy_quarantine": (lambda s, d: ops.split_faults(cleaned(s, d)).rejected, "select * from busy_judged where rejection_reason is not null"),
    "busy_sales_unified": (sales, "select * from busy_unified"),
    "busy_sales_daily": (lambda s, d: marts.daily_unkeyed(marts.natural_fact(sales(s, d))), _daily("busy_fact")),
    "followed_daily": (lambda s, d: followed(s, d).daily.read(), _daily("followed_fact")),
    "followed_customers": (
        lambda s, d: followed(s, d).customers.read(),
        f"select * exclude (customer_key) from ({renamed(oracles.DIM_CUSTOMER, int_sales_unified='followed_unified')})",
    ),
}
