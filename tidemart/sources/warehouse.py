"""Tables for readers: stored models, views of recent days, appends to a warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.operators.curve import clustered
from tidemart.plans.registry import CLUSTERED, Warehouse, build_order

VIEWS = ("stg_sales", "stg_customers", "stg_products", "int_sales_unified")
ROWS_PER_PART, CONNECTIONS = 5000, 4

# The columns a warehouse append has, in order, by the cleaned column that each is made from.
EXPORTED = (
    ("ORDER_ID", "order_id"), ("STORE_ID", "customer_id"), ("PRODUCT_ID", "product_id"), ("PRODUCT_NAME", "product_name"),
    ("CATEGORY", "category"), ("SUB_CATEGORY", "sub_category"), ("QUANTITY", "quantity"), ("UNIT_PRICE", "unit_price"),
    ("TOTAL_PRICE", "sales"), ("ORDER_DATE", "order_date"), ("SHIP_DATE", "ship_date"), ("SALES", "sales"), ("PROFIT", "profit"),
    ("SHIPPING_COST", "shipping_cost"), ("CUSTOMER_SEGMENT", "segment"), ("MARKET", "market"), ("REGION", "region"),
    ("COUNTRY", "country"), ("STATE", "state"), ("CITY", "city"), ("ORDER_PRIORITY", "order_priority"),
    ("SOURCE_FILE", "source_file"), ("BATCH_ID", "batch_id"), ("INGESTION_TIMESTAMP", "ingestion_timestamp"),
    ("SOURCE_SYSTEM", "source_system"), ("PARTITION_DATE", "partition_date"),
)
#: Of these, what files without market, shipping and priority do not have.
ABSENT = ("SUB_CATEGORY", "SHIPPING_COST", "MARKET", "ORDER_PRIORITY")


def schema_name(target: str, custom: str | None, default: str = "analytics") -> str:
    """Models keep their own schema in production; elsewhere it follows the target's."""
    if custom is None:
        return default
    return custom if target == "prod" else f"{default}_{custom}"


def export_columns(df: DataFrame, short: bool = False) -> DataFrame:
    """Cleaned rows in the warehouse's columns: 26, or (``short``) the 22 of the 21-field files.

    The customer stands for the store and the capped sales are the total price too; the partition date is a date. A
    column that the rows do not have (rows that came from no file have no ``source_file``) is null text.
    """
    of = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    kind = lambda name, c: c.cast("date") if name == "PARTITION_DATE" else c
    return df.select(*[kind(name, of(c)).alias(name) for name, c in EXPORTED if not (short and name in ABSENT)])


def parts_for(rows: int, rows_per_part: int = ROWS_PER_PART) -> int:
    return max(1, rows // rows_per_part)


def append(df: DataFrame, path: str, rows_per_part: int = ROWS_PER_PART, most_parts: int | None = None) -> bool:
    """Append to a stored table; False if there is nothing.

    A part for each ``rows_per_part`` rows; ``most_parts`` bounds the files of a large append, which then are larger.
    """
    rows = df.count()
    if not rows:
        return False
    parts = parts_for(rows, rows_per_part)
    export_columns(df).repartition(min(parts, most_parts or parts)).write.mode("append").parquet(path)
    return True


def append_jdbc(df: DataFrame, url: str, name: str, connections: int = CONNECTIONS, rows_per_part: int = ROWS_PER_PART, **options: str) -> bool:
    """Append over at most ``connections`` connections; False if there is nothing."""
    rows = df.count()
    if not rows:
        return False
    parts = min(connections, parts_for(rows, rows_per_part))
    export_columns(df).repartition(parts).write.mode("append").options(batchsize=str(rows_per_part), **options).jdbc(url, name)
    return True


def store(w: Warehouse, root: str, names: list[str] | None = None) -> dict[str, str]:
    """Rebuild models as tables under ``root``, clustered by all their clustering columns at once; staging stays a view."""
    out = {}
    for name in build_order():
        if names is not None and name not in names:
            continue
        if name in VIEWS:
            w[name].createOrReplaceTempView(name)
            continue
        df, path = w[name], f"{root.rstrip('/')}/{name}"
        if by := CLUSTERED.get(name):
            df = clustered(df, list(by))
        df.write.mode("overwrite").parquet(path)
        w.made[name] = w.spark.read.parquet(path)
        out[name] = path
    return out


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A table in the catalogue on files where they lie, and a fresh listing of them; dropping it leaves the files."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def incremental(df: DataFrame, stored: DataFrame, by: str) -> DataFrame:
    """Rows beyond the stored table's high-water mark; all of them while it is empty."""
    mark = stored.agg(F.max(by).alias("_mark"))  # one row
    return df.join(F.broadcast(mark)).where(F.col("_mark").isNull() | (F.col(by) > F.col("_mark"))).drop("_mark")
