"""Named business metrics and reports over the star schema."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.functions import columns as c
from tidemart.operators.quantiles import quantiles
from tidemart.plans.registry import Warehouse
from tidemart.sources.scratch import stored_parts


def metrics(unique: bool = False) -> dict[str, Column]:
    """Aggregates by name; ratios are ratios of sums.

    ``unique``: each row is a sale of its own, as in the fact, so rows are counted and no key is dealt to be told apart.
    """
    sales = F.count(F.lit(1) if unique else "sales_key")
    return _metrics(c.money_sum, F.sum("quantity_sold"), sales, sales if unique else F.countDistinct("sales_key"))


def _metrics(money: Callable[[str], Column], units: Column, sales: Column, orders: Column) -> dict[str, Column]:
    net = money("net_sales_amount")
    return {
        "profit_margin": money("profit_amount") / F.nullif(net, F.lit(0.0)),
        "average_order_value": net / sales,
        "discount_rate": money("discount_amount") / F.nullif(money("gross_sales_amount"), F.lit(0.0)),
        "units_per_order": units / orders,
        "total_orders": orders,
    }


#: Drill-down paths, from coarse to fine.
HIERARCHIES = {
    "date": ("year_number", "quarter", "month_number", "date_value"),
    "product": ("category", "sub_category", "product_name"),
    "geography": ("region", "country", "state", "city"),
}


def star(w: Warehouse, *with_: str) -> DataFrame:
    """The fact with the attributes that reports group by; of the dimensions named (date, product, customer), or all."""
    dates = w["dim_date"].select("date_key", "date_value", "year_number", "quarter", "month_number", "month_name")
    products = w["dim_product"].select("product_key", "product_id", "product_name", "category", "sub_category")
    customers = w["dim_customer"].select("customer_key", "customer_segment", "customer_value_tier", "recency_segment", "region", "country", "state", "city")
    out = w["fact_sales"]
    for name, df in (("date", F.broadcast(dates)), ("product", products), ("customer", customers)):
        if not with_ or name in with_:
            out = out.join(df, f"{name}_key", "left")
    return out


def kpis(sales: DataFrame, *by: str, unique: bool = False) -> DataFrame:
    return (sales.groupBy(*by) if by else sales.groupBy()).agg(*[m.alias(n) for n, m in metrics(unique).items()])


def kpis_of_parts(parts: Iterable[DataFrame], *by: str) -> DataFrame:
    """``kpis`` of sales that come in parts, each row a sale of its own: the sums of each part are written, then added."""
    money = ("net_sales_amount", "profit_amount", "discount_amount", "gross_sales_amount")
    sums = [F.sum(F.col(x).cast("decimal(18,4)")).alias(x) for x in money] + [F.sum("quantity_sold").alias("units"), F.count(F.lit(1)).alias("sales")]
    found = stored_parts((part.groupBy(*by).agg(*sums) for part in parts), "sums")
    added = _metrics(lambda x: F.sum(x).cast("double"), F.sum("units"), F.sum("sales"), F.sum("sales"))
    return found.groupBy(*by).agg(*[v.alias(n) for n, v in added.items()])


def drill_down(sales: DataFrame, hierarchy: str, levels: int, unique: bool = False) -> DataFrame:
    by = HIERARCHIES[hierarchy][:levels]
    return kpis(sales, *by, unique=unique)


def roll_up(sales: DataFrame, hierarchy: str, levels: int = 2) -> DataFrame:
    """Net sales at every level of a hierarchy at once; nulls are totals."""
    by = HIERARCHIES[hierarchy][:levels]
    return sales.rollup(*by).agg(c.money_sum("net_sales_amount").alias("net_sales"), F.count("*").alias("sales"), F.grouping_id().cast("int").alias("level"))


def sales_by_category(sales: DataFrame) -> DataFrame:
    return sales.groupBy("category").agg(
        c.money_sum("net_sales_amount").alias("total_sales"),
        c.money_sum("profit_amount").alias("total_profit"),
        F.countDistinct("customer_key").alias("unique_customers"),
    ).orderBy(F.desc("total_sales"), "category")


def monthly_trend(sales: DataFrame) -> DataFrame:
    """Sales by month with the change on the year before, running and overall totals and rank.

    The windows run over months, not sales: one small partition is meant.
    """
    by = sales.groupBy("year_number", "month_number").agg(
        c.money_sum("net_sales_amount").alias("net_sales"), F.countDistinct("order_id").alias("orders")
    )
    w = Window.orderBy("year_number", "month_number")
    before = F.lag("net_sales", 12).over(w)
    cents = F.col("net_sales").cast("decimal(18,4)")
    return by.select(
        "year_number",
        "month_number",
        "net_sales",
        "orders",
        ((F.col("net_sales") - before) / F.nullif(before, F.lit(0.0))).alias("change_on_year"),
        F.sum(cents).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("double").alias("running_sales"),
        (F.col("net_sales") / F.sum(cents).over(Window.partitionBy()).cast("double")).alias("share"),
        F.rank().over(Window.orderBy(F.desc("net_sales"))).alias("sales_rank"),
    )


def top_products(sales: DataFrame, n: int = 10, bottom: bool = False) -> DataFrame:
    by = sales.groupBy("product_id").agg(c.money_sum("net_sales_amount").alias("net_sales"), c.money_sum("profit_amount").alias("profit"))
    order = F.asc("net_sales") if bottom else F.desc("net_sales")
    return by.orderBy(order, "product_id").limit(n)


def tier_summary(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_value_tier", "recency_segment").agg(F.count("*").alias("customers"), c.money_sum("total_spent").alias("spent"))


def segment_summary(sales: DataFrame, unique: bool = False) -> DataFrame:
    return kpis(sales, "customer_segment", unique=unique)


def shipping_cost(stg: DataFrame) -> DataFrame:
    return stg.groupBy("ship_mode").agg(
        F.count("*").alias("sales"), c.money_sum("shipping_cost").alias("shipping_cost"), (c.money_sum("shipping_cost") / F.nullif(c.money_sum("net_amount"), F.lit(0.0))).alias("share_of_net")
    )


def source_breakdown(silver: DataFrame) -> DataFrame:
    return silver.groupBy("source_system").agg(F.count("*").alias("records"), F.max("processing_timestamp").alias("latest"))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def spine_span(dates: DataFrame) -> DataFrame:
    d = "date_value"
    return dates.agg(F.count("*").alias("days"), F.min(d).alias("first_day"), F.max(d).alias("last_day"), (F.datediff(F.max(d), F.min(d)) + 1).alias("span"))


def top_duplicates(df: DataFrame, *keys: str, n: int = 10) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), *keys).limit(n)


def category_breakdown(df: DataFrame, n: int = 5) -> DataFrame:
    return df.groupBy("category").agg(F.count("*").alias("n"), c.money_sum("sales").alias("sales")).orderBy(F.desc("n"), "category").limit(n)


def summary(df: DataFrame) -> DataFrame:
    """Rows, distinct orders, order-product pairs, first and last day, and the range and mean of sales."""
    return df.agg(
        F.count("*").alias("rows"),
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct(F.concat("order_id", F.lit("-"), "product_id")).alias("order_products"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
        F.min("sales").alias("least"),
        F.max("sales").alias("most"),
        c.money_avg("sales").alias("mean"),
    )


def model_counts(w: Warehouse, *names: str) -> DataFrame:
    out = None
    for n in names:
        one = w[n].agg(F.count("*").alias("row_count")).select(F.lit(n).alias("model"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def iqr_outliers(df: DataFrame, column: str, times: float = 1.5) -> DataFrame:
    """Quartiles by linear interpolation and how many values lie beyond ``times`` the range between them.

    The quartiles are exact and found in a few passes over the column (``quantiles``), no task sees all values. No row if
    all is null.
    """
    v = F.col("v")
    q1, q3 = quantiles(df, column, [0.25, 0.75], one_rounding=True)
    values = df.select(F.col(column).alias("v")).where(v.isNotNull())
    low, high = (F.lit(q).cast("double") for q in (q1, q3))
    reach = times * (high - low)
    out = values.agg(F.count("*").alias("n"), F.count_if((v < low - reach) | (v > high + reach)).alias("outliers")).where("n > 0")
    return out.select(low.alias("q1"), high.alias("q3"), "n", "outliers", (F.col("outliers") / F.col("n")).alias("outlier_rate"))


def quantile_table(df: DataFrame, column: str, *shares: float) -> DataFrame:
    """A row for each share with the column's exact quantile."""
    return df.sparkSession.createDataFrame(list(zip(shares, quantiles(df, column, list(shares)), strict=True)), "share double, value double")


def for_reader(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """The rows a reader may see."""
    return df.where(F.col(column).isin(*allowed))
