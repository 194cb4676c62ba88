"""Staging models over the cleaned table: sales, customers, products."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.config import DEFAULT, Settings
from tidemart.functions import columns as c


def _audit(settings: Settings) -> dict[str, Column]:
    return c.audit_columns(F.lit(settings.as_of).cast("timestamp"))


STG_SALES = (
    "sales_silver_key", "order_id", "customer_id", "product_id", "order_date", "ship_date", "ship_mode", "order_priority",
    "customer_name", "customer_segment", "city", "state", "country", "postal_code", "market", "region", "product_name",
    "category", "sub_category", "quantity", "unit_price", "sales_amount", "discount_rate", "profit_amount",
    "shipping_cost", "gross_amount", "discount_amount", "net_amount", "sale_date", "processing_timestamp",
    "source_system", "is_valid_record", "data_quality_score", "created_at", "updated_at", "invocation_id", "target_name",
)


#: The columns of the cleaned table that ``stg_sales`` reads.
READ = (
    "order_id", "customer_id", "product_id", "order_date", "ship_date", "ship_mode", "order_priority", "customer_name", "segment", "city", "state",
    "country", "postal_code", "market", "region", "product_name", "category", "sub_category", "quantity", "sales", "discount", "profit", "shipping_cost",
    "processing_timestamp", "source_system",
)


def sales_valid() -> Column:
    """The first rule that speaks decides; unknown quantities and sales pass."""
    q, s, d = F.col("quantity"), F.col("sales"), F.col("discount")
    return (
        F.when(q <= 0, False)
        .when(s <= 0, False)
        .when(F.col("order_date").isNull(), False)
        .when(F.col("ship_date").isNotNull() & (F.col("ship_date") < F.col("order_date")), False)
        .when((d < 0) | (d > 1), False)
        .otherwise(True)
    )


def sales_score(source_system: Column, has: Callable[[str], Column] = lambda x: F.col(x).isNotNull()) -> Column:
    return c.quality_score(
        [(has(x), 15) for x in ("order_id", "customer_id", "product_id")]
        + [(F.col("quantity") > 0, 10), (F.col("sales") > 0, 10), (has("order_date"), 10)]
        + [(has(x), 5) for x in ("customer_name", "category", "region", "country")]
        + [(source_system.isin("BATCH", "KAFKA"), 5)]
    )


def stg_sales(silver: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Valid sales with a score of 70 or more; ``discount_amount`` stays null where the discount is.

    Rows may carry ``has_<name>`` in place of the names of products and customers, which are then left out.
    """
    sales, rate = F.col("sales"), F.coalesce("discount", F.lit(0.0))
    system = F.upper(c.trimmed("source_system"))
    out = silver.select(
        "*",
        *[F.col(x).alias(y) for x, y in (("segment", "customer_segment"), ("has_segment", "has_customer_segment")) if x in silver.columns],
        sales.alias("sales_amount"),
        rate.alias("discount_rate"),
        F.col("profit").alias("profit_amount"),
        sales.alias("gross_amount"),
        (sales * F.col("discount")).alias("discount_amount"),
        (sales * (1 - rate)).alias("net_amount"),
        F.col("order_date").alias("sale_date"),
        c.surrogate_key("order_id", "product_id").alias("sales_silver_key"),
        sales_valid().alias("is_valid_record"),
        sales_score(system, lambda x: c.known(silver, x)).alias("data_quality_score"),
    ).withColumns(
        {
            "unit_price": F.when(F.col("quantity") > 0, sales / F.col("quantity")).otherwise(0.0),
            "source_system": system,
            **_audit(settings),
        }
    )
    kept = [x for x in STG_SALES if x in out.columns] + [x for x in out.columns if x.startswith("has_")]
    return out.where(F.col("is_valid_record") & (F.col("data_quality_score") >= 70)).select(*kept)


def stg_customers(sales: DataFrame, settings: Settings = DEFAULT, names: DataFrame | None = None) -> DataFrame:
    """One row a customer: name, segment and place of the newest sale (named ones first), and what they bought.

    The newest sale is the maximum of a struct within the same aggregation, so sales are grouped once and never joined
    to themselves. ``names``: those of each customer, where all its sales bear the same; customers are met with them
    after the aggregation, which then deals no text.
    """
    kept = ("customer_name", "customer_segment", "city", "state", "country", "postal_code", "market", "region")
    first = [F.coalesce(c.not_blank("customer_name"), F.lit(False)).cast("int").alias("_named")] if names is None else []
    newest = F.struct(*first, "order_date", "processing_timestamp", "order_id", "product_id", *(kept if names is None else ()))
    base = sales.where(F.col("customer_id").isNotNull()).select(
        "customer_id", newest.alias("_newest"), "quantity", "sales_amount", "profit_amount"
    )
    by = (
        base.groupBy("customer_id")
        .agg(
            *([F.max("_newest").alias("n")] if names is None else []),
            F.countDistinct("_newest.order_id").alias("total_orders"),
            F.count("_newest.order_id").alias("_ordered"),
            F.sum("quantity").alias("total_items_purchased"),
            c.money_sum("sales_amount").alias("lifetime_value"),
            c.money_avg("sales_amount").alias("avg_order_value"),
            c.money_sum("profit_amount").alias("total_profit_generated"),
            F.max("_newest.order_date").alias("last_order_date"),
            F.min("_newest.order_date").alias("effective_date"),
            F.max("_newest.processing_timestamp").alias("ingestion_timestamp"),
        )
        .withColumn("customer_tenure_days", F.datediff("last_order_date", "effective_date"))
    )
    if names is not None:
        by = by.join(names.select("customer_id", F.struct(*kept).alias("n")), "customer_id")
    n = lambda x: F.col(f"n.{x}")
    up = lambda x: F.upper(c.trimmed(x))
    # some order or none: who does not read their number need not tell them apart
    orders, value, tenure = F.col("_ordered"), F.col("lifetime_value"), F.col("customer_tenure_days")
    key = c.not_blank("customer_id")
    out = by.select(
        c.surrogate_key("customer_id").alias("customer_key"),
        up("customer_id").alias("customer_id"),
        c.trimmed(n("customer_name")).alias("customer_name"),
        up(n("customer_segment")).alias("customer_segment"),
        c.trimmed(n("city")).alias("city"),
        up(n("state")).alias("state"),
        up(n("country")).alias("country"),
        c.trimmed(n("postal_code")).alias("postal_code"),
        up(n("market")).alias("market"),
        up(n("region")).alias("region"),
        c.location(n("city"), n("state"), n("country")).alias("full_location"),
        "total_orders",
        "total_items_purchased",
        "lifetime_value",
        "avg_order_value",
        "total_profit_generated",
        c.bucket(value, [(10000, "PLATINUM"), (5000, "GOLD"), (1000, "SILVER")], "BRONZE", below=False).alias("value_tier"),
        c.bucket(tenure, [(1095, "LOYAL"), (365, "ESTABLISHED"), (90, "REGULAR")], "NEW", below=False).alias("tenure_category"),
        "effective_date",
        "last_order_date",
        "customer_tenure_days",
        F.coalesce(F.col("last_order_date") >= F.date_sub(F.lit(settings.as_of), 90), F.lit(False)).alias("is_active"),
        F.when(~key, False).when(orders <= 0, False).when(value <= 0, False).when(F.col("effective_date").isNull(), False).otherwise(True).alias("is_valid_record"),
        c.quality_score(
            [(key, 20), (c.not_blank(n("customer_name")), 15), (n("customer_segment").isNotNull(), 15)]
            + [(n(x).isNotNull(), 10) for x in ("city", "country", "region")]
            + [(orders > 0, 10), (value > 0, 10)]
        ).alias("data_quality_score"),
        "ingestion_timestamp",
        *[v.alias(k) for k, v in _audit(settings).items()],
    )
    return out.where(F.col("is_valid_record") & (F.col("data_quality_score") >= 70))


def stg_products(sales: DataFrame, settings: Settings = DEFAULT, unique: bool = False, names: DataFrame | None = None) -> DataFrame:
    """One row a product: attributes of the newest sale, prices and totals over all.

    ``unique``: sales have an order and are one for each order and product, so they are counted as orders, and nothing is
    dealt to tell orders apart. ``names``: see ``stg_customers``.
    """
    kept = ("product_name", "category", "sub_category")
    newest = F.struct("sale_date", "processing_timestamp", "order_id", *(kept if names is None else ()))
    base = sales.where(F.col("product_id").isNotNull() & (F.col("product_id") != "")).select(
        "product_id", newest.alias("_newest"), "unit_price", "quantity", "sales_amount", "profit_amount"
    )
    by = base.groupBy("product_id").agg(
        *([F.max("_newest").alias("n")] if names is None else []),
        c.fine_avg("unit_price").alias("unit_price"),
        F.min("unit_price").alias("min_unit_price"),
        F.max("unit_price").alias("max_unit_price"),
        (F.count(F.lit(1)) if unique else F.countDistinct("_newest.order_id")).alias("total_orders"),
        F.sum("quantity").alias("total_quantity_sold"),
        c.money_sum("sales_amount").alias("total_sales"),
        c.money_avg("profit_amount").alias("_profit"),
        F.max("_newest.sale_date").alias("last_sale_date"),
        F.min("_newest.sale_date").alias("effective_date"),
        F.max("_newest.processing_timestamp").alias("ingestion_timestamp"),
    )
    if names is not None:
        by = by.join(names.select("product_id", F.struct(*kept).alias("n")), "product_id")
    n = lambda x: F.col(f"n.{x}")
    price, key, name = F.col("unit_price"), c.not_blank("product_id"), c.not_blank(n("product_name"))
    margin = F.when(price > 0, F.round((F.col("_profit") / price).cast("decimal(20,8)"), 4).cast("double"))
    out = by.select(
        c.surrogate_key("product_id").alias("product_key"),
        F.upper(c.trimmed("product_id")).alias("product_id"),
        c.trimmed(n("product_name")).alias("product_name"),
        F.upper(c.trimmed(n("category"))).alias("category"),
        F.upper(c.trimmed(n("sub_category"))).alias("sub_category"),
        "unit_price",
        "min_unit_price",
        "max_unit_price",
        margin.alias("estimated_profit_margin_pct"),
        "total_orders",
        "total_quantity_sold",
        "total_sales",
        "effective_date",
        "last_sale_date",
        F.coalesce(F.col("last_sale_date") >= F.date_sub(F.lit(settings.as_of), 30), F.lit(False)).alias("is_active"),
        F.when(~key, False)
        .when(~F.coalesce(name, F.lit(False)), False)
        .when(price.isNull() | (price <= 0), False)
        .when(n("category").isNull(), False)
        .otherwise(True)
        .alias("is_valid_record"),
        c.quality_score(
            [(key, 25), (name, 20), (n("category").isNotNull(), 15), (n("sub_category").isNotNull(), 10)]
            + [(price > 0, 15), (F.col("total_orders") > 0, 10), (F.col("total_sales") > 0, 5)]
        ).alias("data_quality_score"),
        "ingestion_timestamp",
        *[v.alias(k) for k, v in _audit(settings).items()],
    )
    return out.where(F.col("is_valid_record") & (F.col("data_quality_score") >= 70))
