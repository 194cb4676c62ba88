"""Between staging and marts: unified sales, product and store versions, the days of the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemart.config import DEFAULT, Settings
from tidemart.functions import columns as c

UNIFIED = (
    "unified_sales_key", "order_id", "store_id", "product_id", "customer_id", "product_name", "category", "quantity",
    "unit_price", "total_price", "discount_rate", "gross_amount", "discount_amount", "net_amount", "profit_amount",
    "estimated_profit", "profit_margin_pct", "sale_timestamp", "sale_date", "sale_hour", "ship_date", "payment_method",
    "store_location", "customer_segment", "region", "country", "state", "city", "transaction_size_category",
    "discount_category", "quantity_category", "time_of_day", "day_type", "data_source", "source_system",
    "ingestion_timestamp", "partition_date", "is_valid_record", "data_quality_score", "enhanced_quality_score",
    "created_at", "updated_at",
)


#: Of these, what products and customers are called.
NAMES = ("product_name", "category", "store_location", "customer_segment", "region", "country", "state", "city")


def derived() -> dict[str, Column]:
    """What follows from a unified sale's own measures and times: joins need not carry it."""
    net, hour = F.col("net_amount"), F.hour("sale_timestamp")
    return {
        "unified_sales_key": c.surrogate_key("order_id", "product_id"),
        "profit_margin_pct": F.when(net > 0, F.col("estimated_profit") / net),
        "sale_hour": hour,
        "transaction_size_category": c.bucket(net, [(50, "SMALL"), (200, "MEDIUM"), (500, "LARGE")], "EXTRA_LARGE"),
        "discount_category": F.when(F.col("discount_rate") == 0, "NO_DISCOUNT").otherwise(
            c.bucket("discount_rate", [(0.1, "LOW_DISCOUNT"), (0.25, "MEDIUM_DISCOUNT")], "HIGH_DISCOUNT", inclusive=True)
        ),
        "quantity_category": F.when(F.col("quantity") == 1, "SINGLE_ITEM").otherwise(
            c.bucket("quantity", [(5, "FEW_ITEMS"), (10, "MULTIPLE_ITEMS")], "BULK_PURCHASE", inclusive=True)
        ),
        "time_of_day": c.day_part(hour),
        "day_type": F.when(c.day_number("sale_date").isin(0, 6), "WEEKEND").otherwise("WEEKDAY"),
    }


def unified_sales(sales: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Sales with derived profit, categories and an enhanced score of 75 or more; a projection and a filter.

    Without the names of products and customers where the sales have none (see ``staging.stg_sales``).
    """
    named = "city" in sales.columns
    net = F.col("net_amount")
    profit = F.coalesce("profit_amount", net * 0.15)
    has = lambda x: c.known(sales, x)
    system = F.when(F.col("source_system") == "KAFKA", "STREAMING").otherwise(F.col("source_system"))
    out = sales.withColumns(
        {
            "store_id": F.col("customer_id"),
            "total_price": F.col("sales_amount"),
            "estimated_profit": profit,
            "sale_timestamp": F.col("processing_timestamp"),
            "payment_method": F.lit("UNKNOWN"),
            **({"store_location": c.location("city", "state", "country")} if "city" in sales.columns else {}),
            "data_source": system,
            "ingestion_timestamp": F.col("processing_timestamp"),
            "partition_date": F.col("order_date"),
            "enhanced_quality_score": F.col("data_quality_score")
            + c.quality_score(
                [(has("customer_id") & (F.col("customer_id") != ""), 5)] + [(has(x), 5) for x in ("profit_amount", "region", "customer_segment")]
            ),
        }
    )
    return out.where(F.col("is_valid_record") & (F.col("enhanced_quality_score") >= 75)).withColumns(derived()).select(*[x for x in UNIFIED if named or x not in NAMES])


def days_active(effective: str, expires: str, settings: Settings = DEFAULT) -> Column:
    open_ended = F.col(expires) == F.lit(settings.scd2_end)
    return F.when(open_ended, None).otherwise(F.datediff(expires, effective) + 1)


def product_versions(products: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Validity ranges of product rows: each ends the day before the next begins, the newest is open-ended.

    One window orders a product's rows for both the rank (1 is newest) and the end.
    """
    newest = [F.col("effective_date").desc(), F.col("ingestion_timestamp").desc(), F.col("product_key").desc()]
    w = Window.partitionBy("product_id").orderBy(*newest)
    rank, following = F.row_number().over(w), F.lag("effective_date").over(w)
    price = F.col("unit_price")
    ranked = products.select(
        "*", rank.alias("version_number"), F.coalesce(F.date_sub(following, 1), F.lit(settings.scd2_end)).alias("expiration_date")
    ).where("is_valid_record")
    current = F.col("version_number") == 1
    return ranked.select(
        c.surrogate_key("product_id", "effective_date", "version_number").alias("product_scd2_key"),
        "product_id",
        "product_name",
        "category",
        "sub_category",
        F.lit("UNKNOWN").alias("brand"),
        F.round((price * 0.70).cast("decimal(20,8)"), 2).cast("double").alias("unit_cost"),
        "unit_price",
        F.lit(0.30).alias("profit_margin_pct"),
        "effective_date",
        "expiration_date",
        current.alias("is_current"),
        "is_active",
        "version_number",
        F.when(current, "CURRENT_VERSION").otherwise("HISTORICAL_VERSION").alias("change_type"),
        days_active("effective_date", "expiration_date", settings).alias("days_active"),
        c.bucket(price, [(10, "LOW_PRICE"), (50, "MEDIUM_PRICE"), (200, "HIGH_PRICE")], "PREMIUM_PRICE").alias("price_tier"),
        margin_tier(F.lit(0.30)).alias("margin_tier"),
        "is_valid_record",
        "data_quality_score",
        "ingestion_timestamp",
        "created_at",
        "updated_at",
    )


def margin_tier(margin: Column) -> Column:
    return c.bucket(margin, [(0.1, "LOW_MARGIN"), (0.3, "MEDIUM_MARGIN"), (0.5, "HIGH_MARGIN")], "PREMIUM_MARGIN")


def region_group(region: Column) -> Column:
    """Which regions lie together."""
    return (
        F.when(region.isin("NORTH", "NORTHEAST", "NORTHWEST"), "NORTHERN_REGIONS")
        .when(region.isin("SOUTH", "SOUTHEAST", "SOUTHWEST"), "SOUTHERN_REGIONS")
        .when(region.isin("EAST", "WEST"), "COASTAL_REGIONS")
        .when(region.isin("CENTRAL", "MIDWEST"), "CENTRAL_REGIONS")
        .otherwise("OTHER_REGIONS")
    )


def store_versions(customers: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Stores are the customers' places: one open-ended version each."""
    age = c.years_between("effective_date", F.lit(settings.as_of))
    end = F.lit(settings.scd2_end)
    return customers.where("is_valid_record").select(
        c.surrogate_key(F.col("customer_id"), F.col("effective_date"), F.lit(1)).alias("store_scd2_key"),
        F.col("customer_id").alias("store_id"),
        F.col("customer_name").alias("store_name"),
        F.col("city").alias("store_location"),
        F.lit("RETAIL").alias("store_type"),
        "city",
        "state",
        "country",
        "region",
        "full_location",
        F.col("effective_date").alias("opening_date"),
        c.bucket("customer_tenure_days", [(1095, "LEGACY"), (365, "ESTABLISHED"), (90, "MATURE")], "NEW", below=False).alias("store_age_category"),
        "effective_date",
        end.alias("expiration_date"),
        F.lit(True).alias("is_current"),
        "is_active",
        F.lit(1).alias("version_number"),
        F.lit("NEW_STORE").alias("change_type"),
        F.lit(None).cast("int").alias("days_active"),
        c.bucket(age, [(10, "LEGACY"), (5, "ESTABLISHED"), (2, "MATURE"), (1, "DEVELOPING")], "NEW", below=False).alias("maturity_level"),
        region_group(F.col("region")).alias("geographic_cluster"),
        "is_valid_record",
        "data_quality_score",
        "ingestion_timestamp",
        "created_at",
        "updated_at",
    )


def date_spine(spark: SparkSession, settings: Settings = DEFAULT) -> DataFrame:
    """``date_day``: each day from the start to before the end."""
    days = F.sequence(F.lit(settings.spine_start), F.date_sub(F.lit(settings.spine_end), 1))
    return spark.range(1).select(F.explode(days).alias("date_day"))
