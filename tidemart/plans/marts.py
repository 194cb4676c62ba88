"""The star schema: four dimensions, the sales fact and its daily roll-up."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.config import DEFAULT, Settings
from tidemart.functions import columns as c
from tidemart.operators.keys import dense_keys, ranged_keys
from tidemart.plans.intermediate import derived
from tidemart.sources.scratch import shares, stored, stored_parts

# Holidays by month and day.
HOLIDAYS = ((1, 1, "New Year's Day"), (7, 4, "Independence Day"), (12, 25, "Christmas Day"))


def holidays(spark: SparkSession, first: int, last: int) -> DataFrame:
    """(date_value, holiday_name, is_federal), three a year."""
    rows = [(date(y, m, d), name, True) for y in range(first, last + 1) for m, d, name in HOLIDAYS]
    return spark.createDataFrame(rows, "date_value date, holiday_name string, is_federal boolean")


def _now(settings: Settings) -> Column:
    return F.lit(settings.as_of).cast("timestamp")


def dim_date(spark: SparkSession, spine: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The calendar with week bounds, fiscal fields (years start in February) and holidays."""
    d, month, year = F.col("date_day"), F.month("date_day"), F.year("date_day")
    dow = c.day_number(d)
    week = F.date_trunc("week", d).cast("date")
    shown = F.date_sub(d, 1) if settings.shifted_day_names else d
    days = spine.select(
        c.date_key(d).alias("date_key"),
        d.alias("date_value"),
        dow.alias("day_of_week"),
        F.day(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(shown, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        week.alias("week_start_date"),
        F.date_add(week, 6).alias("week_end_date"),
        month.alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_abbreviation"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        year.alias("year_number"),
        dow.isin(0, 6).alias("is_weekend"),
        F.when(month >= 2, year).otherwise(year - 1).alias("fiscal_year"),
        (F.floor(F.pmod(month + 10, F.lit(12)) / 3) + 1).cast("int").alias("fiscal_quarter"),
        F.when(month >= 2, month - 1).otherwise(month + 11).alias("fiscal_month"),
    )
    off = holidays(spark, settings.spine_start.year, settings.spine_end.year).select("date_value", "holiday_name")
    out = days.join(F.broadcast(off), "date_value", "left")
    first = ["date_key", "date_value"]
    return out.select(
        *first,
        *[x for x in days.columns if x not in first and not x.startswith("fiscal")],
        F.col("holiday_name").isNotNull().alias("is_holiday"),
        "holiday_name",
        "fiscal_year",
        "fiscal_quarter",
        "fiscal_month",
        _now(settings).alias("created_at"),
        _now(settings).alias("updated_at"),
    )


def blank(kind: str, *names: str) -> list[Column]:
    return [F.lit(None).cast(kind).alias(n) for n in names]


def keyed(df: DataFrame, name: str, order: list[str], dense: bool, only: tuple[str, ...] | None = None, parts: int = 1) -> DataFrame:
    """A dimension with keys 1..N in the order given, or (not ``dense``) with the ordering columns themselves as key.

    The rows are written before they are numbered, as finding the ranges reads them once more. ``only``: the columns that
    are read, if not all. ``parts``: in how many shares, by the first column of the order, rows are made and written.
    """
    df = df.select(*only) if only else df
    if dense:
        return ranged_keys(stored_parts((df.where(x) for x in shares(F.col(order[0]), parts)), name), name, order)
    return df.select(F.concat_ws("|", *[F.col(c).cast("string") for c in order]).alias(name), "*")


def dim_product(
    versions: DataFrame, settings: Settings = DEFAULT, dense: bool = True, only: tuple[str, ...] | None = None, parts: int = 1
) -> DataFrame:
    office = ["OFFICE_SUPPLIES"] + (["OFFICE SUPPLIES"] if settings.office_with_space else [])
    family = F.when(F.col("category").isin("TECHNOLOGY", "ELECTRONICS"), "HIGH_TECH").when(F.col("category").isin("FURNITURE", *office), "TRADITIONAL").otherwise("OTHER")
    markup = c.ratio(F.col("unit_price"), F.col("unit_cost"))
    out = versions.where(F.col("is_valid_record") & (F.col("data_quality_score") >= 80)).select(
        "product_id", "product_name", "category", "sub_category", "brand", "unit_cost", "unit_price", "profit_margin_pct",
        *blank("string", "product_size", "product_color"), *blank("double", "product_weight"),
        "effective_date", "expiration_date", "is_current", "is_active", "version_number", "change_type", "days_active",
        "price_tier", "margin_tier", family.alias("product_family"),
        c.bucket(markup, [(3, "HIGH_MARKUP"), (2, "MEDIUM_MARKUP"), (1.5, "LOW_MARKUP")], "MINIMAL_MARKUP", below=False).alias("markup_category"),
        "data_quality_score", "ingestion_timestamp", "created_at", "updated_at",
    )
    return keyed(out, "product_key", ["product_id", "effective_date"], dense, only, parts)


def dim_store(
    versions: DataFrame, settings: Settings = DEFAULT, dense: bool = True, only: tuple[str, ...] | None = None, parts: int = 1
) -> DataFrame:
    age = c.years_between("opening_date", F.lit(settings.as_of))
    kind, region = F.col("store_type"), F.col("region")
    out = versions.where(F.col("is_valid_record") & (F.col("data_quality_score") >= 80)).select(
        "store_id", "store_name", "store_location", "city", "state", "country", "region", "store_type", "opening_date",
        *blank("double", "latitude", "longitude"), *blank("string", "timezone"), *blank("int", "store_size_sqft", "employee_count"),
        "effective_date", "expiration_date", "is_current", "is_active", "version_number", "change_type", "days_active",
        "store_age_category", "maturity_level", "geographic_cluster", "full_location",
        F.when(kind.isin("FLAGSHIP", "WAREHOUSE"), "LARGE_FORMAT").when(kind.isin("OUTLET", "KIOSK"), "SMALL_FORMAT").otherwise("STANDARD_FORMAT").alias("store_format"),
        F.when(region.isin("WEST", "EAST"), "COASTAL").when(region.isin("CENTRAL", "MIDWEST"), "INLAND").otherwise("OTHER").alias("geographic_tier"),
        c.bucket(age, [(1, "RAMP_UP"), (3, "GROWTH"), (10, "MATURE")], "LEGACY").alias("lifecycle_stage"),
        "data_quality_score", "ingestion_timestamp", "created_at", "updated_at",
    )
    return keyed(out, "store_key", ["store_id", "effective_date"], dense, only, parts)


def dim_customer(
    unified: DataFrame, settings: Settings = DEFAULT, dense: bool = True, only: tuple[str, ...] | None = None, names: DataFrame | None = None,
    parts: int = 1,
) -> DataFrame:
    """Customers with their newest place and recency, frequency and value segments; one aggregation of the sales.

    ``names``: see ``staging.stg_customers``.
    """
    kept = ("customer_segment", "region", "country", "state", "city")
    newest = F.struct("sale_date", "ingestion_timestamp", *(("unified_sales_key", *kept) if names is None else ()))
    by = (
        unified.where(F.col("customer_id").isNotNull() & (F.col("customer_id") != ""))
        .select("customer_id", newest.alias("_newest"), "order_id", "net_amount", "quantity", "enhanced_quality_score")
        .groupBy("customer_id")
        .agg(
            *([F.max("_newest").alias("n")] if names is None else []),
            F.min("_newest.sale_date").alias("first_purchase_date"),
            F.max("_newest.sale_date").alias("last_purchase_date"),
            F.countDistinct("order_id").alias("total_orders"),
            c.money_sum("net_amount").alias("total_spent"),
            c.money_avg("net_amount").alias("avg_order_value"),
            F.sum("quantity").alias("total_items_purchased"),
            F.max("enhanced_quality_score").alias("data_quality_score"),
            F.min("_newest.ingestion_timestamp").alias("ingestion_timestamp"),
        )
        .withColumn("days_since_last_purchase", F.datediff(F.lit(settings.as_of), "last_purchase_date"))
    )
    if names is not None:
        by = by.join(names.select("customer_id", F.struct(*kept).alias("n")), "customer_id")
    since, orders, spent = F.col("days_since_last_purchase"), F.col("total_orders"), F.col("total_spent")
    out = by.where("data_quality_score >= 75").select(
        "customer_id",
        *blank("string", "customer_name"),
        F.coalesce("n.customer_segment", F.lit("UNKNOWN")).alias("customer_segment"),
        F.lit("INDIVIDUAL").alias("customer_type"),
        *blank("string", "age_range", "gender", "income_bracket"),
        *[F.col(f"n.{x}").alias(x) for x in ("city", "state", "country", "region")],
        "first_purchase_date",
        "last_purchase_date",
        F.coalesce(since <= 30, F.lit(False)).alias("is_active"),
        "total_orders",
        "total_spent",
        "avg_order_value",
        "total_items_purchased",
        "days_since_last_purchase",
        orders.alias("purchase_frequency"),
        spent.alias("monetary_value"),
        c.bucket(since, [(30, "RECENT"), (90, "MODERATE"), (365, "DORMANT")], "LOST", inclusive=True).alias("recency_segment"),
        c.bucket(orders, [(10, "HIGH_FREQUENCY"), (5, "MEDIUM_FREQUENCY"), (2, "LOW_FREQUENCY")], "ONE_TIME", below=False).alias("frequency_segment"),
        c.bucket(spent, [(1000, "HIGH_VALUE"), (500, "MEDIUM_VALUE"), (100, "LOW_VALUE")], "MINIMAL_VALUE", below=False).alias("monetary_segment"),
        c.bucket(spent, [(10000, "VIP"), (5000, "HIGH_VALUE"), (1000, "REGULAR")], "OCCASIONAL", below=False).alias("customer_value_tier"),
        "data_quality_score",
        "ingestion_timestamp",
        _now(settings).alias("created_at"),
        _now(settings).alias("updated_at"),
    )
    return keyed(out, "customer_key", ["customer_id"], dense, only, parts)


FACT = (
    "date_key", "time_key", "product_key", "store_key", "customer_key", "order_id", "payment_method", "quantity_sold",
    "gross_sales_amount", "discount_amount", "net_sales_amount", "cost_amount", "profit_amount", "unit_price",
    "unit_cost", "profit_margin_pct", "discount_pct", "sale_timestamp", "source_system", "transaction_size_category",
    "discount_category", "quantity_category", "time_of_day", "day_type", "data_source", "data_quality_score",
    "created_at", "updated_at",
)


def dim_time(spark: SparkSession) -> DataFrame:
    """One row an hour."""
    h = F.col("id").cast("int")
    return spark.range(24).select(
        h.alias("sale_hour"), (h * 10000).alias("time_key"), c.day_part(h).alias("time_period"), h.between(9, 17).alias("business_hour_flag")
    )


#: What a sale of the fact is made from, and whether its discount is known; the rest follows (``amounts``, ``derived``, ``measures``).
CARRIED = (
    "order_id", "product_id", "store_id", "sale_date", "sale_timestamp", "quantity", "gross_amount", "discount_rate", "estimated_profit", "payment_method",
    "data_source", "data_quality_score", "created_at", "updated_at",
)


def amounts() -> dict[str, Column]:
    """What staging makes of a sale's gross amount, quantity and rate, for rows that carry these only."""
    gross, rate = F.col("gross_amount"), F.col("discount_rate")
    return {
        "unit_price": F.when(F.col("quantity") > 0, gross / F.col("quantity")).otherwise(0.0),
        "discount_amount": F.when(F.col("_discounted"), gross * rate),
        "net_amount": gross * (1 - rate),
    }


def sales_with_keys(
    unified: DataFrame, dates: DataFrame, products: DataFrame, stores: DataFrame, customers: DataFrame | None = None, told: tuple[str, ...] = ()
) -> DataFrame:
    """Sales with dimension keys: those with a date, a product and a store valid on that day, and a score of 80 or more.

    Versions are met on their business key with the range as a residual; the time key is a function of the hour and
    needs no join. Which sides are small enough to broadcast is left to the sizes Spark knows. Without ``customers`` the
    id is the customer's key: every sale that gets here makes its customer a row of that dimension. Stores are the
    customers' places under the customers' ids, so the keys of both are put together first and sales meet them once. What
    follows from other columns is left out, as these rows are dealt by each key. ``told``: what products say besides.
    """
    s = unified.where("data_quality_score >= 80").select(*CARRIED, F.col("discount_amount").isNotNull().alias("_discounted"))
    p = products.where("is_current").select("product_id", "product_key", F.col("effective_date").alias("p0"), F.col("expiration_date").alias("p1"), *told)
    t = stores.where("is_current").select("store_id", "store_key", F.col("effective_date").alias("t0"), F.col("expiration_date").alias("t1"))
    if customers is not None:
        t = t.join(customers.select(F.col("customer_id").alias("store_id"), "customer_key"), "store_id", "left")
    joined = (
        s.join(F.broadcast(dates.select(F.col("date_value").alias("sale_date"), "date_key")), "sale_date")  # a row a day
        .join(p, (s["product_id"] == p["product_id"]) & s["sale_date"].between(F.col("p0"), F.col("p1")))
        .join(t, (s["store_id"] == t["store_id"]) & s["sale_date"].between(F.col("t0"), F.col("t1")))
        .drop(p["product_id"], t["store_id"])
    )
    return joined.withColumn("customer_key", F.nullif("store_id", F.lit(""))) if customers is None else joined


def fact_sales_unkeyed(*tables: DataFrame, told: tuple[str, ...] = ()) -> DataFrame:
    """The fact without a number (see ``sales_with_keys``)."""
    return sales_with_keys(*tables, told=told).withColumns(amounts()).withColumns(derived()).withColumns(measures()).select("unified_sales_key", *FACT, *told)


def measures() -> dict[str, Column]:
    """What a sale adds to the fact besides its keys."""
    cost = F.col("unit_price") * F.col("quantity") - F.col("estimated_profit")
    return {
        "time_key": F.col("sale_hour") * 10000,
        "quantity_sold": F.col("quantity"),
        "gross_sales_amount": F.col("gross_amount"),
        "net_sales_amount": F.col("net_amount"),
        "cost_amount": cost,
        "profit_amount": F.col("estimated_profit"),
        "unit_cost": F.coalesce(cost, F.lit(0.0)),
        "discount_pct": F.col("discount_rate"),
        "source_system": F.col("data_source"),
    }


def natural_fact(unified: DataFrame) -> DataFrame:
    """The fact by business keys: product, store and customer ids stand for the numbers, which readers join.

    It needs no dimension, so what a sale gives depends on that sale alone.
    """
    s = unified.where("data_quality_score >= 80 and coalesce(customer_id, '') <> ''")
    keys = {"date_key": c.date_key("sale_date"), "product_key": F.col("product_id"), "store_key": F.col("store_id"), "customer_key": F.col("customer_id")}
    return s.withColumns(measures() | keys).select("unified_sales_key", *FACT)


def fact_sales(*tables: DataFrame, in_one_task: bool = False, slices: list[Column] | None = None) -> DataFrame:
    """The fact with ``sales_key`` 1..N by date and sale, numbered range by range (or in one task).

    Rows are written before they are numbered, so that what the joins shuffled is gone by then. ``slices``: ranges of
    ``sale_date``, from first to last, of which one is joined, ordered and written at a time.
    """
    number = dense_keys if in_one_task else ranged_keys
    key = {"unified_sales_key": F.unhex(derived()["unified_sales_key"])}  # in the same order, in half the bytes
    rows = sales_with_keys(*tables).withColumns(key).drop("store_id", "product_id", "p0", "p1", "t0", "t1")
    order = ["date_key", "unified_sales_key"]
    if slices and len(slices) > 1 and not in_one_task:
        keyed = ranged_keys(rows, "sales_key", order, slices, without=("unified_sales_key",))
    else:
        keyed = number(stored(rows, "fact"), "sales_key", order)
    return keyed.withColumns(amounts()).withColumns({x: v for x, v in derived().items() if x not in key}).withColumns(measures()).select("sales_key", *FACT)


def fact_for_reports(*tables: DataFrame, told: tuple[str, ...] = ()) -> DataFrame:
    """The fact with the unified key, unique too, as ``sales_key``: for readers that only count it.

    Nothing is sorted, numbered or written, and columns that a reader does not use are pruned to the sources.
    """
    return fact_sales_unkeyed(*tables, told=told).withColumnRenamed("unified_sales_key", "sales_key")


def fact_sales_daily(fact: DataFrame) -> DataFrame:
    """Sales by date, product and store: totals, mixes and tiers; ``daily_sales_key`` numbers them."""
    return ranged_keys(daily_unkeyed(fact), "daily_sales_key", ["date_key", "product_key", "store_key"])


def daily_of_sales(*tables: DataFrame, slices: list[Column]) -> DataFrame:
    """``fact_sales_daily`` straight from sales with their keys: the fact, whose rows it only sums, is neither numbered nor written.

    A group lies within a day, so each range of days in ``slices`` is joined, summed and written by itself.
    """
    sales = sales_with_keys(*tables).withColumns(amounts()).withColumns(derived()).withColumns(measures())
    daily = daily_unkeyed(sales, "sale_date", one_customer=True)
    return ranged_keys(daily, "daily_sales_key", ["date_key", "product_key", "store_key"], slices, without=("sale_date",))


def daily_unkeyed(fact: DataFrame, *also: str, one_customer: bool = False) -> DataFrame:
    """``also``: columns that follow from the day. ``one_customer``: stores are customers, so that a store has one at most and
    nothing is dealt to tell customers apart."""
    customers = F.max(F.col("customer_key").isNotNull().cast("long")) if one_customer else F.countDistinct("customer_key")
    yes = lambda x, *v: F.count_if(F.col(x).isin(*v))
    by = fact.groupBy("date_key", "product_key", "store_key", *also).agg(
        F.count("*").alias("transaction_count"),
        F.sum("quantity_sold").alias("total_quantity_sold"),
        c.money_sum("gross_sales_amount").alias("total_gross_sales"),
        c.money_sum("discount_amount").alias("total_discount_amount"),
        c.money_sum("net_sales_amount").alias("total_net_sales"),
        c.money_sum("cost_amount").alias("total_cost_amount"),
        c.money_sum("profit_amount").alias("total_profit_amount"),
        c.money_avg("net_sales_amount").alias("avg_transaction_size"),
        c.fraction_avg("profit_margin_pct").alias("avg_profit_margin_pct"),
        customers.alias("unique_customers"),
        F.count_if(F.col("discount_pct") > 0).alias("discounted_transactions"),
        yes("transaction_size_category", "LARGE", "EXTRA_LARGE").alias("large_transactions"),
        yes("quantity_category", "BULK_PURCHASE").alias("bulk_purchases"),
        F.avg("data_quality_score").alias("avg_data_quality_score"),
        yes("data_source", "STREAMING").alias("streaming_transactions"),
        yes("data_source", "BATCH").alias("batch_transactions"),
        *[yes("time_of_day", p).alias(f"{p.lower()}_transactions") for p in ("MORNING", "AFTERNOON", "EVENING", "NIGHT")],
        *[yes("payment_method", p).alias(f"{p.lower()}_transactions") for p in ("CREDIT_CARD", "CASH", "DIGITAL_WALLET")],
        F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
    )
    part = lambda p: F.col(f"{p.lower()}_transactions")
    most = F.greatest(*map(part, ("MORNING", "AFTERNOON", "EVENING", "NIGHT")))
    peak = F.when(part("AFTERNOON") == most, "AFTERNOON").when(part("EVENING") == most, "EVENING").when(part("MORNING") == most, "MORNING").otherwise("NIGHT")
    pct = lambda x: c.percent_of(x, "transaction_count")
    return by.where((F.col("transaction_count") >= 1) & (F.col("avg_data_quality_score") >= 70)).select(
        "date_key", "product_key", "store_key", *also, "transaction_count", "total_quantity_sold", "total_gross_sales",
        "total_discount_amount", "total_net_sales", "total_cost_amount", "total_profit_amount", "avg_transaction_size",
        "avg_profit_margin_pct", "unique_customers",
        "discounted_transactions", pct("discounted_transactions").alias("discount_penetration_pct"),
        "large_transactions", pct("large_transactions").alias("large_transaction_pct"),
        "bulk_purchases", pct("bulk_purchases").alias("bulk_purchase_pct"),
        "avg_data_quality_score", "streaming_transactions", "batch_transactions", pct("streaming_transactions").alias("streaming_mix_pct"),
        "morning_transactions", "afternoon_transactions", "evening_transactions", "night_transactions", peak.alias("peak_time_period"),
        "credit_card_transactions", "cash_transactions", "digital_wallet_transactions",
        pct("credit_card_transactions").alias("credit_card_pct"), pct("digital_wallet_transactions").alias("digital_wallet_pct"),
        c.bucket("total_net_sales", [(10000, "HIGH_PERFORMANCE"), (5000, "GOOD_PERFORMANCE"), (1000, "AVERAGE_PERFORMANCE")], "LOW_PERFORMANCE", below=False).alias("daily_performance_tier"),
        "created_at", "updated_at",
    )


def recent(df: DataFrame, day: str, settings: Settings = DEFAULT, days: int = 30) -> DataFrame:
    """Rows of the last ``days`` days by a date, timestamp or yyyyMMdd key column."""
    since = F.date_sub(F.lit(settings.as_of), days)
    kind = dict(df.dtypes)[day]
    return df.where(F.col(day) >= c.date_key(since) if kind in ("int", "bigint") else F.to_date(day) >= since)
