"""Suites of checks over the models: business rules, dimensional integrity, versions, daily totals, completeness."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.config import DEFAULT, Settings
from tidemart.functions import columns as c
from tidemart.operators import checks as q
from tidemart.plans.registry import Warehouse
from tidemart.sources.scratch import stored, stored_parts

# The bounds of the business rules.
MARGIN_LOW, MARGIN_HIGH = -35.0, 0.95
DAILY_LOW, DAILY_HIGH = 1_000, 1_000_000
LOSS = 1.05

GRAIN = ["date_key", "product_key", "store_key"]


def _rows(df: DataFrame, layer: str, rule: str, model: str) -> DataFrame:
    return df.select(F.lit(layer).alias("layer"), F.lit(rule).alias("rule_type"), F.lit(model).alias("model_name"), F.col("n").cast("long").alias("violation_count"))


def _fused(df: DataFrame, layer: str, model: str, rules: dict) -> DataFrame:
    found = q.fused(df, rules)
    return found.select(F.lit(layer).alias("layer"), F.col("rule").alias("rule_type"), F.lit(model).alias("model_name"), "violation_count")


def _bad_versions(settings: Settings):
    open_ended = F.col("expiration_date") == F.lit(settings.scd2_end)
    return (F.col("effective_date") > F.col("expiration_date")) | (F.col("is_current") & ~open_ended) | (~F.col("is_current") & open_ended)


def daily_variance(w: Warehouse) -> DataFrame:
    """Daily rows beside the sum of their sales."""
    again = w["fact_sales"].groupBy(*GRAIN).agg(c.money_sum("net_sales_amount").alias("detail"))
    return w["fact_sales_daily"].join(again, GRAIN, "left").withColumn("variance", F.abs(F.col("total_net_sales") - F.coalesce("detail", F.lit(0.0))))


def _counted(df: DataFrame, wrong: Column, days: list[Column] | None) -> DataFrame:
    """``n``, the number of daily rows that are wrong; of ``days`` one range at a time, if there are any."""
    one = lambda rows: rows.agg(F.count_if(wrong).alias("n"))
    if not days:
        return one(df)
    return stored_parts((one(df.where(some)) for some in days), "counts").agg(F.sum("n").alias("n"))


def _united(checks: list[DataFrame], apart: bool) -> DataFrame:
    """The findings of all checks, each of which is made and written by itself if they are kept ``apart``."""
    return reduce(DataFrame.unionByName, [stored(x, "found") if apart else x for x in checks])


def business_rules(w: Warehouse, settings: Settings = DEFAULT, days: list[Column] | None = None) -> DataFrame:
    """(layer, rule_type, model_name, violation_count) of the rules that are broken.

    Row-level rules of a table are counted in one scan of it. ``days``: ranges of ``date_key`` of which daily rows are
    checked one at a time; then all else is done one after the other too.
    """
    stg, uni, fact, daily = w["stg_sales"], w["int_sales_unified"], w["fact_sales"], w["fact_sales_daily"]
    amount = F.col("net_amount")
    size = F.col("transaction_size_category")
    margin = c.ratio(F.col("profit_amount"), F.col("net_sales_amount"))
    spent, tier = F.col("total_spent"), F.col("customer_value_tier")
    dow, off = F.col("day_of_week"), F.col("is_weekend")
    staging = _fused(
        stg,
        "STAGING",
        "stg_sales",
        {
            "INVALID_DISCOUNT_RATES": (F.col("discount_rate") < 0) | (F.col("discount_rate") > 1),
            "AMOUNT_CALCULATION_ERROR": (F.abs(F.col("gross_amount") - F.col("quantity") * F.col("unit_price")) > 0.01)
            | (F.abs(amount - (F.col("gross_amount") - F.col("discount_amount"))) > 0.01),
            "INCORRECT_QUALITY_SCORE": (F.col("data_quality_score") < 70)
            | (
                (F.col("data_quality_score") == 100)
                & (
                    F.col("order_id").isNull() | F.col("customer_id").isNull() | F.col("product_id").isNull()
                    | (F.col("quantity") <= 0) | (F.col("unit_price") <= 0) | F.col("sale_date").isNull()
                )
            ),
        },
    )
    week, day = settings.as_of - timedelta(days=7), settings.as_of - timedelta(days=1)
    size_off = (
        ((size == "SMALL") & (amount >= 50))
        | ((size == "MEDIUM") & ((amount < 50) | (amount >= 200)))
        | ((size == "LARGE") & ((amount < 200) | (amount >= 500)))
        | ((size == "EXTRA_LARGE") & (amount < 500))
    )
    middle = uni.agg(
        (F.count("*") - F.countDistinct("order_id", "product_id", "data_source")).alias("repeated"),
        F.count_if(size_off).alias("size_off"),
        F.count_if(F.col("sale_date") >= F.lit(week)).alias("a"),
    )
    versions = [_fused(w[m], "INTERMEDIATE", m, {"INVALID_SCD2_DATES": _bad_versions(settings)}) for m in ("int_product_scd2", "int_store_scd2")]
    dated = fact.join(w["dim_date"].select("date_key", "date_value"), "date_key", "left")
    facts = dated.agg(
        F.count_if(F.col("date_value").isNull()).alias("lost"),
        F.count_if((margin > MARGIN_HIGH) | (margin < MARGIN_LOW)).alias("margin_off"),
        F.count_if(F.col("date_value") >= F.lit(week)).alias("b"),
        c.money_sum(F.when(F.col("date_value") == F.lit(day), F.col("net_sales_amount"))).alias("s"),
    )
    once = middle.crossJoin(facts)  # two single rows, from one pass over each table
    named = [
        ("INTERMEDIATE", "DUPLICATE_UNIFIED_RECORDS", "int_sales_unified", F.col("repeated")),
        ("INTERMEDIATE", "INCORRECT_SIZE_CATEGORY", "int_sales_unified", F.col("size_off")),
        ("MARTS", "BROKEN_REFERENTIAL_INTEGRITY", "fact_sales", F.col("lost")),
        ("MARTS", "UNREALISTIC_PROFIT_MARGINS", "fact_sales", F.col("margin_off")),
        ("CROSS_LAYER", "DATA_LOSS_IN_PIPELINE", "staging_to_facts", F.when(F.col("a") > F.col("b") * LOSS, F.col("a") - F.col("b")).otherwise(0)),
        ("CROSS_LAYER", "METRIC_OUT_OF_RANGE", "daily_sales_volume", F.when((F.col("s") < DAILY_LOW) | (F.col("s") > DAILY_HIGH), 1).otherwise(0)),
    ]
    single = [F.struct(*[F.lit(x).alias(n) for x, n in zip(r[:3], ("layer", "rule_type", "model_name"), strict=True)], r[3].cast("long").alias("violation_count")) for r in named]
    single = once.select(F.explode(F.array(*single)).alias("r")).select("r.*")
    tiers = _fused(
        w["dim_customer"],
        "MARTS",
        "dim_customer",
        {
            "INCORRECT_CUSTOMER_TIERS": ((tier == "VIP") & (spent < 10000))
            | ((tier == "HIGH_VALUE") & ((spent < 5000) | (spent >= 10000)))
            | ((tier == "REGULAR") & ((spent < 1000) | (spent >= 5000)))
            | ((tier == "OCCASIONAL") & (spent >= 1000))
        },
    )
    calendar = _fused(
        w["dim_date"],
        "MARTS",
        "dim_date",
        {
            "DATE_DIMENSION_LOGIC_ERROR": (off != dow.isin(0, 6))
            | ~F.col("quarter").between(1, 4) | ~F.col("month_number").between(1, 12) | ~dow.between(0, 6)
        },
    )
    sums = _counted(daily_variance(w), F.col("variance") > 0.01, days)
    found = [staging, single, *versions, tiers, calendar, _rows(sums, "MARTS", "DAILY_AGGREGATION_ERROR", "fact_sales_daily")]
    return _united(found, bool(days))


def broken(rules: DataFrame) -> DataFrame:
    """The rules with violations: most first, then by layer and rule."""
    return rules.where("violation_count > 0").orderBy(F.desc("violation_count"), "layer", "rule_type", "model_name")


def dimensional_integrity(w: Warehouse, days: list[Column] | None = None) -> DataFrame:
    """(table_name, issue_type, issue_count), all tests. ``days``: see ``business_rules``."""
    fact = w["fact_sales"]
    one = lambda df, table, issue: df.select(F.lit(table).alias("table_name"), F.lit(issue).alias("issue_type"), F.col("n").alias("issue_count"))
    count = lambda df: df.agg(F.count("*").alias("n"))
    keys = {"dim_date": "date_key", "dim_product": "product_key", "dim_store": "store_key", "dim_customer": "customer_key"}
    out = [one(count(w[d].where(F.col(k).isNull())), d, "MISSING_SURROGATE_KEYS") for d, k in keys.items()]
    for d, k in (("dim_product", "product_id"), ("dim_store", "store_id")):
        out.append(one(count(q.multiple_current(w[d], k)), d, "MULTIPLE_CURRENT_RECORDS"))
    for d, k in (("dim_product", "product_key"), ("dim_store", "store_key"), ("dim_date", "date_key")):
        out.append(one(count(q.referential_integrity(fact, w[d], k, k)), "fact_sales", f"ORPHANED_{k.upper()}"))
    rules = {
        "NULL_MEASURES": F.col("quantity_sold").isNull() | F.col("net_sales_amount").isNull() | F.col("profit_amount").isNull(),
        "INVALID_MEASURES": (F.col("quantity_sold") <= 0) | (F.col("net_sales_amount") <= 0),
    }
    measures = q.fused(fact, rules)
    out.append(measures.select(F.lit("fact_sales").alias("table_name"), F.col("rule").alias("issue_type"), F.col("violation_count").alias("issue_count")))
    out.append(one(_counted(daily_variance(w), F.col("variance") > 0.01, days), "fact_sales_daily", "AGGREGATION_MISMATCH"))
    out.append(one(_counted(w["fact_sales_daily"], F.col("unique_customers") > F.col("transaction_count"), days), "fact_sales_daily", "IMPOSSIBLE_AGGREGATIONS"))
    return _united(out, bool(days))


def version_integrity(w: Warehouse, settings: Settings = DEFAULT) -> DataFrame:
    """(dimension_type, issue_type, business_key, issue_count) of overlaps, gaps and several current versions."""
    out = None
    for kind, model, key, tie in (("PRODUCT", "int_product_scd2", "product_id", "product_scd2_key"), ("STORE", "int_store_scd2", "store_id", "store_scd2_key")):
        df = w[model]
        found = {
            "OVERLAPPING_DATES": q.overlapping_versions(df, key, "effective_date", "expiration_date", tie),
            "DATE_GAPS": q.version_gaps(df, key, "effective_date", "expiration_date", settings.scd2_end),
            "MULTIPLE_CURRENT": q.multiple_current(df, key),
        }
        for issue, rows in found.items():
            one = rows.select(F.lit(kind).alias("dimension_type"), F.lit(issue).alias("issue_type"), F.col(key).alias("business_key"), "issue_count")
            out = one if out is None else out.unionByName(one)
    return out


def daily_accuracy(w: Warehouse, settings: Settings = DEFAULT, days: int = 7, tolerance: float = 0.01) -> DataFrame:
    """Daily rows of the last days that do not follow from their sales."""
    since = F.col("date_key") >= c.date_key(F.lit(settings.as_of - timedelta(days=days)))
    detail = w["fact_sales"].where(since).groupBy(*GRAIN).agg(
        F.count("*").alias("expected_transaction_count"),
        c.money_sum("net_sales_amount").alias("expected_net_sales"),
        F.countDistinct("customer_key").alias("expected_unique_customers"),
    )
    stored = w["fact_sales_daily"].where(since).select(*GRAIN, "transaction_count", "total_net_sales", "unique_customers")
    z = lambda x: F.coalesce(x, F.lit(0))
    both = detail.join(stored, GRAIN, "left").withColumns(
        {
            "transaction_diff": F.abs(F.col("expected_transaction_count") - z("transaction_count")),
            "sales_diff": F.abs(F.col("expected_net_sales") - z("total_net_sales")),
            "customer_diff": F.abs(F.col("expected_unique_customers") - z("unique_customers")),
        }
    )
    return both.where((F.col("transaction_diff") > 0) | (F.col("sales_diff") > tolerance) | (F.col("customer_diff") > 0))


def completeness(w: Warehouse, settings: Settings = DEFAULT, days: int = 7) -> DataFrame:
    """By day: how many of the unified records and orders the fact has, in percent."""
    since = F.lit(settings.as_of - timedelta(days=days))
    staged = w["int_sales_unified"].where(F.col("sale_date") >= since).groupBy("sale_date").agg(
        F.count("*").alias("staging_record_count"), F.countDistinct("order_id").alias("staging_order_count")
    )
    dates = w["dim_date"].where(F.col("date_value") >= since).select("date_key", F.col("date_value").alias("sale_date"))
    recent = w["fact_sales"].where(F.col("date_key") >= c.date_key(since))  # as the dates say, but met before its joins
    told = recent.join(dates, "date_key").groupBy("sale_date").agg(
        F.count("*").alias("fact_record_count"), F.countDistinct("order_id").alias("fact_order_count")
    )
    both = staged.join(told, "sale_date", "left").na.fill(0, ["fact_record_count", "fact_order_count"])
    pct = lambda a, b: F.round((100 * F.col(a).cast("decimal(18,4)") / F.nullif(F.col(b), F.lit(0))).cast("decimal(18,6)"), 2).cast("double")
    return both.withColumns(
        {
            "record_completeness_pct": pct("fact_record_count", "staging_record_count"),
            "order_completeness_pct": pct("fact_order_count", "staging_order_count"),
        }
    )


def incomplete(w: Warehouse, settings: Settings = DEFAULT, least: float = 85) -> DataFrame:
    return completeness(w, settings).where((F.col("record_completeness_pct") < least) | (F.col("order_completeness_pct") < least))
