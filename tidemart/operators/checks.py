"""Data-quality checks: each returns the violating rows (or groups) as a DataFrame; none is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemart.operators.ranges import with_previous

# The patterns of an order id and of an e-mail address.
ORDER_ID = r"[A-Z]{2}-[0-9]{4,}"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def fails(condition: Column) -> Column:
    """True where the condition is false or unknown."""
    return ~F.coalesce(condition, F.lit(False))


# -- rows


def valid_date_range(df: DataFrame, column: str, low: date, high: date) -> DataFrame:
    """Rows outside the range, nulls included."""
    return df.where(fails(F.col(column).between(F.lit(low), F.lit(high))))


def valid_order_id_format(df: DataFrame, column: str, pattern: str = ORDER_ID) -> DataFrame:
    c = F.col(column)
    return df.where(c.isNull() | (F.length(c) < 5) | ~c.rlike(whole(pattern)))


def reasonable_sales_amount(df: DataFrame, column: str, low: float = 0, high: float = 1_000_000) -> DataFrame:
    return df.where(fails((F.col(column) >= low) & (F.col(column) <= high)))


def valid_profit_margin(df: DataFrame, sales: str, profit: str, low: float = -1, high: float = 1) -> DataFrame:
    """Rows with positive sales whose margin is outside the bounds."""
    margin = F.col(profit) / F.nullif(F.col(sales), F.lit(0.0))
    return df.where((F.col(sales) > 0) & ((margin < low) | (margin > high)))


def business_rule_compliance(df: DataFrame, rule: Column | str) -> DataFrame:
    """Rows that break the rule; where it is unknown it passes."""
    return df.where(~(F.expr(rule) if isinstance(rule, str) else rule))


def acceptable_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the bounds; nulls are skipped."""
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | ((c < low) if inclusive else (c <= low))
    if high is not None:
        bad = bad | ((c > high) if inclusive else (c >= high))
    return df.where(c.isNotNull() & bad)


def string_length(df: DataFrame, column: str, low: int | None = None, high: int | None = None) -> DataFrame:
    n = F.length(column)
    return acceptable_range(df.withColumn("_length", n), "_length", low, high).drop("_length")


def valid_email_format(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).rlike(whole(EMAIL)))


def ordered_ranges(df: DataFrame, low: str, high: str, include_nulls: bool = False) -> DataFrame:
    """Rows whose range is upside down; with ``include_nulls`` also those that lack an end."""
    bad = F.col(low) > F.col(high)
    return df.where(bad | F.col(low).isNull() | F.col(high).isNull() if include_nulls else bad)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def data_freshness(df: DataFrame, column: str, now: datetime, hours: int = 24) -> DataFrame:
    """The newest of the rows older than the limit."""
    return df.where(F.col(column) < F.lit(now - timedelta(hours=hours))).orderBy(F.desc(column)).limit(1)


# -- groups


def unique(df: DataFrame, *columns: str, where: Column | str | None = None) -> DataFrame:
    """Key values that occur more than once, with how often."""
    df = df.where(where) if where is not None else df
    return df.groupBy(*columns).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


unique_business_key = unique_combination = unique


def referential_integrity(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key no parent has."""
    keys = parent.where(F.col(parent_key).isNotNull()).select(F.col(parent_key).alias("_key")).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_key"), "left_anti")


relationships = referential_integrity


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Keys without a parent and how many rows have them."""
    found = referential_integrity(child, parent, child_key, parent_key)
    return found.groupBy(child_key).agg(F.count("*").alias("orphaned_records"))


def _before(df: DataFrame, order: list[str], column: str, partition: str | None) -> DataFrame:
    """``df`` with ``previous_date``, the column of the row before it in order, within a partition if there is one.

    Over ranges of the order, so neither a table without partitions nor a large partition is one task's.
    """
    keys = [partition] if partition else []
    out = with_previous(df, [*keys, *order], [*keys, column], "_before")
    before = F.col(f"_before.{column}")
    return out.withColumn("previous_date", F.when(F.col(f"_before.{partition}").eqNullSafe(F.col(partition)), before) if partition else before).drop("_before")


def date_steps(df: DataFrame, column: str, partition: str | None = None) -> DataFrame:
    """Distinct dates in order, each with the one before it and the days between."""
    keys = [partition] if partition else []
    days = _before(df.where(F.col(column).isNotNull()).select(*keys, column).distinct(), [column], column, partition)
    return days.withColumn("day_gap", F.datediff(F.col(column), F.col("previous_date")))


def sequential_dates(df: DataFrame, column: str, partition: str | None = None, max_gap: int = 1) -> DataFrame:
    """Dates that come more than ``max_gap`` days after the one before."""
    return date_steps(df, column, partition).where(F.col("day_gap") > max_gap)


def disordered_dates(df: DataFrame, column: str, order: str | list[str], partition: str | None = None) -> DataFrame:
    """Rows whose date lies before that of the row before them in ``order``, which should leave no ties."""
    order = [order] if isinstance(order, str) else order
    return _before(df, order, column, partition).where(F.col(column) < F.col("previous_date"))


def cross_model_consistency(a: DataFrame, b: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of both with equal keys that differ in a column."""
    left = a.select(*on, *[F.col(c).alias(f"{c}_a") for c in columns])
    right = b.select(*on, *[F.col(c).alias(f"{c}_b") for c in columns])
    differs = F.lit(False)
    for c in columns:
        differs = differs | (F.col(f"{c}_a") != F.col(f"{c}_b"))
    return left.join(right, list(on)).where(differs)


def consistent_aggregation(
    detail: DataFrame, stored: DataFrame, keys: Sequence[str], value: str, total: str, kind: str = "sum", tolerance: float = 0.01
) -> DataFrame:
    """Groups whose aggregate of the detail is not what is stored."""
    amount = F.col(value)
    made = {
        "sum": F.sum(amount.cast("decimal(18,4)")).cast("double"),
        "avg": F.sum(amount.cast("decimal(18,4)")).cast("double") / F.count(amount),
        "count": F.count(amount),
        "min": F.min(amount),
        "max": F.max(amount),
    }[kind]
    again = detail.groupBy(*keys).agg(made.alias("calculated"))
    kept = stored.select(*keys, F.col(total).alias("stored"))
    both = again.join(kept, list(keys), "full_outer")
    gap = F.abs(F.coalesce("calculated", F.lit(0)) - F.coalesce("stored", F.lit(0)))
    return both.where(gap > tolerance)


def overlapping_versions(df: DataFrame, key: str, effective: str, expires: str, tie: str) -> DataFrame:
    """(key, issue_count): ordered pairs of a key's rows whose ranges overlap; ``tie`` tells a key's rows apart.

    A sweep along the days: a row that begins overlaps those that have begun and not ended, days being inclusive, so a
    key with many overlapping rows costs no more than their sort. Rows that end before they begin overlap only rows that
    contain both days; they are few, and compared with their key's rows.
    """
    e, x = F.col(effective), F.col(expires)
    starts = F.struct(e.alias("day"), F.lit(0).alias("ends"))
    ends = F.struct(x.alias("day"), F.lit(1).alias("ends"))
    days = df.where(e <= x).select(key, F.explode(F.array(starts, ends)).alias("at")).select(key, "at.*")
    earlier = Window.partitionBy(key).orderBy("day", "ends").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum(1 - 2 * F.col("ends")).over(earlier), F.lit(0))
    swept = days.withColumn("_open", opened).where("ends = 0").groupBy(key).agg((2 * F.sum("_open")).alias("issue_count"))
    down = df.where(e > x).select(F.col(key).alias("_key"), F.col(tie).alias("_tie"), e.alias("_from"), x.alias("_to"))
    within = (F.col(key) == F.col("_key")) & (F.col(tie) != F.col("_tie")) & (e <= F.col("_to")) & (F.col("_from") <= x)
    others = df.where(e <= x).join(down, within).groupBy(key).agg((2 * F.count("*")).alias("issue_count"))
    return swept.unionByName(others).groupBy(key).agg(F.sum("issue_count").alias("issue_count")).where("issue_count > 0")


def version_gaps(df: DataFrame, key: str, effective: str, expires: str, end: date) -> DataFrame:
    """(key, issue_count): closed rows that no row of the key follows the day after, one each."""
    nxt = df.select(F.col(key).alias("_key"), F.col(effective).alias("_from")).distinct()
    closed = df.where(F.col(expires) != F.lit(end))
    left = closed.join(nxt, (F.col(key) == F.col("_key")) & (F.date_add(expires, 1) == F.col("_from")), "left_anti")
    return left.select(key, F.lit(1).cast("long").alias("issue_count"))


def multiple_current(df: DataFrame, key: str, current: str = "is_current") -> DataFrame:
    return df.where(F.col(current)).groupBy(key).agg(F.count("*").alias("issue_count")).where("issue_count > 1")


def scd2_integrity(df: DataFrame, key: str, effective: str, expires: str, current: str, tie: str) -> DataFrame:
    """(business_key, issue_type, issue_count) of overlaps, several current rows and upside-down ranges."""
    told = lambda x, issue: x.select(F.col(key).cast("string").alias("business_key"), F.lit(issue).alias("issue_type"), "issue_count")
    wrong = df.where(F.col(effective) > F.col(expires)).groupBy(key).agg(F.count("*").alias("issue_count"))
    return (
        told(overlapping_versions(df, key, effective, expires, tie), "OVERLAPPING_PERIODS")
        .unionByName(told(multiple_current(df, key, current), "MULTIPLE_CURRENT"))
        .unionByName(told(wrong, "INVALID_DATE_RANGE"))
    )


# -- whole tables: one row if the check fails


def null_rate(df: DataFrame, column: str, most: float = 0.05) -> DataFrame:
    out = df.agg(F.count("*").alias("total_rows"), F.count_if(F.col(column).isNull()).alias("null_rows"))
    return out.withColumn("null_rate", F.col("null_rows") / F.nullif(F.col("total_rows"), F.lit(0))).where(F.col("null_rate") > most)


def data_distribution(df: DataFrame, column: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """The share of distinct values, if out of bounds."""
    out = df.agg(F.count(column).alias("total_count"), F.countDistinct(column).alias("distinct_count"))
    out = out.withColumn("uniqueness_ratio", F.col("distinct_count") / F.nullif(F.col("total_count"), F.lit(0)))
    return out.where((F.col("uniqueness_ratio") < low) | (F.col("uniqueness_ratio") > high))


def reasonable_cardinality(df: DataFrame, column: str, low=None, high=None, low_pct=None, high_pct=None) -> DataFrame:
    out = df.agg(F.count("*").alias("total_count"), F.countDistinct(column).alias("distinct_count"))
    out = out.withColumn("distinct_pct", 100.0 * F.col("distinct_count") / F.nullif(F.col("total_count"), F.lit(0)))
    bad = F.lit(False)
    for bound, c, under in ((low, "distinct_count", True), (high, "distinct_count", False), (low_pct, "distinct_pct", True), (high_pct, "distinct_pct", False)):
        if bound is not None:
            bad = bad | ((F.col(c) < bound) if under else (F.col(c) > bound))
    return out.where(bad)


def row_count_stability(df: DataFrame, low: int = 1, high: int | None = None) -> DataFrame:
    bad = F.col("row_count") < low
    return df.agg(F.count("*").alias("row_count")).where(bad if high is None else bad | (F.col("row_count") > high))


def model_performance(df: DataFrame, high: int = 10_000_000) -> DataFrame:
    """Whether a model is empty or too large."""
    issue = F.when(F.col("row_count") == 0, "EMPTY_MODEL").when(F.col("row_count") > high, "TOO_MANY_ROWS")
    return df.agg(F.count("*").alias("row_count")).withColumn("issue", issue).where("issue is not null")


def join_efficiency(df: DataFrame, high: int = 1_000_000) -> DataFrame:
    """More rows than a join should give suggest a product of tables."""
    return df.agg(F.count("*").alias("row_count")).where(F.col("row_count") > high)


def clustering_effectiveness(df: DataFrame, *columns: str, most: float = 0.8, rows: int = 10_000) -> DataFrame:
    """Clustering keys that are nearly unique group nothing."""
    out = df.agg(F.count("*").alias("total_rows"), F.countDistinct(*columns).alias("distinct_values"))
    out = out.withColumn("cardinality_ratio", F.col("distinct_values") / F.nullif(F.col("total_rows"), F.lit(0)))
    return out.where((F.col("cardinality_ratio") > most) & (F.col("total_rows") > rows))


def model_dependencies(spark: SparkSession, models: dict) -> DataFrame:
    """Models that read what nobody makes; a circle is an error. Empty if all is well."""
    from tidemart.plans.registry import build_order

    build_order(models)
    missing = sorted((n, r) for n, (reads, _) in models.items() for r in reads if r not in models and r != "silver")
    return spark.createDataFrame(missing, "model string, missing string")


def incremental_efficiency(df: DataFrame, column: str, as_of: date, days: int = 7) -> DataFrame:
    """What the last days hold: rows, first, last and distinct dates."""
    recent = df.where(F.col(column) >= F.lit(as_of - timedelta(days=days)))
    return recent.agg(
        F.count("*").alias("row_count"), F.min(column).alias("first_date"), F.max(column).alias("last_date"), F.countDistinct(column).alias("distinct_dates")
    )


def model_freshness(df: DataFrame, column: str, now: datetime, hours: int = 24) -> DataFrame:
    newest = df.agg(F.max(column).alias("last_update"))
    stale = F.col("last_update").isNull() | (F.col("last_update") < F.lit(now - timedelta(hours=hours)))
    return newest.withColumn("freshness", F.when(stale, "STALE").otherwise("FRESH"))


def source_freshness(df: DataFrame, column: str, now: datetime, warn_hours: float = 2, error_hours: float = 6) -> DataFrame:
    """pass, warn or error by the age of the newest row; no rows are an error."""
    newest = df.agg(F.max(column).alias("max_loaded_at"))
    at = F.col("max_loaded_at")
    status = (
        F.when(at.isNull() | (at < F.lit(now - timedelta(hours=error_hours))), "error")
        .when(at < F.lit(now - timedelta(hours=warn_hours)), "warn")
        .otherwise("pass")
    )
    return newest.withColumn("status", status)


def business_day_freshness(df: DataFrame, column: str, as_of: date, days: int = 1) -> DataFrame:
    """The newest row, if older than ``days`` (two more on weekends)."""
    limit = as_of - timedelta(days=days + (2 if as_of.weekday() >= 5 else 0))
    newest = df.agg(F.max(column).cast("date").alias("last_date"))
    return newest.where(F.col("last_date").isNull() | (F.col("last_date") < F.lit(limit)))


def resource_usage(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).withColumn("estimated_units", F.col("row_count") / 1e6)


# -- many at once


def fused(df: DataFrame, rules: dict[str, Column], **labels: str) -> DataFrame:
    """(labels..., rule, violation_count) for row-level rules over one table, from a single scan.

    ``rules``: what is true of a violating row, by name.
    """
    counts = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, bad in enumerate(rules.values())])
    pairs = ", ".join(f"'{name}', _{i}" for i, name in enumerate(rules))
    out = counts.select(F.expr(f"stack({len(rules)}, {pairs}) as (rule, violation_count)"))
    return out.select(*[F.lit(v).alias(k) for k, v in labels.items()], "rule", "violation_count")


def suite(checks: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(check_name, severity, violation_count, passed) of checks given as name: (violations, severity)."""
    out = None
    for name, (found, severity) in checks.items():
        one = found.agg(F.count("*").alias("violation_count")).select(
            F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "violation_count", (F.col("violation_count") == 0).alias("passed")
        )
        out = one if out is None else out.unionByName(one)
    return out
