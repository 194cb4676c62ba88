"""History from changes that come late, out of order, or delete: the same for any order and grouping of the batches.

What is kept is a point for each key and day on which something was told, even if it told what held already: a change that
lands before it may make it matter. The ranges follow from the points.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidemart.operators.ranges import with_previous


def add_changes(points: DataFrame | None, changes: DataFrame, keys: tuple[str, ...], attributes: tuple[str, ...]) -> DataFrame:
    """The points after more changes: (keys, changed_on, seq, deleted, attributes).

    Of what was told of a key for one day the highest ``seq`` holds, whenever it came (equal ones: the largest in all
    columns). One aggregation with partial maxima, so a key may have any number of changes. Changes without a key or day
    tell nothing.
    """
    columns = [*keys, "changed_on", "seq", "deleted", *attributes]
    new = changes.where(F.col("changed_on").isNotNull()).dropna(subset=list(keys)).select(*columns)
    all_ = new if points is None else points.select(*columns).unionByName(new)
    told = F.max(F.struct("seq", "deleted", *attributes)).alias("_told")
    return all_.groupBy(*keys, "changed_on").agg(told).select(*keys, "changed_on", "_told.*")


def history(points: DataFrame, key: str, attributes: tuple[str, ...], end: date) -> DataFrame:
    """(key, attributes, effective_date, expiration_date, is_current): the ranges between points that change something.

    A deletion ends a range and begins none. Points are read along ranges of (key, day), so a key may have any number.
    """
    state = F.when(~F.col("deleted"), F.struct(*attributes))  # null while deleted
    told = points.select(key, "changed_on", state.alias("_state"), *attributes)
    seen = with_previous(told, [key, "changed_on"], [key, "_state"], "_before")
    first = ~F.coalesce(F.col(f"_before.{key}") == F.col(key), F.lit(False))
    steps = seen.where(F.when(first, F.col("_state").isNotNull()).otherwise(~F.col("_before._state").eqNullSafe(F.col("_state")))).drop("_before")
    steps = steps.withColumn("_back", -F.unix_date("changed_on"))
    ends = with_previous(steps, [key, "_back"], [key, "changed_on"], "_after")
    following = F.when(F.col(f"_after.{key}") == F.col(key), F.col("_after.changed_on"))
    return ends.where(F.col("_state").isNotNull()).select(
        key,
        *attributes,
        F.col("changed_on").alias("effective_date"),
        F.coalesce(F.date_sub(following, 1), F.lit(end)).alias("expiration_date"),
        following.isNull().alias("is_current"),
    )
