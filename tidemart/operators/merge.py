"""MERGE on DataFrames: newer rows update the listed columns, new keys are inserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.operators.silver import assert_unique
from tidemart.schemas import MERGE_SET


def aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """The source in the target's columns and types: what it lacks is null, what the target lacks goes."""
    has = set(source.columns)
    return source.select(
        *[(F.col(f.name) if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema]
    )


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: tuple[str, ...] = ("order_id", "product_id"),
    newer_by: str = "processing_timestamp",
    update: tuple[str, ...] = MERGE_SET,
    check: bool = False,
) -> DataFrame:
    """The target after the merge, from one full outer join on the keys.

    A matched row takes the source's ``update`` columns if the source is strictly newer, else it stays; a key that only
    the source has is inserted whole. With ``check`` a source with repeated keys is an error (a count before the join).
    """
    if check:
        assert_unique(source, *keys)
    source = aligned(source, target)
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_in_source"))
    t = target.withColumn("_in_target", F.lit(True))
    on = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    joined = t.join(s, on, "full_outer")
    inserted = F.col("_in_target").isNull()
    newer = F.col("_in_source") & (F.col(f"_s_{newer_by}") > F.col(newer_by))
    settable = set(update)
    out = []
    for c in target.columns:
        take = inserted | F.coalesce(newer, F.lit(False)) if c in settable else inserted
        out.append(F.when(take, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def track_changes(
    history: DataFrame, current: DataFrame, keys: tuple[str, ...], attributes: tuple[str, ...], on_day, end
) -> DataFrame:
    """History after a day's snapshot: changed rows are closed the day before and opened anew, new keys are opened.

    ``history`` has the keys, the attributes, effective_date, expiration_date and is_current; keys that the snapshot
    lacks stay as they are; a row opened the same day is replaced. One hash of the attributes decides what has changed.
    """
    digest = lambda: F.md5(F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}))
    day, last = F.lit(on_day).cast("date"), F.lit(end).cast("date")
    new = current.select(*keys, F.struct(*attributes).alias("_new"), digest().alias("_new_digest"))
    old = history.withColumn("_digest", digest())
    live = old.where("is_current").join(new, list(keys), "left")
    changed = F.col("_new_digest").isNotNull() & (F.col("_new_digest") != F.col("_digest"))
    today = F.col("effective_date") >= day
    columns = [*keys, *attributes, "effective_date", "expiration_date", "is_current"]
    kept = live.where(~changed).select(*columns)
    closed = live.where(changed & ~today).select(
        *keys, *attributes, "effective_date", F.date_sub(day, 1).alias("expiration_date"), F.lit(False).alias("is_current")
    )
    reopened = live.where(changed).select(*keys, "_new.*", day.alias("effective_date"), last.alias("expiration_date"), F.lit(True).alias("is_current"))
    first = new.join(old.where("is_current").select(*keys), list(keys), "left_anti").select(
        *keys, "_new.*", day.alias("effective_date"), last.alias("expiration_date"), F.lit(True).alias("is_current")
    )
    past = old.where("not is_current").select(*columns)
    return past.unionByName(kept).unionByName(closed).unionByName(reopened).unionByName(first)
