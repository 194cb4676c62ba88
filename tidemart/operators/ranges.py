"""Ordered work without a single-task window.

Rows are dealt to ranges of the order, sorted and written once, so that a recomputed task cannot deal them differently.
What crosses the ends of ranges (how many rows came before, the last row of the range before) goes through a table with
a row for each range, which is joined. Rows with equal keys share a range, so an order with few values needs columns
that break ties.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.sources.scratch import delete, shared_dir, stored, stored_parts


def named(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def row_tie(df: DataFrame) -> Column:
    """A hash of the whole row, so that rows with equal keys have an order of their own; maps cannot be hashed and are left out."""
    return F.xxhash64(*named([c for c, kind in df.dtypes if "map<" not in kind and kind not in ("variant", "void")]))


def ranged(
    df: DataFrame, order: list[str | Column], ranges: int | None = None, slices: list[Column] | None = None, without: tuple[str, ...] = ()
) -> DataFrame:
    """The rows in order: ``_part`` numbers the range, ``_at`` rises along the whole order (with gaps between ranges).

    ``slices``: conditions that follow each other in the order; the rows of one at a time are made and written, then dealt:
    what making them shuffled is gone by then, and finding the ranges does not make them again.
    ``without``: columns of the order that are not written, as nobody reads them.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(rows: DataFrame, first: int) -> DataFrame:
        at = F.monotonically_increasing_id() + F.lit(first * ranges << 33).cast("long")
        return rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_at", at).drop(*without)

    def kept(rows: DataFrame, first: int) -> DataFrame:
        made = f"{shared_dir(rows.sparkSession)}/slice-{uuid.uuid4().hex}"
        out = stored_parts([dealt(stored(rows, "rows", made), first)], "ranges")
        delete(rows.sparkSession, made)
        return out

    parts = [kept(df.where(some), i) for i, some in enumerate(slices)] if slices else [stored_parts([dealt(df, 0)], "ranges")]
    return reduce(DataFrame.unionByName, parts).withColumn("_part", F.shiftright("_at", 33))


def numbered(
    df: DataFrame, name: str, order: list[str], group: list[str] | None = None, start: int = 0, slices: list[Column] | None = None, without: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with ``name``, each row's number from ``start`` in the order given, counted anew in each group.

    A group may hold any share of the rows and none has to fit a task. Rows equal in the whole order take any of their
    numbers. ``slices``, ``without``: see ``ranged``.
    """
    group = group or []
    dealt = ranged(df, [*group, *order], slices=slices, without=without)
    counts = dealt.groupBy("_part", *group).agg(F.count("*").alias("_rows"), F.min("_at").alias("_from"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_from") + start
    # a row for each range, and one more for each group that starts within one
    shifts = counts.select(F.col("_part").alias("_in"), shift.alias("_shift"), *[F.col(g).alias(f"_of_{g}") for g in group])
    same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group], F.col("_part") == F.col("_in"))
    out = dealt.join(F.broadcast(shifts), same)
    return out.select(*named([c for c in df.columns if c not in without]), (F.col("_at") + F.col("_shift")).alias(name))


def with_previous(df: DataFrame, order: list[str], carried: list[str], name: str = "previous") -> DataFrame:
    """``df`` with ``name``, a struct of the ``carried`` columns of the row before; null in the first row of all."""
    dealt = ranged(df, order)
    along = Window.partitionBy("_part").orderBy("_at")
    lasts = dealt.groupBy("_part").agg(F.max_by(F.struct(*carried), "_at").alias("_last"))
    # a row for each range that has rows: the last row of the one before
    handed = lasts.select(F.col("_part").alias("_in"), F.lag("_last").over(Window.orderBy("_part")).alias("_handed"))
    out = dealt.withColumn(name, F.lag(F.struct(*carried)).over(along))
    out = out.join(F.broadcast(handed), F.col("_part") == F.col("_in"), "left")
    return out.select(*named(df.columns), F.coalesce(name, "_handed").alias(name))
