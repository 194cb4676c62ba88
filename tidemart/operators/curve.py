"""Clustering by several columns at once, so that files can be skipped by a filter on any of them.

Each column becomes its place among cuts that split the rows evenly, and the bits of the places take turns in one number.
Rows are ranged by that number, rows with the same number by a hash, so files are of even size however few values the
columns have. The cuts come from a bounded sample: it shapes the layout, never the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.operators.ranges import named, row_tie
from tidemart.sources.scratch import stored

BITS = 8  #: of each column's place
SAMPLE_ROWS = 40_000  #: about as many rows are sampled


def cuts(df: DataFrame, columns: list[str], rows: int, bits: int = BITS) -> DataFrame:
    """One row: for each column an ascending array of ``2 ** bits - 1`` values that split the sampled rows evenly."""
    sample = df.select(*named(columns)) if rows <= SAMPLE_ROWS else df.select(*named(columns)).sample(SAMPLE_ROWS / rows, seed=7)
    kept = sample.agg(*[F.sort_array(F.collect_list(F.col(f"`{c}`"))).alias(f"_sorted_{i}") for i, c in enumerate(columns)])
    kept = stored(kept, "sample")  # written, so that a task that runs again meets the same cuts
    places = F.sequence(F.lit(1), F.lit(2**bits - 1))

    def of(i: int) -> Column:
        values = F.col(f"_sorted_{i}")
        return F.transform(places, lambda n: F.get(values, F.floor(n * F.size(values) / 2**bits).cast("int"))).alias(f"_cuts_{i}")

    return stored(kept.select(*[of(i) for i in range(len(columns))]), "cuts")


def place(value: Column, cuts_: Column, bits: int = BITS) -> Column:
    """How many cuts are not above the value, by bisection; nulls come first."""
    steps = F.array(*[F.lit(2**b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(cuts_, at + step - 1) <= value, step).otherwise(F.lit(0)))


def interleaved(places: list[Column], bits: int = BITS) -> Column:
    """The bits of all places in turn, the highest of each first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, p in enumerate(places):
            at = bit * len(places) + len(places) - 1 - i
            out = out.bitwiseOR(F.shiftleft(F.shiftright(p, bit).bitwiseAND(F.lit(1)).cast("long"), at))
    return out


def clustered(df: DataFrame, columns: list[str], files: int | None = None) -> DataFrame:
    """The same rows, ranged and sorted along the curve; ``files`` ranges, or as many as there are shuffle partitions.

    Up to seven columns. Columns of values that cannot be ordered cannot be clustered by.
    """
    if len(columns) * BITS > 63:
        raise ValueError(f"{len(columns)} columns do not fit one number")
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = cuts(df, columns, df.count())
    placed = df.withColumn("_tie", row_tie(df)).join(F.broadcast(found))  # one row
    for i, c in enumerate(columns):
        placed = placed.withColumn(f"_place_{i}", place(F.col(f"`{c}`"), F.col(f"_cuts_{i}")))
    curve = interleaved([F.col(f"_place_{i}") for i in range(len(columns))])
    ranged = placed.select(*named(df.columns), curve.alias("_curve"), "_tie").repartitionByRange(files, "_curve", "_tie")
    return ranged.sortWithinPartitions("_curve", *named(columns)).select(*named(df.columns))
