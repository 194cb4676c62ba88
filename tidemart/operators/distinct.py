"""Distinct counts that are kept: a sketch for each group, day for example, which unite for any window.

An exact distinct count of a window reads the window's rows again; sketches of a few kilobytes a day are read instead.
Rows that come again change nothing, so batches may overlap and be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LOG_SIZE = 14  #: of a sketch, as a power of two of its registers
#: Three standard errors of a united sketch: 1.04 over the root of the number of registers.
ERROR = 3 * 1.04 / 2 ** (LOG_SIZE / 2)


def sketches(df: DataFrame, by: tuple[str, ...], *columns: str) -> DataFrame:
    """A row for each group with a sketch of the distinct values of each column; nulls do not count."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LOG_SIZE)).alias(c) for c in columns])


def united(stored: DataFrame, by: tuple[str, ...], *columns: str) -> DataFrame:
    """Sketches of coarser groups (none: one row), or of old and new ones put together."""
    out = [F.hll_union_agg(c).alias(c) for c in columns]
    return stored.groupBy(*by).agg(*out) if by else stored.agg(*out)


def followed(stored: DataFrame | None, batch: DataFrame, by: tuple[str, ...], *columns: str) -> DataFrame:
    """The stored sketches with a batch of rows taken up; rows known already may be in it."""
    new = sketches(batch, by, *columns)
    return new if stored is None else united(stored.select(*by, *columns).unionByName(new), by, *columns)


def estimates(stored: DataFrame, *columns: str) -> DataFrame:
    """The sketches as counts, each within ``ERROR`` of the exact one nearly always."""
    return stored.withColumns({c: F.hll_sketch_estimate(c) for c in columns})
