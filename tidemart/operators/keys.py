"""Dense surrogate keys 1..N in a given order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.operators.ranges import named, numbered


def dense_keys(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Numbers in one window: for tables that fit a task, such as dimensions."""
    number = F.row_number().over(Window.orderBy(*order)).cast("long")
    return df.select(number.alias(name), "*")


def ranged_keys(df: DataFrame, name: str, order: list[str], slices: list[Column] | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """The same numbers without a single-task window (see ``numbered``), the number first; the order must be total for
    the same rows to get the same numbers."""
    return numbered(df, name, order, start=1, slices=slices, without=without).select(name, *named([c for c in df.columns if c not in without]))


def numbered_within(df: DataFrame, name: str, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
