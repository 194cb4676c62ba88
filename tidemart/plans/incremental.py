"""Sales tables for reports that follow the cleaned table batch by batch, instead of being made anew.

A batch is merged into the cleaned table; the rows that it changed, as they were and as they are, say which groups of the
daily roll-up and which customers are touched. Only these are made again, from the sales that they are made of, and only
the buckets that they lie in are read and written. The sales, the daily roll-up and the customers are all bucketed by the
customer, who is the store of a sale too, so a group's sales are in the bucket of the group.

A batch may be applied again at any time, as after a failure halfway: the rows that it met are kept until it is through,
and every step gives the same result if it is repeated.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemart.config import DEFAULT, Settings
from tidemart.operators.merge import aligned, merge_rows
from tidemart.plans import marts
from tidemart.plans.intermediate import unified_sales
from tidemart.plans.staging import stg_sales
from tidemart.sources.partitioned import KEYS, PartitionedTable
from tidemart.sources.scratch import Scratch, delete, stored

GROUP = ("date_key", "product_key", "store_key")
SALE = "unified_sales_key"


def same(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> Column:
    """Equal keys, null to null."""
    return reduce(Column.__and__, [a[k].eqNullSafe(b[k]) for k in keys])


def without(df: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    return df.join(keys, same(df, keys, names), "left_anti")


def only(df: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    return df.join(keys, same(df, keys, names), "left_semi")


FEW = 100_000  #: keys that are broadcast, so that the rows they are looked up for are not dealt


def few(keys: DataFrame) -> DataFrame:
    """Stored keys, to be broadcast if they are few and merged if not: files tell little of how large they become."""
    return keys.hint("broadcast" if keys.count() <= FEW else "merge")


@dataclass
class Applied:
    """What a batch did: the sales that it changed, and the buckets of the tables that were read and written for them."""

    changed: int
    buckets: list[int]


class Gold:
    """The tables below ``root``. ``buckets`` is fixed when they are made."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, settings: Settings = DEFAULT):
        self.spark, self.root, self.settings = spark, root.rstrip("/"), settings
        table = lambda name, *keys: PartitionedTable(spark, f"{self.root}/{name}", keys, buckets)
        self.silver = table("silver", *KEYS)
        self.sales, self.daily, self.customers = table("sales", "customer_id"), table("daily", "store_key"), table("customers", "customer_id")

    def unified(self, rows: DataFrame) -> DataFrame:
        """Cleaned rows as sales: a projection and a filter, row by row."""
        return unified_sales(stg_sales(rows, self.settings), self.settings)

    def _before(self, batch: DataFrame, name: str) -> DataFrame:
        """The cleaned rows with the batch's keys as they were when the batch came first."""
        path, there = f"{self.root}/_before/{name}", self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        store = there(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(there(f"{path}/_SUCCESS")):
            now = only(self.silver.read(*self.silver.met(batch)), batch, *KEYS) if self.silver.exists() else batch.limit(0)
            now.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def apply(self, batch: DataFrame, name: str) -> Applied:
        """Merge cleaned rows, unique by order and product, and let the tables follow. ``name`` tells batches apart.

        What is written on the way is deleted at the end.
        """
        with Scratch(self.spark):
            return self._apply(batch, name)

    def _apply(self, batch: DataFrame, name: str) -> Applied:
        batch = stored(batch, "batch")
        before = self._before(batch, name)
        touched = self.silver.merge(batch)
        if not touched:
            return Applied(0, [])
        first = before.isEmpty()  # no row was met: all of the batch's come
        new = self.unified(aligned(batch, before) if first else merge_rows(before, batch))  # as the merge left them
        moved = new.withColumn("_come", F.lit(True))
        if not first:
            old = self.unified(before)
            both = old.withColumn("_come", F.lit(False)).unionByName(moved)
            twice = F.count("*").over(Window.partitionBy(SALE, F.xxhash64(*old.columns)))  # as it was and as it is
            moved = both.withColumn("_twice", twice).where("_twice = 1").drop("_twice")
        moved = stored(moved, "moved")
        met = self.sales.met(moved)
        if met:
            come = moved.where("_come").drop("_come")
            kept = self.sales.read(*met).select(*come.columns).join(moved.select(SALE), SALE, "left_anti") if self.sales.exists() else come.limit(0)
            self.sales.replace(met, kept.unionByName(come))
            sales = self._rows(self.sales, met, come)
            groups = few(stored(marts.natural_fact(moved).select(*GROUP).distinct(), "groups"))
            daily = marts.daily_unkeyed(only(marts.natural_fact(sales), groups, *GROUP), one_customer=True)
            self._follow(self.daily, met, groups, daily, GROUP)
            people = few(stored(moved.select("customer_id").distinct(), "people"))
            again = marts.dim_customer(only(sales, people, "customer_id"), self.settings, dense=False).drop("customer_key")
            self._follow(self.customers, met, people, again, ("customer_id",))
        delete(self.spark, f"{self.root}/_before/{name}")
        return Applied(moved.count() if first else moved.select(SALE).distinct().count(), met)

    def _rows(self, table: PartitionedTable, buckets: list[int], like: DataFrame) -> DataFrame:
        return table.read(*buckets).select(*like.columns) if table.exists() else like.limit(0)

    def _follow(self, table: PartitionedTable, met: list[int], keys: DataFrame, again: DataFrame, names: tuple[str, ...]) -> None:
        """The rows with these keys are replaced by those made again."""
        table.replace(met, without(self._rows(table, met, again), keys, *names).unionByName(again))
