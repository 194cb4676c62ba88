"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_own: dict[str, str] = {}  #: folders of local runs, by application
_owned: dict[str, list[str]] = {}  #: folders of the owners that are open, by application, the last one counts


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the folder of the open ``Scratch`` below it; for a local master a folder of our own
    where the setting is unset.

    On a cluster each executor would write to a folder of its own machine and rows would be missing, so it must be set.
    """
    context = spark.sparkContext
    if owned := _owned.get(context.applicationId):
        return owned[-1]
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="tidemart-")
    return _own[context.applicationId]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, whatever its store."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Owner of what is written to the shared folder meanwhile: a folder of its own, deleted at the end.

    Results are lazy and read what lies there, so they are to be written or collected before the end.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        _owned.setdefault(self.spark.sparkContext.applicationId, []).append(self.path)
        return self

    def __exit__(self, *_) -> None:
        _owned[self.spark.sparkContext.applicationId].remove(self.path)
        delete(self.spark, self.path)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs shuffled: Spark's cleaner deletes it once the driver's collector has run, which a
    driver with much memory may not do for hours."""
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, label: str, root: str | None = None) -> DataFrame:
    """``df`` written once and read back: what follows neither recomputes it nor depends on the executors that made it.

    ``root``: where, if not in the shared folder of the moment.
    """
    return stored_parts([df], label, root)


def stored_parts(parts: Iterable[DataFrame], label: str, root: str | None = None) -> DataFrame:
    """The same for a table in parts, one after the other: what one shuffled is gone when the next begins."""
    path = None
    for df in parts:
        spark = df.sparkSession
        path = path or f"{root or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        df.write.mode("append").option("compression", "zstd").parquet(path)
        release(spark)
    return spark.read.schema(df.schema).parquet(path)


def slices(values: DataFrame, column: Column, parts: int) -> list[Column]:
    """Conditions, from low to high, that deal rows with a value in ``column`` (a whole number or a date) to ranges of it.

    ``values``: rows to find the ends from, so that the ranges have about as many of them each; few ends reach the driver.
    """
    if parts <= 1:
        return [F.lit(True)]
    dated = isinstance(values.select(column).schema[0].dataType, T.DateType)
    number = F.unix_date(column) if dated else column
    shares = [i / parts for i in range(1, parts)]
    found = values.select(number.cast("double").alias("v")).approxQuantile("v", shares, 0.2 / parts)
    ends = [F.date_from_unix_date(F.lit(int(v))) if dated else F.lit(int(v)).cast("long") for v in sorted(set(found))]
    if not ends:
        return [F.lit(True)]
    between = [(column > a) & (column <= b) for a, b in zip(ends, ends[1:], strict=False)]
    return [column <= ends[0], *between, column > ends[-1]]


def shares(key: Column, parts: int) -> list[Column]:
    """Conditions that deal rows to ``parts`` by a hash of their key: put on what was grouped by the key, they reach the
    rows below, so that one share of the groups is dealt at a time."""
    return [F.pmod(F.xxhash64(key), F.lit(parts)) == i for i in range(parts)] if parts > 1 else [F.lit(True)]
