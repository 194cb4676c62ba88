"""A Parquet table in hash buckets of its key, so that a merge reads and rewrites only the buckets that a batch meets.

Rows lie in ``<path>/bucket=<b>/``. A merge finds the buckets of the batch, reads those alone (the filter prunes folders),
joins and overwrites just those buckets, of large tables some at a time: Spark writes beside them and puts the new folders
in their place when the job commits. Buckets that the batch does not meet keep their files. MERGE takes strictly newer rows
only, so a batch that is applied again changes nothing, which is what a restart after a failure between two writes does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.operators.merge import aligned, merge_rows
from tidemart.operators.silver import assert_unique
from tidemart.sources.adapter import size_of
from tidemart.sources.scratch import delete, release

KEYS = ("order_id", "product_id")
AT_ONCE = 1 << 28  #: bytes of a table's files and the batch's that are merged at a time, as a join has several times that on disk


class PartitionedTable:
    """``buckets`` is fixed when the table is made: so many that a bucket's rows fit some tasks."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = KEYS, buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def exists(self) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def read(self, *buckets: int) -> DataFrame:
        """All rows, or those of some buckets: other folders are not listed as input."""
        df = self.spark.read.parquet(self.path)
        return (df.where(F.col("bucket").isin(*buckets)) if buckets else df).drop("bucket")

    def _write(self, df: DataFrame, mode: str = "overwrite") -> None:
        """Overwrite the buckets that ``df`` has rows for. Small buckets are dealt to a task each or share one, large ones are
        split between several, as a bucket may hold any share of the rows."""
        out = df.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("bucket").parquet(self.path)
        release(self.spark)

    def _files(self, bucket: int) -> set[str]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/bucket={bucket}")
        store = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return {s.getPath().getName() for s in store.listStatus(path)} if store.exists(path) else set()

    def replace(self, buckets: list[int], df: DataFrame) -> None:
        """Let the buckets hold the rows of ``df``, which lie in them: a bucket without rows goes. ``df`` may read the table."""
        if not self.exists() and df.isEmpty():
            return
        before = {b: self._files(b) for b in buckets}
        self._write(df)
        for b, files in before.items():
            if files and self._files(b) == files:  # no row was written
                delete(self.spark, f"{self.path}/bucket={b}")

    def create(self, rows: DataFrame) -> None:
        self._write(rows)

    def add(self, rows: DataFrame) -> None:
        """Rows with keys that the table does not have."""
        self._write(rows, "append")

    def met(self, source: DataFrame) -> list[int]:
        """The buckets of the source's keys: so many numbers at most."""
        return sorted(r[0] for r in source.select(self.bucket()).distinct().collect())

    def merge(self, source: DataFrame | PartitionedTable, check: bool = True, **options) -> list[int]:
        """Merge as ``merge_rows`` does; returns the buckets that were read and rewritten.

        The source is read several times: a stored table is best. One in the same buckets is read bucket by bucket.
        """
        rows = source.read() if isinstance(source, PartitionedTable) else source
        if check:
            assert_unique(rows, *self.keys)
        if not self.exists():
            self.create(rows)
            return self.met(rows)
        touched = self.met(rows)
        if touched:
            groups = min(len(touched), -(-(size_of(self.read(*touched)) + size_of(rows)) // AT_ONCE))
            for some in (touched[i::groups] for i in range(groups)):
                target = self.read(*some)
                if isinstance(source, PartitionedTable):
                    come = source.read(*some)
                else:
                    come = rows.where(self.bucket().isin(*some)) if groups > 1 else rows
                self._write(merge_rows(target, aligned(come, target), keys=self.keys, **options))
        return touched
