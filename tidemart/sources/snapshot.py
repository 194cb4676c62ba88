"""A versioned Parquet table: immutable snapshots and one small pointer, swapped atomically.

``<path>/v=<n>-<writer>/`` holds a version's files; ``<path>/_versions/<n>.json`` names that folder and says when and by
which batch it came. A version exists once its JSON file does, and that is created only if absent, so of two writers of
the same version one fails, and no reader sees half a write or another writer's files: each writes to a folder of its
own. A version names its own batch only; what was applied is looked up along the versions that are kept, and the newest
of those that were deleted leave the names of their last ``REMEMBERED`` batches in the next. Files go through Hadoop's
file systems, whatever store the path is in.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.operators.merge import merge_rows


FILE_BYTES = 256 << 20  #: of a compacted table's file, about
REMEMBERED = 1000  #: batches whose versions are deleted


class Conflict(RuntimeError):
    """Another writer has committed the version meanwhile."""


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- versions

    def versions(self) -> list[int]:
        folder = self._path(f"{self.path}/_versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def info(self, version: int) -> dict:
        stream = self._fs.open(self._path(f"{self.path}/_versions/{version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    @property
    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def exists(self) -> bool:
        return self.version is not None

    def as_of(self, committed_at: str) -> int:
        """The newest version committed at or before an ISO timestamp."""
        found = [v for v in self.versions() if self.info(v)["at"] <= committed_at]
        if not found:
            raise LookupError(f"no version at {committed_at}")
        return found[-1]

    # -- reading

    def read(self, version: int | None = None, at: str | None = None) -> DataFrame:
        version = self.as_of(at) if at else self.version if version is None else version
        if version not in self.versions():
            raise LookupError(f"{self.path} has no version {version}")
        return self.spark.read.parquet(f"{self.path}/{self.info(version)['folder']}")

    # -- writing

    def _commit(self, version: int, text: dict) -> None:
        target = self._path(f"{self.path}/_versions/{version}.json")
        self._fs.mkdirs(target.getParent())
        try:
            stream = self._fs.create(target, False)  # fails if the file is there
        except Exception as e:
            raise Conflict(f"version {version} of {self.path} is there already") from e
        stream.write(bytearray(json.dumps(text).encode()))
        stream.close()

    def write(self, df: DataFrame, at: str, batch: str | None = None, base: int | None = None, cluster: tuple[str, ...] = ()) -> int:
        """A new version with the rows of ``df``; ``base``: the version that it was made from (default: the newest)."""
        base = self.version if base is None else base
        version = 0 if base is None else base + 1
        if version in self.versions():
            raise Conflict(f"version {version} of {self.path} is there already")
        if cluster:
            df = df.repartitionByRange(*cluster).sortWithinPartitions(*cluster)
        folder = f"v={version}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        past = self._past() if base is not None else []
        self._commit(version, {"version": version, "at": at, "folder": folder, "batch": batch, "past": past})
        return version

    def _past(self) -> list[str]:
        """The batches of versions that are deleted, as the oldest version that is kept remembers them."""
        return self.info(self.versions()[0])["past"]

    def applied(self, batch: str) -> bool:
        return self.exists() and (any(self.info(v)["batch"] == batch for v in reversed(self.versions())) or batch in self._past())

    def merge(self, source: DataFrame, at: str, batch: str | None = None, check: bool = True, **options) -> int:
        """Merge ``source``; the first merge creates the table; a batch that was applied before changes nothing."""
        if batch and self.applied(batch):
            return self.version
        base = self.version
        if base is None:
            return self.write(source, at, batch)
        return self.write(merge_rows(self.read(base), source, check=check, **options), at, batch, base=base)

    def add_columns(self, at: str, **kinds: str) -> int:
        """A version with null columns for the names that are missing."""
        df = self.read()
        return self.write(df.withColumns({n: F.lit(None).cast(k) for n, k in kinds.items() if n not in df.columns}), at)

    def compact(self, at: str, files: int | None = None, cluster: tuple[str, ...] = ()) -> int:
        """A version in fewer files: about ``FILE_BYTES`` each, or as many as told; rows are dealt anew, never drawn into one task."""
        df = self.read()
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        return self.write(df if cluster else df.repartition(files or max(1, -(-size // FILE_BYTES))), at, cluster=cluster)

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` (1 at least) versions, and the folders that no version names.

        Not for use while others write: their folders are named by no version yet.
        """
        versions, keep = self.versions(), max(1, keep)
        old, live = versions[:-keep], versions[-keep:]
        if old:
            names = [n for v in old if (n := self.info(v)["batch"])]
            first = self.info(live[0])
            first["past"] = (self._past() + names)[-REMEMBERED:]
            target = self._path(f"{self.path}/_versions/{live[0]}.json")
            stream = self._fs.create(target, True)  # the same version, with what it now has to remember
            stream.write(bytearray(json.dumps(first).encode()))
            stream.close()
        for v in old:
            self._fs.delete(self._path(f"{self.path}/_versions/{v}.json"), False)
        named = {self.info(v)["folder"] for v in live}
        root = self._path(self.path)
        for s in self._fs.listStatus(root) if self._fs.exists(root) else []:
            if s.getPath().getName().startswith("v=") and s.getPath().getName() not in named:
                self._fs.delete(s.getPath(), True)
        return old


def append_quarantine(rejected: DataFrame, path: str) -> bool:
    """Append rejected rows; False if there were none and nothing was written. Columns may grow over time."""
    if rejected.isEmpty():
        return False
    rejected.write.mode("append").parquet(path)
    return True


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)
