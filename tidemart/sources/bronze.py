"""Taking raw files in: copy what is new, keep a manifest, list what is there."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemart.schemas import CANONICAL, raw_schema
from tidemart.sources.files import day_path
from tidemart.sources.scratch import stored


def file_facts(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """(file_name, path, size_bytes, sha256) of the files below a path; contents stay on the executors."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")
    )


MANIFEST = "file_name string, target string, size_bytes long, sha256 string, status string, changed boolean, error string, at timestamp"


def _stream(uri: str):
    """(file system, path) of a URI as Spark and Hadoop write it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:/", "file:///", 1))


def _copied(origin: str, target: str) -> str | None:
    """Copy a file, seen under its name only when it is whole; the error, if any."""
    try:
        (source, path), (where, name) = _stream(origin), _stream(target)
        where.create_dir(name.rpartition("/")[0], recursive=True)
        part = f"{name.rpartition('/')[0]}/_{uuid.uuid4().hex}.part"
        with source.open_input_stream(path) as a, where.open_output_stream(part) as b:
            while some := a.read(8 << 20):
                b.write(some)
        where.move(part, name)
    except Exception as e:  # one unreadable file does not stop the others; its row says so
        return str(e)[:200]
    return None


def ingest(spark: SparkSession, source: str, root: str, at: datetime, pattern: str = "*.csv") -> DataFrame:
    """Copy files that the day's folder lacks; one manifest row a file: uploaded, skipped or failed.

    Executors read, compare and copy; the driver sees no file name. A file whose name is there is skipped whatever its
    content; ``changed`` tells whether the content differs. Of several files of one name below the source, the one with
    the least path is taken and the others are skipped. The manifest is written to the shared folder when this returns,
    and reading it copies nothing again.
    """
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(day_path(root, at.date())).getFileSystem(conf)
    day = path(day_path(root, at.date())).makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    new = file_facts(spark, source, pattern)
    first = Window.partitionBy("file_name").orderBy("path")
    new = new.withColumns({"_turn": F.row_number().over(first), "_first": F.first("sha256").over(first)})
    none = spark.createDataFrame([], "file_name string, there string")
    there = none
    if fs.exists(path(day)):
        there = file_facts(spark, day, pattern).select("file_name", F.col("sha256").alias("there"))
    known = F.when(F.col("_turn") > 1, F.coalesce("there", "_first")).otherwise(F.col("there"))
    rows = new.join(there, "file_name", "left").select(
        "file_name", "path", F.concat(F.lit(f"{day}/"), "file_name").alias("target"), "size_bytes", "sha256", known.alias("there")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            new = pdf["there"].isna()
            error = [_copied(o, t) if n else None for o, t, n in zip(pdf["path"], pdf["target"], new, strict=True)]
            status = ["skipped" if not n else "failed" if e else "uploaded" for n, e in zip(new, error, strict=True)]
            out = pdf[["file_name", "target", "size_bytes", "sha256"]].copy()
            yield out.assign(status=status, changed=~new & (pdf["there"] != pdf["sha256"]), error=error, at=pd.Timestamp(at))

    return stored(rows.mapInPandas(run, MANIFEST), "manifest")


def ingest_status(manifest: DataFrame) -> DataFrame:
    """(status, uploaded, skipped, failed): success, partial_success, failed or no_files."""
    n = {s: F.count_if(F.col("status") == s).alias(s) for s in ("uploaded", "skipped", "failed")}
    counts = manifest.agg(*n.values())
    status = (
        F.when(F.col("uploaded") + F.col("skipped") + F.col("failed") == 0, "no_files")
        .when(F.col("failed") == 0, "success")
        .when(F.col("uploaded") + F.col("skipped") == 0, "failed")
        .otherwise("partial_success")
    )
    return counts.select(status.alias("status"), *n)


def write_manifest(manifest: DataFrame, root: str) -> None:
    """Append to the upload log beside the data."""
    manifest.coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/_metadata/upload_log")


def listing(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """(status, files, total_bytes): exists, empty or error."""
    try:
        return file_facts(spark, path, pattern).agg(F.count("*").alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes")).select(
            F.when(F.col("files") > 0, "exists").otherwise("empty").alias("status"), "files", "total_bytes"
        )
    except Exception:  # a path that is not there
        return spark.sql("select 'error' as status, 0L as files, 0L as total_bytes")


def sample_rows(spark: SparkSession) -> DataFrame:
    """Two made-up rows in the canonical text columns."""
    base = dict.fromkeys(CANONICAL, "")
    common = base | {"ship_mode": "Standard Class", "segment": "Consumer", "country": "United States", "market": "US", "quantity": "1", "discount": "0.05"}
    one = common | {
        "row_id": "1", "order_id": "ORD-100001", "order_date": "15-01-2024", "ship_date": "17-01-2024", "customer_id": "CUST-10001",
        "customer_name": "Sample One", "city": "New York", "state": "NY", "postal_code": "08701", "region": "East", "product_id": "PROD-1001",
        "category": "Technology", "sub_category": "Phones", "product_name": "Sample Phone", "sales": "299.99", "profit": "89.99",
        "shipping_cost": "9.99", "order_priority": "Medium",
    }
    two = one | {"row_id": "2", "order_id": "ORD-100002", "customer_id": "CUST-10002", "customer_name": "Sample Two", "product_id": "PROD-1002", "product_name": "Sample Desk", "category": "Furniture", "sub_category": "Tables", "sales": "150.00", "profit": "-12.50"}
    return spark.createDataFrame([tuple(r[c] for c in CANONICAL) for r in (one, two)], raw_schema())
