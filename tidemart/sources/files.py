"""Raw files: batch CSV and event JSON, with where each row came from."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemart.functions.columns import snake_columns
from tidemart.schemas import event_schema, typed_csv_schema


def with_provenance(df: DataFrame, batch_id: str, at: datetime) -> DataFrame:
    """The file's base name, when it was read and in which batch."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("source_file"),
        F.lit(at).cast("timestamp").alias("bronze_ingestion_timestamp"),
        F.lit(batch_id).alias("batch_id"),
    )


def read_csv_text(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """CSV with headers, every column text."""
    return spark.read.option("header", True).option("inferSchema", False).option("pathGlobFilter", pattern).csv(path)


def read_events(spark: SparkSession, path: str, pattern: str = "*.json", schema: StructType | None = None) -> DataFrame:
    """JSON lines under the event schema: no pass over the files to infer one."""
    return spark.read.schema(schema or event_schema()).option("multiLine", False).option("pathGlobFilter", pattern).json(path)


def read_typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """The 21-field CSV with typed columns and MM/dd/yyyy dates."""
    return spark.read.schema(typed_csv_schema()).option("header", True).option("dateFormat", "MM/dd/yyyy").csv(path)


def is_event_path(path: str, override: str | None = None) -> bool:
    """JSON if told so, else by the path's name."""
    return override == "json" if override else "sales_events" in path


def batch_day(batch_id: str, today: date) -> date:
    """The day a batch id begins with, else today."""
    return date.fromisoformat(batch_id[:10]) if re.match(r"\d{4}-\d{2}-\d{2}", batch_id or "") else today


def day_path(root: str, day: date) -> str:
    return f"{root.rstrip('/')}/year={day:%Y}/month={day:%m}/day={day:%d}"


def read_day(spark: SparkSession, root: str, day: date, reader: Callable[[SparkSession, str], DataFrame] = read_csv_text) -> DataFrame:
    """One day's files, year, month and day as columns: the others are pruned, not listed and dropped."""
    df = reader(spark, root)
    return df.where((F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day))


def read_raw(
    spark: SparkSession, root: str, batch_id: str, today: date, at: datetime, fallback: str | None = None, kind: str | None = None
) -> DataFrame:
    """A day's rows with normalised names and provenance; from ``fallback`` if the day has none or cannot be read.

    Names are normalised whichever way the rows came.
    """
    path = day_path(root, batch_day(batch_id, today))
    reader = read_events if is_event_path(root, kind) else read_csv_text
    try:
        df = reader(spark, path)
        if fallback is not None and df.isEmpty():
            raise LookupError(path)
    except (AnalysisException, LookupError):
        if fallback is None:
            raise
        df = read_csv_text(spark, fallback)
    return snake_columns(with_provenance(df, batch_id, at))


def modified_between(spark: SparkSession, path: str, after: datetime, before: datetime, schema: StructType | None = None) -> DataFrame:
    """Events of files modified in ``[after, before)``, however many files there are."""
    reader = spark.read.schema(schema or event_schema()).option("recursiveFileLookup", True)
    return reader.option("modifiedAfter", f"{after:%Y-%m-%dT%H:%M:%S}").option("modifiedBefore", f"{before:%Y-%m-%dT%H:%M:%S}").json(path)
