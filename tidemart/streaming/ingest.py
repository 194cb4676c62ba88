"""Micro-batches of events into the cleaned table, and windows over streams."""

from __future__ import annotations

from dataclasses import replace


from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemart.config import DEFAULT, Settings
from tidemart.operators import silver as ops
from tidemart.schemas import event_schema
from tidemart.sources.snapshot import SnapshotTable


def event_stream(spark: SparkSession, path: str, files: int | None = None, schema: StructType | None = None) -> DataFrame:
    """New JSON files below a folder, ``files`` at most in a batch."""
    reader = spark.readStream.schema(schema or event_schema()).option("recursiveFileLookup", True)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).json(path)


def event_times(df: DataFrame) -> DataFrame:
    """Events with the time they were made at as processing time, so that a late one loses to a newer one."""
    made = F.to_timestamp("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return df.withColumn("processing_timestamp", made).drop("event_timestamp", "producer_id", "source_system")


def merge_batch(table: SnapshotTable, settings: Settings, at: str, query: str):
    """What a micro-batch does: clean, split, deduplicate, merge. Empty batches and batches applied before do nothing."""

    def run(batch: DataFrame, number: int) -> None:
        name = f"{query}-{number}"
        if batch.isEmpty() or table.applied(name):
            return
        rows = ops.silver(event_times(batch), replace(settings, batch_id=name))
        if not rows.isEmpty():
            table.merge(rows, at, batch=name)

    return run


def start_merge(
    events: DataFrame, table: SnapshotTable, checkpoint: str, at: str, settings: Settings = DEFAULT, name: str = "events", every: str | None = None
) -> StreamingQuery:
    """Merge a stream into the table: all there is now, or on and on ``every`` so often (such as 15 minutes).

    The checkpoint knows which files were read and the table which batches were applied, so a restart repeats nothing.
    """
    writer = events.writeStream.foreachBatch(merge_batch(table, replace(settings, source_system="KAFKA"), at, name)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def start_files(events: DataFrame, path: str, checkpoint: str, at: str = "event_timestamp", every: str | None = None) -> StreamingQuery:
    """Events to JSON files in folders by hour."""
    t = F.to_timestamp(at)
    parts = {"year": F.date_format(t, "yyyy"), "month": F.date_format(t, "MM"), "day": F.date_format(t, "dd"), "hour": F.date_format(t, "HH")}
    writer = events.withColumns(parts).writeStream.format("json").partitionBy(*parts).option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def split_malformed(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) of JSON lines: those that do not parse, or lack an order id, are set aside whole."""
    parsed = lines.select(F.col(column).alias("raw"), F.from_json(column, event_schema()).alias("e"))
    good = F.col("e").isNotNull() & F.col("e.order_id").isNotNull()
    return parsed.where(good).select("e.*"), parsed.where(~good).select("raw")


def windowed(df: DataFrame, at: str, length: str = "15 minutes", slide: str | None = None, late: str | None = None, by: tuple[str, ...] = (), value: str | None = None) -> DataFrame:
    """Counts (and sums) by window of time; on a stream ``late`` is how long late rows are waited for."""
    if late:
        df = df.withWatermark(at, late)
    window = F.window(at, length, slide) if slide else F.window(at, length)
    aggs = [F.count("*").alias("n")]
    if value:
        aggs.append(F.sum(F.col(value).cast("decimal(18,4)")).cast("double").alias("total"))
    out = df.groupBy(window.alias("w"), *by).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, *[c for c in ("n", "total") if c in out.columns])


def sessions(df: DataFrame, at: str, by: str, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    if late:
        df = df.withWatermark(at, late)
    out = df.groupBy(F.session_window(at, gap).alias("w"), by).agg(F.count("*").alias("n"))
    return out.select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def first_seen(df: DataFrame, at: str, key: str, late: str) -> DataFrame:
    """A stream without repeats of a key within the time late rows are waited for."""
    return df.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def health(query: StreamingQuery) -> dict:
    """Whether a query runs, what ended it and what it last read."""
    last = query.lastProgress
    return {
        "active": query.isActive,
        "error": str(query.exception()) if query.exception() else None,
        "batch": last["batchId"] if last else None,
        "rows": last["numInputRows"] if last else 0,
        "at": last["timestamp"] if last else None,
    }


def keep_running(start, tries: int = 3):
    """Start a query again if it ends with an error, from its checkpoint, so many times."""
    for left in range(tries, 0, -1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except Exception:
            if left == 1:
                raise
    return None


