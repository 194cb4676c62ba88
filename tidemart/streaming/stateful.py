"""Joins of two streams within a time, and ordered funnels with timers; and where results of streams are written to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.sources.scratch import shared_dir
from tidemart.streaming.ingest import split_malformed


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, within: str, late: str, outer: bool = False
) -> DataFrame:
    """Rows of two streams with equal keys, the right one's time from the left one's to ``within`` after it, both inclusive.

    Right columns get the prefix ``r_``. State is kept for ``within`` and the time ``late`` that late rows are waited
    for; ``outer``: left rows without a partner come too, once none can come any more. Works on tables as well.
    """
    l, r = left.withWatermark(left_at, late), right.withWatermark(right_at, late)
    r = r.select(*[F.col(c).alias(f"r_{c}") for c in r.columns])
    since, until = F.col(f"r_{right_at}") >= F.col(left_at), F.col(f"r_{right_at}") <= F.col(left_at) + F.expr(f"interval {within}")
    return l.join(r, (F.col(key) == F.col(f"r_{key}")) & since & until, "left_outer" if outer else "inner")


def _utc(ms: float) -> datetime:
    return datetime.fromtimestamp(ms / 1000, timezone.utc).replace(tzinfo=None)


def funnels(df: DataFrame, key: str, at: str, kind: str, steps: tuple[str, ...], gap: timedelta, late: str) -> DataFrame:
    """(key, started, ended, n, reached, step_times) of each session of a key, when it is over.

    A session ends when nothing follows its last event for ``gap``; ``reached`` counts how many ``steps`` came in their
    order, other events between them or not, and ``step_times`` says when. Events wait in the state until the watermark
    has passed them and are taken in the order of their times (ties by kind), so how they were dealt to batches does not
    show; a timer closes what is over. The state is one open session and the events of a key within ``late``.
    """
    out = T.StructType(
        [df.schema[key], T.StructField("started", T.TimestampType()), T.StructField("ended", T.TimestampType()), T.StructField("n", T.LongType())]
        + [T.StructField("reached", T.IntegerType()), T.StructField("step_times", T.ArrayType(T.TimestampType()))]
    )
    kept = T.StructType(
        [T.StructField("times", T.ArrayType(T.LongType())), T.StructField("kinds", T.ArrayType(T.StringType()))]
        + [T.StructField(c, T.LongType()) for c in ("started", "last", "n")]
        + [T.StructField("steps", T.ArrayType(T.LongType()))]
    )
    silence = gap // timedelta(microseconds=1)
    stamp = lambda us: pd.Timestamp(us, unit="us")

    def run(keys: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        times, kinds, started, last, n, reached = state.get if state.exists else ([], [], None, None, 0, [])
        waiting = list(zip(times, kinds, strict=True))
        for frame in frames:
            waiting += zip(frame[at].astype("datetime64[us]").astype("int64"), frame[kind].fillna(""), strict=True)
        waiting.sort()
        mark, reached, closed = state.getCurrentWatermarkMs() * 1000, list(reached), []
        close = lambda: closed.append((*keys, stamp(started), stamp(last + silence), n, len(reached), [stamp(x) for x in reached]))
        while waiting and waiting[0][0] <= mark:
            time, what = waiting.pop(0)
            if started is not None and time >= last + silence:
                close()
                started, reached = None, []
            if started is None:
                started, n = time, 0
            last, n = time, n + 1
            if len(reached) < len(steps) and what == steps[len(reached)]:
                reached.append(time)
        if started is not None and last + silence <= mark:
            close()
            started, last, n, reached = None, None, 0, []
        if started is None and not waiting:
            if state.exists:
                state.remove()
        else:
            state.update(([int(t) for t, _ in waiting], [k for _, k in waiting], started, last, n, reached))
            due = min(([waiting[0][0]] if waiting else []) + ([last + silence] if started is not None else []))
            state.setTimeoutTimestamp(max(due, mark) // 1000 + 1)
        if closed:
            yield pd.DataFrame(closed, columns=out.names)

    from pyspark.sql.streaming.state import GroupStateTimeout

    grouped = df.select(key, at, kind).withWatermark(at, late).groupBy(key)
    return grouped.applyInPandasWithState(run, out, kept, "append", GroupStateTimeout.EventTimeTimeout)


def run_to_files(stream: DataFrame, label: str, complete: bool = False) -> DataFrame:
    """What a stream gives until its input ends, in files of the shared folder; ``complete``: its last whole result."""
    spark = stream.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{path}-progress")
    if complete:
        writer = writer.outputMode("complete").foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(path))
    else:
        writer = writer.format("parquet").option("path", path)
    writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def start_two_sinks(
    lines: DataFrame, path: str, checkpoint: str, column: str = "value", every: str | None = None, rows_per_file: int = 0
) -> StreamingQuery:
    """JSON lines to ``<path>/events`` and, whole, to ``<path>/dead_letters`` what does not parse or lacks an order id.

    A micro-batch writes both under its number and overwrites what a run of it that failed has left, so a restart
    between the two sinks loses and repeats nothing. How many files or rows a batch has is bounded by the source's
    options, ``rows_per_file`` bounds the files that are written.
    """

    def run(batch: DataFrame, number: int) -> None:
        kept = batch.persist()  # read twice
        try:
            for name, rows in zip(("events", "dead_letters"), split_malformed(kept, column), strict=True):
                rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/{name}/batch={number}")
        finally:
            kept.unpersist()

    writer = lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
