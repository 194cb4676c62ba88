"""Joins of streams, funnels and two sinks: late and missing partners, any dealing to batches, restarts."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemart.streaming import stateful

T0 = datetime(2024, 1, 1)
at = lambda minutes: T0 + timedelta(minutes=minutes)
SHAPE = "user string, ts timestamp, kind string"


def files(spark, path, *batches):
    """One file for each batch, read one at a time in this order."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").json(f"file://{path}/{n}")
    stream = spark.readStream.schema(SHAPE).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1)
    return stream.json(f"file://{path}")


def test_interval_join(spark, tmp_path):
    left = files(spark, tmp_path / "l", [("a", at(0), "l"), ("b", at(5), "l"), ("c", at(6), "l")], [("a", at(90), "l")], [("z", at(500), "l")], [("z", at(900), "l")])
    right = files(spark, tmp_path / "r", [("a", at(10), "r"), ("a", at(31), "r"), ("c", at(5), "r")], [("b", at(35), "r"), ("a", at(89), "r")], [("z", at(500), "r")], [("y", at(900), "r")])
    out = stateful.run_to_files(stateful.interval_join(left, right, "user", "ts", "ts", "30 minutes", "2 hours", outer=True), "joined")
    got = sorted((r.user, r.ts, r.r_ts) for r in out.where("user <> 'z'").select("user", "ts", "r_ts").collect() if r.r_ts)
    assert got == [("a", at(0), at(10)), ("b", at(5), at(35))]
    assert sorted((r.user, r.ts) for r in out.where("r_ts is null").collect()) == [("a", at(90)), ("c", at(6))]


def naive(events, steps, gap):
    out = []
    for user in {e[0] for e in events}:
        open_ = None
        for _, ts, kind in sorted((e for e in events if e[0] == user), key=lambda e: (e[1], e[2])) + [(user, at(10**6), "")]:
            if open_ and ts >= open_[1] + gap:
                out.append((user, open_[0], open_[1] + gap, open_[2], len(open_[3])))
                open_ = None
            open_ = open_ or [ts, ts, 0, []]
            open_[1], open_[2] = ts, open_[2] + 1
            if len(open_[3]) < len(steps) and kind == steps[len(open_[3])]:
                open_[3].append(ts)
    return sorted(out)


def test_funnels_in_any_batches(spark, tmp_path):
    random.seed(8)
    steps, gap = ("view", "cart", "buy"), timedelta(minutes=40)
    events = [(random.choice("abc"), at(random.randrange(2000) + k / 100), random.choice([*steps, "view", "other"])) for k in range(150)]
    expected = naive(events, steps, gap)
    events.sort(key=lambda e: e[1])
    for n, size in enumerate((150, 30)):
        batches = [events[i : i + size] for i in range(0, 150, size)]
        if size < 150:  # some come two batches late, within the time that is waited for
            batches[2], batches[1] = batches[2] + batches[1][::2], batches[1][1::2]
        stream = files(spark, tmp_path / str(n), *batches, [("end", at(5000), "other")], [("end", at(9000), "other")])
        out = stateful.run_to_files(stateful.funnels(stream, "user", "ts", "kind", steps, gap, "20 hours"), "funnels")
        got = sorted((r.user, r.started, r.ended, r.n, r.reached) for r in out.where("user <> 'end'").collect())
        assert got == expected and all(len(r.step_times) == r.reached for r in out.collect())


def test_two_sinks_and_a_restart_between_them(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    good = [json.dumps({"order_id": f"o{i}", "product_id": "p"}) for i in range(6)]
    (tmp_path / "in" / "1.txt").write_text("\n".join([*good[:3], "{broken", '{"product_id": "x"}']))
    lines = spark.readStream.text(f"file://{tmp_path}/in")
    start = lambda: stateful.start_two_sinks(lines, f"file://{tmp_path}/out", f"file://{tmp_path}/progress", rows_per_file=2)
    split, calls = stateful.split_malformed, []

    def fails(df, column):
        events, dead = split(df, column)
        calls.append(1)
        return (events, dead.withColumn("raw", F.raise_error(F.lit("lost")))) if len(calls) == 1 else (events, dead)

    monkeypatch.setattr(stateful, "split_malformed", fails)
    with pytest.raises(Exception, match="lost"):
        start().awaitTermination()
    assert list((tmp_path / "out" / "events").glob("batch=0/*.parquet"))  # the first sink was through
    (tmp_path / "in" / "2.txt").write_text("\n".join([*good[3:], "[]"]))
    start().awaitTermination()
    events, dead = (spark.read.parquet(f"file://{tmp_path}/out/{n}") for n in ("events", "dead_letters"))
    assert sorted(r.order_id for r in events.collect()) == [f"o{i}" for i in range(6)]
    assert sorted(r.raw for r in dead.collect()) == sorted(["{broken", '{"product_id": "x"}', "[]"])
    assert len(list((tmp_path / "out" / "events").rglob("*.parquet"))) >= 3
