"""Merges, versions, keys and streams."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemart.config import Settings
from tidemart.operators import checks, silver as ops
from tidemart.operators.keys import dense_keys, ranged_keys
from tidemart.operators.merge import merge_rows, track_changes
from tidemart.plans.registry import MODELS, build_order
from tidemart.sources import generator
from tidemart.sources.partitioned import PartitionedTable
from tidemart.sources.snapshot import Conflict, SnapshotTable, append_quarantine, read_quarantine
from tidemart.streaming import ingest

AT = "2024-01-01T00:00:00"
T = [datetime(2024, 1, d) for d in (1, 2, 3)]
SHAPE = "order_id string, product_id string, customer_name string, sales double, processing_timestamp timestamp"


def rows(spark, *r):
    return spark.createDataFrame(list(r), SHAPE)


def test_merge_rules(spark):
    target = rows(spark, ("a", "1", "old", 1.0, T[1]), ("b", "1", "old", 2.0, T[1]), ("c", "1", "old", 3.0, T[1]))
    source = rows(spark, ("a", "1", "new", 10.0, T[2]), ("b", "1", "new", 20.0, T[1]), ("c", "1", "new", 30.0, T[0]), ("d", "1", "new", 40.0, T[0]))
    out = {r.order_id: (r.customer_name, r.sales) for r in merge_rows(target, source, check=True).collect()}
    assert out == {"a": ("old", 10.0), "b": ("old", 2.0), "c": ("old", 3.0), "d": ("new", 40.0)}


def test_merge_aligns_columns_and_rejects_repeats(spark):
    target = rows(spark, ("a", "1", "x", 1.0, T[0]))
    source = rows(spark, ("b", "1", "y", 2.0, T[0])).drop("customer_name").withColumn("extra", F.lit(1))
    out = merge_rows(target, source)
    assert out.columns == target.columns and out.where("order_id = 'b'").first().customer_name is None
    with pytest.raises(ValueError, match="share"):
        merge_rows(target, source.union(source), check=True)


def test_snapshots(spark, tmp_path):
    t = SnapshotTable(spark, f"file://{tmp_path}/t")
    assert not t.exists()
    assert t.merge(rows(spark, ("a", "1", "x", 1.0, T[0])), "2024-01-01", "b1") == 0
    assert t.merge(rows(spark, ("a", "1", "x", 5.0, T[1]), ("b", "1", "y", 2.0, T[0])), "2024-01-02", "b2") == 1
    assert t.merge(rows(spark, ("z", "1", "y", 2.0, T[0])), "2024-01-03", "b2") == 1  # applied before
    assert t.read().count() == 2 and t.read(0).count() == 1 and t.read(at="2024-01-01").first().sales == 1.0
    with pytest.raises(Conflict):
        t.write(t.read(), AT, base=0)
    with pytest.raises(LookupError):
        t.read(7)
    assert t.add_columns(AT, source_row_id="string") == 2 and "source_row_id" in t.read().columns
    assert t.compact(AT) == 3 and t.read().count() == 2
    assert t.vacuum(keep=1) == [0, 1, 2] and t.versions() == [3]


def test_unfinished_write_is_not_seen(spark, tmp_path):
    t = SnapshotTable(spark, f"file://{tmp_path}/t")
    t.write(rows(spark, ("a", "1", "x", 1.0, T[0])), AT)
    rows(spark, ("b", "1", "x", 1.0, T[0])).write.parquet(f"file://{tmp_path}/t/v=1-dead")  # died before its commit
    assert t.read().count() == 1
    assert t.write(rows(spark, ("c", "1", "x", 1.0, T[0])), AT) == 1 and t.read().first().order_id == "c"
    t.vacuum(keep=2)
    assert not (tmp_path / "t" / "v=1-dead").exists() and t.read(0).first().order_id == "a"


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    """B writes all its files between A's files and A's commit: A's version has A's rows, and B fails."""
    path = f"file://{tmp_path}/t"
    a, b = SnapshotTable(spark, path), SnapshotTable(spark, path)
    a.write(rows(spark, ("x", "1", "x", 1.0, T[0])), AT)
    commit, failed = SnapshotTable._commit, []

    def late(self, version, text):
        if self is a:
            monkeypatch.setattr(SnapshotTable, "_commit", lambda *_: failed.append(1))  # B dies before its own commit
            b.write(rows(spark, *[(f"b{i}", "1", "b", 1.0, T[0]) for i in range(5)]), AT, "B-1")
            monkeypatch.setattr(SnapshotTable, "_commit", commit)
        commit(self, version, text)

    monkeypatch.setattr(SnapshotTable, "_commit", late)
    a.write(rows(spark, ("a", "1", "a", 1.0, T[0])), AT, "A-1")
    monkeypatch.setattr(SnapshotTable, "_commit", commit)
    assert failed and [r.order_id for r in b.read().collect()] == ["a"] and b.applied("A-1") and not b.applied("B-1")
    with pytest.raises(Conflict):
        b.write(rows(spark, ("b", "1", "b", 1.0, T[0])), AT, "B-1", base=0)
    assert b.write(rows(spark, ("b", "1", "b", 1.0, T[0])), AT, "B-1") == 2


def test_batches_are_remembered(spark, tmp_path):
    t = SnapshotTable(spark, f"file://{tmp_path}/t")
    for n in range(4):
        t.merge(rows(spark, (f"k{n}", "1", "x", 1.0, T[0])), AT, f"b{n}")
    assert t.info(3)["past"] == [] and t.info(3)["batch"] == "b3"
    assert t.vacuum(keep=1) == [0, 1, 2] and all(t.applied(f"b{n}") for n in range(4)) and not t.applied("b4")
    t.merge(rows(spark, ("k9", "1", "x", 1.0, T[0])), AT, "b4")
    t.vacuum(keep=1)
    assert t.applied("b0") and t.applied("b4") and t.read().count() == 5


def test_merge_of_the_buckets_that_are_met(spark, tmp_path):
    table = PartitionedTable(spark, f"file://{tmp_path}/t", buckets=16)
    whole = rows(spark, *[(f"o{i}", "1", "old", float(i), T[1]) for i in range(200)])
    assert not table.exists()
    table.merge(whole)
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    before = files()
    batch = rows(spark, ("o3", "1", "new", -1.0, T[2]), ("o4", "1", "late", -1.0, T[0]), ("n1", "1", "new", -1.0, T[0]))
    expected = merge_rows(whole, batch).collect()
    touched = table.merge(batch)
    assert 1 <= len(touched) <= 3 and touched == table.met(batch)
    after, of = files(), lambda name: int(name.split("bucket=")[1].split("/")[0])
    assert {f for f in before if of(f) not in touched} <= after.keys() and all(after[f] == t for f, t in before.items() if of(f) not in touched)
    assert not {f for f in before if of(f) in touched} & after.keys()
    assert sorted(table.read().collect()) == sorted(expected) and len(expected) == 201
    read = table.read(*touched)
    assert len(read.inputFiles()) < len(table.read().inputFiles()) or "PartitionFilters: [" in read._jdf.queryExecution().toString()
    table.merge(batch)  # again, as after a failure
    assert sorted(table.read().collect()) == sorted(expected)
    assert table.merge(batch.limit(0)) == []
    with pytest.raises(ValueError, match="share"):
        table.merge(batch.union(batch))


def test_quarantine(spark, tmp_path):
    path = f"file://{tmp_path}/q"
    assert not append_quarantine(rows(spark).limit(0), path)
    assert append_quarantine(rows(spark, ("a", "1", "x", 1.0, T[0])), path)
    assert append_quarantine(rows(spark, ("b", "1", "x", 1.0, T[0])).withColumn("more", F.lit(1)), path)
    assert read_quarantine(spark, path).select("more").count() == 2


def test_history(spark):
    day, end = date(2024, 5, 1), date(2099, 12, 31)
    old = spark.createDataFrame([(1, "a", date(2024, 1, 1), end, True), (2, "b", date(2024, 1, 1), end, True), (3, "c", date(2024, 1, 1), end, True)], "k int, v string, effective_date date, expiration_date date, is_current boolean")
    new = spark.createDataFrame([(1, "a"), (2, None), (4, "d")], "k int, v string")
    out = track_changes(old, new, ("k",), ("v",), day, end)
    got = sorted((r.k, r.v or "", str(r.effective_date), r.is_current) for r in out.collect())
    assert got == [(1, "a", "2024-01-01", True), (2, "", "2024-05-01", True), (2, "b", "2024-01-01", False), (3, "c", "2024-01-01", True), (4, "d", "2024-05-01", True)]
    assert checks.scd2_integrity(out, "k", "effective_date", "expiration_date", "is_current", "v").count() == 0
    again = track_changes(out, new, ("k",), ("v",), day, end)
    assert again.exceptAll(out).count() == 0 and again.count() == out.count()


def test_keys_do_not_depend_on_how_they_are_made(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("x"), F.col("id").alias("y"))
    a, b = dense_keys(df, "n", ["x"]), ranged_keys(df.repartition(7), "n", ["x"])
    assert a.exceptAll(b).count() == 0 and b.count() == 500
    assert ranged_keys(df.limit(0), "n", ["x"]).count() == 0


def test_models_are_ordered():
    order = build_order()
    assert all(order.index(r) < order.index(n) for n, (reads, _) in MODELS.items() for r in reads if r in MODELS)
    with pytest.raises(Exception, match="cycle"):
        build_order({"a": (("b",), None), "b": (("a",), None)})


def test_generator(spark):
    a = generator.generate(spark, 300, date(2024, 1, 1))
    assert a.exceptAll(generator.generate(spark, 300, date(2024, 1, 1)).repartition(5)).count() == 0
    assert a.where("sales <= 0 or quantity not between 1 and 10 or discount > 0.5").count() == 0
    back = generator.from_messages(generator.as_messages(a))
    assert back.exceptAll(a).count() == 0
    share = a.where("discount > 0").count() / 300
    assert 0.2 < share < 0.4


def test_production(spark):
    got, waits, now = [], [], [0.0]

    def wait(s):
        waits.append(s)
        now[0] += s

    assert generator.produce(got.append, spark, date(2024, 1, 1), 250, batch=100, rate=50, clock=lambda: now[0], wait=wait) == 250
    assert [df.count() for df in got] == [100, 100, 50] and waits == [0.0, 2.0, 2.0]
    whole = got[0].union(got[1]).union(got[2])
    assert whole.exceptAll(generator.generate(spark, 250, date(2024, 1, 1))).count() == 0
    burst = []
    assert generator.produce(burst.append, spark, date(2024, 1, 1), 30, batch=10, wait=wait) == 30 and len(burst) == 3 and len(waits) == 3
    assert generator.produce(burst.append, spark, date(2024, 1, 1), 0) == 0


def test_stream_merges_once(spark, tmp_path):
    events = generator.generate(spark, 200, date(2024, 1, 1))
    events.repartition(4).write.json(f"{tmp_path}/in")
    table = SnapshotTable(spark, f"file://{tmp_path}/silver")
    settings = Settings(as_of=date(2024, 1, 2), source_system="KAFKA")
    for _ in range(2):  # the second run finds nothing new
        stream = ingest.event_stream(spark, f"{tmp_path}/in", files=1)
        ingest.start_merge(stream, table, f"{tmp_path}/check", AT, settings).awaitTermination()
    whole = ops.silver(ingest.event_times(events), settings)
    keys = ["order_id", "product_id", "sales", "processing_timestamp"]
    assert table.read().select(keys).exceptAll(whole.select(keys)).count() == 0
    assert table.read().count() == whole.count()
    old = events.limit(1).withColumn("event_timestamp", F.lit("2001-01-01T00:00:00Z")).withColumn("sales", F.lit(1.0))
    old.write.json(f"{tmp_path}/in2")
    before = table.read().count()
    ingest.start_merge(ingest.event_stream(spark, f"{tmp_path}/in2"), table, f"{tmp_path}/check2", AT, settings, name="late").awaitTermination()
    assert table.read().count() == before and table.read().where("sales = 1.0").count() == 0


def test_malformed_lines(spark):
    lines = spark.createDataFrame([(json.dumps({"order_id": "x"}),), ("{broken",), ("{}",)], "value string")
    good, dead = ingest.split_malformed(lines)
    assert good.count() == 1 and dead.count() == 2


def test_stream_files_by_hour(spark, tmp_path):
    generator.generate(spark, 50, date(2024, 1, 1)).write.json(f"{tmp_path}/in")
    ingest.start_files(ingest.event_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    out = spark.read.json(f"{tmp_path}/out")
    assert out.count() == 50 and {"year", "month", "day", "hour"} <= set(out.columns)


def test_first_seen(spark, tmp_path):
    events = generator.generate(spark, 40, date(2024, 1, 1))
    for part in ("a", "b"):
        events.write.mode("append").json(f"{tmp_path}/in")
    stream = ingest.event_stream(spark, f"{tmp_path}/in").withColumn("at", F.to_timestamp("event_timestamp"))
    out = ingest.first_seen(stream, "at", "order_id", "2 days")
    query = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination()
    kept = spark.read.parquet(f"{tmp_path}/out")
    assert kept.count() == events.select("order_id").distinct().count() == kept.select("order_id").distinct().count()


def test_failed_stream_goes_on(spark, tmp_path):
    generator.generate(spark, 30, date(2024, 1, 1)).write.json(f"{tmp_path}/in")
    tries, seen = [], []

    def start(failures):
        def batch(df, number):
            if len(tries) <= failures:
                raise RuntimeError("no")
            seen.append(df.count())

        tries.append(1)
        return ingest.event_stream(spark, f"{tmp_path}/in").writeStream.foreachBatch(batch).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()

    with pytest.raises(Exception, match="no"):
        ingest.keep_running(lambda: start(9), tries=2)
    assert len(tries) == 2 and not seen
    tries.clear()
    query = ingest.keep_running(lambda: start(1))
    assert len(tries) == 2 and sum(seen) == 30
    told = ingest.health(query)
    assert (told["active"], told["error"], told["batch"], told["rows"]) == (False, None, 0, 30)
