"""Rendezvous shards: a naive version, the moves that a changed number or weight makes, and odd rows."""

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.conftest import same_as_sql
from tidemart.llm import queries, sharding

DOCS = "doc_id long, text string, shard string, _shard int"


def slow_choice(key, weights):
    scores = []
    for s, w in enumerate(weights):
        n = int(hashlib.md5(f"{key}|{s}".encode()).hexdigest()[: sharding.DIGITS], 16)
        scores.append((-w / math.log((n + 0.5) / 16**sharding.DIGITS), s))
    return max(scores)[1]


def keyed(spark, n):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.lit("ab").alias("text"))


def chosen(df, weights):
    return {r.doc_id: r.shard for r in sharding.assigned(df, weights).collect()}


def test_same_as_sql(spark, sf_dir, duck):
    same_as_sql(queries.op11_rendezvous_shards(spark, sf_dir), duck, queries.ORACLES["op11_rendezvous_shards"])


@pytest.mark.parametrize("weights", [[1.0], [1.0] * 8, [1.0, 2.0, 3.0, 0.5], [3.0, 0.0, 1.0]])
def test_choices_are_the_naive_ones(spark, weights):
    assert chosen(keyed(spark, 500), weights) == {i: slow_choice(f"={i}", weights) for i in range(500)}


def test_shares_and_moves(spark):
    df = keyed(spark, 20_000)
    weights = [1.0, 2.0, 3.0, 4.0]
    before = chosen(df, weights)
    counts = Counter(before.values())
    assert all(abs(counts[s] - 20_000 * w / 10) < 5 * math.sqrt(20_000 * w / 10) for s, w in enumerate(weights))
    grown = chosen(df, [*weights, 2.0])
    moved = [i for i in before if before[i] != grown[i]]
    assert {grown[i] for i in moved} == {4} and abs(len(moved) - 20_000 * 2 / 12) < 300
    heavier = chosen(df, [1.0, 2.0, 3.0, 6.0])
    assert {heavier[i] for i in before if before[i] != heavier[i]} == {3}
    gone = chosen(df, [1.0, 2.0, 3.0, 0.0])
    assert {before[i] for i in before if before[i] != gone[i]} == {3}
    told = {(r.from_shard, r.to_shard): (r.n_rows, r.n_bytes) for r in sharding.moves(df, weights, [*weights, 2.0]).collect()}
    assert told == {(s, 4): (n, 2 * n) for s, n in Counter(before[i] for i in moved).items()}
    with pytest.raises(ValueError):
        sharding.choice(F.lit("a"), [0.0])


def test_odd_rows(spark):
    long = "é" * 300_000
    data = [(1, "a", "x", 9), (1, "a", "x", 9), (1, "a", "y", 9), (1, "b", "x", 9), (2, None, None, None), (3, "", "x", 1), (None, long, "x", 1), (None, None, "x", 1)]
    data += [(7, "same", "z", 0)] * 400
    df = spark.createDataFrame(data, DOCS).repartition(5)
    rows = sharding.sharded(df).collect()
    assert len(rows) == len(data) and {r.law for r in rows} == {"key"}
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    text = lambda t: (t or "").encode()
    want = Counter((i, len(text(t)) + 1, zlib.crc32(text(t)), slow_choice("" if i is None else f"={i}", sharding.EVEN)) for i, t, *_ in data)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in rows) == want
    empty = sharding.sharded(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_written_shards(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "FILE_BYTES", 1 << 17)  # several files a shard
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sharding.write_shards(df, f"file://{tmp_path}/out", [1.0, 2.0, 1.0])
    back = spark.read.parquet(f"file://{tmp_path}/out")
    assert {r.doc_id: r.shard for r in back.collect()} == chosen(df, [1.0, 2.0, 1.0])
    assert back.drop("shard").exceptAll(df).count() == 0 and back.count() == df.count()
    assert len(list((tmp_path / "out" / "shard=1").glob("*.parquet"))) > 1
    with pytest.raises(ValueError):
        sharding.write_shards(df.withColumn("shard", F.lit(1)), f"file://{tmp_path}/no", [1.0])
