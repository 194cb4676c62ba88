"""Hard negatives against all pairs, bounds of trees, and odd rows."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tests.conftest import rows_of, same_as_sql
from tidemart.llm import negatives, queries

ROWS = "vec_id long, label int, embedding array<float>, x string, place int"


def test_same_as_sql(spark, sf_dir, duck):
    same_as_sql(queries.op13_hard_negatives(spark, sf_dir), duck, queries.ORACLES["op13_hard_negatives"])


def naive(rows, is_anchor, positives=5, negatives_=10):
    """All pairs; rows are (id, label, vector)."""
    rows = [(i, y, np.array([int(np.floor(256 * float(np.float32(c)))) for c in v], object)) for i, y, v in rows]
    width = max((len(v) for *_, v in rows), default=0)
    rows = [(i, y, np.append(v, [0] * (width - len(v)))) for i, y, v in rows]
    out = []
    for k, (i, y, v) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = sorted((-int(sum(v * w)), j is None, j or 0, n, z == y) for n, (j, z, w) in enumerate(rows) if n != k)
        for s, p_null, p, _, _ in [r for r in scored if r[4]][:positives]:
            hits = [r for r in scored if not r[4] and 30 * -s <= 100 * -r[0] <= 90 * -s][:negatives_]
            out += [(i, None if r[1] else r[2], -r[0], None if p_null else p, -s, rank) for rank, r in enumerate(hits, 1)]
    return sorted(out, key=lambda row: tuple((v is None, str(v)) for v in row))


def mined(spark, rows, is_anchor, **options):
    df = spark.createDataFrame([(i, y, v, "z", 3) for i, y, v in rows], ROWS).repartition(3)
    return rows_of(negatives.hard_negatives(df, is_anchor, **options))


@pytest.mark.parametrize("shift", [0.0, 0.6])
def test_all_pairs(spark, monkeypatch, shift):
    monkeypatch.setattr(negatives, "SHARD_NUMBERS", 400)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 8))
    rows = [(k, int(rng.integers(4)), [float(np.float32(c)) for c in centres[k % 5] + rng.normal(size=8) * 0.4 + shift]) for k in range(700)]
    assert mined(spark, rows, F.col("vec_id") % 23 == 0) == naive(rows, lambda i: i % 23 == 0)


def test_hot_group_and_ties(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD_NUMBERS", 100)
    rng = np.random.default_rng(4)
    rows = [(k, k % 3 if k % 2 else 0, [0.5, 0.25, 0.125] if k % 3 else [float(np.float32(c)) for c in rng.normal(size=3)]) for k in range(400)]
    assert mined(spark, rows, F.col("vec_id") % 40 == 0) == naive(rows, lambda i: i % 40 == 0)


def test_odd_rows(spark):
    nan = float("nan")
    good = [(0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.5, 0.2]), (None, 2, [0.5, 0.2]), (3, 1, [0.1]), (4, 2, []), (0, 1, [1.0, 0.5]), (7, 2, [0.5, 0.2]), (8, 2, [-1.0, 0.0])]
    bad = [(100, None, [1.0, 1.0]), (101, 1, None), (102, 2, [nan, 1.0]), (103, 2, [None, 1.0]), (104, 2, [float("inf"), 1.0])]
    got = mined(spark, good + bad, F.col("vec_id") % 100 == 0)
    assert got == naive(good, lambda i: i is not None and i % 100 == 0) and any(None in row for row in got)
    assert mined(spark, [], F.col("vec_id") % 100 == 0) == [] == mined(spark, bad, F.col("vec_id") % 100 == 0)
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [1.0])], F.lit(True)) == []  # no other label
    assert mined(spark, good[:3], F.lit(None).cast("boolean")) == []


def test_numbers_beyond_doubles(spark):
    rows = [(k, k % 2, [float(np.float32(4e5 + 7919 * k)), float(np.float32(3e5 - 104729 * (k % 4)))]) for k in range(40)]
    assert mined(spark, rows, F.col("vec_id") % 10 == 0) == naive(rows, lambda i: i % 10 == 0)


@settings(max_examples=60, deadline=None)
@given(data=st.data(), width=st.integers(1, 4), n=st.integers(1, 60))
def test_bounds_hold(data, width, n):
    entry = st.integers(-50, 50)
    x = np.array(data.draw(st.lists(st.lists(entry, min_size=width, max_size=width), min_size=n, max_size=n)))
    queries_ = np.hstack([x[: max(1, n // 3)].astype(float), np.zeros((max(1, n // 3), 1))])
    norm = float((x * x).sum(axis=1).max())
    nodes = negatives.grown(negatives.augmented(x, norm), 4)
    least, most = negatives.score_bounds(*negatives.bounds(nodes, queries_), queries_, norm)
    seen = []
    for k, node in enumerate(nodes):
        if node.vantage is None:
            scores = x[node.rows] @ queries_[:, :-1].T
            assert (scores >= least[k]).all() and (scores <= most[k]).all() and len(node.rows) <= 4
            seen += node.rows.tolist()
    assert sorted(seen) == list(range(n))
