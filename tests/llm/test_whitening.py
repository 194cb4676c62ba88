"""Whitening against an eigen decomposition of the exact covariance, merges of states, and odd rows."""

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tidemart.llm import queries, whitening
from tidemart.llm.whitening import State, Whitening

VECTORS = "vec_id long, embedding array<float>, label int, whitened string"


def exact(vectors):
    """(n, sums, covariance) of the distinct integer vectors, covariance from exact fractions."""
    fit = sorted({tuple(v) for v in vectors})
    x = np.array(fit, dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = n * x - sums
    return n, sums, np.array([[float(Fraction(int(v), n**3)) for v in row] for row in centred.T @ centred])


def floors(vector):
    return [int(np.floor(256 * float(np.float32(c)))) for c in vector]


def checked(rows, given_, k=4):
    """``rows`` hold what the exact covariance of ``given_`` (id, vector) says."""
    whole = [(i, floors(v)) for i, v in given_]
    n, sums, cov = exact(v for _, v in whole)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1].T
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    found = {(r.vec_id, r.component): r for r in rows}
    assert len(found) == len(rows) == len(whole) * k
    for c in range(k):
        got = np.array([found[i, c + 1].whitened for i, _ in whole])
        want = (np.array([v for _, v in whole], float) - np.array([int(s) / n for s in sums])) @ vectors[c] / np.sqrt(values[c])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
        assert found[whole[0][0], c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-10)
    for i, v in whole:
        assert found[i, 1].deviation == sum((n * a - int(s)) ** 2 for a, s in zip(v, sums, strict=True))


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = queries.op12_svd_whitening(spark, sf_dir).collect()
    checked(rows, [(r.vec_id, r.embedding) for r in table])
    assert queries.op12_svd_whitening(spark, sf_dir).dtypes[3] == ("deviation", "bigint")


@settings(max_examples=60, deadline=None)
@given(data=st.data(), d=st.integers(1, 6), parts=st.integers(1, 5))
def test_merges_lose_nothing(data, d, parts):
    rows = st.lists(st.lists(st.integers(-300, 300), min_size=d, max_size=d), min_size=1, max_size=9)
    blocks = [np.array(data.draw(rows), np.int64) for _ in range(parts)]
    state = State.of(blocks[0])
    for block in blocks[1:]:
        state = state.merged(State.of(block))
    x = np.vstack(blocks).astype(float)
    centred = x - x.mean(axis=0)
    assert state.n == len(x) and list(state.sums) == list(x.sum(axis=0))
    assert len(state.scaled) <= d and np.allclose(state.scaled.T @ state.scaled, centred.T @ centred, atol=1e-6, rtol=1e-9)
    model = Whitening.of(state)
    assert np.allclose(model.vectors @ model.vectors.T, np.eye(d)) and (np.diff(model.values) <= 1e-9).all()


def test_tree_of_merges(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_BYTES", 1)  # two states at a time
    rng = np.random.default_rng(0)
    data = [(i, [float(np.float32(c)) for c in v], 0, "x") for i, v in enumerate(rng.normal(size=(300, 6)) * [9, 5, 3, 2, 1, 0.5] + 40)]
    df = spark.createDataFrame(data, VECTORS).repartition(7)
    rows = whitening.whitened(df, k=6).collect()
    checked(rows, [(r[0], r[1]) for r in data], k=6)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.1, 0.5, -0.2]), (2, [0.9, -0.5, 0.7]), (2, [0.9, -0.5, 0.7]), (None, [0.3, 0.3, 0.1]), (5, [-0.0, 0.2, 0.9]), (6, [1.0, 1.0])]
    bad = [(10, None), (11, [0.1, None, 0.2]), (12, [nan, 0.1, 0.2]), (13, [inf, 0.1, 0.2]), (14, [-inf, 0.1, 0.2])]
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in good + bad], VECTORS)
    rows = whitening.whitened(df).collect()
    assert len(rows) == 3 * len(good) and {r.n for r in rows} == {5} and {r.component for r in rows} == {1, 2, 3}
    n, sums, cov = exact(floors(v + [0.0] * (3 - len(v))) for _, v in good)
    assert rows[0].explained == pytest.approx(np.linalg.eigvalsh(cov)[-1] / np.trace(cov))
    for c in (1, 2, 3):
        twice = [r.whitened for r in rows if r.vec_id == 2 and r.component == c]
        assert len(twice) == 2 and twice[0] == twice[1]


def test_no_variance_and_nothing(spark):
    df = spark.createDataFrame([(i, [0.5, 0.25], 1, "x") for i in range(3)], VECTORS)
    rows = whitening.whitened(df).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows] == [(1, 0, None, 0.0, None)] * 6
    flat = spark.createDataFrame([(i, [0.01 * i, 0.5], 1, "x") for i in range(30)], VECTORS)
    rows = whitening.whitened(flat).collect()
    assert {r.whitened is None for r in rows if r.component == 1} == {False} and {r.whitened for r in rows if r.component == 2} == {None}
    assert rows[0].identity_error < 1e-9
    for none in (df.limit(0), spark.createDataFrame([(1, [], 1, "x"), (2, None, 1, "x")], VECTORS)):
        out = whitening.whitened(none)
        assert out.count() == 0 and dict(out.dtypes)["deviation"] == "decimal(38,0)"


def test_huge_numbers(spark):
    data = [(1, [3e38, 1.0], 0, "x"), (2, [-3e38, 2.0], 0, "x"), (3, [1e30, 0.5], 0, "x"), (4, [1e12, 0.5], 0, "x"), (5, [1e12, 0.25], 0, "x")]
    rows = whitening.whitened(spark.createDataFrame(data, VECTORS)).collect()
    assert len(rows) == 10 and all(r.whitened is not None for r in rows if r.component == 1)
