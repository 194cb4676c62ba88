"""Numbers, previous rows, as-of lookups, histories and overlaps against brute force, with hot keys over many ranges."""

import random
import time
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemart.operators import checks
from tidemart.operators.asof import as_of
from tidemart.operators.history import add_changes, history
from tidemart.operators.ranges import numbered, with_previous

DAY, END = date(2024, 1, 1), date(2099, 12, 31)
day = lambda n: DAY + timedelta(days=n)


def test_previous_rows_and_numbers(spark):
    data = [(i * 7 % 500, "hot" if i % 3 else None) for i in range(500)]
    df = spark.createDataFrame(data, "n int, g string").repartition(6)
    got = {r.n: r["before"] and r["before"].n for r in with_previous(df, ["n"], ["n"], "before").collect()}
    assert got == {n: n - 1 if n else None for n in range(500)}
    for group in ("hot", None):
        members = sorted(n for n, g in data if g == group)
        found = {r.n: r.k for r in numbered(df, "k", ["n"], ["g"]).collect() if r.g == group}
        assert found == {n: k for k, n in enumerate(members)}
    assert with_previous(df.limit(0), ["n"], ["n"]).count() == numbered(df.limit(0), "k", ["n"]).count() == 0


def test_ordered_checks_are_no_single_task(spark):
    rows = [(n, day(n - (9 if n % 50 == 0 else 0))) for n in range(400)]
    df = spark.createDataFrame(rows, "n int, d date")
    out = checks.disordered_dates(df, "d", "n")
    assert {r.n for r in out.collect()} == set(range(50, 400, 50))
    plan = out._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan.split("== Physical Plan ==")[1].replace("BroadcastExchange", "").split("FileScan")[0]


def test_as_of(spark):
    random.seed(5)
    versions = [(k, day(random.randrange(300)), f"v{i}") for i, k in enumerate(random.choices(["hot"] * 6 + ["a", "b", None], k=120))]
    versions = [(k, d, d + timedelta(days=random.randrange(40)), t) for k, d, t in versions] + [("hot", day(400), None, "open")]
    facts = [(random.choice(["hot"] * 8 + ["a", "b", "none", None]), day(random.randrange(-5, 420)), i) for i in range(900)]
    f = spark.createDataFrame(facts, "key string, d date, n int").repartition(5)
    v = spark.createDataFrame(versions, "key string, since date, until date, name string").repartition(3)

    def naive(k, d, with_end):
        begun = max(((s, t, u) for kk, s, u, t in versions if k is not None and kk == k and s <= d), default=None)
        return begun[1] if begun and not (with_end and begun[2] and begun[2] < d) else None

    for until in (None, "until"):
        out = as_of(f, v, "key", "d", "since", ["name"], until, "name").collect()
        assert {r.n: r.version and r.version.name for r in out} == {n: naive(k, d, until) for k, d, n in facts}
    assert {r.version for r in as_of(f, v.limit(0), "key", "d", "since", ["name"]).collect()} == {None}


def slow_history(changes):
    out = []
    for k in {c[0] for c in changes}:
        told = {}
        for _, d, seq, dead, a in sorted((c for c in changes if c[0] == k), key=lambda c: (c[1], c[2], c[3], c[4])):
            told[d] = None if dead else a
        steps, state = [], None
        for d in sorted(told):
            if told[d] != state:
                steps.append((d, told[d]))
                state = told[d]
        for n, (d, a) in enumerate(steps):
            if a is not None:
                nxt = steps[n + 1][0] if n + 1 < len(steps) else None
                out.append((k, a, d, nxt - timedelta(days=1) if nxt else END, nxt is None))
    return sorted(out)


def test_history_in_any_order(spark):
    random.seed(6)
    changes = [(random.choice("xxxxxyz"), day(random.randrange(60)), n, random.random() < 0.15, random.choice("AB")) for n in range(300)]
    expected = slow_history(changes)
    kinds = "k string, changed_on date, seq int, deleted boolean, a string"
    for batches in (1, 4):
        random.shuffle(changes)
        points = None
        for b in range(batches):
            points = add_changes(points, spark.createDataFrame(changes[b::batches], kinds), ("k",), ("a",))
        assert sorted(map(tuple, history(points, "k", ("a",), END).collect())) == expected
    odd = spark.createDataFrame([(None, DAY, 1, False, "A"), ("x", None, 1, False, "A"), ("y", DAY, 1, True, "A")], kinds)
    assert history(add_changes(None, odd, ("k",), ("a",)), "k", ("a",), END).count() == 0


def test_a_late_change_splits_a_range_that_was_told_twice(spark):
    kinds = "k int, changed_on date, seq int, deleted boolean, a string"
    points = add_changes(None, spark.createDataFrame([(1, day(0), 1, False, "A"), (1, day(9), 2, False, "A")], kinds), ("k",), ("a",))
    assert history(points, "k", ("a",), END).count() == 1
    points = add_changes(points, spark.createDataFrame([(1, day(4), 3, False, "B")], kinds), ("k",), ("a",))
    got = sorted((r.effective_date, r.expiration_date, r.a) for r in history(points, "k", ("a",), END).collect())
    assert got == [(day(0), day(3), "A"), (day(4), day(8), "B"), (day(9), END, "A")]


@pytest.mark.parametrize("seed", range(2))
def test_overlaps(spark, seed):
    random.seed(seed)
    rows = [(random.choice("aab"), day(s := random.randrange(40)), day(s + random.randrange(-3, 9)), f"t{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "k string, e date, x date, t string")
    want = Counter(k for k, e, x, t in rows for k2, e2, x2, t2 in rows if k == k2 and t != t2 and e <= x2 and e2 <= x)
    assert {r.k: r.issue_count for r in checks.overlapping_versions(df, "k", "e", "x", "t").collect()} == dict(want)


def test_many_overlaps_of_one_key(spark):
    n = 100_000
    df = spark.range(n).select(F.lit("hot").alias("k"), F.date_add(F.lit(DAY), (F.col("id") % 1000).cast("int")).alias("e"), F.lit(END).alias("x"), F.col("id").alias("t"))
    began = time.monotonic()
    assert checks.overlapping_versions(df, "k", "e", "x", "t").first().issue_count == n * (n - 1)
    assert time.monotonic() - began < 60
