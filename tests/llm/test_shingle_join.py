"""The Jaccard join against brute force, and its parts."""

from itertools import combinations

import numpy as np
import pytest

from tidemart.llm import shingle_join as sj
from tidemart.llm.components import connected_components


def words(seed, n):
    draw = np.random.default_rng(seed)
    return [f"w{x}" for x in draw.integers(0, 5000, n)]


def edited(tokens, at):
    return [f"z{i}" if i in at else t for i, t in enumerate(tokens)]


def shingles(text):
    t = (text or "").lower().split()
    return {tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} if t else set()


def brute(rows):
    """{place: (class id, links)} over rows (id, text)."""
    sets = [shingles(t) for _, t in rows]
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if like(sets[i], sets[j]) >= 0.8:
            links[i] += 1
            links[j] += 1
            root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, least[top(i)], links[i]) for i, (d, _) in enumerate(rows)), key=str)


def corpus():
    rows = [(0, None), (1, ""), (2, "  \n"), (3, "one two"), (4, "ONE  two"), (5, "one two three"), (6, "a b c d e")]
    base = words(1, 300)
    rows += [(10 + k, " ".join(edited(base, {7 * i for i in range(k)}))) for k in range(8)]  # from copies to unlike
    rows += [(20 + k, " ".join(words(50 + k, 80))) for k in range(10)]
    long = words(3, 20_000)
    rows += [(40, " ".join(long)), (41, " ".join(edited(long, {5, 900})))]
    rows += [(40, " ".join(long)), (50, rows[9][1]), (51, rows[9][1])]  # a repeated row and exact copies
    return rows


def join(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, copies int")
    return sorted(((r.doc_id, r.class_id, r.links) for r in sj.similar_rows(df, **kw).collect()), key=str)


def test_like_brute_force(spark):
    assert join(spark, corpus()) == brute(corpus())


def test_hot_groups_are_verified_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sj, "SMALL", 2)
    monkeypatch.setattr(sj, "CELL_NODES", 3)
    base = words(9, 120)
    rows = corpus() + [(100 + k, " ".join(edited(base, {k, (3 * k) % 110 + 1}))) for k in range(25)]
    assert join(spark, rows) == brute(rows)


def test_hot_groups_with_empty_cells(spark, monkeypatch):
    monkeypatch.setattr(sj, "SMALL", 2)
    monkeypatch.setattr(sj, "CELL_SHINGLES", 50)  # about two cells for each node
    base = words(9, 120)
    rows = [(k, " ".join(edited(base, {k}))) for k in range(20)]
    assert join(spark, rows) == brute(rows)


def test_chained_texts(spark, monkeypatch):
    """Half of each text is that of the text before: buckets are large and chain all, few texts are linked."""
    monkeypatch.setattr(sj, "SMALL", 2)
    monkeypatch.setattr(sj, "CELL_NODES", 4)
    stretches = [words(300 + k, 60) for k in range(12)]
    rows = []
    for k in range(11):
        base = stretches[k] + stretches[k + 1]
        rows += [(10 * k + e, " ".join(edited(base, {(17 * e) % 120, (31 * e) % 120}))) for e in range(6)]
    assert join(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    more = sj.similar_rows(df, rows=2).select("doc_id", "class_id", "links").collect()  # more pairs meet, in more groups
    assert sorted((tuple(r) for r in more), key=str) == brute(rows)


def test_pairs_are_left_to_the_first_group_of_both():
    a, b, c = (x * 16 for x in (b"\x00", b"\x01", b"\xff"))
    groups = [[a, b, c], [b, c], [a, c], [c]]
    met = sj.met_before(groups, c)
    assert {(i, j) for i, j in combinations(range(4), 2) if met[i, j]} == {(0, 1), (0, 2)}
    assert not sj.met_before(groups, a).any()


def test_empty_table(spark):
    assert join(spark, []) == []


def test_one_of_each_keeps_columns(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, copies int")
    kept = sj.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in brute(rows)})


def test_rows_with_equal_ids_and_texts(spark):
    rows = [(1, "a b c d e f", f"u{k}", {"k": "same"}) for k in range(30)] + [(2, "x y z", "v", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pick string, more map<string,string>")
    kept = [sorted((r.doc_id, r.pick) for r in sj.one_of_each(df.repartition(n, "pick")).collect()) for n in (1, 3)]
    assert kept[0] == kept[1] and [d for d, _ in kept[0]] == [1, 2]


def test_null_ids(spark):
    got = join(spark, [(None, "a b c d e f"), (None, "a b c d e f"), (3, "x y z u v w")])
    assert sorted(got, key=str) == sorted([(None, None, 1), (None, None, 1), (3, 3, 0)], key=str)


def test_bands_reach_the_recall():
    b = sj.bands_for(0.8, 5, 0.9995)
    assert 1 - (1 - 0.8**5) ** b >= 0.9995 > 1 - (1 - 0.8**5) ** (b - 1)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (5, 4)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(None, 1), (2, None)]])
def test_components(spark, edges):
    df = spark.createDataFrame([(*e,) for e in edges], "a long, b long")
    root = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            for x in (a, b):
                root.setdefault(x, x)
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)

    def top(x):
        return x if root[x] == x else top(root[x])

    assert {(r.node, r.component) for r in connected_components(df, "a", "b").collect()} == {(x, top(x)) for x in root}
