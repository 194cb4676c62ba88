"""Hard negatives by a vantage-point forest over norm-augmented vectors.

Each vector gets one more coordinate that fills its norm up to the largest one, and an anchor gets 0 there. Then the
distance between anchor and row falls as their inner product rises, so the nearest rows have the highest scores and a
window of scores is an annulus around the anchor. Rows are dealt to cells of a small tree of vantage points and to shards
of bounded size within a cell; each shard has a tree of its own, whose nodes are rows of a table. An anchor visits the
shards of its own cell first, and after that, with the score of the last row it needs no more than, those whose cells
can hold better ones. In a shard it visits leaves from near to far and ends where no leaf can be near enough.
Distances only choose what is visited, with room for rounding; scores are whole numbers.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.llm.common import arrow_input, written
from tidemart.llm.vectors import matrix, whole_vectors

LEAF = 256  #: rows in a leaf, at most
SAMPLE = 2048  #: rows that choose the vantage points of the cells
CELLS = 256  #: at most
SHARD_NUMBERS = 1 << 22  #: entries of vectors in a shard, about
ROOM = 1e-7  #: of the squared norms: what rounding may add to or take from a bound
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
NODE = (
    "shard int, node int, near int, far int, ranges array<double>, vantage array<double>, "
    "ids array<long>, labels array<long>, places array<long>, x array<long>"
)
FOUND = "place long, want int, score long, id long, found long"


def number_type(norm: float):
    """Scores between rows of at most this squared norm are exact in it."""
    return np.float64 if norm < 1 << 53 else np.int64 if norm < 1 << 62 else object


def augmented(x: np.ndarray, norm: float) -> np.ndarray:
    """The rows with the coordinate that fills their squared norm up to ``norm``."""
    x = x.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(norm - (x * x).sum(axis=1), 0))[:, None]])


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - to) ** 2).sum(axis=1), 0))


@dataclass
class Node:
    """An inner node has a vantage point, a child with the nearer half of its rows and one with the others, and for each
    child the range of its rows' distances to the point; a leaf has rows."""

    near: int = -1
    far: int = -1
    ranges: tuple[float, ...] = ()
    vantage: np.ndarray | None = None
    rows: np.ndarray | None = None


def grown(points: np.ndarray, leaf: int) -> list[Node]:
    """The tree over augmented points, the root first and children after their parents. Points that are all as far from
    each vantage point tried, such as equal ones, are cut in two anyhow."""
    nodes = [Node(rows=np.arange(len(points)))]
    for node in nodes:
        rows = node.rows
        if len(rows) <= leaf:
            continue
        tried = [distances(points[rows], points[v]) for v in rows[np.linspace(0, len(rows) - 1, 5).astype(int)]]
        best = max(range(len(tried)), key=lambda k: tried[k].std())
        d = tried[best]
        order = np.argsort(d, kind="stable")
        cut = len(rows) // 2
        a, b = order[:cut], order[cut:]
        node.vantage = points[rows[np.linspace(0, len(rows) - 1, 5).astype(int)[best]]]
        node.ranges = (d[a[0]], d[a[-1]], d[b[0]], d[b[-1]])
        node.near, node.far, node.rows = len(nodes), len(nodes) + 1, None
        nodes += [Node(rows=rows[a]), Node(rows=rows[b])]
    return nodes


def bounds(nodes: list[Node], queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node and query the least and the largest distance that a row below the node can have."""
    low, high = np.zeros((len(nodes), len(queries))), np.full((len(nodes), len(queries)), np.inf)
    for k, node in enumerate(nodes):
        if node.vantage is None:
            continue
        d = distances(queries, node.vantage)
        for child, (least, most) in ((node.near, node.ranges[:2]), (node.far, node.ranges[2:])):
            low[child] = np.maximum(low[k], np.maximum(d - most, least - d))
            high[child] = np.minimum(high[k], d + most)
    return low, high


def score_bounds(low: np.ndarray, high: np.ndarray, queries: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """The distances as scores, from least to largest, with room for rounding."""
    both = norm + (queries * queries).sum(axis=1)
    room = ROOM * both + 1
    return (both - np.square(high)) / 2 - room, (both - np.square(low)) / 2 + room


class Tree:
    """One shard: its nodes, and the rows of its leaves."""

    def __init__(self, batch: pa.RecordBatch, width: int, norm: float):
        self.norm, self.kind = norm, number_type(norm)
        whole = lambda c, k: batch.column(c)[k].values
        self.nodes, self.leaves = [], {}
        for k in range(batch.num_rows):
            near, far = batch.column("near")[k].as_py(), batch.column("far")[k].as_py()
            if near >= 0:
                vantage = whole("vantage", k).to_numpy()
                self.nodes.append(Node(near, far, tuple(batch.column("ranges")[k].as_py()), vantage))
                continue
            self.nodes.append(Node())
            ids = whole("ids", k)
            x = whole("x", k).to_numpy().reshape(len(ids), width).astype(self.kind)
            unknown = np.asarray(ids.is_null().to_numpy(zero_copy_only=False))
            self.leaves[k] = x, ids.fill_null(HIGHEST).to_numpy(), unknown, whole("labels", k).to_numpy(), whole("places", k).to_numpy()

    def search(self, x: np.ndarray, labels: np.ndarray, places: np.ndarray, wants: list, k: int, same: bool) -> Iterator[tuple]:
        """(place, want, score, id, found) of the first ``k`` rows in each window of each query; a query's ``wants`` are
        (number, least score, largest score)."""
        queries = np.hstack([x.astype(np.float64), np.zeros((len(x), 1))])
        low, high = bounds(self.nodes, queries)
        least, most = score_bounds(low, high, queries, self.norm)
        leaves = np.fromiter(self.leaves, int, len(self.leaves))
        for q in range(len(x)):
            order = leaves[np.argsort(low[leaves, q], kind="stable")]
            windows = [[want, lo, hi, []] for want, lo, hi in wants[q]]
            for leaf in order:
                asked = [w for w in windows if w[1] <= most[leaf, q] and w[2] >= least[leaf, q]]
                if not asked:
                    if all(w[1] > most[leaf, q] for w in windows):
                        break  # leaves further off hold lower scores only
                    continue
                rows, ids, unknown, kinds, own = self.leaves[leaf]
                scores = rows @ x[q].astype(self.kind)
                fits = (scores >= min(w[1] for w in asked)) & (scores <= max(w[2] for w in asked)) & ((kinds == labels[q]) == same) & (own != places[q])
                at = np.flatnonzero(fits)
                if not len(at):
                    continue
                # better rows first: higher scores, then smaller ids, null ids last
                at = at[np.lexsort((own[at], unknown[at], ids[at], -scores[at]))]
                for w in asked:
                    hits = at[(scores[at] >= w[1]) & (scores[at] <= w[2])][:k]
                    new = [(-int(scores[i]), bool(unknown[i]), int(ids[i]), int(own[i])) for i in hits]
                    w[3] = heapq.nsmallest(k, w[3] + new)
                    if len(w[3]) == k:
                        w[1] = max(w[1], -w[3][-1][0])
            for want, _, _, found in windows:
                for score, unknown, i, place in found:
                    yield int(places[q]), want, -score, None if unknown else i, place


@dataclass
class Forest:
    """Rows (``points``: id, label, x, place, whether an anchor) and the nodes of all shards' trees."""

    points: DataFrame
    nodes: DataFrame
    cells: list[Node]  #: the tree of cells
    shards: list[tuple[int, int]]  #: by leaf of the tree of cells: its first shard and how many it has
    width: int
    norm: float

    @classmethod
    def over(cls, points: DataFrame, leaf: int = LEAF, shard_numbers: int = SHARD_NUMBERS) -> Forest | None:
        """Of a written table of points; None if it is empty."""
        norms = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
        seen = points.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.max(norms).alias("norm")).first()
        if not seen.n:
            return None
        width, norm = seen.width, seen.norm
        tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        wanted = min(CELLS, 1 << (max(1, tasks) - 1).bit_length(), 1 << max(0, (seen.n // 32).bit_length() - 1))
        sample = points.select("x").orderBy(F.xxhash64("place")).limit(SAMPLE).toPandas()["x"]  # a bounded sample
        sampled = np.zeros((len(sample), width), np.int64)
        for k, v in enumerate(sample):
            sampled[k, : len(v)] = v
        cells = grown(augmented(sampled, norm), max(1, -(-len(sampled) // wanted)))
        for node in cells:
            if node.vantage is not None:  # other rows than those of the sample are only known to lie on one side
                middle = (node.ranges[1] + node.ranges[2]) / 2
                node.ranges = (0.0, middle, middle, math.inf)
            node.rows = None
        dealt = written(in_cells(points, cells, width, norm), "cells")
        counts = dict(dealt.groupBy("cell").count().collect())  # a row for each cell
        shards, first = [], 0
        for k in range(len(cells)):
            many = -(-counts.get(k, 0) * max(1, width) // shard_numbers)
            shards.append((first, many))
            first += many
        starts, many = (F.array(*[F.lit(s[i]) for s in shards]) for i in (0, 1))
        of = lambda array: F.element_at(array, F.col("cell") + 1)
        shard = of(starts) + F.pmod(F.xxhash64("place"), of(many)).cast("int")
        trees = arrow_input(dealt.withColumn("shard", shard), "shard", "id", "label", "place", "x")
        nodes = trees.groupBy("shard").applyInArrow(lambda t: shard_nodes(t, width, norm, leaf), NODE)
        return cls(points, written(nodes, "trees"), cells, shards, width, norm)

    def first(self, requests: DataFrame, k: int, same: bool) -> DataFrame:
        """(place, want, score, id, found, rank): for each request's windows the first ``k`` other rows with its label
        (``same``) or another one, from high to low score, equal scores by id.

        Requests: (place, label, x, wants: an array of (want, low, high)). Two rounds: the request's own cell, and then
        the others that may hold better rows. Each shard returns ``k`` rows a window at most.
        """
        requests = written(requests.where(F.size("wants") > 0), "requests")
        home = written(self._round(requests, k, same, True), "found")
        enough = ranked(home).where(F.col("rank") == k).groupBy("place")
        enough = enough.agg(F.map_from_entries(F.collect_list(F.struct("want", "score"))).alias("enough"))  # a few windows
        raised = lambda w: F.struct(w["want"], F.greatest(w["low"], F.coalesce(F.col("enough")[w["want"]], w["low"])).alias("low"), w["high"])
        left = requests.join(enough, "place", "left").select("place", "label", "x", F.transform("wants", raised).alias("wants"))
        others = self._round(left, k, same, False)
        return ranked(home.union(others)).where(F.col("rank") <= k)

    def _round(self, requests: DataFrame, k: int, same: bool, home: bool) -> DataFrame:
        width, norm, cells = self.width, self.norm, self.cells
        starts, many = (F.array(*[F.lit(s[i]) for s in self.shards]) for i in (0, 1))
        of = lambda array: F.element_at(array, F.col("cell") + 1)
        visits = with_visits(requests, cells, width, norm, home).withColumn("cell", F.explode("visits")).where(of(many) > 0)
        visits = visits.withColumn("shard", F.explode(F.sequence(of(starts), of(starts) + of(many) - 1)))
        asked = visits.select("shard", F.lit(HIGHEST).alias("at"), F.array("label").alias("labels"), F.array("place").alias("places"), "x", "wants")
        trees = self.nodes.withColumn("at", F.col("node").cast("long"))
        both = trees.unionByName(asked, allowMissingColumns=True)
        parts = max(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), sum(n for _, n in self.shards))
        met = both.repartition(parts, "shard").sortWithinPartitions("shard", "at").drop("at")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, shard, parts = None, None, []
            for batch in batches:
                numbers = batch.column("shard").to_numpy()
                is_node = np.asarray(batch.column("node").is_valid())
                changes = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(is_node.astype(int)) != 0)) + 1
                for a, b in zip([0, *changes], [*changes, len(numbers)], strict=True):
                    if a == b:
                        continue
                    piece = batch.slice(a, b - a)
                    if shard != numbers[a]:
                        tree, shard, parts = None, numbers[a], []
                    if is_node[a]:
                        parts.append(piece)
                        continue
                    if tree is None:
                        tree, parts = Tree(pa.concat_batches(parts), width, norm), []
                    wants = [[(w["want"], w["low"], w["high"]) for w in some] for some in piece.column("wants").to_pylist()]
                    firsts = lambda c, p=piece: p.column(c).flatten().to_numpy()
                    rows = list(tree.search(matrix(piece.column("x"), width), firsts("labels"), firsts("places"), wants, k, same))
                    if rows:
                        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, names=["place", "want", "score", "id", "found"])

        return arrow_input(met).mapInArrow(run, FOUND)


def ranked(found: DataFrame) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("found")]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("place", "want").orderBy(*order)))


def in_cells(points: DataFrame, cells: list[Node], width: int, norm: float) -> DataFrame:
    """The points with the leaf of the tree of cells that they fall into."""
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = augmented(matrix(batch.column("x"), width), norm)
            yield batch.append_column("cell", pa.array(homes(cells, x), pa.int32()))

    kept = arrow_input(points, "id", "label", "place", "x")
    return kept.mapInArrow(run, T.StructType([*kept.schema, T.StructField("cell", T.IntegerType())]))


def homes(cells: list[Node], points: np.ndarray) -> np.ndarray:
    at = np.zeros(len(points), np.int64)
    for k, node in enumerate(cells):
        if node.vantage is not None:
            here = np.flatnonzero(at == k)
            at[here] = np.where(distances(points[here], node.vantage) <= node.ranges[1], node.near, node.far)
    return at


def with_visits(requests: DataFrame, cells: list[Node], width: int, norm: float, home: bool) -> DataFrame:
    """The requests with ``visits``, the cells to look into: each one's own, or else the others that its windows may meet."""
    from pyspark.sql import types as T

    leaves = np.array([k for k, node in enumerate(cells) if node.vantage is None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), width).astype(np.float64)
            queries = np.hstack([x, np.zeros((len(x), 1))])
            own = homes(cells, queries)
            if home:
                visits = [[int(c)] for c in own]
            else:
                least, most = score_bounds(*bounds(cells, queries), queries, norm)
                visits = []
                for q, wants in enumerate(batch.column("wants").to_pylist()):
                    meets = np.zeros(len(leaves), bool)
                    for w in wants:
                        meets |= (most[leaves, q] >= w["low"]) & (least[leaves, q] <= w["high"])
                    visits.append([int(c) for c in leaves[meets] if c != own[q]])
            yield batch.append_column("visits", pa.array(visits, pa.list_(pa.int32())))

    kept = arrow_input(requests, "place", "label", "x", "wants")
    return kept.mapInArrow(run, T.StructType([*kept.schema, T.StructField("visits", T.ArrayType(T.IntegerType()))]))


def shard_nodes(rows: pa.Table, width: int, norm: float, leaf: int) -> pa.Table:
    """The tree of one shard, a row for each node."""
    rows = rows.sort_by("place").combine_chunks()
    x = matrix(rows.column("x").combine_chunks(), width)
    points = augmented(x, norm)
    shard, out = rows.column("shard")[0].as_py(), []
    for k, node in enumerate(grown(points, leaf)):
        one = {"shard": shard, "node": k, "near": node.near, "far": node.far, "ranges": list(map(float, node.ranges)), "vantage": [], "ids": [], "labels": [], "places": [], "x": []}
        if node.vantage is not None:
            one["vantage"] = node.vantage.tolist()
        else:
            picked = rows.take(pa.array(node.rows))
            one |= {"ids": picked.column("id").to_pylist(), "labels": picked.column("label").to_pylist(), "places": picked.column("place").to_pylist(), "x": x[node.rows].ravel().tolist()}
        out.append(one)
    kinds = [("shard", pa.int32()), ("node", pa.int32()), ("near", pa.int32()), ("far", pa.int32()), ("ranges", pa.list_(pa.float64())), ("vantage", pa.list_(pa.float64()))]
    kinds += [(c, pa.list_(pa.int64())) for c in ("ids", "labels", "places", "x")]
    return pa.Table.from_pylist(out, schema=pa.schema(kinds))


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its first
    ``positives`` other rows of the same label the first ``negatives`` rows of other labels whose score is between
    ``low_percent`` and ``high_percent`` of the positive's.

    Scores are inner products of the vectors' entries as ``floor(256 c)``; higher scores come first, ties by smaller id
    (null ids last). Ids and labels are whole numbers. Rows with a null label, and vectors that are null or have null or
    infinite entries or ones that are no numbers, take no part; shorter vectors are filled up with zeros. ``is_anchor``
    is a condition on the rows of ``df`` (null: no). Repeated rows are rows of their own: other rows than the anchor's
    own, and anchors themselves. An anchor with no such positive or negative has no rows; scores below 0 have no window.
    An empty table gives an empty result; other columns are not read. Every search is exact; a search that returns
    fewer rows than asked for visits all shards its window meets.
    """
    kept = [F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor")]
    rows = whole_vectors(df.where(F.col(f"`{label_col}`").isNotNull()), vector_col, *kept)
    points = written(rows.withColumn("place", F.monotonically_increasing_id()), "points")
    forest = Forest.over(points)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if not forest:
        return df.sparkSession.createDataFrame([], ", ".join(f"{c} {'int' if c == 'rank' else 'long'}" for c in names))
    want = lambda n, low, high: F.struct(n.cast("int").alias("want"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    anchors = points.where("anchor").select("place", F.col("id").alias("anchor_id"), "label", "x")
    everything = F.array(want(F.lit(0), F.lit(LOWEST), F.lit(HIGHEST)))
    same = forest.first(anchors.select("place", "label", "x", everything.alias("wants")), positives, True)
    same = written(same.select("place", F.col("rank").alias("want"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    wide = F.col("positive_score").cast("decimal(38,0)")
    low, high = F.ceil(wide * low_percent / 100), F.floor(wide * high_percent / 100)
    windows = same.where("positive_score >= 0").groupBy("place").agg(F.collect_list(want(F.col("want"), low, high)).alias("wants"))
    windows = windows.withColumn("wants", F.filter("wants", lambda w: w["low"] <= w["high"]))
    other = forest.first(anchors.join(windows, "place").select("place", "label", "x", "wants"), negatives, False)
    other = other.select("place", "want", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return other.join(same, ["place", "want"]).join(anchors.select("place", "anchor_id"), "place").select(*names)


SQL = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda c: floor(256 * c::double)) as x
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.x, b.x)::bigint as score
  from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positives as (
  select * from scored where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
  row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id)::integer as rank
from positives p join scored n on n.anchor_id = p.anchor_id and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify rank <= 10
"""
