"""N-gram Jaccard join: MinHash bands propose, full shingle sets decide, connected links make classes.

Texts with equal shingle sets are one node from the start. Nodes that share a band meet in its bucket. Buckets of up to
``SMALL`` nodes give pairs, each verified once. Larger buckets with the same least node make a hot group, so a group
spans what meets that one node and is never a chain of texts that only neighbours join. A pair is verified in the first
group that both are in, in blocks: nodes are dealt into cells, a task compares two cells by a matrix product and returns
one row per node (its links and its root), so nothing grows with the square of a group but the arithmetic itself.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.common import arrow_input, field, written
from tidemart.llm.components import connected_components

WORDS, THRESHOLD = 5, 0.8
SMALL = 16  #: nodes of a bucket whose pairs are listed
CELL_NODES, CELL_SHINGLES = 512, 400_000  #: a cell holds about so many nodes and shingles at most
PRIME = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float = THRESHOLD, rows: int = 5, recall: float = 0.9995) -> int:
    """Bands of ``rows`` hashes that let a pair at the threshold meet with at least this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, on wrapping arithmetic."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's shingles of five lower-cased words.

    Fewer words make one shingle, none an empty set. Word hashes are remembered, up to a bound.
    """

    def __init__(self, remembered: int = 100_000):
        self.words: dict[str, int] = {}
        self.remembered = remembered

    def __call__(self, text: str | None) -> np.ndarray:
        known, tokens = self.words, (text or "").lower().split()
        if not tokens:
            return np.empty(0, np.uint64)
        hashes = []
        for w in tokens:
            h = known.get(w)
            if h is None:
                if len(known) >= self.remembered:
                    known.clear()
                h = known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            hashes.append(h)
        h = np.array(hashes, np.uint64)
        size = min(WORDS, len(h))
        n = len(h) - size + 1
        total = np.full(n, size, np.uint64)
        for k in range(size):
            total = total * PRIME + h[k : k + n]
        return np.unique(mixed(total))


class Bands:
    """Band values of a set: ``rows`` minima each under random affine maps of the 64-bit hashes."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = draw.integers(0, 2**63, (bands * rows, 1), np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 2**63, (bands * rows, 1), np.uint64)
        self.salt = draw.integers(0, 2**63, (bands,), np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo(np.uint64).max)
        for at in range(0, len(shingles), 512):
            least = np.minimum(least, (shingles[at : at + 512] * self.a + self.b).min(axis=1))
        value = self.salt.copy()
        for row in least.reshape(self.bands, self.rows).T:
            value = mixed(value * PRIME + row)
        return value.view(np.int64)


def signed_rows(df: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """(id, text_md5, node, n, bands) per row; ``node`` is a digest of the shingle set."""
    schema = T.StructType(
        [
            field(df, id_col, "id"),
            T.StructField("text_md5", T.BinaryType()),
            T.StructField("node", T.BinaryType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, signature = Shingles(), Bands(bands, rows)
        for batch in batches:
            md5, node, n, values = [], [], [], []
            for x in batch.column(1):
                text = x.as_py() or ""
                found = shingles(text)
                md5.append(hashlib.md5(text.encode()).digest())
                node.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                n.append(len(found))
                values.append(signature(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(md5, pa.binary()),
                    pa.array(node, pa.binary()),
                    pa.array(n, pa.int32()),
                    pa.ListArray.from_arrays(
                        np.arange(0, bands * len(n) + 1, bands, dtype=np.int32),
                        pa.array(np.concatenate(values) if values else [], pa.int64()),
                    ),
                ],
                names=schema.names,
            )

    return arrow_input(df, id_col, text_col).mapInArrow(run, schema)


def block_links(sets: list[np.ndarray], cell: np.ndarray, low: int, high: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked sets, between the cells ``low`` and ``high``, or within the one if they are equal."""
    left = np.flatnonzero(cell == low)
    right = np.flatnonzero(cell == high)
    sizes = np.array([len(s) for s in sets], np.float32)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    names, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = often[column] > 1  # a hash that one set has makes no intersection
    owner, column = owner[keep], np.unique(column[keep], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (first, first + width))
        dense = np.zeros((len(sets), width), np.float32)
        dense[owner[a:b], column[a:b] - first] = 1
        common += dense[left] @ dense[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    linked = (common.astype(np.float64) >= threshold * union.astype(np.float64) - 1e-9) & (union > 0)
    i, j = np.nonzero(linked)
    i, j = left[i], right[j]
    apart = i < j if low == high else slice(None)
    return i[apart], j[apart]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) + len(b) else 1.0


def _verify_pairs(pairs: DataFrame, threshold: float) -> DataFrame:
    """The listed pairs that are similar enough; columns a, b and their copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            last, kept = (None, None), []
            for row in range(batch.num_rows):
                a = batch.column(0)[row].as_py()
                if a != last[0]:
                    last = a, shingles(batch.column(4)[row].as_py())
                kept.append(jaccard(last[1], shingles(batch.column(5)[row].as_py())) >= threshold - 1e-9)
            yield batch.select(range(4)).filter(pa.array(kept, pa.bool_()))

    schema = "a binary, b binary, copies_a long, copies_b long"
    return arrow_input(pairs, "a", "b", "copies_a", "copies_b", "text_a", "text_b").mapInArrow(run, schema)


def met_before(groups: list[list[bytes]], here: bytes) -> np.ndarray:
    """Which two nodes share a group that comes before this one: a symmetric matrix of booleans."""
    owner = [k for k, own in enumerate(groups) for g in own if g < here]
    _, column = np.unique(np.array([g for own in groups for g in own if g < here], "S16"), return_inverse=True)
    member = np.zeros((len(groups), int(column.max()) + 1 if len(column) else 0), np.float32)
    member[owner, column] = 1
    return member @ member.T > 0


def _verify_blocks(members: DataFrame, threshold: float) -> DataFrame:
    """Per node of a pair of cells: its links there (copies counted) and the root of its linked nodes.

    Pairs that share an earlier group are left to that one, so that each is counted once.
    """

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        low, high = map(int, key[1:])
        none = pd.DataFrame({"node": [], "root": [], "links": []})
        if low < high and pdf["cell"].nunique() < 2:  # no node is in the other cell
            return none
        pdf = pdf.drop_duplicates("node").sort_values("node", ignore_index=True)
        cell = pdf["cell"].to_numpy()
        before = met_before([list(g) for g in pdf["groups"]], bytes(key[0]))
        if before[np.ix_(cell == low, cell == high)].all():
            return none
        shingles = Shingles()
        i, j = block_links([shingles(t) for t in pdf["text"]], cell, low, high, threshold)
        i, j = i[~before[i, j]], j[~before[i, j]]
        copies, root = pdf["copies"].to_numpy(), np.arange(len(pdf))
        links = np.bincount(i, copies[j], len(pdf)) + np.bincount(j, copies[i], len(pdf))
        while len(i):
            before = root.copy()
            least = np.minimum(root[i], root[j])
            np.minimum.at(root, i, least)
            np.minimum.at(root, j, least)
            root = root[root]
            if (root == before).all():
                break
        some = links > 0
        nodes = pdf["node"].to_numpy()
        return pd.DataFrame({"node": nodes[some], "root": nodes[root[some]], "links": links[some].astype(np.int64)})

    return members.groupBy("hot", "low", "high").applyInPandas(run, "node binary, root binary, links long")


def _hot_cells(hot: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each node of a hot group, once for each pair of cells that its own cell is part of."""
    sized = hot.join(nodes.select("node", "n", "copies"), "node").withColumn("hot", F.explode("groups"))
    number = F.greatest(F.ceil(F.count("*") / CELL_NODES), F.ceil(F.sum("n") / CELL_SHINGLES), F.lit(1)).cast("int")
    cells = written(sized.groupBy("hot").agg(number.alias("cells")), "cells")  # so that Spark may split a group in the join
    dealt = sized.join(cells, "hot").withColumn("cell", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    return dealt.select(
        "hot", F.least("cell", "other").alias("low"), F.greatest("cell", "other").alias("high"), "cell", "node", "copies", "groups"
    )


def similar_rows(
    df: DataFrame, threshold: float = THRESHOLD, rows: int = 5, recall: float = 0.9995, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text_md5, class_id, links, keeper) per row.

    ``class_id`` is the least id of the rows joined by links of Jaccard similarity ``threshold`` or more, ``links`` the
    number of other rows linked to this one, ``keeper`` the (id, text_md5) of the row that stands for the class. Null
    texts and texts without words have equal, empty sets and are copies of each other; repeated rows are copies;
    null ids are allowed; an empty table gives an empty result; other columns are not read.
    """
    bands = bands_for(threshold, rows, recall)
    signed = written(signed_rows(df, id_col, text_col, bands, rows), "signed")
    nodes = written(
        signed.groupBy("node").agg(
            F.min(F.struct("id", "text_md5")).alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")
        ),
        "nodes",
    )
    spread = nodes.where("n > 0").select("node", F.explode("bands").alias("band"))
    buckets = spread.groupBy("band").agg(F.count("*").alias("size"), F.min("node").alias("least")).where("size > 1")
    members = written(spread.join(buckets, "band"), "members")

    large = members.where(F.col("size") > SMALL)
    hot = written(large.groupBy("node").agg(F.collect_set("least").alias("groups")), "hot")  # one a band at most
    listed = members.where(F.col("size") <= SMALL).join(hot, "node", "left").select("band", "node", "groups")
    x, y = listed.alias("x"), listed.alias("y")
    apart = ~F.coalesce(F.arrays_overlap("x.groups", "y.groups"), F.lit(False))
    pairs = written(
        x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.node") < F.col("y.node")) & apart)
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .distinct(),
        "pairs",
    )

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(hot.select("node")).distinct()
    wanted = wanted.join(nodes, "node").select("node", "copies", "first.*")
    whole = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    whole = whole.withColumn("text_md5", F.unhex(F.md5("text")))
    same = whole["id"].eqNullSafe(wanted["id"]) & (whole["text_md5"] == wanted["text_md5"])
    texts = written(whole.join(wanted, same).select("node", "copies", "text").dropDuplicates(["node"]), "texts")

    one = lambda s: texts.select(F.col("node").alias(s), F.col("copies").alias(f"copies_{s}"), F.col("text").alias(f"text_{s}"))
    found = written(_verify_pairs(pairs.join(one("b"), "b").join(one("a"), "a"), threshold), "found")
    blocks = _hot_cells(hot, nodes).join(texts.select("node", "text"), "node")
    block = written(_verify_blocks(blocks, threshold), "blocks")

    edges = found.select("a", "b").union(block.select("node", "root"))
    classes = connected_components(edges, "a", "b")
    links = (
        found.select(F.col("a").alias("node"), F.col("copies_b").alias("links"))
        .union(found.select("b", "copies_a"))
        .union(block.select("node", "links"))
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    standing = written(
        classes.join(nodes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("keeper")), "standing"
    )
    classes = classes.join(standing, "component").select("node", "keeper")
    told = written(
        nodes.select("node", "first", "copies")
        .join(classes, "node", "left")
        .join(links, "node", "left")
        .select(
            "node",
            F.coalesce("keeper", "first").alias("keeper"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        ),
        "told",
    )  # written, so that Spark may split a node with many copies in the join that follows
    return signed.select("id", "text_md5", "node").join(told, "node").select(
        F.col("id").alias(id_col), "text_md5", F.col("keeper.id").alias("class_id"), "links", "keeper"
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df``, one of each class of similar texts: that with the least id. All columns are kept.

    A null id is the least. Of a class's rows that share the least id, that with the least MD5 of its text stays; of rows
    that share the text too, that with the least hash of all columns (but maps, which cannot be hashed), so that no
    partitioning changes the choice. Null texts and texts without words are one class; an empty table stays empty.
    """
    keepers = similar_rows(df, id_col=id_col, text_col=text_col, **options).select("keeper.*").distinct()
    keepers = written(keepers.toDF("_id", "_md5"), "keepers")
    md5 = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    plain = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    own = df.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), md5.alias("md5"), F.xxhash64(*plain).alias("pick"))
    kept = own.join(keepers, own["id"].eqNullSafe(keepers["_id"]) & (own["md5"] == keepers["_md5"]), "left_semi")
    return kept.groupBy("id", "md5").agg(F.min_by("row", "pick").alias("row")).select("row.*")


#: Exact, over all pairs that share a shingle.
SQL = f"""
with recursive split as (
  select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') as w from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] else list_sort(list_distinct(list_transform(
    range(1, greatest(len(w) - {WORDS - 1}, 1) + 1), lambda i: array_to_string(w[i : i + {WORDS - 1}], ' ')))) end as s from split
), nodes as (
  select md5(array_to_string(s, '\n')) as node, any_value(s) as s, min(doc_id) as first, count(*) as copies
  from sets group by 1
), parts as (
  select node, len(s) as n, unnest(s) as p from nodes
), links as (
  select x.node as a, y.node as b from parts x join parts y on x.p = y.p and x.node <> y.node
  group by x.node, y.node, x.n, y.n having count(*) >= {THRESHOLD} * (x.n + y.n - count(*)) - 1e-9
), reach as (
  select node as a, node as b from nodes union select reach.a, links.b from reach join links on reach.b = links.a
), classes as (
  select reach.a as node, min(nodes.first) as class_id from reach join nodes on nodes.node = reach.b group by reach.a
), counts as (
  select a as node, sum(copies) as links from links join nodes on nodes.node = links.b group by a
)
select doc_id, class_id, (copies - 1 + coalesce(links, 0))::bigint as links
from sets join nodes on nodes.node = md5(array_to_string(sets.s, '\n')) join classes using (node) left join counts using (node)
"""
