"""Shards by weighted rendezvous hashing of stable record keys.

Every shard gives a key the score ``-weight / ln(u)``, where ``u`` in (0, 1) is a hash of key and shard; the largest score
takes the row. A shard's share is its weight's, a further shard takes rows only into itself, one that is taken away only
gives up its own, and a changed weight moves rows only to or from its shard: no score of another shard changes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import text_of, written
from tidemart.operators.ranges import named, numbered

DIGITS = 13  #: hex digits of a hash that count, 52 bits
SHARDS = 8
EVEN = [1.0] * SHARDS
FILE_BYTES = 256 << 20  #: of text in a file of a shard, about


def record_key(column: str) -> Column:
    """The key that is hashed: the value as text; null is a key of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit(""))


def score(key: Column, shard: int, weight: float) -> Column:
    hashed = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{shard}"))), 1, DIGITS), 16, 10).cast("long")
    return F.lit(-float(weight)) / F.ln((hashed + F.lit(0.5)) / F.lit(float(16**DIGITS)))


def choice(key: Column, weights: list[float]) -> Column:
    """The shard of each key among ``0 .. len(weights) - 1``; a shard of weight 0 takes nothing."""
    if any(w < 0 for w in weights) or not any(weights):
        raise ValueError("weights are not negative, and one is positive")
    scored = [F.struct(score(key, s, w).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights) if w]
    return (F.greatest(*scored) if len(scored) > 1 else scored[0])["shard"]


def assigned(df: DataFrame, weights: list[float], id_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """``df`` with its shard; nothing is shuffled. Rows that are to stay together, such as equal texts, need a key in
    common: give a column with a hash of the text as ``id_col``. A column called ``name`` is replaced."""
    return df.withColumn(name, choice(record_key(id_col), weights))


def sharded(
    df: DataFrame,
    weights: list[float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    others: dict[str, list[float]] | None = None,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of each row, then a shard for each of ``others``.

    ``weights``: one for each shard, 8 equal ones by default; ``grown_shard`` is the shard if there were one more, of
    the mean weight; ``others`` names further columns, each with weights of its own. ``size`` is the text's UTF-8 bytes (null: none) plus 1, and ``slot`` the place in the shard, from 0
    without gaps in order of (id, text_crc32, size). Null ids share a key; repeated rows have slots of their own, in any
    order; an empty table gives an empty result; other columns are not read. Texts are read once and not shuffled, and
    slots are counted over ranges, so a shard or key may hold any share of the rows.
    """
    weights, others = weights or EVEN, others or {}
    key, text = record_key(id_col), text_of(text_col)
    rows = df.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        choice(key, weights).alias("shard"),
        choice(key, [*weights, sum(weights) / len(weights)]).alias("grown_shard"),
        *[choice(key, w).alias(name) for name, w in others.items()],
    )
    rows = written(rows, "shards").withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    placed = numbered(rows, "slot", ["_id", "text_crc32", "size", "_spread"], ["shard"])
    return placed.select(F.col("_id").alias(id_col), "size", "text_crc32", "law", "shard", "slot", "grown_shard", *others)


def moves(df: DataFrame, before: list[float], after: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(from_shard, to_shard, n_rows, n_bytes): what a change of the shards' weights or number would move; nothing moved, no row."""
    key = record_key(id_col)
    went = df.select(choice(key, before).alias("from_shard"), choice(key, after).alias("to_shard"), F.octet_length(text_of(text_col)).alias("_b"))
    return went.where("from_shard <> to_shard").groupBy("from_shard", "to_shard").agg(F.count("*").alias("n_rows"), F.sum("_b").alias("n_bytes"))


def write_shards(df: DataFrame, path: str, weights: list[float], id_col: str = "doc_id", text_col: str = "text") -> None:
    """Whole rows, all columns, in folders ``shard=0`` and so on below ``path``.

    A shard is dealt to as many tasks as its bytes ask for, rows at random, so none has to fit a task. A column called
    ``shard`` would clash with the folders and is an error.
    """
    if "shard" in df.columns:
        raise ValueError("the rows have a column shard")
    own = f"_{uuid.uuid4().hex}"
    rows = assigned(df, weights, id_col)
    sizes = dict(rows.groupBy("shard").agg(F.sum(F.octet_length(text_of(text_col)))).collect())  # a row for each shard
    files = [1 + sizes.get(s, 0) // FILE_BYTES for s in range(len(weights))]
    of = F.element_at(F.array(*map(F.lit, files)), F.col("shard") + 1)
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), of)
    out = rows.withColumn(own, spread).repartition(sum(files), "shard", own)
    out.select(*named(df.columns), "shard").write.partitionBy("shard").parquet(path)


def _duck_choice(weights: list[float]) -> str:
    u = f"((('0x' || substr(md5(key || '|' || s.i), 1, {DIGITS}))::bigint + 0.5::double) / {float(16**DIGITS)!r}::double)"
    given = ", ".join(f"{{'i': {i}, 'w': {w!r}::double}}" for i, w in enumerate(weights))
    return f"list_max(list_transform([{given}], lambda s: {{'score': -s.w / ln({u}), 'i': s.i}})).i::integer"


def _duck_crc32(text: str) -> str:
    """The checksum by half bytes: each is looked up in a table of sixteen remainders."""
    remainders = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ 0xEDB88320 * (n & 1)
        remainders.append(f"{n}::bigint")
    half = lambda c: f"xor([{', '.join(remainders)}][({c} & 15) + 1], {c} >> 4)"
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::bigint)"
    ones = "4294967295::bigint"
    return f"xor(list_reduce(list_concat([{ones}], {octets}), lambda c, b: {half(half('xor(c, b)'))}), {ones})"


def sql(others: dict[str, list[float]]) -> str:
    """The same for DuckDB over ``documents``."""
    more = "".join(f", {_duck_choice(w)} as {name}" for name, w in others.items())
    return f"""
select * exclude (key), row_number() over (partition by shard order by doc_id, text_crc32, size) - 1 as slot
from (
  select *, 'key' as law, {_duck_choice(EVEN)} as shard, {_duck_choice([*EVEN, 1.0])} as grown_shard{more}
  from (
    select doc_id, (strlen(coalesce(text, '')) + 1)::bigint as size, {_duck_crc32("coalesce(text, '')")} as text_crc32,
      coalesce('=' || doc_id, '') as key
    from documents
  )
)
"""
