"""Best-fit packing of tokenised documents by the sum-of-squares rule."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.common import arrow_input, field, written
from tidemart.operators.ranges import numbered

#: Characters whose classes (letter, digit, space) no Unicode version disputes: Latin, Greek, Cyrillic, kana, Han and
#: Hangul; other texts take the slower encoder.
PLAIN = re.compile("[\t\n\r -~¡-ſ‐-‧€Ͱ-ӿ\u3041-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]*").fullmatch

LONGEST_BLANK = 100_000  #: characters of a whitespace run that the fast encoder gets; it panics on over a million


class Ids:
    """Token ids of ``byte_bpe_50k.json``, special strings read as that tokenizer reads them by default.

    The same vocabulary as ranks is several times faster and gives the same ids for ordinary text; texts with a special
    string, with characters outside PLAIN or with a very long run of whitespace go through the tokenizer itself.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> list[int]:
        if PLAIN(text) and not any(s in text for s in self.special) and not long_blank(text):
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


def long_blank(text: str) -> bool:
    """Whether a run of whitespace is longer than LONGEST_BLANK."""
    return len(text) > LONGEST_BLANK and any(m.end() - m.start() > LONGEST_BLANK for m in re.finditer(r"\s+", text))


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces after a first one that may be shorter."""
    if length <= capacity:
        return [(0, length)]
    rest = length % capacity
    starts = ([0] if rest else []) + list(range(rest, length, capacity))
    return [(s, (rest if s == 0 and rest else capacity)) for s in starts]


def tokenize_pieces(
    df: DataFrame, tokenizer: tuple[str, str, str], capacity: int, end_id: int, id_col: str, text_col: str, carried: tuple[str, ...] = ()
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) and the carried columns for each piece of each document with its end id."""
    schema = T.StructType(
        [
            field(df, id_col),
            T.StructField("piece", T.IntegerType(), False),
            T.StructField("start", T.LongType(), False),
            T.StructField("length", T.LongType(), False),
            T.StructField("ids_crc32", T.LongType(), False),
            *[field(df, c) for c in carried],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Ids(*tokenizer)
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    at.append(row)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s : s + n]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    *[batch.column(2 + k).take(pa.array(at, pa.int64())) for k in range(len(carried))],
                ],
                names=[id_col, "piece", "start", "length", "ids_crc32", *carried],
            )

    return arrow_input(df, id_col, text_col, *carried).mapInArrow(run, schema)


def standing(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and text of each row, and its place (``_file``, ``_at``) in the order in which the rows stand.

    Spark reads files in any order, so where ``df`` is a read of files the place is that of the row in its file.
    """
    if df._jdf.queryExecution().analyzed().nodeName().startswith("LogicalRelation"):
        name = F.col("_metadata.file_name")  # part-99999 is before part-100000
        file, at = F.concat(F.lpad(F.length(name).cast("string"), 4, "0"), name), F.col("_metadata.row_index")
    else:
        file, at = F.lit(""), F.monotonically_increasing_id()
    return df.select(id_col, text_col, file.alias("_file"), at.alias("_at"))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) for each item, placed from the longest to the shortest.

    Of the open bins that hold it, an item goes to the one that makes the sum over residual gaps of the squared number
    of open bins with that gap smallest (equal sums: the tightest bin); a new bin is opened only when none holds it,
    which in this order leaves fewer bins than letting new bins compete. Items of equal length keep their order.
    """
    n = len(lengths)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    counts = np.zeros(capacity + 1, np.int64)  # open bins by residual gap; full bins are not open
    holders: list[list[int]] = [[] for _ in range(capacity + 1)]
    none, new = np.iinfo(np.int64).max, 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        gap = capacity
        if s < capacity:
            # moving a bin from gap g to gap g - s changes the sum by 2 (counts[g - s] - counts[g] + 1); a bin that
            # becomes full leaves the sum
            change = 2 * (counts[: capacity - s] - counts[s:capacity] + 1)
            change[0] = 1 - 2 * counts[s]
            change[counts[s:capacity] == 0] = none
            k = int(change.argmin())
            if change[k] != none:
                gap = s + k
        if gap == capacity:
            b = new
            new += 1
        else:
            b = holders[gap].pop()
            counts[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            holders[gap - s].append(b)
            counts[gap - s] += 1
    return bins, offsets


def pack(
    df: DataFrame,
    tokenizer: tuple[str, str, str],
    capacity: int = 2048,
    end_id: int = 0,
    shard_items: int = 65_536,
    id_col: str = "doc_id",
    text_col: str = "text",
    in_order: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens: one row per piece with its place.

    Tokens are made once and only the pieces' sizes travel: they are dealt by a hash of their places in the table (so
    repeated rows spread) into shards of about ``shard_items`` pieces, and each shard is packed on its own, so a task's
    memory is bounded whatever the input. A shard leaves a few bins part-empty, out of tens of thousands. With ``in_order`` the shards are consecutive ranges
    of the rows as they stand, pieces of equal length keep that order, and a shard's sequences are numbered by the
    place of the piece that opened them, its longest; so sequences follow the order of the rows. Null texts are empty and hold the end id alone;
    repeated rows are packed as separate documents; null ids are allowed; an empty table gives an empty result.
    """
    carried = ("_file", "_at") if in_order else ("_at",)
    rows = standing(df, id_col, text_col) if in_order else df.select(id_col, text_col, F.monotonically_increasing_id().alias("_at"))
    pieces = written(tokenize_pieces(rows, tokenizer, capacity, end_id, id_col, text_col, carried), "pieces")
    count = pieces.count()
    shards = max(1, -(-count // shard_items))
    schema = T.StructType(
        [*pieces.drop(*carried).schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        by = ["_n"] if in_order else ["_at", "piece"]
        pdf = pdf.sort_values(by, kind="stable").reset_index(drop=True)
        bins, offsets = sum_of_squares(pdf["length"].to_numpy(), capacity)
        if in_order:
            opened = bins[offsets == 0]  # in order of the openers' places
            turn = np.empty_like(opened)
            turn[opened] = np.arange(len(opened))
            bins = turn[bins]
        out = pdf[schema.names[:-2]].copy()
        out["sequence_id"], out["offset"] = bins + (int(key[0]) << 40), offsets
        return out

    if in_order:
        placed = numbered(pieces.withColumnRenamed("_at", "_place"), "_n", ["_file", "_place", "piece"])
        dealt = placed.drop("_file", "_place").withColumn("_shard", F.expr(f"_n * {shards} div {max(1, count)}"))
    else:
        dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64("_at", "piece"), F.lit(shards)))
    return dealt.groupBy("_shard").applyInPandas(run, schema)
