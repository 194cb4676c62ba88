"""Token counts by heap-and-linked-list byte-pair merging, without making identifiers.

A text is cut where no vocabulary piece can span, each segment starts as one symbol a character, and the pair of
neighbours with the best rank is popped from a heap and joined until none is left. The count is the number of
initial symbols minus the number of merges; a character outside the vocabulary stands for as many symbols as it has
UTF-8 bytes (byte fallback) and takes part in no merge.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tidemart.llm.common import arrow_input, field

SPACE = "▁"


class PieceCounter:
    """Counts what a sentencepiece BPE model with an identity normaliser makes of a text (no begin or end tokens).

    ``cache_size`` bounds the segments remembered per worker; when it is full the memory starts afresh, so the count
    never depends on it.
    """

    def __init__(self, model_path: str, cache_size: int = 400_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        pieces = {model.id_to_piece(i): -model.get_score(i) for i in ids}
        self.chars = {p for p in pieces if len(p) == 1}
        self.rank = {p: r for p, r in pieces.items() if len(p) > 1}
        if any(c not in self.chars for p in self.rank for c in p):
            raise ValueError("a piece holds a character that is no piece itself")
        if model.normalize("a  b\n") != f"{SPACE}a{SPACE}{SPACE}b\n":
            raise ValueError("only models with an identity normaliser and a leading space are handled")
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.rank)
        line = "" if any("\n" in p for p in pieces) else "\n"
        self.segments = re.compile(f"(?s:.+)" if crossing else f" *[^ {line}]+| +|{line or '(?!)'}+").findall
        self.cache: dict[str, int] = {}
        self.cache_size = cache_size

    def merges(self, text: str) -> int:
        """How many merges the segment undergoes."""
        rank, n = self.rank, len(text)
        symbol: list[str | None] = list(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(text[i : i + 2])
            if r is not None:
                heap.append((r, i, text[i : i + 2]))
        heapify(heap)
        done = 0
        while heap:
            _, i, joined = heappop(heap)
            left, j = symbol[i], after[i]
            if left is None or j >= n or left + symbol[j] != joined:
                continue  # one of the two has been merged since
            done += 1
            symbol[i], symbol[j] = joined, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                pair = joined + symbol[k]
                r = rank.get(pair)
                if r is not None:
                    heappush(heap, (r, i, pair))
            h = before[i]
            if h >= 0:
                pair = symbol[h] + joined
                r = rank.get(pair)
                if r is not None:
                    heappush(heap, (r, h, pair))
        return done

    def segment(self, raw: str) -> int:
        text = raw.replace(" ", SPACE)
        chars = self.chars
        start = sum(1 if c in chars else len(c.encode("utf-8", "replace")) for c in text)
        return start - (self.merges(text) if len(text) > 1 else 0)

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if SPACE in text:
            text = text.replace(SPACE, " ")
        cache, total = self.cache, 0
        for raw in self.segments(" " + text):
            n = cache.get(raw)
            if n is None:
                n = self.segment(raw)
                if len(raw) <= 64:
                    if len(cache) >= self.cache_size:
                        cache.clear()
                    cache[raw] = n
            total += n
        return total


def count_tokens(
    df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096
) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    Null and empty texts have 0 bytes and 0 tokens; repeated rows stay repeated; an empty table gives an empty
    result; other columns are not read. No shuffle: each task streams its own rows.
    """
    schema = T.StructType(
        [
            field(df, id_col),
            T.StructField("n_bytes", T.LongType(), False),
            T.StructField("n_tokens", T.LongType(), False),
            T.StructField("over_limit", T.BooleanType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = PieceCounter(model_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = [count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_()),
                ],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    return arrow_input(df, id_col, text_col).mapInArrow(run, schema)
