"""Quality by a byte-level convolutional network in numpy, trained here on labelled rows.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Bytes are embedded, a plane marks places
that repeat what stood a little before, learned filters run over each chunk and are max-pooled, and the chunks' pooled
activations are combined (their mean and their maximum) into one probability. Gradients flow only through the places
that won the pooling, so training is a few matrix products a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.common import arrow_input, field, held_out, score_of
from tidemart.llm.toxicity import training_rows

WIDTH, STEP = 512, 448  #: bytes of a chunk, and from one chunk's start to the next; the overlap exceeds a filter
EMBED, TAPS, FILTERS = 6, 7, 24
STRIDE = 2  #: between a filter's places
LAGS, RUN = 32, 16  #: a byte repeats if RUN bytes up to it equal those a lag of 2 to LAGS before
BLOCK = 256  #: chunks taken at once, which bounds memory for any length
SAMPLE_ROWS, SAMPLE_CHARS = 1500, 30_000  #: labelled rows of each class that are learned from, and their length, at most
EPOCHS, BATCH, RATE, SEED = 6, 16, 0.01, 11


def chunks_of(text: str | None, marks: bool = True) -> np.ndarray:
    """(2, chunks, WIDTH) bytes and repeat marks (or zeros); the last chunk ends with zeros; an empty text is one such chunk."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    mark = np.zeros(len(raw), np.uint8)
    for lag in range(2, LAGS + 1 if marks else 0):
        if len(raw) < lag + RUN:
            break
        same = raw[lag:] == raw[:-lag]
        k = 1
        while k < RUN:
            same = same[k:] & same[:-k]
            k *= 2
        mark[lag + RUN - 1 :] |= same
    n = max(1, -(-max(0, len(raw) - WIDTH) // STEP) + 1)
    out = np.zeros((2, (n - 1) * STEP + WIDTH), np.uint8)
    out[0, : len(raw)], out[1, : len(raw)] = raw, mark
    return np.lib.stride_tricks.sliding_window_view(out, WIDTH, axis=1)[:, ::STEP]


@dataclass
class Network:
    embed: np.ndarray  #: (256, EMBED)
    filters: np.ndarray  #: (TAPS * (EMBED + 1), FILTERS)
    bias: np.ndarray
    head: np.ndarray  #: (2 * FILTERS,)
    constant: np.ndarray  #: (1,)
    marks: bool = True  #: whether repetition is marked

    @classmethod
    def fresh(cls, seed: int = SEED, marks: bool = True) -> Network:
        draw = np.random.default_rng(seed)
        f32 = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        width = TAPS * (EMBED + 1)
        return cls(
            f32(256, EMBED, scale=0.5),
            f32(width, FILTERS, scale=width**-0.5),
            np.zeros(FILTERS, np.float32),
            f32(2 * FILTERS, scale=0.1),
            np.zeros(1, np.float32),
            marks,
        )

    def windows(self, part: np.ndarray) -> np.ndarray:
        """(chunks, places, TAPS * (EMBED + 1)) of the embedded bytes and marks under each filter place."""
        planes = np.empty((*part.shape[1:], EMBED + 1), np.float32)
        planes[..., :EMBED] = self.embed[part[0]]
        planes[..., EMBED] = part[1]
        view = np.lib.stride_tricks.sliding_window_view(planes, TAPS, axis=1)[:, ::STRIDE]
        return view.transpose(0, 1, 3, 2).reshape(view.shape[0], view.shape[1], -1)

    def pooled(self, chunks: np.ndarray, places: bool = False):
        """Each chunk's largest activation of each filter, rectified; and where it stood."""
        tops, at = [], []
        for low in range(0, chunks.shape[1], BLOCK):
            windows = self.windows(chunks[:, low : low + BLOCK])
            active = windows @ self.filters
            if places:
                won = active.argmax(axis=1)
                at.append(won)
                tops.append(np.take_along_axis(active, won[:, None], axis=1)[:, 0])
            else:
                tops.append(active.max(axis=1))
        top = np.maximum(np.concatenate(tops) + self.bias, 0)
        return (top, np.concatenate(at)) if places else top

    def logit(self, top: np.ndarray) -> float:
        return float(np.concatenate([top.mean(axis=0), top.max(axis=0)]) @ self.head + self.constant[0])

    def score(self, text: str | None) -> float:
        z = self.logit(self.pooled(chunks_of(text, self.marks)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def gradients(self, chunks: np.ndarray, y: int) -> tuple[list[np.ndarray], float]:
        top, at = self.pooled(chunks, places=True)
        p = 1 / (1 + np.exp(-np.clip(self.logit(top), -30, 30)))
        error = np.float32(p - y)
        best, every = top.argmax(axis=0), np.arange(FILTERS)
        g_head = error * np.concatenate([top.mean(axis=0), top.max(axis=0)])
        g_top = np.tile(error * self.head[:FILTERS] / len(top), (len(top), 1))
        g_top[best, every] += error * self.head[FILTERS:]
        g_top[top <= 0] = 0
        g_filters, g_embed = np.zeros_like(self.filters), np.zeros_like(self.embed)
        c, f = np.nonzero(g_top)
        g = g_top[c, f]
        spots = at[c, f][:, None] * STRIDE + np.arange(TAPS)
        under, marks = chunks[0][c[:, None], spots], chunks[1][c[:, None], spots]
        planes = np.concatenate([self.embed[under], marks[..., None].astype(np.float32)], axis=2).reshape(len(c), -1)
        np.add.at(g_filters.T, f, planes * g[:, None])
        back = (self.filters.T[f] * g[:, None]).reshape(len(c), TAPS, EMBED + 1)[..., :EMBED]
        np.add.at(g_embed, under.ravel(), back.reshape(-1, EMBED))
        loss = -np.log(max(1e-9, p if y else 1 - p))
        return [g_embed, g_filters, g_top.sum(axis=0), g_head, np.array([error])], float(loss)

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.head, self.constant]


def train(texts: list[str], labels: list[int], seed: int = SEED, marks: bool = True) -> Network:
    """A network fitted by Adam in batches of documents; the same rows in the same order give the same network."""
    net, draw = Network.fresh(seed, marks), np.random.default_rng(seed)
    if len(set(labels)) < 2:  # one class alone teaches a constant
        net.head[:] = 0
        net.constant[:] = 3.0 if 1 in labels else -3.0 if labels else 0.0
        return net
    chunks = [chunks_of(t, marks) for t in texts]
    share = np.bincount(labels, minlength=2) / len(labels)
    first, second, step = [np.zeros_like(w) for w in net.weights()], [np.zeros_like(w) for w in net.weights()], 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = draw.permutation(len(chunks))
        for low in range(0, len(order), BATCH):
            total = [np.zeros_like(w) for w in net.weights()]
            for i in order[low : low + BATCH]:
                found, _ = net.gradients(chunks[i], labels[i])
                for t, g in zip(total, found, strict=True):
                    t += g * np.float32(0.5 / share[labels[i]])
            step += 1
            for w, g, m, v in zip(net.weights(), total, first, second, strict=True):
                g = g / len(order[low : low + BATCH]) + 1e-4 * w
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 3,
    fold: int = 1,
    rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    marks: bool = True,
) -> Network:
    """A network from at most ``rows`` labelled rows of each class outside the held-out fold.

    Rows of more than SAMPLE_CHARS characters are scored, but not learned from; nor are rows with null ids. Without
    labels every score is one half. ``marks``: with the plane that marks repetition, else on learned filters alone.
    """
    known = training_rows(docs, labels, label, folds, fold, rows, id_col, text_col, SAMPLE_CHARS)
    seen = known.orderBy(F.xxhash64("text"), "text").toPandas()  # 2 x rows texts of SAMPLE_CHARS characters at most
    return train(seen["text"].tolist(), [int(y) for y in seen["y"]], marks=marks)


def scored(df: DataFrame, network: Network, folds: int = 3, fold: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of each row; ``score`` is the probability of label 1.

    Null texts are empty, and an empty text is a chunk of zeros; repeated rows have equal scores; other columns are not
    read; an empty table gives an empty result.
    """
    schema = T.StructType([field(df, id_col), T.StructField("score", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [network.score(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=schema.names)

    out = arrow_input(df, id_col, text_col).mapInArrow(run, schema)
    return out.select(id_col, held_out(id_col, folds, fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def worthy(df: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """The rows whose texts score one half or more, with all columns, whatever their names.

    Null and empty texts are a chunk of zeros; null ids and repeated rows stay or go by their texts; an empty table
    gives an empty result.
    """
    return arrow_input(df).where(score_of(network.score, text_col) >= 0.5)
