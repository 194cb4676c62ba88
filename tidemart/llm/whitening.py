"""Whitening of vectors by hierarchical singular value decompositions.

Each task reduces its rows to a state: their number and sums (the mean), and all singular values and right vectors of the
centred rows. Two states merge by stacking their scaled vectors and one row that corrects for the difference of the means,
and decomposing the stack again. No dimension is dropped on the way, so the last state has the covariance of all rows, and
singular values are never squared before the end. A state has the size of one covariance matrix, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.common import arrow_input, field, written
from tidemart.llm.vectors import matrix, whole_vectors

COMPONENTS = 4
FAN_BYTES = 64 << 20  #: of states that a task merges
STATE = "level long, n long, sums array<string>, rank int, scaled array<double>"


@dataclass
class State:
    n: int
    sums: np.ndarray  #: exact, Python numbers
    scaled: np.ndarray  #: a right singular vector times its value in each row

    @classmethod
    def of(cls, x: np.ndarray) -> State:
        small = max(int(x.max()), -int(x.min())) * len(x) < 1 << 63
        sums = x.sum(axis=0).astype(object) if small else x.sum(axis=0, dtype=object)
        mean = np.array([int(s) / len(x) for s in sums])
        return cls(len(x), sums, decomposed(x - mean))

    def merged(self, other: State) -> State:
        n = self.n + other.n
        # the difference of the means from whole numbers, rounded once
        gap = np.array([int(a * other.n - b * self.n) / (self.n * other.n) for a, b in zip(self.sums, other.sums, strict=True)])
        correction = np.sqrt(self.n / n * other.n) * gap
        return State(n, self.sums + other.sums, decomposed(np.vstack([self.scaled, other.scaled, correction])))

    def row(self, level: int) -> tuple:
        return level, self.n, [str(s) for s in self.sums], len(self.scaled), self.scaled.ravel()

    @classmethod
    def from_row(cls, row) -> State:
        return cls(int(row.n), np.array([int(s) for s in row.sums], object), np.array(row.scaled, float).reshape(int(row.rank), -1))


def decomposed(rows: np.ndarray) -> np.ndarray:
    """Rows with the same products of columns as the given ones: all right singular vectors, times their values."""
    if len(rows) > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    _, values, vectors = np.linalg.svd(rows, full_matrices=False)
    return values[:, None] * vectors


def states_of(fit: DataFrame, width: int) -> DataFrame:
    """One state for each partition that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = None
        for batch in batches:
            if batch.num_rows:
                one = State.of(matrix(batch.column("x"), width))
                state = state.merged(one) if state else one
        if state:
            level, n, sums, rank, scaled = state.row(TaskContext.get().partitionId())
            yield pa.RecordBatch.from_pydict(
                {"level": [level], "n": [n], "sums": [sums], "rank": pa.array([rank], pa.int32()), "scaled": [scaled]}
            )

    return arrow_input(fit, "x").mapInArrow(run, STATE)


def merged_states(states: DataFrame, fan: int) -> DataFrame:
    """One state for each ``fan`` states next to each other."""

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        state = None
        for row in rows.sort_values("level").itertuples():
            one = State.from_row(row)
            state = state.merged(one) if state else one
        return pd.DataFrame([state.row(int(key[0]))], columns=["level", "n", "sums", "rank", "scaled"])

    return states.groupBy(F.floor(F.col("level") / fan)).applyInPandas(merge, STATE)


@dataclass
class Whitening:
    """``values`` are the eigenvalues of the covariance (divisor ``n``), falling, and the rows of ``vectors`` their unit vectors."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, state: State) -> Whitening:
        width = state.scaled.shape[1]
        _, values, vectors = np.linalg.svd(state.scaled, full_matrices=True)
        vectors *= np.sign(vectors[np.arange(width), np.abs(vectors).argmax(axis=1)])[:, None]  # the largest entry is positive
        values = np.append(values, np.zeros(width - len(values))) ** 2 / state.n
        return cls(state.n, [int(s) for s in state.sums], values, vectors)

    @classmethod
    def fit(cls, vectors: DataFrame, width: int) -> Whitening | None:
        """Of a written table of vectors ``x``, every row counted; None if it is empty."""
        states = written(states_of(vectors, width), "states")
        fan = max(2, min(64, FAN_BYTES // (8 * max(1, width) ** 2)))
        while (many := states.agg(F.count("*"), F.max("level")).first())[0] > 1:
            # numbers of empty partitions are missing, so neighbours may be alone; each level divides the numbers
            states = written(merged_states(states, min(fan, many[1] + 1)), "states")
        last = states.first()
        return cls.of(State.from_row(last)) if last else None

    @property
    def explained(self) -> np.ndarray:
        """Each component's share of the variance; 0 where there is none."""
        total = self.values.sum()
        return self.values / total if total else np.zeros_like(self.values)

    def varies(self) -> np.ndarray:
        """Which components have variance beyond rounding."""
        return self.values > self.values[:1].max(initial=0) * 1e-20 * max(1, len(self.values))

    def project(self, x: np.ndarray, k: int) -> np.ndarray:
        """The first ``k`` whitened coordinates of each row; not a number where a component has no variance."""
        mean = np.array([s / self.n for s in self.sums])
        scale = np.where(self.varies()[:k], self.values[:k], np.nan)
        return (x - mean) @ (self.vectors[:k] / np.sqrt(scale)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[Decimal | None]:
        """The sum over dimensions of ``(n x - sum) ** 2`` of each row, exact; null beyond 38 digits."""
        most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        small = most * max(most, *map(abs, self.sums)) * x.shape[1] < 1 << 63
        own = x if small else x.astype(object)
        sums = np.array(self.sums, own.dtype)
        squares, products, n, rest = (own * own).sum(axis=1), (own * sums).sum(axis=1), self.n, sum(s * s for s in self.sums)
        exact = [n * n * int(q) - 2 * n * int(p) + rest for q, p in zip(squares, products, strict=True)]
        return [Decimal(v) if v < 10**38 else None for v in exact]


def projected(df: DataFrame, model: Whitening, k: int, id_col: str | None = None) -> DataFrame:
    """(the id, ``deviation``, ``whitened`` array) of each row of vectors ``x``."""
    width = len(model.sums)
    kept = [id_col] if id_col else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), width)
            near = model.project(x, k)
            whitened = pa.ListArray.from_arrays(
                np.arange(len(x) + 1, dtype=np.int32) * near.shape[1], pa.array(near.ravel(), mask=np.isnan(near.ravel()))
            )
            columns = {c: batch.column(c) for c in kept}
            if id_col:
                columns["deviation"] = pa.array(model.deviations(x), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_pydict(columns | {"whitened": whitened})

    out = [field(df, c) for c in kept] + ([T.StructField("deviation", T.DecimalType(38, 0))] if id_col else [])
    schema = T.StructType([*out, T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return arrow_input(df, *kept, "x").mapInArrow(run, schema)


def identity_error(fit: DataFrame, model: Whitening, k: int) -> float | None:
    """The largest absolute entry of the whitened rows' covariance (centred, divisor ``n``) minus the identity; null if no
    component varies. Covariances of parts are merged by Spark's own aggregate."""
    at = [i for i in range(min(k, len(model.values))) if model.varies()[i]]
    if not at:
        return None
    w = lambda i: F.col("whitened")[i]
    pairs = [F.covar_pop(w(i), w(j)) - F.lit(float(i == j)) for i in at for j in at if i <= j]
    entries = projected(fit, model, k).agg(F.array_max(F.array(*[F.abs(p) for p in pairs])).alias("error"))
    return entries.first()["error"]  # one row


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component up to ``k``.

    Rows whose vector is null or has null or infinite entries or ones that are no numbers are dropped; entries count as
    ``floor(256 c)``. Means and covariance are those of the distinct vectors, each once, so repeated rows have no weight
    but a row each in the result. Vectors shorter than the longest are filled up with zeros; there are as many components
    as dimensions at most. A component without variance (fewer different vectors than dimensions) has a null ``whitened``
    and explains 0. ``deviation`` is exact, a decimal of 38 digits and null beyond. Null ids stay; a table without vectors
    gives an empty result; other columns are not read. The plan shuffles the vectors once, to find the distinct ones; the
    driver sees the last state only.
    """
    rows = written(whole_vectors(df, vector_col, F.col(f"`{id_col}`").alias("_id")), "vectors")
    fit = written(rows.groupBy("x").agg(F.lit(1).alias("_one")).select("x"), "distinct")
    width = fit.agg(F.max(F.size("x"))).first()[0] or 0
    model = Whitening.fit(fit, width) if width else None
    if not model:
        kinds = {"component": "int", "n": "long", "deviation": "decimal(38,0)", "whitened": "double", "explained": "double", "identity_error": "double"}
        return rows.limit(0).select(F.col("_id").alias(id_col), *[F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()])
    k = min(k, width)
    error = identity_error(fit, model, k)
    out = projected(rows, model, k, "_id").select("_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    share = F.element_at(F.array(*[F.lit(float(e)) for e in model.explained[:k]]), F.col("_at") + 1)
    return out.select(
        F.col("_id").alias(id_col),
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        share.alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
