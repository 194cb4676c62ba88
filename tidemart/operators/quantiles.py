"""Exact quantiles without gathering the values: selection by pivots that a sketch proposes.

A quantile lies between two ranks. For each rank one pass proposes three pivots near it, a second counts the values
below and at each pivot. The rank then either is a pivot's, or lies in one of the open intervals between, which the next
pass searches. The counts decide, so the result is exact however good the sketch is; a good one leaves a few in ten
thousand of the values to the next pass. Only counts and pivots leave the tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

ACCURACY = 10_000  #: of the sketch; intervals with fewer values are searched in one more pass


@dataclass
class _Rank:
    """A rank that is looked for among the values strictly between two, of which ``size`` values, ``below`` come before."""

    rank: int
    size: int
    below: int = 0
    low: list[Any] = field(default_factory=list)  #: the value that all others are above, if any
    high: list[Any] = field(default_factory=list)
    found: list[Any] = field(default_factory=list)

    def inside(self, v: Column) -> Column:
        bounds = [v > F.lit(x) for x in self.low] + [v < F.lit(x) for x in self.high]
        return reduce(Column.__and__, bounds, v.isNotNull())

    def shares(self) -> list[float]:
        """Where the pivots should lie: at the rank and a little below and above it."""
        at, reach = (self.rank - self.below + 0.5) / self.size, 2 / ACCURACY
        return [max(0.0, at - reach), at, min(1.0, at + reach)]

    def narrow(self, pivots: list[Any], under: list[int], equal: list[int]) -> None:
        """``under`` and ``equal``: how many of the values inside lie below each pivot and at it."""
        from_, low = 0, self.low
        for pivot, fewer, same in zip(pivots, under, equal, strict=True):
            wanted = self.rank - self.below
            if fewer <= wanted < fewer + same:
                self.found = [pivot]
                return
            if wanted < fewer:
                self.low, self.high, self.below, self.size = low, [pivot], self.below + from_, fewer - from_
                return
            from_, low = fewer + same, [pivot]
        self.low, self.below, self.size = low, self.below + from_, self.size - from_


def select_ranks(df: DataFrame, column: str, ranks: list[int], rows: int) -> dict[int, Any]:
    """The values of these ranks (from 0) among the ``rows`` values of ``column`` that are not null."""
    v = F.col(column)
    open_ = [_Rank(r, rows) for r in sorted(set(ranks))]
    out = {}
    while open_:
        near = [F.percentile_approx(F.when(r.inside(v), v), F.lit(r.shares()), F.lit(ACCURACY)).alias(f"p{i}") for i, r in enumerate(open_)]
        proposed = df.agg(*near).first()
        pivots = [sorted(set(p)) for p in proposed]
        counts = df.agg(
            *[
                F.count_if(r.inside(v) & (v < F.lit(p) if kind == "u" else v == F.lit(p))).alias(f"{kind}{i}_{k}")
                for i, r in enumerate(open_)
                for k, p in enumerate(pivots[i])
                for kind in "ue"
            ]
        ).first()
        for i, r in enumerate(open_):
            of = lambda kind: [counts[f"{kind}{i}_{k}"] for k in range(len(pivots[i]))]  # noqa: B023, E731
            r.narrow(pivots[i], of("u"), of("e"))
            if r.found:
                out[r.rank] = r.found[0]
        open_ = [r for r in open_ if not r.found]
    return out


def quantiles(df: DataFrame, column: str, shares: list[float], one_rounding: bool = False) -> list[float | None]:
    """The quantiles of a numeric column by linear interpolation, as ``percentile`` gives them; None if all is null.

    With ``one_rounding`` the lower value's part is added to the upper's before it is rounded, as ``quantile_cont`` does:
    the results differ by a last digit at most.

    NaN is above all numbers, zeros have no sign. ``df`` is read about seven times whatever its size, one column of it; store it if it is
    dear to make.
    """
    values = df.select((F.col(column).cast("double") + F.lit(0.0)).alias("v")).where("v is not null")
    rows = values.count()
    if not rows:
        return [None] * len(shares)
    places = [(rows - 1) * s for s in shares]
    found = select_ranks(values, "v", [int(edge(p)) for p in places for edge in (math.floor, math.ceil)], rows)

    def between(place: float) -> float:
        down, up = math.floor(place), math.ceil(place)
        low, high = found[down], found[up]
        if down == up or low == high:
            return low
        if one_rounding and math.isfinite(low) and math.isfinite(high):
            return math.fma(low, up - place, (place - down) * high)
        return (up - place) * low + (place - down) * high

    return [between(p) for p in places]
