"""Mixing sources to target weights by Pfair scheduling.

Rows of a source are numbered and cut into blocks. Block ``i`` (from 0) of a source with weight ``w`` (its share of all
weights, an exact fraction) is released at slot ``floor(i / w)`` and due by slot ``ceil((i + 1) / w)``; of the released
blocks the one with the earliest deadline takes each slot, so after any number ``t`` of slots a source has had between
``w t - 1`` and ``w t + 1`` blocks. Equal deadlines go to the larger weight, then by name. When a source runs out, the
others go on under their weights, scaled up to fill the slots: a new phase, counted from its first slot.

Sources of one weight have equal windows and are served in turn, so the schedule is worked out by class of weight. Which
blocks an earliest-deadline schedule has done by slot ``T`` needs no history (see ``done_by``): tasks therefore schedule
ranges of slots independently, and the driver only looks for the slots at which sources run out.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.operators.ranges import numbered, row_tie

TASK_SLOTS = 65_536  #: slots that a task schedules; more if a source's windows are long
SLAB = 1 << 21  #: numbers in one array of a look back
LOOKS = 150  #: what scheduling a slot costs, in numbers of a look back


def whole_parts(weights: list[Fraction]) -> list[int]:
    """The weights as whole numbers in the same proportion."""
    unit = math.lcm(*(w.denominator for w in weights))
    whole = [int(w * unit) for w in weights]
    common = math.gcd(*whole)
    return [n // common for n in whole]


def least_waiting(parts: list[int], sizes: list[int], ends: list[int]) -> list[int]:
    """For each two ends next to each other the least number of blocks that wait, released and not done, before a slot
    after the one and up to the other."""
    if len(ends) < 2:
        return []
    total, low, high = math.sumprod(parts, sizes), ends[0] + 1, ends[-1] + 1
    exact = max(parts) * high < 1 << 62
    a, m = np.array(parts, np.int64 if exact else object), np.array(sizes, np.int64 if exact else object)
    least = np.full(len(ends) - 1, sum(sizes))
    rows, last = max(1024, SLAB // len(parts)), np.array(ends[1:])
    for at in range(low, high, rows):
        t = np.arange(at, min(high, at + rows)).astype(a.dtype)
        waits = (-(np.outer(-t, a) // total) @ m - t).astype(np.int64)
        part = np.searchsorted(last, t.astype(np.int64))  # the pair of ends that each slot is between
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        least[part[starts]] = np.minimum(least[part[starts]], np.minimum.reduceat(waits, starts))
    return least.tolist()


def done_by(parts: list[int], sizes: list[int], t: int) -> list[int]:
    """How many blocks of each class an earliest-deadline-first schedule has done before slot ``t`` of a phase.

    ``parts`` are the classes' weights, ``sizes`` their numbers of sources. All blocks due by ``t`` are done, and those
    released later are not; of a source at most one block remains, with a window around ``t``. The slots left over go to
    these by deadline, as long as of the blocks released before any earlier slot no more stay undone than waited there:
    sets of unit jobs that fit before ``t`` are a matroid, whose best basis the schedule takes.
    """
    total = math.sumprod(parts, sizes)
    full = [a * t // total for a in parts]
    open_slots = t - math.sumprod(full, sizes)
    around = [c for c, a in enumerate(parts) if a * t % total]
    release = {c: full[c] * total // parts[c] for c in around}
    room, earlier = {}, 0  #: by release: how many blocks released from there on may be done
    ends = sorted(set(release.values()))
    for r, least in zip(ends, [0, *least_waiting(parts, sizes, ends)], strict=False):
        room[r] = open_slots + least - earlier
        earlier += sum(sizes[c] for c in around if release[c] == r)
    done = [n * m for n, m in zip(full, sizes, strict=True)]
    for c in sorted(around, key=lambda c: (-(-(full[c] + 1) * total // parts[c]), c)):
        bound = [r for r in room if r <= release[c]]
        taken = max(0, min(sizes[c], *(room[r] for r in bound)))
        for r in bound:
            room[r] -= taken
        done[c] += taken
    return done


def windows(parts: list[int], sizes: list[int], done: list[int], low: int, high: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(slot, class, number, release, deadline) of the blocks in the slots [low, high) of a phase, ``done`` before.

    Block ``number`` of a class belongs to its source ``number % size`` and is that one's block ``number // size``.
    """
    total = math.sumprod(parts, sizes)
    release = lambda c, k: k // sizes[c] * total // parts[c]
    due = lambda c, k: -(-(k // sizes[c] + 1) * total // parts[c])
    waiting = [(release(c, k), c, k) for c, k in enumerate(done)]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    for t in range(low, high):
        while waiting and waiting[0][0] <= t:
            _, c, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due(c, k), c, k))
        end, c, k = heapq.heappop(ready)
        if end <= t:
            raise AssertionError("a block missed its deadline")
        yield t, c, k, release(c, k), end
        heapq.heappush(waiting, (release(c, k + 1), c, k + 1))


@dataclass
class Phase:
    start: int  #: first slot
    slots: int
    parts: list[int]  #: by class
    done: list[int]  #: blocks of each class in the phase


@dataclass
class Plan:
    """The phases in which all ``blocks`` are scheduled, each block once."""

    weights: list[Fraction]  #: classes, from the largest weight
    names: list[list[str]]  #: sources of each class, by name
    blocks: list[np.ndarray]
    phases: list[Phase]

    @classmethod
    def of(cls, blocks: dict[str, int], weights: dict[str, Fraction]) -> Plan:
        kinds = sorted({weights[s] for s, n in blocks.items() if n}, reverse=True)
        names = [sorted(s for s, n in blocks.items() if n and weights[s] == w) for w in kinds]
        plan = cls(kinds, names, [np.array([blocks[s] for s in some], np.int64) for some in names], [])
        start = 0
        for live, left, _, _ in plan.states():
            sizes = [len(x) for x in left]
            parts = whole_parts([kinds[c] for c in live])
            total = math.sumprod(parts, sizes)
            # of each class the source with the fewest blocks left, the first of such, ends first
            lasts = [(int(x.min()) - 1) * len(x) + int(x.argmin()) for x in left]
            low = min(n // m * total // a for n, m, a in zip(lasts, sizes, parts, strict=True))
            high = min(-(-(n // m + 1) * total // a) for n, m, a in zip(lasts, sizes, parts, strict=True))
            back = min(high, total // min(parts)) * len(parts) // LOOKS  # slots that cost as much as one look back
            done = [0] * len(parts)
            if low > back:
                done = done_by(parts, sizes, low)
                while high - low > 2 * back + 1:  # nobody has ended before slot low, somebody before slot high
                    mid = (low + high) // 2
                    then = done_by(parts, sizes, mid)
                    if any(n < k for n, k in zip(lasts, then, strict=True)):
                        high = mid
                    else:
                        low, done = mid, then
            else:
                low = 0
            for t, c, k, _, _ in windows(parts, sizes, done, low, high):
                done[c] = k + 1
                if k == lasts[c]:
                    break
            plan.phases.append(Phase(start, t + 1, parts, done))
            start += t + 1
        return plan

    @property
    def slots(self) -> int:
        return self.phases[-1].start + self.phases[-1].slots if self.phases else 0

    def states(self) -> Iterator[tuple[list[int], list[np.ndarray], list[np.ndarray], list[np.ndarray]]]:
        """Before each phase: (classes with blocks left; for each its sources' blocks left, blocks done, places in names)."""
        live = list(range(len(self.weights)))
        left = [x.copy() for x in self.blocks]
        had = [np.zeros_like(x) for x in left]
        place = [np.arange(len(x)) for x in left]
        n = 0
        while live:
            yield live, left, had, place
            for k, done in enumerate(self.phases[n].done):
                turns = done // len(left[k]) + (np.arange(len(left[k])) < done % len(left[k]))
                left[k], had[k] = left[k] - turns, had[k] + turns
                some = left[k] > 0
                left[k], had[k], place[k] = left[k][some], had[k][some], place[k][some]
            keep = [k for k in range(len(live)) if len(left[k])]
            live, left, had, place = ([x[k] for k in keep] for x in (live, left, had, place))
            n += 1

    def rows(self, low: int, high: int) -> Iterator[tuple[str, int, int, int, int]]:
        """(source, block, release, deadline, slot) of the slots [low, high)."""
        for phase, (live, left, had, place) in zip(self.phases, self.states(), strict=True):
            a, b = max(low, phase.start) - phase.start, min(high - phase.start, phase.slots)
            if a < b:
                sizes = [len(x) for x in left]
                for t, c, k, release, due in windows(phase.parts, sizes, done_by(phase.parts, sizes, a), a, b):
                    turn, j = divmod(k, sizes[c])
                    name = self.names[live[c]][place[c][j]]
                    yield name, int(had[c][j]) + turn, phase.start + release, phase.start + due, phase.start + t

    def task_slots(self, least: int = TASK_SLOTS) -> int:
        """Slots of a task, so many that the look back before the first costs no more than they do."""
        if not self.phases:
            return least
        weight = sum(w * len(n) for w, n in zip(self.weights, self.names, strict=True))
        return max(least, min(self.slots, int(weight / self.weights[-1])) * len(self.weights) // LOOKS)


def planned(spark: SparkSession, plan: Plan, task_slots: int | None = None) -> DataFrame:
    """(_key, _block, _release, _deadline, _slot) of every block, ranges of slots scheduled by as many tasks."""
    each = task_slots or plan.task_slots()
    tasks = max(1, -(-plan.slots // each))
    schema = "_key string, _block long, _release long, _deadline long, _slot long"
    names = ["_key", "_block", "_release", "_deadline", "_slot"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column(0).to_pylist():
                rows = []
                for row in plan.rows(n * each, min(plan.slots, (n + 1) * each)):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return spark.range(0, tasks, 1, tasks).mapInArrow(run, schema)


def scheduled(
    df: DataFrame,
    weights: dict[str, float] | None = None,
    other: float = 1.0,
    block_rows: int = 32,
    id_col: str = "doc_id",
    source_col: str = "source",
    task_slots: int | None = None,
) -> DataFrame:
    """Each row as a struct ``_row``, with a struct ``_place`` (block, release, deadline, slot, position).

    ``weights``: target weights by source, fractions or numbers, which count as their decimals say; sources without one
    get ``other``. ``block`` numbers a source's blocks of ``block_rows`` rows in order of the MD5 of the id, rows that
    share it by a hash of the row (the last block may be shorter); ``release`` and ``deadline`` bound the slot; rows in order of (slot, position) are the mixture,
    ``position`` being the row's place in its block. No row is lost or repeated. Any number of sources; a null source is
    a source of its own; null ids and repeated rows have places of their own; an empty table gives an empty result;
    other columns stay, whatever their names. Weights must be positive.
    """
    exact = lambda w: w if isinstance(w, Fraction) else Fraction(str(w))
    weights, other = {s: exact(w) for s, w in (weights or {}).items()}, exact(other)
    if other <= 0 or any(w <= 0 for w in weights.values()):
        raise ValueError("weights are positive")
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit(""))
    hashed = F.unhex(F.md5(F.col(id_col).cast("string")))
    based = df.select(F.struct("*").alias("_row"), key.alias("_key"), hashed.alias("_hash"), row_tie(df).alias("_tie"))
    counts = based.groupBy("_key").count().collect()  # a row for each source
    blocks = {r["_key"]: -(-r["count"] // block_rows) for r in counts}
    plan = Plan.of(blocks, {k: weights.get(k[1:], other) if k else other for k in blocks})
    placed = numbered(based, "_n", ["_hash", "_tie"], ["_key"]).withColumn("_block", F.floor(F.col("_n") / block_rows))
    place = F.struct(
        F.col("_block").alias("block"),
        F.col("_release").alias("release"),
        F.col("_deadline").alias("deadline"),
        F.col("_slot").alias("slot"),
        F.pmod(F.col("_n"), F.lit(block_rows)).cast("int").alias("position"),
    )
    return placed.join(planned(df.sparkSession, plan, task_slots), ["_key", "_block"]).select("_row", place.alias("_place"))


def schedule(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """(id, source, block, release, deadline, slot, position) of each row; see ``scheduled``."""
    out = scheduled(df.select(id_col, source_col), id_col=id_col, source_col=source_col, **options)
    return out.select(f"_row.{id_col}", f"_row.{source_col}", "_place.*")


def mixed_rows(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` in the order of the mixture: partitions and the rows within them follow (slot, position).

    All rows and columns are kept, with null texts, sources and ids, repeated rows included; an empty table stays empty.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["_place.slot", "_place.position"]
    return scheduled(df, **options).repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("_row.*")


def sql(weights: dict[str, int], block_rows: int = 32) -> str:
    """The same for DuckDB over ``documents``, slot by slot; whole weights, 1 for other sources."""
    weight = "case source " + " ".join(f"when '{s}' then {w}" for s, w in weights.items()) + " else 1 end"
    return f"""
with recursive numbered as (
  select doc_id, source, row_number() over (partition by source order by md5(doc_id::varchar), doc_id) - 1 as n from documents
), sized as (
  select source, ({weight})::bigint as w, ((count(*) + {block_rows - 1}) // {block_rows})::bigint as blocks from documents group by source
), steps as (
  select -1::bigint as slot, 0::bigint as start, list({{'s': source, 'w': w, 'l': blocks, 'had': 0::bigint, 'before': 0::bigint}} order by w desc, source) as alive,
    null::varchar as s, 0::bigint as block, 0::bigint as release, 0::bigint as deadline
  from sized having count(*) > 0
  union all
  select slot, case when ended then slot + 1 else start end,
    case when ended then list_transform(list_filter(now, lambda x: x.l > 0),
      lambda x: {{'s': x.s, 'w': x.w, 'l': x.l, 'had': 0::bigint, 'before': x.before + x.had}}) else now end,
    p.s, p.before + p.had, start + p.had * total // p.w, start + ((p.had + 1) * total + p.w - 1) // p.w
  from (
    select *, list_transform(alive, lambda x: {{'s': x.s, 'w': x.w, 'l': x.l - (x.s = p.s)::bigint, 'had': x.had + (x.s = p.s)::bigint, 'before': x.before}}) as now,
      p.l = 1 as ended
    from (
      select *, list_filter(ready, lambda x: ((x.had + 1) * total + x.w - 1) // x.w = list_min(list_transform(ready, lambda y: ((y.had + 1) * total + y.w - 1) // y.w)))[1] as p
      from (
        select *, list_filter(alive, lambda x: x.had * total // x.w <= slot - start) as ready
        from (select slot + 1 as slot, start, alive, list_sum(list_transform(alive, lambda x: x.w))::bigint as total from steps where len(alive) > 0)
      )
    )
  )
)
select doc_id, source, block, release, deadline, slot, (n % {block_rows})::integer as position
from numbered join steps on steps.s = numbered.source and steps.block = numbered.n // {block_rows}
"""
