"""One-dimensional k-means over value histograms, for many fits at once.

A histogram ``(component, value, weight)`` becomes a table of prefix sums in
two passes: it is range-partitioned and summed within its partitions, and the
partitions' totals, added up in order, give the offset of each. A row then
holds the sums of weight, value and squared value (weighted) up to its value,
and the next value. A cluster of a one-dimensional fit is a range of values, so
a Lloyd round needs the sums at the k - 1 boundaries only: a job without a
shuffle in which every row answers for the boundaries between its value and the
next one. A job also brings neighbours of each boundary, AHEAD rows in all, so
that rounds that move a boundary by less need no job. What reaches the
driver is centres and those sums, however many rows the histogram has.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.sources.io import shared_path

LAST = 2**63 - 1
SUM = "decimal(38,0)"
#: Neighbouring rows that a job brings along, and rows that the driver remembers between rounds.
AHEAD, REMEMBER = 8192, 100_000
#: Up to so many boundaries are looked up by a filter.
FEW = 32
#: Rows of a block of draws (rows x starts) in a task.
DRAW_ROWS = 1024
Sums = tuple[int, int, int]


@dataclass
class PrefixSums:
    """component, value, next_value, weight, the inclusive sums w, s, q, and the
    value's place pos."""
    table: DataFrame
    span: dict[str, tuple[int, int]]
    total: dict[str, Sums]
    known: dict[str, list[tuple]] = field(default_factory=dict)

    @classmethod
    def build(cls, hist: DataFrame) -> PrefixSums:
        spark = hist.sparkSession
        path = shared_path(spark, "prefix_sums", uuid.uuid4().hex)
        (hist.select("component", F.col("value").cast("long").alias("value"), F.col("weight").cast("long").alias("weight"))
         .repartitionByRange("component", "value").withColumn("part", F.spark_partition_id()).write.parquet(f"{path}/ranges"))
        rows = spark.read.parquet(f"{path}/ranges")
        v, w = F.col("value").cast(SUM), F.col("weight").cast(SUM)
        measures = {"w": w, "s": v * w, "q": v * v * w, "pos": F.lit(1).cast(SUM)}
        parts = (rows.groupBy("component", "part").agg(F.min("value").alias("first"), F.max("value").alias("last"),
                                                       *[F.sum(m).cast(SUM).alias(n) for n, m in measures.items()])
                 .orderBy("component", "part").collect())  # a row per component and range partition
        offsets, span, total = [], {}, {}
        for r, following in zip(parts, [*parts[1:], None]):
            c, sums = r["component"], [r[n] for n in measures]
            before = total.get(c, [Decimal(0)] * len(measures))
            after = following["first"] if following is not None and following["component"] == c else LAST
            offsets.append((c, r["part"], after, *before))
            span[c], total[c] = (span.get(c, (r["first"],))[0], r["last"]), [x + y for x, y in zip(before, sums)]
        order = Window.partitionBy("component", "part").orderBy("value")
        running = order.rowsBetween(Window.unboundedPreceding, 0)
        sums = rows.select("component", "part", "value", "weight", F.lead("value").over(order).alias("next"),
                           *[F.sum(m).over(running).alias(n) for n, m in measures.items()])
        offset = spark.createDataFrame(offsets, "component string, part int, after long, " + ", ".join(f"{n}0 {SUM}" for n in measures))
        (sums.join(offset, ["component", "part"])
         .select("component", "value", "weight", F.coalesce("next", "after").alias("next_value"),
                 *[(F.col(n) + F.col(f"{n}0")).cast("long" if n == "pos" else SUM).alias(n) for n in measures])
         .sortWithinPartitions("component", "value").write.parquet(f"{path}/sums"))
        return cls(spark.read.parquet(f"{path}/sums"), span, {c: tuple(int(x) for x in t[:3]) for c, t in total.items()})

    def _place(self, component: str, bound: int) -> int:
        return bisect_right(self.known.get(component, []), bound, key=lambda r: r[0]) - 1

    def _row(self, component: str, bound: int) -> tuple | None:
        """The remembered row that answers for the bound."""
        i = self._place(component, bound)
        return self.known[component][i] if i >= 0 and bound < self.known[component][i][1] else None

    def upto(self, component: str, bound: int) -> Sums:
        """Sums over the values <= bound, which must have been read."""
        first, last = self.span[component]
        return (0, 0, 0) if bound < first else self.total[component] if bound >= last else self._row(component, bound)[2:5]

    def read(self, bounds: set[tuple[str, int]]) -> None:
        """Read the rows that answer for the (component, bound) pairs and aren't remembered."""
        inner = {(c, b) for c, b in bounds if self.span[c][0] <= b < self.span[c][1]}
        new = {x for x in inner if self._row(*x) is None}
        if not new:
            return
        if sum(map(len, self.known.values())) + len(new) + AHEAD > REMEMBER:
            self.known.clear()
            new = inner
        rows = self.table.select("component", "value", "next_value", "w", "s", "q", "pos")
        found = rows.where(self._near(new)) if len(new) <= FEW else rows.mapInArrow(_looking(new, AHEAD // (2 * len(new))), rows.schema)
        for c, value, after, w, s, q, pos in found.collect():  # a row per boundary, and AHEAD
            if self._row(c, value) is None:
                insort(self.known.setdefault(c, []), (value, after, int(w), int(s), int(q), pos))

    def _near(self, new: set[tuple[str, int]]) -> str:
        """The rows of the bounds, and those from the nearest known row on towards each."""
        near, terms = AHEAD // len(new), []
        for c, b in sorted(new):
            rows, i = self.known.get(c, []), self._place(c, b)
            below, above = rows[i] if i >= 0 else None, rows[i + 1] if i + 1 < len(rows) else None
            around = ""
            if below and (not above or b - below[0] <= above[0] - b):
                around = f" OR pos BETWEEN {below[5]} AND {below[5] + near}"
            elif above:
                around = f" OR pos BETWEEN {above[5] - near} AND {above[5]}"
            terms.append(f"component = '{c}' AND (value <= {b} AND next_value > {b}{around})")
        return " OR ".join(terms)

    def clusters(self, component: str, centers: list[float]) -> list[Sums]:
        """The sums of each centre's cluster; the boundaries must have been read."""
        at = [(0, 0, 0), *(self.upto(component, b) for b in boundaries(centers)), self.total[component]]
        return [tuple(y - x for x, y in zip(a, b)) for a, b in zip(at, at[1:])]

    def cost(self, component: str, centers: list[float]) -> Fraction:
        """Exact weighted sum of squared distances to the nearest centre."""
        out = Fraction(0)
        for c, (w, s, q) in zip(map(Fraction, centers), self.clusters(component, centers)):
            out += q - 2 * c * s + c * c * w
        return out


def _looking(new: set[tuple[str, int]], near: int):
    """The same for many bounds, as a function over Arrow batches, with ``near`` neighbours on each side."""
    wanted: dict[str, list[int]] = {}
    for c, b in sorted(new):
        wanted.setdefault(c, []).append(b)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            component = b.column("component")
            value, after = (b.column(c).to_numpy() for c in ("value", "next_value"))
            take = np.zeros(b.num_rows + 1, dtype=np.int64)
            for c in pc.unique(component).to_pylist():
                mine, at = np.flatnonzero(pc.equal(component, c).to_numpy(zero_copy_only=False)), np.array(wanted.get(c, []), dtype=np.int64)
                hit = mine[np.searchsorted(at, after[mine]) > np.searchsorted(at, value[mine])]
                np.add.at(take, np.maximum(hit - near, 0), 1)
                np.add.at(take, np.minimum(hit + near + 1, b.num_rows), -1)
            yield b.take(pa.array(np.flatnonzero(np.cumsum(take)[:-1] > 0)))
    return look


def boundaries(centers: list[float]) -> list[int]:
    """Largest whole value on the left of each midpoint (a value on it belongs to the left)."""
    return [math.floor((a + b) / 2) for a, b in zip(centers, centers[1:])]


@dataclass
class Fit:
    """A fit of one component: sorted centres, and how it went. The centres
    after some earlier number of rounds are kept where ``stops`` asks for them."""
    component: str
    centers: list[float]
    max_rounds: int
    stops: dict[int, list[float] | None] = field(default_factory=dict)
    rounds: int = 0
    settled: bool = False


def even_start(sums: PrefixSums, component: str, k: int) -> list[float]:
    """lo + (hi - lo)(2i + 1) / 2k."""
    lo, hi = sums.span[component]
    return [lo + (hi - lo) * (2 * i + 1) / (2 * k) for i in range(k)]


def run(sums: PrefixSums, fits: list[Fit]) -> None:
    """Lloyd rounds for all fits until each is settled or at its limit. An
    empty cluster keeps its centre."""
    active = [f for f in fits if f.component in sums.span]
    while active:
        sums.read({(f.component, b) for f in active for b in boundaries(f.centers)})
        for f in active:
            new = [s / w if w else c for c, (w, s, _) in zip(f.centers, sums.clusters(f.component, f.centers))]
            f.rounds, f.settled, f.centers = f.rounds + 1, new == f.centers, new
            if f.rounds in f.stops:
                f.stops[f.rounds] = new
        active = [f for f in active if not f.settled and f.rounds < f.max_rounds]


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer over unsigned integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniforms(seeds: np.ndarray, step: int, values: np.ndarray) -> np.ndarray:
    """A number in (0, 1) for each value (row) and seed (column), the same in any task."""
    with np.errstate(over="ignore"):
        s = _mix(seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step + 1))
        x = _mix(values.astype(np.int64).view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) ^ s[None, :])
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def drawn_starts(sums: PrefixSums, starts: list[tuple[str, int, str, int]]) -> list[list[float]]:
    """Centres for each (component, k, init, seed), drawn from the histogram.

    One job per centre, for all starts: each value gets the key -ln(u) / mass,
    and the smallest key wins, which draws a value with probability mass /
    total. The mass is the weight; for ``k-means++``, from the second centre on,
    weight x squared distance to the nearest centre drawn; for ``random``, that
    of the values not drawn yet. With fewer values than centres the last one is
    repeated."""
    chosen: list[list[int]] = [[] for _ in starts]
    for step in range(max((k for _, k, _, _ in starts), default=0)):
        todo: dict[str, list[int]] = {}
        for i, (component, k, _, _) in enumerate(starts):
            if component in sums.span and len(chosen[i]) == step < k:
                todo.setdefault(component, []).append(i)
        if not todo:
            break
        seeds = {c: np.array([starts[i][3] for i in ids], dtype=np.int64) for c, ids in todo.items()}
        plus = {c: np.array([starts[i][2] == "k-means++" for i in ids]) for c, ids in todo.items()}
        done = {c: np.array([chosen[i] for i in ids], dtype=np.float64).reshape(len(ids), step) for c, ids in todo.items()}

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = {c: (np.full(len(ids), np.inf), np.zeros(len(ids), dtype=np.int64)) for c, ids in todo.items()}
            for b in batches:
                component = b.column("component")
                all_values, all_weights = (b.column(n).to_numpy() for n in ("value", "weight"))
                for c in pc.unique(component).to_pylist():
                    rows = np.flatnonzero(pc.equal(component, c).to_numpy(zero_copy_only=False))
                    for at in range(0, len(rows), DRAW_ROWS):
                        v, w = (x[rows[at:at + DRAW_ROWS]] for x in (all_values, all_weights))
                        mass = np.repeat(w.astype(np.float64)[:, None], len(todo[c]), axis=1)
                        if step:
                            gap = np.full(mass.shape, np.inf)
                            for j in range(step):
                                np.minimum(gap, (v[:, None] - done[c][None, :, j]) ** 2, out=gap)
                            mass *= np.where(plus[c][None, :], gap, gap > 0)
                        with np.errstate(divide="ignore"):
                            key = -np.log(uniforms(seeds[c], step, v)) / mass
                        least, top, pick = key.argmin(axis=0), *best[c]
                        low = key[least, np.arange(len(least))]
                        better = (low < top) | ((low == top) & (v[least] < pick) & np.isfinite(low))
                        top[better], pick[better] = low[better], v[least][better]
            out = [(i, float(x), int(y)) for c, ids in todo.items() for i, x, y in zip(ids, *best[c]) if np.isfinite(x)]
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64())],
                                             names=["start", "key", "value"])

        found = (sums.table.where(F.col("component").isin(*todo)).select("component", "value", "weight")
                 .mapInArrow(draw, "start int, key double, value long").groupBy("start").agg(F.min(F.struct("key", "value")).alias("x")))
        for r in found.collect():  # a row per start
            chosen[r["start"]].append(r["x"]["value"])
    return [[float(x) for x in sorted(c + c[-1:] * (k - len(c)))] for c, (_, k, _, _) in zip(chosen, starts)]


def best_of_starts(sums: PrefixSums, points: list[tuple[str, int, str, int, int]], seed: int) -> list[list[float] | None]:
    """For each (component, k, init, n_init, max_iter) the centres of least
    cost among its starts 0 .. n_init - 1 (of equals the first), each run for at
    most max_iter rounds. Points share their starts, and equal starts one run.
    None for a component without values."""
    points = [p if p[0] in sums.span else None for p in points]
    names = {p: [(p[0], p[1], p[2], seed + 7919 * i) for i in range(p[3])] for p in points if p}
    starts = sorted({n for ns in names.values() for n in ns})
    centers = dict(zip(starts, drawn_starts(sums, starts)))
    fits: dict[tuple, Fit] = {}
    for p, ns in names.items():
        for n in ns:
            f = fits.setdefault((p[0], *centers[n]), Fit(p[0], centers[n], 0))
            f.max_rounds = max(f.max_rounds, p[4])
            f.stops[p[4]] = None
    run(sums, list(fits.values()))
    ends = {p: [(f.stops[p[4]] or f.centers) for f in (fits[p[0], *centers[n]] for n in ns)] for p, ns in names.items()}
    sums.read({(p[0], b) for p, cs in ends.items() for c in cs for b in boundaries(c)})
    cost = {(c, e): sums.cost(c, list(e)) for c, e in {(p[0], tuple(e)) for p, es in ends.items() for e in es}}
    return [p and min(ends[p], key=lambda e: cost[p[0], tuple(e)]) for p in points]
