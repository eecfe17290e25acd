"""Exact quantiles with linear interpolation at any size.

The values at the wanted ranks are found by narrowing. A sketch per column proposes values on
either side of each rank (pivots), at the distance of the sketch's rank bound; one scan counts how many
values lie below and at every pivot, and brings along the values between the two pivots of a rank where
the bound says that these are few. Ranks that still have more values between their pivots than one task
sorts with ease go another round; the values around the others are gathered and sorted. Only sketches, counts and gathered values
are shuffled, never the data, and the counts make the outcome exact whatever the error of the sketch.
Every size of data takes this one path, so the same rows have the same quantiles however many others
there are.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GATHER_ROWS = 200_000
# Values around one rank that the counting scan itself may bring to the driver, and those around all ranks.
GATHER_AT_ONCE, GATHER_ALL = 20_000, 200_000
# The sketch is larger where the small one leaves more around a rank than the counting scan may bring.
_SKETCH, _FINE_SKETCH = 4_096, 32_768
_FINE_ACCURACY = 10_000
# Pivots that are compared in generated code, by halves.
_STRAIGHT = 32


@dataclass
class _Search:
    """What is known of one column: pivots with the counts of values below and up to them."""

    rows: int
    wanted: set[int]
    pivots: list[float] = field(default_factory=list)
    below: list[int] = field(default_factory=list)
    upto: list[int] = field(default_factory=list)
    found: dict[int, float] = field(default_factory=dict)

    def learn(self, pivots: Sequence[float], below: Sequence[int], upto: Sequence[int]) -> None:
        known = dict(zip(self.pivots, zip(self.below, self.upto)))
        known.update(zip(pivots, zip(below, upto)))
        self.pivots = sorted(known)
        self.below = [known[p][0] for p in self.pivots]
        self.upto = [known[p][1] for p in self.pivots]
        for rank in self.wanted - self.found.keys():
            i = self._first_reaching(rank)
            if i < len(self.pivots) and self.below[i] <= rank:
                self.found[rank] = self.pivots[i]

    def _first_reaching(self, rank: int) -> int:
        return bisect_left(self.upto, rank + 1)

    def open_brackets(self) -> dict[tuple, tuple[int, int, list[int]]]:
        """``(above, below)`` of unresolved ranks: values before, values inside, ranks."""
        brackets: dict[tuple, tuple[int, int, list[int]]] = {}
        for rank in sorted(self.wanted - self.found.keys()):
            i = self._first_reaching(rank)
            above = self.pivots[i - 1] if i else None
            before = self.upto[i - 1] if i else 0
            below = self.pivots[i] if i < len(self.pivots) else None
            end = self.below[i] if i < len(self.pivots) else self.rows
            brackets.setdefault((above, below), (before, end - before, []))[2].append(rank)
        return brackets


def _within(value: Column, above: float | None, below: float | None) -> Column:
    held = value.isNotNull()
    if above is not None:
        held = held & (value > above)
    if below is not None:
        held = held & (value < below)
    return held


def quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    probabilities: Sequence[float],
    approximate: bool = False,
    counts: Mapping[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles of named double expressions, null for one without values.

    The result is as large as names times probabilities, whatever the data.
    """
    if not values:
        return {}
    probabilities = list(probabilities)
    if not approximate:
        return narrowed_quantiles(df, values, probabilities, counts=counts)
    make = [F.percentile_approx(v, probabilities, _FINE_ACCURACY) for v in values.values()]
    row = df.agg(*[m.alias(f"q{i}") for i, m in enumerate(make)]).first()
    none = [None] * len(probabilities)
    return {k: list(row[f"q{i}"] or none) for i, k in enumerate(values)}


def between(low: float, high: float, part: float) -> float:
    """The value a ``part`` of the way from low to high; no arithmetic where they are one value,
    as infinities would not survive it."""
    return low if part == 0 or low == high else (1 - part) * low + part * high


def narrowed_quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    probabilities: Sequence[float],
    gather_rows: int = GATHER_ROWS,
    counts: Mapping[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Exact quantiles by counting; see the module text. ``counts`` are the values of each name where they are at hand."""
    names = list(values)
    short = {n: f"v{i}" for i, n in enumerate(names)}
    frame = df.select(*[values[n].cast("double").alias(short[n]) for n in names])
    if counts is None:
        counted = frame.agg(*[F.count(c).alias(c) for c in short.values()]).first()
    else:
        counted = {short[n]: counts[n] for n in names}

    searches: dict[str, _Search] = {}
    for n in names:
        rows = counted[short[n]]
        wanted = {
            rank
            for p in probabilities
            if rows
            for rank in (math.floor(p * (rows - 1)), math.ceil(p * (rows - 1)))
        }
        searches[short[n]] = _Search(rows, wanted)

    # A round adds at least one value inside each wide bracket to the pivots, so this ends.
    while _round(frame, searches, gather_rows):
        pass
    _gather(frame, searches)

    result: dict[str, list[float | None]] = {}
    for n in names:
        search = searches[short[n]]
        result[n] = []
        for p in probabilities:
            if not search.rows:
                result[n].append(None)
                continue
            position = p * (search.rows - 1)
            low = search.found[math.floor(position)]
            high = search.found[math.ceil(position)]
            result[n].append(between(low, high, position - math.floor(position)))
    return result


def _margin(inside: int) -> tuple[int, float]:
    """A sketch's size for so many values, and the share of them within which it finds a rank, but for very few."""
    share = {size: 3 * 2.296 / size**0.9723 for size in (_SKETCH, _FINE_SKETCH)}
    size = _FINE_SKETCH if 2 * share[_SKETCH] * inside > GATHER_AT_ONCE else _SKETCH
    return size, share[size]


def _aims(rank: int, before: int, inside: int) -> tuple[float, float]:
    """Shares of a bracket's values to either side of a rank, as far off as the sketch may be."""
    middle, margin = (rank - before + 0.5) / inside, _margin(inside)[1]
    return max(middle - margin, 0.0), min(middle + margin, 1.0)


def _round(frame: DataFrame, searches: dict[str, _Search], gather_rows: int) -> bool:
    """Sketch and count once for every bracket that holds many values.

    The sketch's rank bound says how many values can lie between the pivots on either side of a
    wanted rank. Where these are few, the counting scan brings them along, value by value, and
    the rank is settled by it. What is left of a column after its first round is gathered, unless it is too much for that.
    """
    few = min(gather_rows, GATHER_AT_ONCE)
    wide = [
        (c, bounds, bracket)
        for c, search in searches.items()
        for bounds, bracket in search.open_brackets().items()
        if bracket[1] > (gather_rows if search.pivots else few)
    ]
    if not wide:
        return False
    around = sum(2 * _margin(inside)[1] * inside * len(ranks) for _, _, (_, inside, ranks) in wide)
    sketches, asked, aims = [], [], []
    for i, (c, bounds, (before, inside, ranks)) in enumerate(wide):
        aims.append(sorted({a for rank in ranks for a in _aims(rank, before, inside)}))
        held = F.col(c) if bounds == (None, None) else F.when(_within(F.col(c), *bounds), F.col(c))
        sketches.append(F.kll_sketch_agg_double(held, _margin(inside)[0]).alias(f"s{i}"))
        asked.append(F.kll_sketch_get_quantile_double(f"s{i}", F.array(*map(F.lit, aims[i]))).alias(f"p{i}"))
    proposed = frame.agg(*sketches).select(*asked).first()

    pivots: dict[str, list[float]] = {}
    near: dict[str, list[tuple[float, float]]] = {}
    for i, (c, _, (before, inside, ranks)) in enumerate(wide):
        at = dict(zip(aims[i], (0.0 if p == 0 else p for p in proposed[f"p{i}"])))
        pivots[c] = sorted({*pivots.get(c, []), *at.values()})
        if around <= GATHER_ALL and 2 * _margin(inside)[1] * inside <= few:
            near.setdefault(c, []).extend(tuple(at[a] for a in _aims(rank, before, inside)) for rank in ranks)
    # Slot 2k+1 holds the values equal to pivot k, slot 2k those between pivots k-1 and k.
    kept = {
        c: [slot % 2 == 0 and 0 < slot < 2 * len(found) and any(low <= found[slot // 2 - 1] and found[slot // 2] <= high for low, high in near.get(c, []))
            for slot in range(2 * len(found) + 1)]
        for c, found in pivots.items()
    }
    sizes = _slotted(frame, pivots, kept).groupBy("at", "slot", "v").agg(F.count(F.lit(1)).alias("n"))
    by_slot: dict[tuple, list[tuple]] = {}
    for r in sizes.collect():
        by_slot.setdefault((r["at"], r["slot"]), []).append((r["v"], r["n"]))
    for at, (c, found) in enumerate(pivots.items()):
        values, below, upto, total = [], [], [], 0
        for slot in range(2 * len(found)):
            for v, n in sorted(by_slot.get((at, slot), [(None, 0)] if slot % 2 else [])):
                if slot % 2 or kept[c][slot]:
                    values.append(found[slot // 2] if slot % 2 else v)
                    below.append(total)
                    upto.append(total + n)
                total += n
        searches[c].learn(values, below, upto)
    return True


def _slotted(frame: DataFrame, pivots: dict[str, list[float]], kept: dict[str, list[bool]]) -> DataFrame:
    """``(at, slot, v)``: the slot of each value, and the value itself in the kept slots; ``at`` numbers the columns.

    The pivots come to the unpivoted values as one row per column, so a single short expression serves all
    columns; a chain of cases for each of them would be more code than the JVM compiles.
    """
    most = max(map(len, pivots.values()))
    # Nothing is at or above the padding.
    rows = [(at, [*found, *[math.nan] * (most - len(found))], kept[c]) for at, (c, found) in enumerate(pivots.items())]
    table = frame.sparkSession.createDataFrame(rows, "of int, pivots array<double>, kept array<boolean>")
    x = F.col("x")
    if most <= _STRAIGHT:
        table = table.select("of", "kept", *[F.col("pivots")[k].alias(f"p{k}") for k in range(most)])
        slot = _slot_of(x, 0, most)
    else:
        slot = F.size(F.filter("pivots", lambda p: p <= x)) + F.size(F.filter("pivots", lambda p: p < x))
    # Numbers are joined and grouped in half the time that names are.
    cells = frame.select(F.posexplode(F.array(*pivots)).alias("at", "x")).filter(x.isNotNull())
    slotted = cells.join(F.broadcast(table), F.col("at") == F.col("of")).select("at", "x", "kept", slot.alias("slot"))
    v = F.when(F.col("kept")[F.col("slot")], F.col("x"))
    return slotted.select("at", "slot", v.alias("v"))


def _slot_of(x: Column, start: int, end: int) -> Column:
    """The slot of a value among the pivots from ``start`` to ``end``, by halves."""
    if start == end:
        return F.lit(2 * start)
    k = (start + end) // 2
    pivot = F.col(f"p{k}")
    return F.when(x < pivot, _slot_of(x, start, k)).when(x > pivot, _slot_of(x, k + 1, end)).otherwise(F.lit(2 * k + 1))


def _gather(frame: DataFrame, searches: dict[str, _Search]) -> None:
    """Sort the values left in each bracket: no more than the gather limit of each."""
    pivots: dict[str, list[float]] = {}
    kept: dict[str, list[bool]] = {}
    left: dict[tuple[int, int], tuple[str, int, list[int]]] = {}
    for c, search in searches.items():
        brackets = search.open_brackets()
        if not brackets:
            continue
        pivots[c] = sorted({p for bounds in brackets for p in bounds if p is not None})
        kept[c] = [False] * (2 * len(pivots[c]) + 1)
        for (above, _), (before, _, ranks) in brackets.items():
            slot = 0 if above is None else 2 * pivots[c].index(above) + 2
            kept[c][slot] = True
            left[len(pivots) - 1, slot] = (c, before, ranks)
    if not left:
        return
    values = _slotted(frame, pivots, kept).filter(F.col("v").isNotNull()).groupBy("at", "slot", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("at", "slot").orderBy("v"))
    rows = [(at, slot, [rank - before for rank in ranks]) for (at, slot), (_, before, ranks) in left.items()]
    # One row per bracket.
    wanted = frame.sparkSession.createDataFrame(rows, "at int, slot int, offsets array<bigint>")
    hits = (
        values.withColumn("upto", upto)
        .join(F.broadcast(wanted), ["at", "slot"])
        .filter(F.exists("offsets", lambda o: (F.col("upto") > o) & (F.col("upto") - F.col("n") <= o)))
        .select("at", "slot", "v", (F.col("upto") - F.col("n")).alias("start"), "upto")
    )
    for hit in hits.collect():
        c, before, ranks = left[hit["at"], hit["slot"]]
        for rank in ranks:
            if hit["start"] <= rank - before < hit["upto"]:
                searches[c].found[rank] = hit["v"]
