"""Global order without a single-partition window.

Two forms are offered. :func:`rank_cuts` finds the exact rows that stand at a
few given ranks; a quantile score or a top share is then a comparison with a
handful of literals, so the full table is neither sorted nor shuffled.
:func:`global_rank` numbers every row, with one range shuffle.

Both order by a value and then by a unique key, so ties never pile up in one
partition, however many rows share the value.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.functions.columns import known
from patronlens.sources.staging import stage

# A sketch keeps about this many points. All sketches of a column meet in one
# task, so it trades their size against the share of rows left in the brackets.
SKETCH_ACCURACY = 2_000


@dataclass(frozen=True)
class RankSpec:
    """What to rank: ``value`` ascending among the rows where ``among`` holds.

    ``ranks`` maps the number of ranked rows to the ranks wanted, from 1.
    """

    name: str
    value: Column
    ranks: Callable[[int], Sequence[int]]
    among: Column | None = None

    def ranked_value(self) -> Column:
        value = known(self.value)
        return value if self.among is None else F.when(self.among, value)


@dataclass(frozen=True)
class RankCuts:
    """The rows found: ``cuts[i]`` is the (value, key) at the i-th wanted rank."""

    rows: int
    cuts: tuple[tuple[float, Any], ...]


@dataclass
class _Bracket:
    """A value interval known to hold some of the wanted ranks."""

    spec: int
    low: float
    high: float
    below: int
    inside: int
    targets: list[int]


def cuts_passed(spec: RankSpec, key: str, found: RankCuts) -> Column:
    """How many cut rows stand strictly before this row; null if not ranked."""
    value = spec.ranked_value()
    passed = F.lit(0)
    for cut_value, cut_key in found.cuts:
        after = (value > F.lit(cut_value)) | ((value == F.lit(cut_value)) & (F.col(key) > F.lit(cut_key)))
        passed = passed + after.cast("int")
    return F.when(value.isNotNull(), passed)


def rank_cuts(df: DataFrame, key: str, specs: Sequence[RankSpec]) -> dict[str, RankCuts]:
    """Find the exact rows at the wanted ranks of every spec.

    ``df`` is read four times and should be a stored table. The rows are counted;
    quantile sketches propose a value bracket around each rank, and an exact count
    of the rows below and inside confirms it. Only the bracket rows, value and key
    alone, are ordered. A bracket the counts do not confirm falls back to all
    values, so the result never rests on the sketch. Tables of every size take this
    one way. Without ranked rows there are no cuts.
    """
    values = [spec.ranked_value() for spec in specs]
    counted = df.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(values)]).first()
    sizes = [counted[f"n{i}"] for i in range(len(specs))]
    targets = [sorted(set(spec.ranks(n))) for spec, n in zip(specs, sizes)]
    for spec, n, ranks in zip(specs, sizes, targets):
        if any(r < 1 or r > n for r in ranks):
            raise ValueError(f"{spec.name}: ranks {ranks} outside 1..{n}")

    found = _rows_at(df, key, values, _narrow(df, values, sizes, targets))
    return {
        spec.name: RankCuts(n, tuple(found[(i, r)] for r in spec.ranks(n)))
        for i, (spec, n) in enumerate(zip(specs, sizes))
    }


def _narrow(
    df: DataFrame, values: list[Column], sizes: list[int], targets: list[list[int]]
) -> list[_Bracket]:
    """Bracket every target between two sketched quantiles, then count exactly."""
    margin = 4.0 / SKETCH_ACCURACY
    sketches = {}
    for i, (value, n, ranks) in enumerate(zip(values, sizes, targets)):
        ends = [F.lit(min(1.0, max(0.0, r / n + side))) for r in ranks for side in (-margin, margin)]
        if ends:
            sketches[i] = F.percentile_approx(value, F.array(*ends), SKETCH_ACCURACY).alias(f"s{i}")
    if not sketches:
        return []
    sketched = df.agg(*sketches.values()).first()

    merged: list[_Bracket] = []
    for i in sketches:
        ends = sketched[f"s{i}"]
        for rank, low, high in zip(targets[i], ends[::2], ends[1::2]):
            last = merged[-1] if merged else None
            if last is not None and last.spec == i and low <= last.high:
                last.high = max(last.high, high)
                last.targets.append(rank)
            else:
                merged.append(_Bracket(i, low, high, 0, 0, [rank]))

    counts = []
    for j, b in enumerate(merged):
        value = values[b.spec]
        counts.append(F.count_if(value < F.lit(b.low)).alias(f"b{j}"))
        counts.append(F.count_if(value.between(F.lit(b.low), F.lit(b.high))).alias(f"i{j}"))
    counted = df.agg(*counts).first()
    unconfirmed = set()
    for j, b in enumerate(merged):
        b.below, b.inside = counted[f"b{j}"], counted[f"i{j}"]
        if b.targets[0] <= b.below or b.targets[-1] > b.below + b.inside:
            unconfirmed.add(b.spec)
    kept = [b for b in merged if b.spec not in unconfirmed]
    kept += [_Bracket(i, -math.inf, math.inf, 0, sizes[i], targets[i]) for i in sorted(unconfirmed)]
    return kept


def _rows_at(
    df: DataFrame, key: str, values: list[Column], brackets: list[_Bracket]
) -> dict[tuple[int, int], tuple[float, Any]]:
    """Order the bracket rows and return the (value, key) at each target rank."""
    if not brackets:
        return {}
    entries = []
    for tag, b in enumerate(brackets):
        value = values[b.spec]
        inside = value.between(F.lit(b.low), F.lit(b.high))
        entries.append(F.when(inside, F.struct(F.lit(tag).alias("tag"), value.alias("value"))))
    narrow = (
        df.select(F.col(key).alias("key"), F.explode(F.array_compact(F.array(*entries))).alias("entry"))
        .select("entry.tag", "entry.value", "key")
    )
    places = {(tag, r - b.below): (b.spec, r) for tag, b in enumerate(brackets) for r in b.targets}
    ordered = ordered_rows(narrow, ["tag", "value", "key"], "rank_cuts")
    starts = slice_starts(ordered).orderBy("slice").collect()
    before_tag, total = [], 0
    for b in brackets:
        before_tag.append(total)
        total += b.inside
    at = {}
    for (tag, place), target in places.items():
        index = before_tag[tag] + place - 1
        holder = max((s for s in starts if s["start"] <= index), key=lambda s: s["start"])
        at[(holder["slice"] << 33) + index - holder["start"]] = target
    rows = ordered.where(F.col("position").isin(list(at))).collect()
    return {at[row["position"]]: (row["value"], row["key"]) for row in rows}


def ordered_rows(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Sort globally and store each row's ``position``.

    The position holds the output slice in its upper bits and the place within
    the slice in its lower 33 bits. It is written out, so later passes agree on
    it even if a task is run again.
    """
    ordered = df.orderBy(*order).withColumn("position", F.monotonically_increasing_id())
    return stage(ordered, name)


def slice_of(position: Column) -> Column:
    """The output slice of a stored position."""
    return F.shiftright(position, 33)


def place_of(position: Column) -> Column:
    """The place within the slice, from 0."""
    return position.bitwiseAND(F.lit((1 << 33) - 1))


def slice_starts(ordered: DataFrame, *totals: str) -> DataFrame:
    """Rows in all earlier slices, one row per slice.

    For each of ``totals`` also its sum over the earlier slices (``_before``) and
    over all slices (``_total``).

    There are at most as many slices as shuffle partitions, which bounds both
    the window below and any broadcast of the result.
    """
    sums = [F.sum(c).alias(c) for c in totals]
    per_slice = ordered.groupBy(slice_of(F.col("position")).alias("slice")).agg(F.count("*").alias("rows"), *sums)
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start")]
    columns += [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in totals]
    everything = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    columns += [F.sum(c).over(everything).alias(f"{c}_total") for c in totals]
    return per_slice.select("slice", *columns)


def global_rank(df: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Number all rows from 1 in the given order, which must be total."""
    ordered = ordered_rows(df, order, "global_rank").withColumn("slice", slice_of(F.col("position")))
    starts = F.broadcast(slice_starts(ordered))
    rank = F.col("start") + place_of(F.col("position")) + F.lit(1)
    return ordered.join(starts, "slice").withColumn(name, rank).drop("slice", "start", "position")


def quantile_last_ranks(rows: int, bins: int) -> list[int]:
    """The last rank of every equal-size bin but the highest.

    Bin edges are the linearly interpolated quantiles of the ranks 1..n, a rank
    equal to an edge going to the lower bin. Edges are computed in floating point
    the way array libraries do, since that decides which bin gets an edge rank.
    """
    if rows < 2:
        raise ValueError("Bin edges must be unique: at least two rows are needed")
    last = []
    for i in range(1, bins):
        index = (rows - 1) * (i * (1.0 / bins) * 100.0 / 100.0)
        low = math.floor(index)
        part = index - low
        edge = (low + 2) - (1 - part) if part >= 0.5 else (low + 1) + part
        last.append(max(1, math.floor(edge)))
    return last


def quantile_spec(name: str, value: Column, bins: int, among: Column | None = None) -> RankSpec:
    """A spec whose passed cuts are the zero-based quantile bin."""
    return RankSpec(name, value, lambda n: quantile_last_ranks(n, bins), among)


def first_rows_spec(name: str, value: Column, count: Callable[[int], int], among: Column | None = None) -> RankSpec:
    """A spec whose passed cuts are 0 for the first ``count(n)`` rows, else 1."""
    return RankSpec(name, value, lambda n: [count(n)] if n else [], among)
