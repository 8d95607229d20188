"""Exact percentiles of many columns without gathering a column in one task."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from decimal import ROUND_CEILING, ROUND_FLOOR, ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCALE = 10_000  # values are decimals with four places and are counted as whole ten-thousandths
_SIX, _TEN = Decimal(1).scaleb(-6), Decimal(1).scaleb(-10)


@dataclass(frozen=True)
class Percentile:
    """One requested percentile: ``cont`` interpolates between neighbours, otherwise an existing value is taken."""

    name: str
    column: str
    p: Decimal
    cont: bool = True

    def rank(self, n: int) -> Decimal:
        """Zero-based position among n sorted values; fractional for ``cont``."""
        position = self.p * (n - 1) if self.cont else (self.p * n).to_integral_value(ROUND_CEILING) - 1
        return max(position.quantize(_SIX, ROUND_HALF_UP), Decimal(0))


@dataclass(frozen=True)
class _Target:
    """A value sought by rank, the range [low, high] that holds it, and the number of values below the range."""

    column: str
    rank: int
    low: int
    high: int
    below: int

    def narrowed(self, counts: Mapping[int, int], width: int) -> _Target:
        """The bucket of this width in which the rank lies."""
        below = self.below
        for bucket in sorted(counts):
            if below + counts[bucket] > self.rank:
                low = self.low + bucket * width
                return _Target(self.column, self.rank, low, min(low + width - 1, self.high), below)
            below += counts[bucket]
        raise AssertionError("the counts of a range add up to its values")


_WHOLE = f"cast(cast(`{{}}` as decimal(18,4)) * {_SCALE} as bigint)"


def _whole(column: str) -> Column:
    return F.expr(_WHOLE.format(column))


def exact_percentiles(
    df: DataFrame, wanted: list[Percentile], buckets: int = 4096, more: Mapping[str, Column] | None = None
) -> dict[str, object]:
    """A decimal per request, None where the column has no values, and the aggregates asked for in ``more``.

    The range of each wanted rank is cut into ``buckets`` buckets, whose values are only counted, with partial aggregation;
    the bucket that holds the rank is the next range, until it is a single value. Whatever the size of ``df``, a round moves at
    most ``buckets`` counts per rank and task and ends in as many rows, and the number of rounds is the logarithm of the
    range: three for amounts up to some billion. ``df`` is read once per round and should be cheap to read.
    """
    columns = list(dict.fromkeys(w.column for w in wanted))
    first = [
        F.struct(F.count(c).alias("n"), F.min(_whole(c)).alias("low"), F.max(_whole(c)).alias("high")).alias(f"column {c}")
        for c in columns
    ]
    found = df.agg(*first, *[c.alias(name) for name, c in (more or {}).items()]).first()
    ranks = {w: w.rank(found[f"column {w.column}"].n) for w in wanted if found[f"column {w.column}"].n}
    targets: dict[tuple[str, int], _Target] = {}
    for w, rank in ranks.items():
        whole = found[f"column {w.column}"]
        for place in (int(rank), int(rank.to_integral_value(ROUND_CEILING))):
            targets[w.column, place] = _Target(w.column, place, whole.low, whole.high, 0)
    while any(t.low < t.high for t in targets.values()):
        targets = _round(df, targets, buckets)
    exact: dict[str, object] = {name: found[name] for name in more or {}}
    for w in wanted:
        exact[w.name] = None
        if w in ranks:
            floor = ranks[w].to_integral_value(ROUND_FLOOR)
            below, above = (
                Decimal(targets[w.column, int(ranks[w].to_integral_value(side))].low) / _SCALE for side in (ROUND_FLOOR, ROUND_CEILING)
            )
            exact[w.name] = (below + (ranks[w] - floor) * (above - below)).quantize(_TEN, ROUND_HALF_UP)
    return exact


def _round(df: DataFrame, targets: dict[tuple[str, int], _Target], buckets: int) -> dict[tuple[str, int], _Target]:
    """One pass over df: count the buckets of every open range, and go on with those that hold the ranks."""
    ranges = list(dict.fromkeys((t.column, t.low, t.high) for t in targets.values() if t.low < t.high))
    widths = {r: max(1, -(-(r[2] - r[1] + 1) // buckets)) for r in ranges}
    hits = []
    for number, (column, low, high) in enumerate(ranges):
        bucket = F.expr(f"({_WHOLE.format(column)} - {low}L) div {widths[column, low, high]}L").cast("int")
        hit = F.struct(F.lit(number).alias("range"), bucket.alias("bucket"))
        hits.append(F.when(_whole(column).between(low, high), hit))
    counted = df.select(F.explode(F.array_compact(F.array(*hits))).alias("hit")).groupBy("hit").agg(F.count("*").alias("n"))
    counts: dict[int, dict[int, int]] = {number: {} for number in range(len(ranges))}
    for row in counted.select("hit.range", "hit.bucket", "n").collect():  # at most buckets rows per range
        counts[row.range][row.bucket] = row.n
    out = {}
    for key, t in targets.items():
        place = (t.column, t.low, t.high)
        out[key] = t.narrowed(counts[ranges.index(place)], widths[place]) if t.low < t.high else t
    return out
