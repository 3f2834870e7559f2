"""Exact quantiles with bounded state and a number of reads that depends on neither width nor skew.

The built-in exact ``percentile`` keeps a count per distinct value in one task. Here the wanted order statistics of all
columns are narrowed together, digit by digit: the first read counts values per sign and power of two, each later
one splits every interval that still holds a wanted rank into ``accuracy`` equal parts. Intervals of at most ``bracket_rows``
values are counted value by value in the same read. Every read is one plain aggregate with map-side
combine that gives count, least and greatest value per part, so intervals shrink to values that
occur, and a hot value ends its interval at once.

A power of two has 2^52 doubles and a read divides by ``accuracy``, so six reads are the most at the default,
four are usual; the built-in functions have no access to the bits of a double, hence parts of equal width.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BRACKET_ROWS = 20_000
ACCURACY = 2_048
# Rows a read brings to the driver at most, whatever the width: intervals share them.
ROWS_AT_ONCE = 500_000
# Below the first power of two a double can have, above the last one; infinities are beyond all.
LOWEST_POWER, INFINITE = 1_100, 5_000


@dataclass(frozen=True)
class _Interval:
    """A part of a column's values, from the least to the greatest one in it, that holds wanted ranks."""

    column: int
    low: float
    high: float
    below: int  # values of the column under ``low``
    inside: int


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    bracket_rows: int = BRACKET_ROWS,
    accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, ``None`` for a column without values.

    NaN is missing, like NULL. Infinities are values: a quantile whose lower neighbour is minus
    infinity, or whose upper neighbour is plus infinity, is that infinity. The table must not change between reads.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    numbers = [F.col(c).cast("double") for c in columns]
    values = df.select(*[F.when(~F.isnan(x), x).alias(f"v{i}") for i, x in enumerate(numbers)])

    # rank -> value per column; places of the quantiles between ranks
    known: list[dict[int, float]] = [{} for _ in columns]
    whole = [_Interval(i, -math.inf, math.inf, 0, 0) for i in range(len(columns))]
    parts = _counted(values, whole, [_power(f"v{i}") for i in range(len(columns))])
    sizes = [int(part["n"].sum()) for part in parts]
    wanted = [[p * (n - 1) for p in probabilities] if n else [] for n in sizes]
    ranks = [sorted({int(k) for pos in at for k in (math.floor(pos), math.ceil(pos))}) for at in wanted]
    open_ = [part for own, table in zip(whole, parts) for part in _holding(own, table, ranks[own.column], known[own.column])]

    while open_:
        share = ROWS_AT_ONCE // len(open_)
        keys = [_digit(i, min(bracket_rows, share), max(min(accuracy, share), 2)) for i in open_]
        parts = _counted(values, open_, keys)
        open_ = [part for own, table in zip(open_, parts) for part in _holding(own, table, ranks[own.column], known[own.column])]
    return {
        c: [_between(known[i], pos) for pos in wanted[i]] if sizes[i] else [None] * len(probabilities)
        for i, c in enumerate(columns)
    }


def _power(name: str) -> Column:
    """Sign and power of two of a value as one number that never falls as the value grows."""
    size = F.abs(F.col(name))
    power = F.when(size == F.lit(math.inf), F.lit(float(INFINITE))).when(size > 0, F.floor(F.log2(size)).cast("double") + F.lit(float(LOWEST_POWER)))
    return F.signum(F.col(name)) * F.coalesce(power, F.lit(0.0))


def _digit(own: _Interval, few: int, accuracy: int) -> Column:
    """The value itself where few are left, else the part of the interval it falls in."""
    value = F.col(f"v{own.column}")
    if own.inside <= few:
        return value
    return F.floor((value - F.lit(own.low)) / F.lit(own.high - own.low) * F.lit(float(accuracy))).cast("double")


def _counted(values: DataFrame, intervals: list[_Interval], keys: list[Column]) -> list[dict[str, np.ndarray]]:
    """One read: per interval its parts in order, with count, least and greatest value."""
    cells = []
    for t, (own, key) in enumerate(zip(intervals, keys)):
        value = F.col(f"v{own.column}")
        cell = F.struct(F.lit(t).alias("t"), key.alias("part"), value.alias("v"))
        cells.append(F.when((value >= F.lit(own.low)) & (value <= F.lit(own.high)), cell))
    table = (
        values.select(F.inline(F.array_compact(F.array(*cells))))
        .groupBy("t", "part")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .select("t", "n", "low", "high")
        .toArrow()
    )
    t, n, low, high = (table.column(c).to_numpy() for c in ("t", "n", "low", "high"))
    order = np.lexsort((low, t))
    ends = np.searchsorted(t[order], np.arange(len(intervals) + 1))
    return [{"n": n[o], "low": low[o], "high": high[o]} for a, b in zip(ends, ends[1:]) for o in [order[a:b]]]


def _holding(own: _Interval, parts: dict[str, np.ndarray], ranks: list[int], known: dict[int, float]) -> list[_Interval]:
    """Parts that hold ranks still unknown; ranks in parts of a single value become known."""
    ends = own.below + np.cumsum(parts["n"])
    found: dict[int, _Interval] = {}
    for k in ranks:
        if k in known or not len(ends) or not own.below <= k < ends[-1]:
            continue
        at = int(np.searchsorted(ends, k, side="right"))
        n, low, high = int(parts["n"][at]), float(parts["low"][at]), float(parts["high"][at])
        if low == high:
            known[k] = low
        elif k == ends[at] - n:
            known[k] = low
        elif k == ends[at] - 1:
            known[k] = high
        else:
            found[at] = _Interval(own.column, low, high, int(ends[at]) - n, n)
    return list(found.values())


def _between(known: dict[int, float], pos: float) -> float:
    low, high = known[math.floor(pos)], known[math.ceil(pos)]
    if math.isinf(low) or math.isinf(high):
        return low if low == -math.inf else high
    return low + (high - low) * (pos - math.floor(pos))
