"""Alert rules evaluated on a tick spine.

Every rule yields one row per evaluation tick: ``(rule, severity, tick_ts, value, active,
firing)``. Ticks go on to ``as_of``, so a log that has stopped is judged too. ``active`` is the condition at the tick, ``firing`` that it held for the whole
hold time. Data is reduced to one row per tick first, so windows only see ticks, and only a
bounded stretch of them.

A rule is a value (``Rule``); the functions named after rules judge a stored log with one. With ``start`` only the ticks
after it are judged, from the rows (and, with ``day``, the day partitions) that windows and hold times of these
ticks reach back to. ``operators/rollup.py`` judges a rule from kept step sums in the same way.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.numeric import ms_to_seconds
from tallyframe.functions.timing import at_second, second_of
from tallyframe.operators.series import TIME_BOUNDS, cells, on_spine, sliding, spine_between, tick_ends, tick_spine

# Ticks per window partition when the hold time is checked.
STRETCH = 10_000


def hold(active: str, steps: int, by: Sequence[str] = ("rule",), order: str = "tick") -> Column:
    """Condition true now and at each of the ``steps`` ticks before; false while history is short."""
    recent = Window.partitionBy(*by).orderBy(order).rowsBetween(-steps, 0)
    flag = F.coalesce(F.col(active), F.lit(False)).cast("int")
    return (F.min(flag).over(recent) == 1) & (F.count(F.lit(1)).over(recent) == steps + 1)


def with_firing(
    ticks: DataFrame, active: str, steps: int, step_seconds: int, by: Sequence[str] = ("rule",), stretch: int = STRETCH
) -> DataFrame:
    """Add ``firing`` to evenly spaced ticks of any number.

    The ticks are cut into stretches, each preceded by the ticks its hold time reaches back
    to, so no window sees more than a stretch and its lead-in.
    """
    width = max(stretch, steps + 1) * step_seconds
    own = F.floor(F.col("tick") / width)
    leads_in = F.col("tick") + steps * step_seconds >= (own + 1) * width
    copies = F.explode(F.when(leads_in, F.array(own, own + 1)).otherwise(F.array(own)))
    placed = ticks.withColumn("_own", own).withColumn("_stretch", copies)
    judged_rows = placed.withColumn("firing", hold(active, steps, (*by, "_stretch")))
    return judged_rows.where(F.col("_stretch") == F.col("_own")).drop("_own", "_stretch")


def judged(
    values: DataFrame, rule: str, severity: str, active: Column, hold_seconds: int, step_seconds: int
) -> DataFrame:
    """``(tick, value)`` to alert rows."""
    if hold_seconds % step_seconds:
        raise ValueError("the hold time must be a multiple of the step")
    ticks = values.withColumn("rule", F.lit(rule)).withColumn("active", F.coalesce(active, F.lit(False)))
    return with_firing(ticks, "active", hold_seconds // step_seconds, step_seconds).select(
        "rule",
        F.lit(severity).alias("severity"),
        at_second(F.col("tick")).alias("tick_ts"),
        F.col("value").cast("double").alias("value"),
        "active",
        "firing",
    )


def windowed_counts(
    rows: DataFrame, window_seconds: int, step_seconds: int, sums: dict[str, Column], as_of: dt.datetime | None = None
) -> DataFrame:
    """Sums over the look-back window at every tick, empty ticks included, up to the last row or ``as_of``."""
    part = cells(rows, step_seconds, sums)
    slid = sliding(part, window_seconds, step_seconds, list(sums))
    return on_spine(slid, tick_spine(rows, step_seconds, as_of=as_of), list(sums))


def bucket_quantile(q: float, bounds: Sequence[float], count: str = "n", bucket: str = "b") -> Column:
    """Quantile interpolated inside the first bucket that reaches rank ``q * count``, from columns that hold
    the cumulative counts ``b0, b1, ...``; NULL where nothing was counted."""
    rank = F.col(count) * F.lit(float(q))
    out = None
    for i, high in enumerate(bounds):
        here, low = F.col(f"{bucket}{i}"), F.lit(float(bounds[i - 1]) if i else 0.0)
        before = F.col(f"{bucket}{i - 1}") if i else F.lit(0)
        share = F.coalesce(F.try_divide(rank - before, here - before), F.lit(0.0))
        reached, value = (here >= rank) & (here > 0), low + (F.lit(float(high)) - low) * share
        out = F.when(reached, value) if out is None else out.when(reached, value)
    return out.when(F.col(count) > 0, F.lit(float(bounds[-1])))


@dataclass(frozen=True)
class Rule:
    """``sums`` per row; ``value`` of the sums over ``window`` seconds; the condition on the column ``value``."""

    name: str
    severity: str
    window: int
    hold: int
    step: int
    sums: Mapping[str, Column]
    value: Column
    active: Column


def evaluate(rule: Rule, step_sums: DataFrame, spine: DataFrame) -> DataFrame:
    """Alert rows of the ticks of ``spine`` from sums per step (``tick`` and the rule's columns)."""
    names = list(rule.sums)
    slid = on_spine(sliding(step_sums, rule.window, rule.step, names), spine, names)
    return judged(slid.select("tick", rule.value.alias("value")), rule.name, rule.severity, rule.active, rule.hold, rule.step)


def over_log(
    rule: Rule,
    log: DataFrame,
    as_of: dt.datetime | None = None,
    start: dt.datetime | None = None,
    day: str | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Alert rows of a stored log: all ticks, or those after ``start``.

    ``day`` names a date column the log is partitioned by. The results are those of the whole log: ticks still begin with its first
    row, which is looked for in its first day.
    """
    if start is None:
        return evaluate(rule, cells(log, rule.step, rule.sums, ts=ts), tick_spine(log, rule.step, ts, as_of))
    first, last = tick_ends(log, rule.step, ts, as_of, day)
    after = second_of(start)
    rows = log.where(F.col(ts) > start - dt.timedelta(seconds=rule.window + rule.hold + rule.step))
    if day:
        rows = rows.where(F.col(day) >= (start - dt.timedelta(seconds=rule.window + rule.hold + rule.step)).date())
    return recent(rule, cells(rows, rule.step, rule.sums, ts=ts), first, last, after)


def recent(rule: Rule, step_sums: DataFrame, first: int | None, last: int | None, after: int) -> DataFrame:
    """Alert rows of the ticks after the second ``after`` up to ``last``; ``first`` is the first tick of the whole log."""
    begin = after // rule.step * rule.step + rule.step
    lead = None if first is None else max(first, begin - rule.hold)
    found = evaluate(rule, step_sums, spine_between(step_sums.sparkSession, lead, last, rule.step))
    return found.where(F.col("tick_ts") >= at_second(F.lit(begin)))


def error_rate_rule(percent: float = 5.0, window: int = 300, hold_for: int = 120, step: int = 60, severity: str = "warning") -> Rule:
    sums = {"requests": F.lit(1), "errors": (F.col("status_code") >= 400).cast("int")}
    share = F.try_divide(F.col("errors") * 100.0, F.col("requests"))
    return Rule("high_error_rate", severity, window, hold_for, step, sums, share, F.col("value") > percent)


def high_error_rate(
    log: DataFrame,
    percent: float = 5.0,
    window: int = 300,
    hold_for: int = 120,
    step: int = 60,
    severity: str = "warning",
    **span,
) -> DataFrame:
    return over_log(error_rate_rule(percent, window, hold_for, step, severity), log, **span)


def slow_rule(
    seconds: float = 1.0,
    q: float = 0.95,
    window: int = 300,
    hold_for: int = 120,
    step: int = 60,
    rule: str = "slow_processing",
    severity: str = "warning",
    bounds: Sequence[float] = TIME_BOUNDS,
) -> Rule:
    """Interpolated time quantile above a limit; windows without times have no value and never fire."""
    x = ms_to_seconds("processing_time_ms")
    sums = {f"b{i}": (x <= F.lit(float(b))).cast("int") for i, b in enumerate(bounds)} | {"n": x.isNotNull().cast("int")}
    return Rule(rule, severity, window, hold_for, step, sums, bucket_quantile(q, bounds), F.col("value") > seconds)


def slow_requests(
    log: DataFrame,
    seconds: float = 1.0,
    q: float = 0.95,
    window: int = 300,
    hold_for: int = 120,
    step: int = 60,
    rule: str = "slow_processing",
    severity: str = "warning",
    bounds: Sequence[float] = TIME_BOUNDS,
    **span,
) -> DataFrame:
    return over_log(slow_rule(seconds, q, window, hold_for, step, rule, severity, bounds), log, **span)


def slow_prediction(log: DataFrame, seconds: float = 0.5, hold_for: int = 180, **options) -> DataFrame:
    return slow_requests(log, seconds, hold_for=hold_for, rule="slow_prediction", **options)


def _volume_rule(name: str, severity: str, window: int, hold_for: int, step: int, active: Column) -> Rule:
    per_minute = F.col("requests") / F.lit(float(window)) * 60
    return Rule(name, severity, window, hold_for, step, {"requests": F.lit(1)}, per_minute, active)


def low_volume_rule(per_minute: float = 1.0, window: int = 600, hold_for: int = 300, step: int = 60) -> Rule:
    return _volume_rule("low_volume", "info", window, hold_for, step, F.col("value") < per_minute)


def low_volume(log: DataFrame, per_minute: float = 1.0, window: int = 600, hold_for: int = 300, step: int = 60, **span) -> DataFrame:
    return over_log(low_volume_rule(per_minute, window, hold_for, step), log, **span)


def high_volume_rule(per_minute: float = 100.0, window: int = 300, hold_for: int = 60, step: int = 60) -> Rule:
    return _volume_rule("high_volume", "warning", window, hold_for, step, F.col("value") > per_minute)


def high_volume(log: DataFrame, per_minute: float = 100.0, window: int = 300, hold_for: int = 60, step: int = 60, **span) -> DataFrame:
    return over_log(high_volume_rule(per_minute, window, hold_for, step), log, **span)


def no_predictions_rule(window: int = 600, hold_for: int = 600, step: int = 60) -> Rule:
    made = {"predictions": F.col("prediction").isNotNull().cast("int")}
    return Rule("no_predictions", "info", window, hold_for, step, made, F.col("predictions"), F.col("value") == 0)


def no_predictions(log: DataFrame, window: int = 600, hold_for: int = 600, step: int = 60, **span) -> DataFrame:
    return over_log(no_predictions_rule(window, hold_for, step), log, **span)


def log_growth_rule(size: Column, max_bytes: float = 1048576.0, window: int = 3600, hold_for: int = 600, step: int = 60) -> Rule:
    """Bytes of rows appended in the window above a limit."""
    bytes_ = {"bytes": size.cast("long")}
    return Rule("log_growth", "info", window, hold_for, step, bytes_, F.col("bytes"), F.col("value") > max_bytes)


def log_growth(
    log: DataFrame, size: Column, max_bytes: float = 1048576.0, window: int = 3600, hold_for: int = 600, step: int = 60, **span
) -> DataFrame:
    return over_log(log_growth_rule(size, max_bytes, window, hold_for, step), log, **span)


def no_runs_rule(window: int = 3600, hold_for: int = 1800, step: int = 60) -> Rule:
    return Rule("no_runs", "warning", window, hold_for, step, {"runs": F.lit(1)}, F.col("runs"), F.col("value") < 1)


def no_runs(runs: DataFrame, window: int = 3600, hold_for: int = 1800, step: int = 60, **span) -> DataFrame:
    return over_log(no_runs_rule(window, hold_for, step), runs, **span)
