"""Alert rules on a stream: state per rule, and ticks that a clock brings when the log is silent.

Rows become sums per step, which Spark emits once the watermark has closed a step. Each rule then keeps the sums of its
look-back window and the number of ticks its condition has held. Ticks are judged as the watermark passes them, by
timers if no rows come with it. The watermark follows the log and a second stream, the clock, so a log that
stops is judged on: ``clock_stream`` makes one from the ``rate`` source, a table of moments does as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tallyframe.functions.numeric import ms_to_seconds
from tallyframe.functions.timing import at_second
from tallyframe.operators.series import TIME_BOUNDS

OUT = "rule string, severity string, tick long, value double, active boolean, firing boolean"
STATE = "judged long, held long, ticks array<long>, sums array<double>"
FRAME_TICKS = 10_000  # ticks judged and returned at a time, or a window if that is more


@dataclass(frozen=True)
class StreamRule:
    """What is summed per row, the value of a look-back window's sums, and when that value is an alert."""

    name: str
    severity: str
    window: int
    hold: int
    sums: Mapping[str, Column]
    value: Callable[[Sequence[float]], float | None]
    active: Callable[[float], bool]


def error_rate_rule(percent: float = 5.0, window: int = 300, hold: int = 120, severity: str = "warning") -> StreamRule:
    sums = {"requests": F.lit(1), "errors": F.col("status_code") >= 400}
    share = lambda s: s[1] * 100.0 / s[0] if s[0] else None
    return StreamRule("high_error_rate", severity, window, hold, sums, share, lambda v: v > percent)


def quantile_of(q: float, bounds: Sequence[float], cumulative: Sequence[float], count: float) -> float | None:
    """Interpolated inside the first bucket that reaches rank ``q * count``."""
    if not count:
        return None
    rank, before, low = q * count, 0.0, 0.0
    for high, here in zip(bounds, cumulative):
        if here >= rank and here > 0:
            return low + (high - low) * ((rank - before) / (here - before) if here > before else 0.0)
        before, low = here, high
    return float(bounds[-1])


def slow_rule(
    seconds: float = 1.0, q: float = 0.95, window: int = 300, hold: int = 120, name: str = "slow_processing", bounds: Sequence[float] = TIME_BOUNDS
) -> StreamRule:
    x = ms_to_seconds("processing_time_ms")
    sums = {"n": x.isNotNull()} | {f"b{i}": x <= F.lit(float(b)) for i, b in enumerate(bounds)}
    value = lambda s: quantile_of(q, bounds, s[1:], s[0])
    return StreamRule(name, "warning", window, hold, sums, value, lambda v: v > seconds)


def low_volume_rule(per_minute: float = 1.0, window: int = 600, hold: int = 300) -> StreamRule:
    return StreamRule("low_volume", "info", window, hold, {"requests": F.lit(1)}, lambda s: s[0] / window * 60, lambda v: v < per_minute)


def high_volume_rule(per_minute: float = 100.0, window: int = 300, hold: int = 60) -> StreamRule:
    return StreamRule("high_volume", "warning", window, hold, {"requests": F.lit(1)}, lambda s: s[0] / window * 60, lambda v: v > per_minute)


def silence_rule(window: int = 600, hold: int = 600) -> StreamRule:
    made = F.col("prediction").isNotNull()
    return StreamRule("no_predictions", "info", window, hold, {"made": made}, lambda s: s[0], lambda v: v == 0)


def growth_rule(size: Column, max_bytes: float = 1048576.0, window: int = 3600, hold: int = 600) -> StreamRule:
    return StreamRule("log_growth", "info", window, hold, {"bytes": size}, lambda s: s[0], lambda v: v > max_bytes)


def no_runs_rule(window: int = 3600, hold: int = 1800) -> StreamRule:
    return StreamRule("no_runs", "warning", window, hold, {"runs": F.lit(1)}, lambda s: s[0], lambda v: v < 1)


class _Judge(StatefulProcessor):
    """One rule's ticks. ``rules`` maps a name to severity, window and hold in steps, value and condition."""

    def __init__(self, rules: dict[str, tuple], step: int):
        self.rules, self.step = rules, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        begun, judged, held, ticks, sums = self.state.exists(), 0, 0, [], []
        first = None
        if begun:
            judged, held, *known = self._held()
            ticks, sums = [known[0]], [known[1]]
        for frame in rows:
            tick = frame["tick"].to_numpy(np.int64)
            real = tick[frame["real"].to_numpy() > 0]
            if len(real):
                first = min(int(real.min()), first) if first is not None else int(real.min())
            ticks.append(tick)
            sums.append(np.array(frame["sums"].tolist(), dtype=float).reshape(len(tick), -1))
        # the first row begins the ticks, not the clock
        if begun or first is not None:
            yield from self._judge(key[0], judged if begun else first - self.step, held, *self._ordered(ticks, sums), timerValues)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            yield from self._judge(key[0], *self._held(), timerValues)

    def close(self) -> None:
        pass

    @staticmethod
    def _ordered(ticks: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Ticks and sums by tick; of one tick's sums the last."""
        tick = np.concatenate(ticks)
        order = np.argsort(tick, kind="stable")
        order = order[np.append(np.diff(tick[order]) != 0, True)]
        return tick[order], np.concatenate(sums)[order]

    def _held(self) -> tuple[int, int, np.ndarray, np.ndarray]:
        judged, held, ticks, flat = self.state.get()
        tick = np.array(ticks, dtype=np.int64)
        order = np.argsort(tick)
        return judged, held, tick[order], np.array(flat, dtype=float).reshape(len(tick), -1)[order]

    def _judge(self, name: str, judged: int, held: int, ticks: np.ndarray, sums: np.ndarray, timers: TimerValues) -> Iterator[pd.DataFrame]:
        """The ticks up to the watermark in frames of bounded size: neither they nor the sums between them are held at once."""
        severity, window, hold, value_of, is_active = self.rules[name]
        step, width = self.step, sums.shape[1]
        last = timers.getCurrentWatermarkInMs() // 1000 // step * step
        columns = [f.split()[0] for f in OUT.split(", ")]
        while judged < last:
            n = min((last - judged) // step, max(FRAME_TICKS, window))
            # sums are whole numbers, so the difference of two running totals is exact
            at = slice(*np.searchsorted(ticks, [judged - (window - 1) * step, judged + n * step + 1]))
            steps = np.zeros((window + n, width))
            steps[(ticks[at] - judged) // step + window - 1] = sums[at]
            running = np.cumsum(steps, axis=0)
            totals = running[window:] - running[:n]
            out = []
            for total in totals.tolist():
                judged += step
                value = value_of(total) if width else None
                active = value is not None and is_active(value)
                held = min(held + 1, hold + 1) if active else 0
                out.append((name, severity, judged, value, active, held > hold))
            yield pd.DataFrame(out, columns=columns).astype({"value": "float64", "active": bool, "firing": bool})
        kept = ticks > judged - window * step
        ticks, sums = ticks[kept], sums[kept]
        if not len(ticks):
            ticks, sums = np.array([judged]), np.zeros((1, width))  # nothing left but the width
        self.state.update((judged, held, ticks.tolist(), sums.ravel().tolist()))
        self.handle.registerTimer((judged + step) * 1000)


def clock_stream(spark: SparkSession) -> DataFrame:
    """``ts``: the wall clock as a stream, once a second."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.col("timestamp").alias("ts"))


def alert_stream(log: DataFrame, rules: Sequence[StreamRule], step: int = 60, clock: DataFrame | None = None, delay: str = "1 minute") -> DataFrame:
    """``rule, severity, tick_ts, value, active, firing``: every tick of every rule once the watermark, ``delay`` behind the newest
    row of ``log`` or ``clock``, has passed it; the same rows as the rules over a stored log give.

    Ticks begin with the first row of the log. Rows later than the delay are dropped. Rows with no ``ts`` take no part. State is
    the steps of a window per rule, however long the stream runs. Without a clock a silent log is not judged.
    """
    for rule in rules:
        if rule.window % step or rule.hold % step:
            raise ValueError("window and hold time must be multiples of the step")
    if len({rule.name for rule in rules}) != len(rules):
        raise ValueError("two rules have one name")
    # steps end with their tick, as those of a stored log do
    own = [c.cast("double").alias(f"{k}_{n}") for k, rule in enumerate(rules) for n, c in rule.sums.items()]
    names = [c for k, rule in enumerate(rules) for c in (f"{k}_{n}" for n in rule.sums)]
    rows = log.select((F.col("ts") - F.expr("INTERVAL 1 MICROSECOND")).alias("at"), F.lit(1).alias("real"), *own)
    if clock is not None:
        rows = rows.unionByName(clock.select(F.col("ts").alias("at"), F.lit(0).alias("real"), *[F.lit(0.0).alias(n) for n in names]))
    cells = rows.withWatermark("at", delay).groupBy(F.window("at", f"{step} seconds"))
    cells = cells.agg(F.sum("real").alias("real"), *[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names])
    parts = [
        F.struct(F.lit(rule.name).alias("rule"), F.array(*[F.col(f"{k}_{n}") for n in rule.sums]).alias("sums")) for k, rule in enumerate(rules)
    ]
    each = cells.select(F.window_time("window").alias("at"), F.unix_timestamp("window.end").alias("tick"), "real", F.explode(F.array(*parts)).alias("p"))
    each = each.select("at", "tick", "real", "p.rule", "p.sums")
    known = {rule.name: (rule.severity, rule.window // step, rule.hold // step, rule.value, rule.active) for rule in rules}
    judged = each.groupBy("rule").transformWithStateInPandas(_Judge(known, step), OUT, "append", "eventTime")
    return judged.select("rule", "severity", at_second(F.col("tick")).alias("tick_ts"), "value", "active", "firing")
