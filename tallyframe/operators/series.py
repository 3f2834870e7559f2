"""Metric series from the request log: counters, histograms, gauges, quantiles, rates.

Sliding windows are built from step-sized cells: rows are first reduced to one row per
cell and label, and only these small partials are spread over the windows they belong to.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.functions.numeric import ms_to_seconds
from tallyframe.functions.payload import bound_label, error_class
from tallyframe.functions.timing import at_second, moment, second_of, since, tick_after
from tallyframe.operators.ordering import number_rows
from tallyframe.operators.requestlog import AsOf, prediction_value

# Histogram bounds, seconds and dollars.
TIME_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
VALUE_BOUNDS = (50000, 100000, 200000, 300000, 400000, 500000, 750000, 1000000, 1500000, 2000000)


# --- metric rows ---------------------------------------------------------------------------


def metrics_from_requests(log: DataFrame) -> DataFrame:
    """Every request as its metric rows ``(ts, metric_name, metric_value)``; no shuffle."""

    def metric(name: str, value: Column, when: Column | None = None) -> Column:
        row = F.struct(F.lit(name).alias("metric_name"), value.cast("double").alias("metric_value"))
        return row if when is None else F.when(when, row)

    value = prediction_value(log)
    rows = F.array(
        metric("request_response_time", F.col("processing_time_ms"), F.col("processing_time_ms").isNotNull()),
        metric("request_count", F.lit(1)),
        metric("error_count", F.lit(1), F.col("status_code") >= 400),
        metric("prediction_count", F.lit(1), value.isNotNull()),
        metric("prediction_value", value, value.isNotNull()),
    )
    return log.select("ts", F.inline(F.array_compact(rows)))


def metric_stats(
    metrics: DataFrame, name: str, hours: float = 24, as_of: AsOf = None, day: str | None = None
) -> DataFrame:
    """count, avg, min, max, sum of one metric in the window; zeros when there is none."""
    rows = since(metrics, hours, as_of, day=day).where(F.col("metric_name") == name)
    v = "metric_value"
    zero = F.lit(0.0)
    return rows.agg(
        F.count(v).alias("count"),
        *[F.coalesce(f(v), zero).alias(n) for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max), ("sum", F.sum))],
    )


# --- counters and breakdowns ---------------------------------------------------------------


def counter(log: DataFrame, labels: Sequence[str], out: str = "value") -> DataFrame:
    return log.groupBy(*labels).agg(F.count(F.lit(1)).alias(out))


def request_counter(log: DataFrame) -> DataFrame:
    return counter(log, ["endpoint", "method", "status_code"])


def error_counter(log: DataFrame) -> DataFrame:
    failed = log.where(F.col("status_code") >= 400).withColumn("error_type", error_class("status_code"))
    return counter(failed, ["endpoint", "error_type"])


def value_by_region(log: DataFrame, region: str = "location_type") -> DataFrame:
    return counter(log.where(F.col("prediction").isNotNull()), [region], "prediction_count")


def status_breakdown(log: DataFrame) -> DataFrame:
    total = log.agg(F.count(F.lit(1))).scalar()
    return counter(log, ["status_code"], "requests").withColumn("share", F.col("requests") / total)


# --- histograms ----------------------------------------------------------------------------


def histogram(log: DataFrame, value: Column, bounds: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Cumulative buckets ``(labels, le, bound, cum_count, sum, count)``; a bound counts values
    equal to it, the last bucket is ``+Inf`` with a NULL bound. One wide aggregate, then rows."""
    work = log.withColumn("_x", value.cast("double")).where(F.col("_x").isNotNull())
    wide = work.groupBy(*labels).agg(
        *[F.count_if(F.col("_x") <= F.lit(float(b))).alias(f"b{i}") for i, b in enumerate(bounds)],
        F.count("_x").alias("count"),
        F.sum("_x").alias("sum"),
    )
    cells = [
        F.struct(F.lit(bound_label(b)).alias("le"), F.lit(float(b)).alias("bound"), F.col(f"b{i}").alias("cum_count"))
        for i, b in enumerate(bounds)
    ]
    cells.append(
        F.struct(F.lit("+Inf").alias("le"), F.lit(None).cast("double").alias("bound"), F.col("count").alias("cum_count"))
    )
    return wide.select(*labels, F.inline(F.array(*cells)), "sum", "count")


def time_histogram(log: DataFrame, labels: Sequence[str] = ("endpoint",), bounds: Sequence[float] = TIME_BOUNDS):
    return histogram(log, ms_to_seconds("processing_time_ms"), bounds, labels)


def value_histogram(log: DataFrame, labels: Sequence[str] = ("location_type",), bounds: Sequence[float] = VALUE_BOUNDS):
    return histogram(log, prediction_value(log), bounds, labels)


def bucket_index(value: Column, bounds: Sequence[float]) -> Column:
    """Index of the first bound at or above the value; ``len(bounds)`` beyond the last."""
    out = F.when(value.isNull(), F.lit(None).cast("int"))
    for i, b in enumerate(bounds):
        out = out.when(value <= F.lit(float(b)), F.lit(i))
    return out.otherwise(F.lit(len(bounds)))


def running_buckets(log: DataFrame, value: Column, bounds: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """The same cumulative counts from plain bucket counts and a running sum. Windows see at
    most ``len(bounds) + 1`` rows per label set."""
    counted = (
        log.withColumn("_b", bucket_index(value.cast("double"), bounds))
        .where(F.col("_b").isNotNull())
        .groupBy(*labels)
        .agg(*[F.count_if(F.col("_b") == i).alias(f"n{i}") for i in range(len(bounds) + 1)])
    )
    names = [bound_label(b) for b in bounds] + ["+Inf"]
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("bucket"), F.lit(n).alias("le"), F.col(f"n{i}").alias("bucket_count"))
            for i, n in enumerate(names)
        ]
    )
    upto = Window.partitionBy(*labels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(*labels, F.inline(cells)).withColumn("cum_count", F.sum("bucket_count").over(upto))


def histogram_quantile(hist: DataFrame, q: float, labels: Sequence[str], out: str = "quantile") -> DataFrame:
    """Quantile interpolated inside the first bucket that reaches rank ``q * count``.

    The first bucket starts at 0; a rank in ``+Inf`` gives the highest finite bound.
    """
    by_label = Window.partitionBy(*labels) if labels else Window.partitionBy(F.lit(1))
    in_order = by_label.orderBy(F.col("bound").asc_nulls_last())
    work = (
        hist.withColumn("_low", F.coalesce(F.lag("bound").over(in_order), F.lit(0.0)))
        .withColumn("_prev", F.coalesce(F.lag("cum_count").over(in_order), F.lit(0)))
        .withColumn("_rank", F.lit(float(q)) * F.max("cum_count").over(by_label))
        .where((F.col("cum_count") >= F.col("_rank")) & (F.col("cum_count") > 0))
    )
    first = F.row_number().over(in_order)
    step = F.try_divide(F.col("_rank") - F.col("_prev"), F.col("cum_count") - F.col("_prev"))
    inside = F.col("_low") + (F.col("bound") - F.col("_low")) * F.coalesce(step, F.lit(0.0))
    return (
        work.withColumn("_no", first)
        .where("_no = 1")
        .select(*labels, F.when(F.col("bound").isNull(), F.col("_low")).otherwise(inside).alias(out))
    )


# --- gauges and info -----------------------------------------------------------------------


def gauges(log: DataFrame, as_of: AsOf = None, day: str | None = None) -> DataFrame:
    """Current values as ``(metric, value)`` from one scan of the last 24 hours."""
    end = moment(as_of, log, day=day)
    rows = since(log, 24, as_of, day=day)
    value = prediction_value(rows)
    one = rows.agg(
        F.count_if(F.col("ts") > end - F.expr("INTERVAL 1 HOUR")).cast("double").alias("predictions_last_hour"),
        F.count(F.lit(1)).cast("double").alias("predictions_last_24h"),
        F.avg(value).alias("average_prediction_value_dollars"),
        ms_to_seconds(F.avg("processing_time_ms")).alias("average_processing_time_seconds"),
        F.try_divide(F.count_if(F.col("status_code") != 200) * 100.0, F.count(F.lit(1))).alias("error_rate_percentage"),
    )
    return one.select(
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in one.columns]))
    )


def info_series(metric: str, described: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Metadata rows as an info metric: labels as a map, value 1."""
    pairs = [x for c in labels for x in (F.lit(c), F.col(c).cast("string"))]
    return described.select(F.lit(metric).alias("metric"), F.create_map(*pairs).alias("labels"), F.lit(1.0).alias("value"))


def registry_counts(runs: DataFrame) -> DataFrame:
    return runs.agg(F.countDistinct("experiment_id").alias("experiments"), F.count(F.lit(1)).alias("runs"))


# --- batches and key/value rows --------------------------------------------------------------


def assign_batches(
    log: DataFrame, size: int = 10, keys: Sequence[str] = ("endpoint",), order: Sequence[str] = ("ts", "id"), **options
) -> DataFrame:
    """Consecutive groups of ``size`` per key; the incomplete rest has no batch yet (NULL)."""
    numbered = number_rows(log, keys, order, "_no", "_size", **options)
    batch = F.floor((F.col("_no") - 1) / size).cast("long")
    complete = (batch + 1) * size <= F.col("_size")
    return numbered.select(*log.columns, F.when(complete, batch).alias("batch_id"))


def batch_stats(batched: DataFrame, keys: Sequence[str] = ("endpoint", "batch_id")) -> DataFrame:
    return batched.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("batch_size"),
        F.avg("prediction").alias("avg_prediction"),
        F.min("prediction").alias("min_prediction"),
        F.max("prediction").alias("max_prediction"),
        F.stddev_pop("prediction").alias("prediction_std"),
        F.avg("processing_time_ms").alias("avg_processing_time_ms"),
        F.max("processing_time_ms").alias("max_processing_time_ms"),
        F.min("processing_time_ms").alias("min_processing_time_ms"),
    )


def melt_predictions(
    scored: DataFrame,
    key: str,
    numeric: Sequence[str],
    other: Sequence[str],
    prediction: str | None = None,
    time_ms: str | None = None,
) -> DataFrame:
    """One prediction as rows ``(key, kind, name, value)``: numbers are metrics, the rest params."""

    def row(kind: str, name: str, c: str) -> Column:
        cell = F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.col(c).cast("string").alias("value"))
        return F.when(F.col(c).isNotNull(), cell)

    rows = [row("metric", f"input_{c}", c) for c in numeric] + [row("param", f"input_{c}", c) for c in other]
    if prediction:
        rows.append(row("metric", "prediction_value", prediction))
    if time_ms:
        rows.append(row("metric", "processing_time_ms", time_ms))
    return scored.select(key, F.inline(F.array_compact(F.array(*rows))))


# --- sliding windows -------------------------------------------------------------------------


def cells(
    rows: DataFrame, step_seconds: int, sums: Mapping[str, Column], labels: Sequence[str] = (), ts: str = "ts"
) -> DataFrame:
    """Partial sums per step-sized cell ``(tick - step, tick]``; ``tick`` in epoch seconds."""
    keyed = rows.withColumn("tick", tick_after(ts, step_seconds))
    return keyed.groupBy("tick", *labels).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def sliding(cell_rows: DataFrame, window_seconds: int, step_seconds: int, sums: Sequence[str], labels: Sequence[str] = ()):
    """Sums over the last ``window_seconds`` at every tick a cell reaches."""
    if window_seconds % step_seconds:
        raise ValueError("the window must be a multiple of the step")
    reach = F.sequence(F.col("tick"), F.col("tick") + F.lit(window_seconds - step_seconds), F.lit(step_seconds))
    spread = cell_rows.withColumn("tick", F.explode(reach))
    return spread.groupBy("tick", *labels).agg(*[F.sum(s).alias(s) for s in sums])


def tick_ends(
    rows: DataFrame, step_seconds: int, ts: str = "ts", as_of: dt.datetime | None = None, day: str | None = None
) -> tuple[int | None, int | None]:
    """First and last evaluation tick: of the first row, and of the last one or ``as_of``. With a ``day`` column the ends are
    looked for in the first and the last day only."""
    if day is None:
        first, last = rows.agg(tick_after(F.min(ts), step_seconds), tick_after(F.max(ts), step_seconds)).first()
    else:
        low, high = rows.agg(F.min(day), F.max(day)).first()
        first = rows.where(F.col(day) == F.lit(low)).agg(tick_after(F.min(ts), step_seconds)).first()[0]
        last = rows.where(F.col(day) == F.lit(high)).agg(tick_after(F.max(ts), step_seconds)).first()[0]
    if as_of is not None:
        last = second_of(as_of) // step_seconds * step_seconds
    return first, last


def spine_between(spark: SparkSession, first: int | None, last: int | None, step_seconds: int) -> DataFrame:
    """Every tick from ``first`` to ``last``, made by many tasks; none if there is no first one."""
    if first is None:
        first, last = 0, -1
    return spark.range(first, max(first, last + 1), step_seconds).select(F.col("id").alias("tick"))


def tick_spine(rows: DataFrame, step_seconds: int, ts: str = "ts", as_of: dt.datetime | None = None) -> DataFrame:
    """Every evaluation tick from the first row to the last one, or to ``as_of``, with or without events."""
    return spine_between(rows.sparkSession, *tick_ends(rows, step_seconds, ts, as_of), step_seconds)


def on_spine(windowed: DataFrame, spine: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Window values at every tick of the spine, 0 where nothing happened."""
    filled = spine.join(windowed, "tick", "left")
    return filled.select("tick", *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in sums])


def rate_windows(log: DataFrame, window_seconds: int = 300, step_seconds: int = 60) -> DataFrame:
    part = cells(log, step_seconds, {"requests": F.lit(1)})
    slid = sliding(part, window_seconds, step_seconds, ["requests"])
    per_second = F.col("requests") / F.lit(float(window_seconds))
    return slid.select(
        at_second(F.col("tick")).alias("tick_ts"),
        "requests",
        per_second.alias("per_second"),
        (per_second * 60).alias("per_minute"),
    )


def avg_over_time(log: DataFrame, window_seconds: int = 300, step_seconds: int = 60) -> DataFrame:
    rows = log.where(F.col("prediction").isNotNull())
    part = cells(rows, step_seconds, {"total": prediction_value(rows), "n": F.lit(1)})
    slid = sliding(part, window_seconds, step_seconds, ["total", "n"])
    return slid.select(
        at_second(F.col("tick")).alias("tick_ts"), "n", F.try_divide(F.col("total"), F.col("n")).alias("avg_value")
    )


def time_heatmap(log: DataFrame, window_seconds: int = 300, bounds: Sequence[float] = TIME_BOUNDS) -> DataFrame:
    """Rows per tumbling window and (non-cumulative) time bucket."""
    seconds = ms_to_seconds("processing_time_ms")
    names = F.array(*[F.lit(bound_label(b)) for b in bounds], F.lit("+Inf"))
    keyed = log.where(F.col("processing_time_ms").isNotNull()).select(
        at_second(tick_after("ts", window_seconds)).alias("tick_ts"),
        F.get(names, bucket_index(seconds, bounds)).alias("le"),
    )
    return keyed.groupBy("tick_ts", "le").agg(F.count(F.lit(1)).alias("requests"))


def rate_by_horizon(log: DataFrame, horizons: Sequence[int] = (1, 6, 24, 168), as_of: AsOf = None, day: str | None = None) -> DataFrame:
    """Predictions per hour over several look-back horizons, in one scan of the longest."""
    end = moment(as_of, log, day=day)
    made = since(log, max(horizons), as_of, day=day).where(F.col("prediction").isNotNull())
    one = made.agg(
        *[F.count_if(F.col("ts") > end - F.make_dt_interval(hours=F.lit(int(h)))).alias(f"h{h}") for h in horizons]
    )
    rows = [
        F.struct(
            F.lit(h).alias("horizon_hours"),
            F.col(f"h{h}").alias("predictions"),
            (F.col(f"h{h}") / F.lit(float(h))).alias("per_hour"),
        )
        for h in horizons
    ]
    return one.select(F.inline(F.array(*rows)))


def prediction_deviation(
    log: DataFrame,
    recent_hours: int = 24,
    baseline_hours: int = 168,
    threshold: float = 20.0,
    as_of: AsOf = None,
    day: str | None = None,
) -> DataFrame:
    """Shift of the mean prediction against the period before it, in percent."""
    end = moment(as_of, log, day=day)
    rows = since(log, recent_hours + baseline_hours, as_of, day=day)
    value = prediction_value(rows)
    is_recent = F.col("ts") > end - F.make_dt_interval(hours=F.lit(recent_hours))
    one = rows.agg(
        F.avg(F.when(is_recent, value)).alias("recent_mean"), F.avg(F.when(~is_recent, value)).alias("baseline_mean")
    )
    shift = F.try_divide(F.col("recent_mean") - F.col("baseline_mean"), F.col("baseline_mean")) * 100
    return one.withColumn("deviation_percent", shift).withColumn(
        "alert", F.coalesce(F.abs(F.col("deviation_percent")) > threshold, F.lit(False))
    )
