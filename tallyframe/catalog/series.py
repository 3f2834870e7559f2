"""Metric series and alert queries."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyframe.catalog.log import DAY
from tallyframe.catalog.registry import ORACLES, over, query, r, tidy
from tallyframe.functions.payload import bound_label
from tallyframe.operators import alerts, rollup, series
from tallyframe.functions.numeric import ms_to_seconds
from tallyframe.session import new_folder
from tallyframe.sources import views


def _log(spark, folder):
    return views.requests(spark, folder)


@query("counter_requests", over("requests", "SELECT endpoint, method, status_code, count(*) AS value FROM requests GROUP BY ALL"))
def _(spark, folder):
    return series.request_counter(_log(spark, folder))


@query("counter_errors", over("requests", """SELECT endpoint, CASE WHEN status_code >= 500 THEN 'server_error' ELSE 'client_error' END AS error_type,
  count(*) AS value FROM requests WHERE status_code >= 400 GROUP BY ALL"""))
def _(spark, folder):
    return series.error_counter(_log(spark, folder))


def _hist_sql(label: str, x: str, bounds, cum: bool = True) -> str:
    rows = [f"SELECT {label}, '{bound_label(b)}' AS le, {float(b)!r}e0 AS bound, count(*) FILTER (WHERE {x} <= {float(b)!r}e0) AS cum_count, sum({x}) AS s, count({x}) AS count FROM requests WHERE {x} IS NOT NULL GROUP BY 1"
            for b in bounds]
    rows.append(f"SELECT {label}, '+Inf', NULL, count({x}), sum({x}), count({x}) FROM requests WHERE {x} IS NOT NULL GROUP BY 1")
    return "+ h AS (" + "\nUNION ALL ".join(rows) + ")"


TIME, VALUE = "(processing_time_ms / 1000)", "prediction"


@query("hist_time", over("requests", _hist_sql("endpoint", TIME, series.TIME_BOUNDS) + f"\nSELECT endpoint, le, bound, cum_count, {r('s')} AS sum, count FROM h"))
def _(spark, folder):
    return tidy(series.time_histogram(_log(spark, folder)))


@query("hist_value", over("requests", _hist_sql("location_type", VALUE, series.VALUE_BOUNDS) + f"\nSELECT location_type, le, bound, cum_count, {r('s', 2)} AS sum, count FROM h"))
def _(spark, folder):
    return tidy(series.value_histogram(_log(spark, folder)), 6, {"sum": 2})


@query("win_hist_cumulative", over("requests", _hist_sql("endpoint", TIME, series.TIME_BOUNDS) + """
SELECT endpoint, le, cum_count, CAST(cum_count - coalesce(lag(cum_count) OVER (PARTITION BY endpoint ORDER BY bound NULLS LAST), 0) AS BIGINT) AS bucket_count FROM h"""))
def _(spark, folder):
    out = series.running_buckets(_log(spark, folder), ms_to_seconds("processing_time_ms"), series.TIME_BOUNDS, ["endpoint"])
    return out.drop("bucket")


QUANTILE_SQL = """, o AS (SELECT *, coalesce(lag(bound) OVER w, 0) AS low, coalesce(lag(cum_count) OVER w, 0) AS prev,
    {q} * max(cum_count) OVER (PARTITION BY {l}) AS rank FROM h WINDOW w AS (PARTITION BY {l} ORDER BY bound NULLS LAST)),
  f AS (SELECT *, row_number() OVER (PARTITION BY {l} ORDER BY bound NULLS LAST) AS no FROM o WHERE cum_count >= rank AND cum_count > 0)"""
INSIDE = "CASE WHEN bound IS NULL THEN low ELSE low + (bound - low) * coalesce((rank - prev) / nullif(cum_count - prev, 0), 0) END"


@query("hist_quantile", over("requests", _hist_sql("endpoint", TIME, series.TIME_BOUNDS) + QUANTILE_SQL.format(q="0.95e0", l="endpoint")
       + f", m AS (SELECT endpoint, {INSIDE} AS v FROM f WHERE no = 1)" + QUANTILE_SQL.format(q="0.5e0", l="endpoint").replace("o AS", "o2 AS").replace("f AS", "f2 AS").replace("FROM o WHERE", "FROM o2 WHERE")
       + f"\nSELECT endpoint, {r('v')} AS p95, {r(INSIDE)} AS p50 FROM m JOIN f2 USING (endpoint) WHERE f2.no = 1"))
def _(spark, folder):
    hist = series.time_histogram(_log(spark, folder))
    p95 = series.histogram_quantile(hist, 0.95, ["endpoint"], "p95")
    p50 = series.histogram_quantile(hist, 0.5, ["endpoint"], "p50")
    return tidy(p95.join(p50, "endpoint"))


@query("gauges", over("requests", f"""+ w AS (SELECT * FROM requests WHERE {DAY}),
  g AS (SELECT 'predictions_last_hour' AS metric, CAST(count(*) FILTER (WHERE ts > (SELECT as_of FROM clock) - INTERVAL 1 HOUR) AS DOUBLE) AS v FROM w
  UNION ALL SELECT 'predictions_last_24h', CAST(count(*) AS DOUBLE) FROM w UNION ALL SELECT 'average_prediction_value_dollars', avg(prediction) FROM w
  UNION ALL SELECT 'average_processing_time_seconds', avg(processing_time_ms) / 1000 FROM w
  UNION ALL SELECT 'error_rate_percentage', count(*) FILTER (WHERE status_code <> 200) * 100e0 / count(*) FROM w)
SELECT metric, {r('v', 5)} AS value FROM g"""))
def _(spark, folder):
    return tidy(series.gauges(_log(spark, folder)), 5)


@query("info_series", over("versions", """+ l AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY CAST(version AS BIGINT) DESC) AS no FROM versions)
SELECT 'model_info' AS metric, name, version, stage, 1e0 AS value FROM l WHERE no = 1"""))
def _(spark, folder):
    newest = views.model_versions(spark, folder).groupBy("name").agg(
        F.max_by(F.struct("version", "stage"), F.col("version").cast("long")).alias("v")
    )
    info = series.info_series("model_info", newest.select("name", "v.*"), ["name", "version", "stage"])
    return info.select("metric", *[F.col("labels")[k].alias(k) for k in ("name", "version", "stage")], "value")


@query("registry_counts", over("runs", "SELECT count(DISTINCT experiment_id) AS experiments, count(*) AS runs FROM runs"))
def _(spark, folder):
    return series.registry_counts(views.runs(spark, folder))


BATCH_SQL = """+ made AS (SELECT * FROM requests WHERE prediction IS NOT NULL),
  n AS (SELECT id, endpoint, prediction, processing_time_ms, row_number() OVER (PARTITION BY endpoint ORDER BY ts, id) AS no, count(*) OVER (PARTITION BY endpoint) AS total FROM made),
  b AS (SELECT *, CASE WHEN ((no - 1) // 10 + 1) * 10 <= total THEN (no - 1) // 10 END AS batch_id FROM n)"""


def _batched(spark, folder, **options):
    return series.assign_batches(_log(spark, folder).where(F.col("prediction").isNotNull()), 10, **options)


@query("batch_assign", over("requests", BATCH_SQL + "\nSELECT id, endpoint, batch_id FROM b"))
def _(spark, folder):
    return _batched(spark, folder).select("id", "endpoint", "batch_id")


@query("batch_assign_ranged", over("requests", BATCH_SQL + "\nSELECT id, endpoint, batch_id FROM b"))
def _(spark, folder):
    """The same by the path for keys that hold a large part of the rows."""
    return _batched(spark, folder, window_rows=0).select("id", "endpoint", "batch_id")


@query("batch_stats", over("requests", BATCH_SQL + f"""
SELECT endpoint, batch_id, count(*) AS batch_size, {r('avg(prediction)', 4)} AS avg_prediction, {r('min(prediction)', 4)} AS min_prediction,
  {r('max(prediction)', 4)} AS max_prediction, {r('stddev_pop(prediction)', 4)} AS prediction_std, {r('avg(processing_time_ms)', 4)} AS avg_processing_time_ms,
  {r('max(processing_time_ms)', 4)} AS max_processing_time_ms, {r('min(processing_time_ms)', 4)} AS min_processing_time_ms FROM b WHERE batch_id IS NOT NULL GROUP BY 1, 2"""))
def _(spark, folder):
    return tidy(series.batch_stats(_batched(spark, folder).where("batch_id is not null")), 4)


_MELT = [("metric", c) for c in ("longitude", "latitude", "housing_median_age", "median_income")] + [("param", "ocean_proximity")]
_MELT_ROWS = [
    f"SELECT block_id, 'metric' AS kind, 'input_{c}' AS name, {r(c)} AS value, NULL::VARCHAR AS text FROM blocks WHERE {c} IS NOT NULL"
    for k, c in _MELT if k == "metric"
] + ["SELECT block_id, 'param', 'input_ocean_proximity', NULL, ocean_proximity FROM blocks WHERE ocean_proximity IS NOT NULL"]


@query("melt_prediction", over("blocks", "\nUNION ALL ".join(_MELT_ROWS)))
def _(spark, folder):
    """Values come back as numbers for metrics and as text for params."""
    numeric, other = [c for k, c in _MELT if k == "metric"], [c for k, c in _MELT if k == "param"]
    rows = series.melt_predictions(views.blocks(spark, folder), "block_id", numeric, other)
    is_metric = F.col("kind") == "metric"
    return tidy(
        rows.select(
            "block_id",
            "kind",
            "name",
            F.when(is_metric, F.col("value").try_cast("double")).alias("value"),
            F.when(~is_metric, F.col("value")).alias("text"),
        )
    )


@query("value_by_region", over("requests", "SELECT location_type, count(*) AS prediction_count FROM requests WHERE prediction IS NOT NULL GROUP BY 1"))
def _(spark, folder):
    return series.value_by_region(_log(spark, folder))


@query("status_breakdown", over("requests", f"SELECT status_code, count(*) AS requests, {r('count(*) / (SELECT count(*) FROM requests)')} AS share FROM requests GROUP BY 1"))
def _(spark, folder):
    return tidy(series.status_breakdown(_log(spark, folder)))


# Ticks in epoch seconds: the first multiple of the step at or after the row.
def _ticks(window: int, step: int, where: str = "true", view: str = "requests") -> str:
    s = step * 1_000_000
    return f"""ticked AS (SELECT *, ((epoch_us(ts) + {s} - 1) // {s}) * {step} AS first_tick FROM {view} WHERE {where}),
  spread AS (SELECT *, unnest(range(first_tick, first_tick + {window}, {step})) AS tick FROM ticked)"""


AT = "make_timestamp(CAST(tick AS BIGINT) * 1000000)"


@query("rate_windows", over("requests", "+ " + _ticks(3600, 300) + f"""
SELECT {AT} AS tick_ts, count(*) AS requests, {r('count(*) / 3600e0', 9)} AS per_second, {r('count(*) / 3600e0 * 60', 9)} AS per_minute FROM spread GROUP BY tick"""))
def _(spark, folder):
    return tidy(series.rate_windows(_log(spark, folder), 3600, 300), 9)


@query("avg_over_time", over("requests", "+ " + _ticks(3600, 300, "prediction IS NOT NULL") + f"""
SELECT {AT} AS tick_ts, count(*) AS n, {r('avg(prediction)', 4)} AS avg_value FROM spread GROUP BY tick"""))
def _(spark, folder):
    return tidy(series.avg_over_time(_log(spark, folder), 3600, 300), 4)


_LE = "CASE " + " ".join(f"WHEN {TIME} <= {float(b)!r}e0 THEN '{bound_label(b)}'" for b in series.TIME_BOUNDS) + " ELSE '+Inf' END"


@query("time_heatmap", over("requests", "+ " + _ticks(3600, 3600) + f"\nSELECT {AT} AS tick_ts, {_LE} AS le, count(*) AS requests FROM spread GROUP BY tick, 2"))
def _(spark, folder):
    return series.time_heatmap(_log(spark, folder), 3600)


@query("rate_by_horizon", over("requests", "\nUNION ALL ".join(
    f"SELECT {h} AS horizon_hours, count(*) AS predictions, {r(f'count(*) / {h}e0')} AS per_hour FROM requests WHERE prediction IS NOT NULL AND ts > (SELECT as_of FROM clock) - INTERVAL {h} HOUR"
    for h in (1, 6, 24, 168))))
def _(spark, folder):
    return tidy(series.rate_by_horizon(_log(spark, folder)))


@query("prediction_deviation", over("requests", f"""+ d AS (SELECT avg(prediction) FILTER (WHERE ts > (SELECT as_of FROM clock) - INTERVAL 24 HOUR) AS a,
    avg(prediction) FILTER (WHERE ts <= (SELECT as_of FROM clock) - INTERVAL 24 HOUR) AS b FROM requests WHERE ts > (SELECT as_of FROM clock) - INTERVAL 192 HOUR)
SELECT {r('a', 4)} AS recent_mean, {r('b', 4)} AS baseline_mean, {r('(a - b) / b * 100', 4)} AS deviation_percent, abs((a - b) / b * 100) > 20 AS alert FROM d"""))
def _(spark, folder):
    return tidy(series.prediction_deviation(_log(spark, folder)), 4)


# --- alerts -----------------------------------------------------------------------------------

W, STEP, HOLD = 3600, 300, 900
# Rules are judged this long after the last row, when the log has fallen silent.
SILENT = dt.timedelta(hours=2)


def _late(rows: DataFrame) -> dt.datetime:
    return rows.agg(F.max("ts")).first()[0] + SILENT


def _last(view: str, step: int) -> str:
    """The last tick up to that time."""
    shift = int(SILENT.total_seconds()) * 1_000_000
    return f"(SELECT (epoch_us(max(ts)) + {shift}) // {step * 1_000_000} * {step} FROM {view})"


def _alert_sql(rule: str, severity: str, value: str, active: str, hold: int = HOLD, window: int = W, step: int = STEP,
               where: str = "true", view: str = "requests", views_: str = "requests", digits: int = 6, extra: str = "") -> str:
    s, k = step * 1_000_000, hold // step
    return over(views_, f"""+ {_ticks(window, step, where, view)},
  spine AS (SELECT unnest(range(min(first_tick), {_last(view, step)} + 1, {step})) AS tick FROM ticked){extra},
  vals AS (SELECT spine.tick AS tick, {value} AS v FROM spine LEFT JOIN spread ON spread.tick = spine.tick GROUP BY spine.tick),
  act AS (SELECT *, coalesce({active}, false) AS active FROM vals)
SELECT '{rule}' AS rule, '{severity}' AS severity, {AT} AS tick_ts, {r('v', digits)} AS value, active,
  min(CAST(active AS INTEGER)) OVER h = 1 AND count(*) OVER h = {k + 1} AS firing FROM act WINDOW h AS (ORDER BY tick ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)""")


@query("join_eval_spine", over("requests", f"""+ {_ticks(W, STEP)}, spine AS (SELECT unnest(range(min(first_tick), {_last("requests", STEP)} + 1, {STEP})) AS tick FROM ticked)
SELECT spine.tick AS tick, count(spread.tick) AS requests FROM spine LEFT JOIN spread ON spread.tick = spine.tick GROUP BY 1"""))
def _(spark, folder):
    log = _log(spark, folder)
    return alerts.windowed_counts(log, W, STEP, {"requests": F.lit(1)}, _late(log))


ERRORS = "count(*) FILTER (WHERE status_code >= 400) * 100e0 / nullif(count(spread.tick), 0)"


@query("alert_high_error_rate", _alert_sql("high_error_rate", "warning", ERRORS, "v > 25"))
def _(spark, folder):
    log = _log(spark, folder)
    return tidy(alerts.high_error_rate(log, 25.0, W, HOLD, STEP, as_of=_late(log)))


@query("alert_high_error_rate_critical", _alert_sql("high_error_rate", "critical", ERRORS, "v > 5", hold=600))
def _(spark, folder):
    log = _log(spark, folder)
    return tidy(alerts.high_error_rate(log, 5.0, W, 600, STEP, "critical", as_of=_late(log)))


def _p95() -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE {TIME} <= {float(b)!r}e0) AS b{i}" for i, b in enumerate(series.TIME_BOUNDS))
    rows = "\n  UNION ALL ".join([f"SELECT tick, {float(b)!r}e0 AS bound, b{i} AS cum_count FROM wide" for i, b in enumerate(series.TIME_BOUNDS)]
                                 + ["SELECT tick, NULL, n FROM wide"])
    return f""", wide AS (SELECT tick, {counts}, count(*) AS n FROM spread GROUP BY tick), h AS ({rows}){QUANTILE_SQL.format(q='0.95e0', l='tick')},
  p95 AS (SELECT tick, {INSIDE} AS p FROM f WHERE no = 1)"""


def _slow_sql(rule: str, limit: float, hold: int) -> str:
    return _alert_sql(rule, "warning", "(SELECT p FROM p95 WHERE p95.tick = spine.tick)", f"v > {limit}e0", hold, extra=_p95())


@query("alert_slow_processing", _slow_sql("slow_processing", 0.0975, HOLD))
def _(spark, folder):
    log = _log(spark, folder)
    return tidy(alerts.slow_requests(log, 0.0975, window=W, hold_for=HOLD, step=STEP, as_of=_late(log)))


@query("alert_slow_prediction", _slow_sql("slow_prediction", 0.095, 600))
def _(spark, folder):
    log = _log(spark, folder)
    return tidy(alerts.slow_prediction(log, 0.095, hold_for=600, window=W, step=STEP, as_of=_late(log)))


PER_MINUTE = "count(spread.tick) / 3600e0 * 60"


@query("alert_low_volume", _alert_sql("low_volume", "info", PER_MINUTE, "v < 0.2"))
def _(spark, folder):
    log = _log(spark, folder)
    return tidy(alerts.low_volume(log, 0.2, W, HOLD, STEP, as_of=_late(log)))


@query("alert_high_volume", _alert_sql("high_volume", "warning", PER_MINUTE, "v > 0.25", hold=300))
def _(spark, folder):
    log = _log(spark, folder)
    return tidy(alerts.high_volume(log, 0.25, W, 300, STEP, as_of=_late(log)))


@query("alert_no_predictions", _alert_sql("no_predictions", "info", "CAST(count(spread.prediction) AS DOUBLE)", "v = 0", hold=600, window=600))
def _(spark, folder):
    log = _log(spark, folder)
    return tidy(alerts.no_predictions(log, 600, 600, STEP, as_of=_late(log)))


@query("alert_log_growth", _alert_sql("log_growth", "info", "CAST(coalesce(sum(length(input_data)), 0) AS DOUBLE)", "v > 150", hold=600))
def _(spark, folder):
    log = _log(spark, folder)
    return tidy(alerts.log_growth(log, F.length("input_data"), 150.0, W, 600, STEP, as_of=_late(log)))


@query("alert_no_runs", _alert_sql("no_runs", "warning", "CAST(count(spread.run_id) AS DOUBLE)", "v < 1", hold=60, window=300, step=60,
       view="runs", views_="runs"))
def _(spark, folder):
    """A run comes every seven minutes: a window of five has gaps."""
    runs = views.runs(spark, folder)
    return tidy(alerts.no_runs(runs, 300, 60, 60, as_of=_late(runs)))


@query("alert_hold", _alert_sql("half_hour", "info", "CAST(count(spread.tick) AS DOUBLE)", "v > 6", hold=900, window=1800))
def _(spark, folder):
    log = _log(spark, folder)
    counted = alerts.windowed_counts(log, 1800, STEP, {"value": F.lit(1)}, _late(log))
    return tidy(alerts.judged(counted, "half_hour", "info", F.col("value") > 6, 900, STEP))


# --- rules over the last hours, from the log's days and from a rollup ------------------------------

RECENT_HOURS = 30
_RECENT = ("high_error_rate", "slow_processing", "low_volume", "high_volume", "no_predictions", "log_growth")


def _recent_rules():
    return [
        alerts.error_rate_rule(25.0, W, HOLD, STEP),
        alerts.slow_rule(0.0975, window=W, hold_for=HOLD, step=STEP),
        alerts.low_volume_rule(0.2, W, HOLD, STEP),
        alerts.high_volume_rule(0.25, W, 300, STEP),
        alerts.no_predictions_rule(600, 600, STEP),
        alerts.log_growth_rule(F.length("input_data"), 150.0, W, 600, STEP),
    ]


def _recent_sql() -> str:
    start = f"(SELECT max(ts) FROM events) + INTERVAL {int(SILENT.total_seconds())} SECOND - INTERVAL {RECENT_HOURS} HOUR"
    parts = [f"SELECT * FROM ({ORACLES['alert_' + name]}) WHERE epoch_us(tick_ts) // {STEP * 1000000} > epoch_us({start}) // {STEP * 1000000}" for name in _RECENT]
    return "\nUNION ALL ".join(parts)


def _by_day(spark, folder):
    """The log as its table keeps it: one partition a day."""
    path = new_folder(spark, "log")
    _log(spark, folder).withColumn("dt", F.to_date("ts")).repartition("dt").write.partitionBy("dt").parquet(path)
    return spark.read.parquet(path)


@query("alerts_recent", _recent_sql())
def _(spark, folder):
    """All rules over the last thirty hours, each from the days its windows reach back to."""
    log = _by_day(spark, folder)
    as_of = _late(log)
    start = as_of - dt.timedelta(hours=RECENT_HOURS)
    parts = [alerts.over_log(rule, log, as_of, start, "dt") for rule in _recent_rules()]
    return tidy(reduce(DataFrame.unionByName, parts))


@query("alerts_rollup", _recent_sql())
def _(spark, folder):
    """The same from step sums that were kept day by day; the last two days are summed twice, as a log that grows is."""
    log, rules = _by_day(spark, folder), _recent_rules()
    as_of, path = _late(log), new_folder(spark, "rollup")
    rollup.refresh(log, path, rules, "dt")
    newest_day = (as_of - SILENT).date()
    rollup.refresh(log, path, rules, "dt", [newest_day - dt.timedelta(days=1), newest_day])
    start = as_of - dt.timedelta(hours=RECENT_HOURS)
    parts = [rollup.judge(spark, path, rule, start, as_of) for rule in rules]
    return tidy(reduce(DataFrame.unionByName, parts))
