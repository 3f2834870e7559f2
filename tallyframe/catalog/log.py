"""Request-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.registry import over, query, r, tidy
from tallyframe.functions.timing import since
from tallyframe.operators import requestlog as rl
from tallyframe.operators import series
from tallyframe.sources import views

DAY = "ts > (SELECT as_of FROM clock) - INTERVAL 24 HOUR"
MONTH = "ts > (SELECT as_of FROM clock) - INTERVAL 720 HOUR"
SHOWN = "id, ts, endpoint, method, input_data, prediction, processing_time_ms, status_code, error_message"


@query("flt_last_hours", over("requests", f"SELECT id, ts FROM requests WHERE {DAY}"))
def _(spark, folder):
    return since(views.requests(spark, folder), 24).select("id", "ts")


@query("flt_endpoint", over("requests", "SELECT id, ts, prediction FROM requests WHERE endpoint = 'purchase'"))
def _(spark, folder):
    return rl.for_endpoint(views.requests(spark, folder), "purchase").select("id", "ts", "prediction")


@query("flt_price_range", over("requests", "SELECT id, prediction FROM requests WHERE prediction >= 50000 AND prediction <= 100000"))
def _(spark, folder):
    """The prediction as text, as a log of texts would hold it."""
    log = views.requests(spark, folder).withColumn("prediction", F.col("prediction").cast("string"))
    found = rl.in_price_range(log, 50000, 100000)
    return found.select("id", rl.prediction_value(found).alias("prediction"))


@query("flt_json_fields", over("requests", "SELECT id, input_data FROM requests WHERE prediction IS NOT NULL AND CAST(json_extract_string(input_data, '$.k') AS DOUBLE) = 42"))
def _(spark, folder):
    return rl.with_json_fields(views.requests(spark, folder), {"k": 42}).select("id", "input_data")


@query("flt_two_sigma", over("requests", f"""+ w AS (SELECT * FROM requests WHERE {MONTH} AND prediction IS NOT NULL),
  st AS (SELECT avg(prediction) AS m, stddev_samp(prediction) AS s FROM w)
SELECT id, prediction FROM w, st WHERE prediction < m - 2 * s OR prediction > m + 2 * s"""))
def _(spark, folder):
    return rl.outside_two_sigma(views.requests(spark, folder), 720).select("id", "prediction")


@query("norm_json_payload", over("requests", "SELECT id, CASE WHEN status_code = 500 THEN NULL ELSE CAST(processing_time_ms AS INTEGER) END AS k FROM requests"))
def _(spark, folder):
    """Payloads of failed requests are cut off on purpose: they decode to an empty record."""
    log = views.requests(spark, folder)
    broken = F.when(F.col("status_code") == 500, F.substring("input_data", 1, 4)).otherwise(F.col("input_data"))
    return rl.decoded_payload(log.withColumn("input_data", broken), "k int").select("id", F.col("payload.k").alias("k"))


def _stats_sql(where: str, hours: int) -> str:
    return over("requests", f"""+ w AS (SELECT * FROM requests WHERE {where})
SELECT count(*) AS total_predictions, count(*) FILTER (WHERE status_code = 200) AS successful_predictions, count(prediction) AS predictions_with_values,
  {r('coalesce((count(*) - count(*) FILTER (WHERE status_code = 200)) / nullif(count(*), 0) * 100, 0)', 2)} AS error_rate_percent,
  {r('coalesce(avg(processing_time_ms), 0)', 2)} AS avg_processing_time_ms, {r('avg(prediction)', 2)} AS avg_prediction_value,
  {r('min(prediction)', 2)} AS min_prediction_value, {r('max(prediction)', 2)} AS max_prediction_value, {hours} AS time_window_hours FROM w""")


@query("log_stats", _stats_sql(MONTH, 720))
def _(spark, folder):
    return rl.log_stats(views.requests(spark, folder), 720)


@query("log_stats_day", _stats_sql(DAY + " AND endpoint = 'click'", 24))
def _(spark, folder):
    return rl.log_stats(views.requests(spark, folder), 24, "click")


HOURLY = over("requests", f"""SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS hour, count(*) AS prediction_count,
  {r('avg(prediction)', 2)} AS avg_prediction, {r('min(prediction)', 2)} AS min_prediction, {r('max(prediction)', 2)} AS max_prediction,
  {r('avg(processing_time_ms)', 2)} AS avg_processing_time_ms FROM requests WHERE {MONTH} AND prediction IS NOT NULL GROUP BY 1 ORDER BY 1 DESC""")


@query("log_hourly", HOURLY)
def _(spark, folder):
    return rl.log_hourly(views.requests(spark, folder), 720)


@query("log_count", over("requests", f"SELECT count(*) AS total FROM requests WHERE {MONTH} AND endpoint = 'view' AND prediction BETWEEN 10000 AND 200000"))
def _(spark, folder):
    return rl.log_count(views.requests(spark, folder), hours=720, endpoint="view", low=10000, high=200000)


@query("recent_predictions", over("requests", f"SELECT {SHOWN} FROM requests ORDER BY ts DESC, id DESC LIMIT 100"))
def _(spark, folder):
    return rl.recent_predictions(views.requests(spark, folder), 100)


def _page_sql(limit: int, offset: int) -> str:
    return over("requests", f"""+ w AS (SELECT {SHOWN} FROM requests WHERE {MONTH} AND endpoint = 'click')
SELECT *, (SELECT count(*) FROM w) AS total, {limit + offset} < (SELECT count(*) FROM w) AS has_more FROM w ORDER BY ts DESC, id DESC LIMIT {limit} OFFSET {offset}""")


@query("log_page", _page_sql(50, 100))
def _(spark, folder):
    return rl.log_page(views.requests(spark, folder), 50, 100, hours=720, endpoint="click")


@query("log_page_deep", _page_sql(50, 100))
def _(spark, folder):
    """The same page by the path for deep offsets."""
    return rl.log_page(views.requests(spark, folder), 50, 100, top_rows=0, hours=720, endpoint="click")


@query("log_search", over("requests", """SELECT id, ts, endpoint, input_data, prediction, processing_time_ms FROM requests
WHERE prediction IS NOT NULL AND CAST(json_extract_string(input_data, '$.k') AS DOUBLE) = 7 ORDER BY ts DESC, id DESC LIMIT 20"""))
def _(spark, folder):
    return rl.log_search(views.requests(spark, folder), {"k": 7}, 20)


METRICS_SQL = """+ metrics AS (SELECT ts, 'request_response_time' AS metric_name, processing_time_ms AS metric_value FROM requests
  UNION ALL SELECT ts, 'request_count', 1 FROM requests UNION ALL SELECT ts, 'error_count', 1 FROM requests WHERE status_code >= 400
  UNION ALL SELECT ts, 'prediction_count', 1 FROM requests WHERE prediction IS NOT NULL
  UNION ALL SELECT ts, 'prediction_value', prediction FROM requests WHERE prediction IS NOT NULL)"""


@query("metrics_from_requests", over("requests", METRICS_SQL + "\nSELECT * FROM metrics"))
def _(spark, folder):
    return series.metrics_from_requests(views.requests(spark, folder))


@query("metric_stats", over("requests", METRICS_SQL + f"""
SELECT count(*) AS count, {r('avg(metric_value)', 4)} AS avg, {r('min(metric_value)', 4)} AS min, {r('max(metric_value)', 4)} AS max,
  {r('sum(metric_value)', 2)} AS sum FROM metrics WHERE metric_name = 'prediction_value' AND {MONTH}"""))
def _(spark, folder):
    metrics = series.metrics_from_requests(views.requests(spark, folder))
    return tidy(series.metric_stats(metrics, "prediction_value", 720), 4, {"sum": 2})


@query("service_metrics", over("requests", f"""SELECT count(prediction) AS total_predictions,
  count(*) FILTER (WHERE prediction IS NOT NULL AND ts > (SELECT as_of FROM clock) - INTERVAL 1 HOUR) AS predictions_last_hour,
  {r('avg(processing_time_ms)')} AS average_response_time_ms, {r('count(*) FILTER (WHERE status_code >= 400) * 100e0 / count(*)')} AS error_rate_percentage,
  max(ts) AS last_updated FROM requests"""))
def _(spark, folder):
    return tidy(rl.service_metrics(views.requests(spark, folder)))


@query("perf_last_n", over("requests", f"""+ n AS (SELECT processing_time_ms AS t FROM requests ORDER BY ts DESC, id DESC LIMIT 1000),
  a AS (SELECT avg(t) AS x, max(t) AS y, min(t) AS z FROM n)
SELECT count(*) AS total_requests, count(*) FILTER (WHERE status_code >= 400) AS total_errors,
  {r('count(*) FILTER (WHERE status_code >= 400) * 100e0 / count(*)')} AS error_rate_percentage, {r('(SELECT x FROM a)')} AS average_response_time_ms,
  {r('(SELECT y FROM a)')} AS max_response_time_ms, {r('(SELECT z FROM a)')} AS min_response_time_ms FROM requests"""))
def _(spark, folder):
    return tidy(rl.perf_last_n(views.requests(spark, folder)))


OUTLIER_SQL = """+ w AS (SELECT * FROM requests WHERE ts > (SELECT as_of FROM clock) - INTERVAL {h} HOUR AND prediction IS NOT NULL),
  st AS (SELECT avg(prediction) AS m, stddev_samp(prediction) AS s FROM w),
  o AS (SELECT count(*) AS predictions, count(*) FILTER (WHERE prediction < m - 2 * s OR prediction > m + 2 * s) AS outliers FROM w, st)"""


@query("outlier_ratio", over("requests", OUTLIER_SQL.format(h=720) + f"""
SELECT predictions, outliers, CASE WHEN predictions >= 10 THEN {r('outliers / predictions')} END AS outlier_ratio, predictions >= 10 AS sufficient,
  predictions >= 10 AND outliers / predictions > 0.04 AS degraded FROM o"""))
def _(spark, folder):
    return tidy(rl.outlier_ratio(views.requests(spark, folder), 720, threshold=0.04))
