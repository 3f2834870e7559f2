"""Streaming queries: each drains what is there and returns the sink's content."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.models import _trained, validated_sql
from tallyframe.catalog.registry import ORACLES, over, query, r, tidy
from tallyframe.catalog.series import AT, HOLD, STEP, TIME, W, _late
from tallyframe.operators import series
from tallyframe.plans import scoring
from tallyframe.session import new_folder
from tallyframe.sources import tables, views
from tallyframe.streaming import jobs, rules, stores


def _stream(spark, folder):
    return views.events_as_requests(jobs.table_stream(spark, f"{folder}/events*.parquet"))


def _appended(spark, stream, label: str):
    path = new_folder(spark, label)
    jobs.start_append(stream, path, new_folder(spark, f"{label}-progress")).awaitTermination()
    return spark.read.parquet(path)


def _state(spark, stream, label: str, keys):
    path = new_folder(spark, label)
    stores.start_totals(stream, path, new_folder(spark, f"{label}-progress"), keys).awaitTermination()
    return stores.totals(spark, path, keys)


@query("stream_counters", over("requests", "SELECT endpoint, method, status_code, count(*) AS value FROM requests GROUP BY ALL"))
def _(spark, folder):
    return _state(spark, jobs.counter_stream(_stream(spark, folder)), "counters", ["endpoint", "method", "status_code"])


@query("stream_histograms", over("requests", f"""SELECT endpoint, {', '.join(
    f'count(*) FILTER (WHERE {TIME} <= {float(b)!r}e0) AS le_{i}' for i, b in enumerate(series.TIME_BOUNDS))},
  count(*) AS count, {r(f'sum({TIME})')} AS sum FROM requests GROUP BY 1"""))
def _(spark, folder):
    return tidy(_state(spark, jobs.histogram_stream(_stream(spark, folder)), "histograms", ["endpoint"]))


@query("stream_hourly", over("requests", f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00:00') AS hour, count(*) AS prediction_count,
  {r('avg(prediction)', 2)} AS avg_prediction, {r('min(prediction)', 2)} AS min_prediction, {r('max(prediction)', 2)} AS max_prediction,
  {r('avg(processing_time_ms)', 2)} AS avg_processing_time_ms FROM requests
WHERE prediction IS NOT NULL AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT as_of FROM clock) - INTERVAL 1 DAY GROUP BY 1"""))
def _(spark, folder):
    """Hours the watermark, one day behind the newest row, has passed."""
    return tidy(_appended(spark, jobs.hourly_stream(_stream(spark, folder)), "hourly"), 2)


# Windows of one hour every five minutes, left-closed as the streaming window is.
_SLID = """+ spread AS (SELECT *, unnest(range((epoch_us(ts) // 300000000) * 300 - 3300, (epoch_us(ts) // 300000000) * 300 + 300, 300)) AS start FROM requests),
  slid AS (SELECT start, start + 3600 AS tick, count(*) AS requests, count(*) FILTER (WHERE status_code >= 400) AS errors FROM spread GROUP BY 1
    HAVING start + 3600 <= (SELECT epoch_us(as_of) / 1000000 - 86400 FROM clock))"""


def _rates(spark, folder):
    return jobs.rate_stream(_stream(spark, folder), "1 hour", "5 minutes")


@query("stream_rates", over("requests", _SLID + """
SELECT make_timestamp(CAST(start AS BIGINT) * 1000000) AS start_ts, make_timestamp(CAST(tick AS BIGINT) * 1000000) AS end_ts, requests, errors FROM slid"""))
def _(spark, folder):
    out = _appended(spark, _rates(spark, folder), "rates")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_ts", "end_ts")})


@query("stream_alerts", over("requests", _SLID + f""",
  spine AS (SELECT unnest(range(min(tick), max(tick) + 1, 300)) AS tick FROM slid),
  act AS (SELECT tick, errors * 100e0 / nullif(requests, 0) AS v, coalesce(errors * 100e0 / nullif(requests, 0) > 25, false) AS active FROM spine LEFT JOIN slid USING (tick))
SELECT 'high_error_rate' AS rule, 'warning' AS severity, {AT} AS tick_ts, {r('v')} AS value, active,
  min(CAST(active AS INTEGER)) OVER h = 1 AND count(*) OVER h = 4 AS firing FROM act WINDOW h AS (ORDER BY tick ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"""))
def _(spark, folder):
    found = new_folder(spark, "alerts")
    jobs.start_alerts(
        _rates(spark, folder), new_folder(spark, "windows"), found, new_folder(spark, "alerts-progress"), 25.0, 900, 300
    ).awaitTermination()
    return tidy(spark.read.parquet(found).drop("batch_id"))


def _judged(spark, log, stored, rule, step: int = STEP):
    """Ticks of a rule up to two hours after the last row, which the clock tells."""
    clock = new_folder(spark, "clock")
    late = F.lit(_late(stored)).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    spark.range(1).select(late.alias("ts")).write.parquet(clock)
    out = rules.alert_stream(log, [rule], step, jobs.table_stream(spark, clock), "1 day")
    return tidy(_appended(spark, out, "judged"))


def _rule_query(rule: str, make):
    """The same ticks as the rule gives over the stored log."""

    @query(f"stream_alert_{rule}", ORACLES[f"alert_{rule}"])
    def run(spark, folder):
        return _judged(spark, _stream(spark, folder), views.requests(spark, folder), make())

    return run


_rule_query("high_error_rate", lambda: rules.error_rate_rule(25.0, W, HOLD))
_rule_query("slow_processing", lambda: rules.slow_rule(0.0975, window=W, hold=HOLD))
_rule_query("slow_prediction", lambda: rules.slow_rule(0.095, window=W, hold=600, name="slow_prediction"))
_rule_query("low_volume", lambda: rules.low_volume_rule(0.2, W, HOLD))
_rule_query("high_volume", lambda: rules.high_volume_rule(0.25, W, 300))
_rule_query("no_predictions", lambda: rules.silence_rule(600, 600))
_rule_query("log_growth", lambda: rules.growth_rule(F.length("input_data"), 150.0, W, 600))


@query("stream_alert_no_runs", ORACLES["alert_no_runs"])
def _(spark, folder):
    """Runs as they are appended to their table."""
    stored = views.runs(spark, folder)
    path = new_folder(spark, "runs")
    stored.select("run_id", "ts").write.parquet(path)
    return _judged(spark, jobs.table_stream(spark, path), stored, rules.no_runs_rule(300, 60), 60)


@query("stream_dedupe", over("requests", "SELECT id, ts, endpoint FROM requests"))
def _(spark, folder):
    """The log with every row sent twice: each comes out once."""
    log = _stream(spark, folder)
    twice = log.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    out = _appended(spark, jobs.dedupe_stream(twice), "deduped")
    return out.select("id", F.col("ts").cast("timestamp_ntz").alias("ts"), "endpoint")


@query("stream_batch_stats", over("requests", """+ n AS (SELECT endpoint, CAST(CAST('0x' || substr(md5(CAST(id AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 4 AS INTEGER) AS shard, count(*) AS n
    FROM requests WHERE prediction IS NOT NULL GROUP BY 1, 2)
SELECT endpoint, shard, n // 10 AS batches, n // 10 * 10 AS predictions, true AS ordered FROM n WHERE n >= 10"""))
def _(spark, folder):
    """Batches per endpoint and shard. Which rows meet in a batch depends on arrival, so the
    statistics are only checked for their order."""
    out = _appended(spark, jobs.batch_stats_stream(_stream(spark, folder), shards=4), "batches")
    ordered = (F.col("min_prediction") <= F.col("avg_prediction")) & (F.col("avg_prediction") <= F.col("max_prediction"))
    return out.groupBy("endpoint", "shard").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum(F.col("batch_size").cast("long")).alias("predictions"),
        F.bool_and(ordered).alias("ordered"),
    )


@query("stream_score", validated_sql("id"))
def _(spark, folder):
    """Feature rows as JSON requests, scored and logged as they come."""
    model = _trained(spark, folder, "linear")[1][0]
    raw = new_folder(spark, "raw")
    table = views.blocks(spark, folder)
    fields = [*scoring.INPUT_FIELDS, "median_house_value"]
    table.select(
        F.col("block_id").alias("id"),
        F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'").alias("ts"),
        F.to_json(F.struct(*fields)).alias("input_data"),
    ).write.parquet(raw)
    schema = table.select(*fields).schema
    scored = jobs.score_stream(jobs.table_stream(spark, raw), model, schema)
    out = _appended(spark, scored, "scored")
    return tidy(out.select("id", "prediction", "status_code", "error_message"), 1)


def _csv_folder(spark, folder):
    """Line items as CSV files, one directory per return flag."""
    path = new_folder(spark, "incoming")
    lines = views.read_table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")
    lines.withColumn("flag", F.col("l_returnflag")).write.partitionBy("flag").option("header", True).csv(path)
    return path, lines.schema


@query("src_new_files", "SELECT l_orderkey, l_quantity, l_returnflag, l_linestatus FROM lineitem")
def _(spark, folder):
    path, schema = _csv_folder(spark, folder)
    stream = jobs.new_files(spark, path, schema)
    return _appended(spark, stream, "arrived").drop("file_path")


@query("stream_new_data_trigger", """SELECT l_returnflag AS flag, 'new_data' AS reason, 'triggered' AS status FROM lineitem GROUP BY 1 HAVING count(*) >= 100""")
def _(spark, folder):
    """Folders that got at least one file with enough rows."""
    path, schema = _csv_folder(spark, folder)
    events = new_folder(spark, "events")
    stream = jobs.new_files(spark, path, schema)
    jobs.start_new_data_trigger(stream, events, new_folder(spark, "trigger-progress")).awaitTermination()
    flag = F.regexp_extract("details", "flag=([^/]+)/", 1).alias("flag")
    return tables.scan_log(spark, events).select(flag, "reason", "status").distinct()


@query("stream_changed_files", """SELECT DISTINCT l_returnflag AS flag, 0 AS look FROM lineitem WHERE l_returnflag IN (SELECT l_returnflag FROM lineitem GROUP BY 1 HAVING count(*) >= 100)
UNION ALL SELECT 'A', 1""")
def _(spark, folder):
    """Two looks at a folder: all files are new at first, then those of one flag have changed."""
    path, schema = _csv_folder(spark, folder)
    events, seen, progress, clock = (new_folder(spark, n) for n in ("events", "seen", "watch-progress", "clock"))

    def look():
        spark.range(1).select(F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'").alias("ts")).write.mode("append").parquet(clock)
        ticks = jobs.table_stream(spark, clock)
        stores.start_file_watch(ticks, path, schema, events, seen, progress).awaitTermination()

    look()
    lines = views.read_table(spark, folder, "lineitem").where("l_returnflag = 'A'")
    again = lines.select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")
    again.unionByName(again.limit(1)).write.mode("overwrite").option("header", True).csv(f"{path}/flag=A")
    look()
    flag = F.regexp_extract("details", "flag=([^/]+)/", 1).alias("flag")
    number = F.split_part("batch", F.lit("-"), F.lit(1)).cast("int").alias("look")
    return tables.scan_log(spark, events).select(flag, number).distinct()
