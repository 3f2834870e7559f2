"""Round trips through sources and sinks, read back and checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.log import METRICS_SQL
from tallyframe.catalog.profiling import FULL_SQL, LINE
from tallyframe.catalog.registry import over, query, tidy
from tallyframe.functions.timing import newest
from tallyframe.operators import profiling, series
from tallyframe.operators.cleaning import split_train_test
from tallyframe.operators.retraining import retraining_event
from tallyframe.session import new_folder
from tallyframe.sources import tables, views


@query("src_csv", "SELECT * FROM supplier")
def _(spark, folder):
    supplier = views.read_table(spark, folder, "supplier")
    path = tables.write_csv(supplier, new_folder(spark, "csv"))
    return tables.read_csv(spark, path, supplier.schema)


@query("sink_csv", over("blocks", "SELECT block_id, total_bedrooms, ocean_proximity, median_house_value FROM blocks"))
def _(spark, folder):
    """Missing values come back as missing."""
    table = views.blocks(spark, folder).select("block_id", "total_bedrooms", "ocean_proximity", "median_house_value")
    path = tables.write_csv(table, new_folder(spark, "csv"))
    return tables.read_csv(spark, path, table.schema)


@query("split_store", over("blocks", """SELECT block_id, total_rooms, median_house_value, 'test' AS split FROM blocks
WHERE CAST('0x' || substr(md5(CAST(block_id AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 10000 < 2000"""))
def _(spark, folder):
    """The test side only: reading it prunes the other directory."""
    table = views.blocks(spark, folder).select("block_id", "total_rooms", "median_house_value")
    path = tables.save_split(split_train_test(table, "block_id"), new_folder(spark, "split"))
    return tables.load_split(spark, path, "test")


@query("report_long", FULL_SQL)
def _(spark, folder):
    lines = views.read_table(spark, folder, "lineitem").select(*LINE, "l_returnflag", "l_linestatus")
    profile = tidy(profiling.full_profile(lines, "l_extendedprice", LINE), 3)
    return tables.load_report(spark, tables.save_report(profile, new_folder(spark, "report")))


def _stored_requests(spark, folder):
    return tables.append_requests(views.requests(spark, folder), new_folder(spark, "requests"))


@query("log_append_requests", over("requests", """SELECT id, ts, endpoint, method, input_data, prediction, processing_time_ms, status_code, error_message,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS dt FROM requests"""))
def _(spark, folder):
    stored = tables.scan_log(spark, _stored_requests(spark, folder))
    return stored.withColumn("dt", F.col("dt").cast("string")).drop("user_agent", "ip_address")


@query("log_append_metrics", over("requests", METRICS_SQL + "\nSELECT ts, metric_name, metric_value, 'api' AS source FROM metrics"))
def _(spark, folder):
    metrics = series.metrics_from_requests(views.requests(spark, folder))
    tagged = metrics.withColumn("tags", F.create_map(F.lit("source"), F.lit("api")))
    path = tables.append_metrics(tagged, new_folder(spark, "metrics"))
    return tables.scan_log(spark, path).select("ts", "metric_name", "metric_value", F.col("tags")["source"].alias("source"))


@query("log_append_performance", over("requests", """SELECT ts, 'v' || CAST(CAST(processing_time_ms AS INTEGER) % 3 AS VARCHAR) AS model_version, endpoint AS prediction_type,
  prediction AS prediction_value, CAST(CAST(processing_time_ms AS INTEGER) AS VARCHAR) AS k, 0.5e0 AS weight FROM requests WHERE prediction IS NOT NULL"""))
def _(spark, folder):
    k = F.get_json_object("input_data", "$.k")
    rows = views.requests(spark, folder).where(F.col("prediction").isNotNull()).select(
        "ts",
        F.concat(F.lit("v"), (k.cast("int") % 3).cast("string")).alias("model_version"),
        F.col("endpoint").alias("prediction_type"),
        F.create_map(F.lit("k"), k).alias("input_features"),
        F.col("prediction").alias("prediction_value"),
        F.create_map(F.lit("k"), F.lit(0.5)).alias("feature_importance"),
    )
    stored = tables.scan_log(spark, tables.append_performance(rows, new_folder(spark, "performance")))
    return stored.select(
        "ts",
        "model_version",
        "prediction_type",
        "prediction_value",
        F.col("input_features")["k"].alias("k"),
        F.col("feature_importance")["k"].alias("weight"),
    )


@query("log_append_retraining", over("requests", """SELECT ts, 'manual' AS reason, 'signup' AS details, 'triggered' AS status FROM requests WHERE endpoint = 'signup'"""))
def _(spark, folder):
    log = views.requests(spark, folder).where(F.col("endpoint") == "signup")
    path = tables.append_retraining(log.select(*retraining_event(F.col("ts"), "manual", "signup")), new_folder(spark, "retraining"))
    return tables.scan_log(spark, path).select("ts", "reason", "details", "status")


@query("log_append_runs", over("runs", "SELECT run_id, run_name, experiment_id, test_r2, test_rmse, model_type, max_depth FROM runs"))
def _(spark, folder):
    stored = spark.read.parquet(tables.append_runs(views.runs(spark, folder), new_folder(spark, "runs")))
    return stored.select(
        "run_id",
        "run_name",
        "experiment_id",
        *[F.col("metrics")[m].alias(m) for m in ("test_r2", "test_rmse")],
        *[F.col("params")[p].alias(p) for p in ("model_type", "max_depth")],
    )


@query("log_scan", over("requests", "SELECT id, ts, prediction FROM requests WHERE ts > (SELECT as_of FROM clock) - INTERVAL 48 HOUR"))
def _(spark, folder):
    """Two days of a stored log; the scan touches the partitions of these days only."""
    path = _stored_requests(spark, folder)
    as_of = views.requests(spark, folder).agg(F.max("ts")).first()[0]
    return tables.scan_log(spark, path, 48, as_of).select("id", "ts", "prediction")


RETENTION = """+ counts AS (SELECT 'prediction_requests' AS table_name, count(*) FILTER (WHERE ts < (SELECT as_of FROM clock) - INTERVAL 10 DAY) AS deleted FROM requests
  UNION ALL SELECT 'metrics', count(*) FILTER (WHERE ts < (SELECT as_of FROM clock) - INTERVAL 10 DAY) FROM metrics
  UNION ALL SELECT 'model_performance', count(*) FILTER (WHERE ts < (SELECT as_of FROM clock) - INTERVAL 10 DAY) FROM requests WHERE prediction IS NOT NULL)
SELECT * FROM counts"""


@query("log_retention", over("requests", METRICS_SQL + "," + RETENTION.lstrip("+")))
def _(spark, folder):
    log = views.requests(spark, folder)
    parts = {
        "prediction_requests": log,
        "metrics": series.metrics_from_requests(log),
        "model_performance": log.where(F.col("prediction").isNotNull()),
    }
    return tables.retention_counts(parts, newest(log), 10)


@query("log_retention_kept", over("requests", "SELECT id, ts FROM requests WHERE ts >= (SELECT as_of FROM clock) - INTERVAL 10 DAY"))
def _(spark, folder):
    """What a stored log holds after its clean-up."""
    path = _stored_requests(spark, folder)
    as_of = views.requests(spark, folder).agg(F.max("ts")).first()[0]
    tables.apply_retention(spark, path, as_of, 10)
    return tables.scan_log(spark, path).select("id", "ts")
