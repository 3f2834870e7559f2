"""Readers and writers: CSV tables, split stores and the append-only logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.cleaning import nan_as_null
from tallyframe.session import new_folder

HOUSING_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType())
        for c in (
            "longitude",
            "latitude",
            "housing_median_age",
            "total_rooms",
            "total_bedrooms",
            "population",
            "households",
            "median_income",
            "median_house_value",
        )
    ]
    + [T.StructField("ocean_proximity", T.StringType())]
)

# Columns of the logs.
REQUEST_SCHEMA = (
    "id long, ts timestamp_ntz, endpoint string, method string, input_data string, prediction double, "
    "processing_time_ms double, status_code int, error_message string, user_agent string, ip_address string"
)
METRIC_SCHEMA = "ts timestamp_ntz, metric_name string, metric_value double, tags map<string,string>"
PERFORMANCE_SCHEMA = (
    "ts timestamp_ntz, model_version string, prediction_type string, input_features map<string,string>, "
    "prediction_value double, confidence_score double, feature_importance map<string,double>"
)
RETRAINING_SCHEMA = "ts timestamp_ntz, reason string, details string, status string, model_backup_path string"
RUN_SCHEMA = (
    "run_id string, run_name string, experiment_id string, ts timestamp_ntz, metrics map<string,double>, "
    "params map<string,string>, tags map<string,string>"
)


# --- plain tables ---------------------------------------------------------------------------


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and a declared schema; empty fields and NaN are NULL. Columns are
    matched to the file by position, and a header that disagrees is an error."""
    return nan_as_null(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return nan_as_null(spark.read.parquet(f"{folder}/{name}.parquet"))


def save_split(df: DataFrame, path: str, split: str = "split") -> str:
    """Train and test rows side by side, one directory each, so reading one prunes the other.
    A rebalance keeps files evenly sized even if one split is far larger."""
    df.hint("rebalance", split).write.mode("overwrite").partitionBy(split).parquet(path)
    return path


def load_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    stored = nan_as_null(spark.read.parquet(path))
    return stored if split is None else stored.where(F.col("split") == split)


def save_report(profile: DataFrame, path: str) -> str:
    """Long-form profile as JSON lines."""
    profile.write.mode("overwrite").json(path)
    return path


def load_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("section string, column_name string, stat string, value double").json(path)


# --- append-only logs -------------------------------------------------------------------------


def _append(rows: DataFrame, path: str, day: str = "dt") -> str:
    """Append under one directory per day. The rebalance groups rows of a day into few files
    and splits a day that holds most of them."""
    dated = rows.withColumn(day, F.to_date("ts"))
    dated.hint("rebalance", day).write.mode("append").partitionBy(day).parquet(path)
    return path


def _conform(rows: DataFrame, schema: str, defaults: dict[str, Column] | None = None) -> DataFrame:
    defaults = defaults or {}
    out = []
    for f in T._parse_datatype_string(schema):
        if f.name in rows.columns:
            c = F.col(f.name)
            c = F.coalesce(c, defaults[f.name]) if f.name in defaults else c
        else:
            c = defaults.get(f.name, F.lit(None))
        out.append(c.cast(f.dataType).alias(f.name))
    return rows.select(*out)


def append_requests(rows: DataFrame, path: str) -> str:
    """Request rows; a missing status is 200, a struct payload becomes JSON text. A row without a time is
    stamped with the time of the write, and one without an id gets a hash of the row that is the same
    whenever the row is written again, so look-backs and de-duplication see it."""
    if "input_data" in rows.columns and not isinstance(rows.schema["input_data"].dataType, T.StringType):
        rows = rows.withColumn("input_data", F.to_json("input_data"))
    defaults = {"status_code": F.lit(200), "method": F.lit("POST"), "input_data": F.lit("{}")}
    own = [f"`{c}`" for c in rows.columns if not isinstance(rows.schema[c].dataType, T.MapType)]
    defaults |= {"ts": F.localtimestamp(), "id": F.shiftright(F.xxhash64(*own), 1).bitwiseAND(F.lit((1 << 62) - 1))}
    return _append(_conform(rows, REQUEST_SCHEMA, defaults), path)


def append_metrics(rows: DataFrame, path: str) -> str:
    return _append(_conform(rows, METRIC_SCHEMA), path)


def append_performance(rows: DataFrame, path: str) -> str:
    return _append(_conform(rows, PERFORMANCE_SCHEMA), path)


def append_retraining(rows: DataFrame, path: str, batch: str | None = None) -> str:
    """Retraining events. With the id of a ``batch`` they replace what that batch wrote before; a table of events is
    either written by batches or appended to."""
    events = _conform(rows, RETRAINING_SCHEMA, {"status": F.lit("triggered")})
    if batch is None:
        return _append(events, path)
    dated = events.withColumn("dt", F.to_date("ts")).write.mode("overwrite").option("partitionOverwriteMode", "static")
    dated.partitionBy("dt").parquet(f"{path}/batch={batch}")
    return path


def append_runs(rows: DataFrame, path: str) -> str:
    """Run rows; appended as they are, since runs are few and read as a whole."""
    _conform(rows, RUN_SCHEMA).write.mode("append").parquet(path)
    return path


def scan_log(
    spark: SparkSession, path: str, hours: float | None = None, as_of: dt.datetime | Column | None = None
) -> DataFrame:
    """Log rows, pruned to the days the window touches."""
    from tallyframe.functions.timing import since

    stored = nan_as_null(spark.read.parquet(path))
    return stored if hours is None else since(stored, hours, as_of, day="dt")


# --- retention ----------------------------------------------------------------------------------


def retention_cutoff(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))


def retained(log: DataFrame, as_of: Column, days: int = 30, ts: str = "ts") -> DataFrame:
    """Rows that stay: not older than the cutoff."""
    return log.where(F.col(ts) >= retention_cutoff(as_of, days))


def retention_counts(tables: dict[str, DataFrame], as_of: Column, days: int = 30, ts: str = "ts") -> DataFrame:
    """Rows that a clean-up would delete, per table."""
    out = None
    for name, table in tables.items():
        one = table.agg(F.count_if(F.col(ts) < retention_cutoff(as_of, days)).alias("deleted"))
        one = one.select(F.lit(name).alias("table_name"), "deleted")
        out = one if out is None else out.unionByName(one)
    return out


def apply_retention(spark: SparkSession, path: str, as_of: dt.datetime, days: int = 30) -> int:
    """Delete old rows from a stored log; returns how many.

    Whole expired days are dropped as directories. Only the day the cutoff falls into is
    rewritten, from a staged copy in the shared folder, so the cost does not grow with the log.
    """
    cutoff = as_of - dt.timedelta(days=days)
    stored = spark.read.parquet(path)
    old = stored.where(F.col("dt") <= F.lit(cutoff.date()))
    deleted = old.agg(F.count_if(F.col("ts") < F.lit(cutoff))).first()[0]
    if not deleted:
        return 0
    edge = stored.where(F.col("dt") == F.lit(cutoff.date()))
    expired = [r[0] for r in old.where(F.col("dt") < F.lit(cutoff.date())).select("dt").distinct().collect()]
    kept = edge.where(F.col("ts") >= F.lit(cutoff))
    if kept.limit(1).count():
        staged = new_folder(spark, "retention")
        kept.write.parquet(staged)
        again = spark.read.schema(stored.schema).parquet(staged)
        again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)
    else:
        expired.append(cutoff.date())
    jvm = spark._jvm
    for day in expired:
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/dt={day.isoformat()}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    spark.catalog.refreshByPath(path)
    return deleted
