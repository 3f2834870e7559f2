"""Structured Streaming forms of the log analytics.

Functions named ``*_stream`` map a streaming DataFrame to a streaming DataFrame; ``start_*``
functions attach a sink. Event time must be ``timestamp``; cast zone-less columns first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyframe.functions.numeric import ms_to_seconds
from tallyframe.functions.payload import parse_payload
from tallyframe.functions.timing import hour_text
from tallyframe.operators import alerts
from tallyframe.operators.cleaning import hash_bucket
from tallyframe.operators.retraining import retraining_event
from tallyframe.operators.series import TIME_BOUNDS, on_spine
from tallyframe.operators.validation import BUSINESS, RuleSet
from tallyframe.plans.scoring import score_validated
from tallyframe.sources.tables import append_retraining

# --- sources ----------------------------------------------------------------------------------


def new_files(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int = 1000) -> DataFrame:
    """CSV files as they appear below a folder, each path once. The name comes along as
    ``file_path`` for per-file decisions."""
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
        .withColumn("file_path", F.col("_metadata.file_path"))
    )


def table_stream(spark: SparkSession, path: str, ts: str = "ts", files_per_batch: int = 1000) -> DataFrame:
    """A growing Parquet table as a stream with ``timestamp`` event time."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream.withColumn(ts, F.col(ts).cast("timestamp")) if ts in stream.columns else stream


# --- transformations ----------------------------------------------------------------------------


def dedupe_stream(log: DataFrame, keys: Sequence[str] = ("id",), delay: str = "1 day") -> DataFrame:
    """Replayed rows are dropped as long as they arrive within the delay; state is bounded by it."""
    return log.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def counter_stream(log: DataFrame, labels: Sequence[str] = ("endpoint", "method", "status_code")) -> DataFrame:
    """Running totals; state grows with the label sets only."""
    return log.groupBy(*labels).agg(F.count(F.lit(1)).alias("value"))


def histogram_stream(log: DataFrame, labels: Sequence[str] = ("endpoint",), bounds: Sequence[float] = TIME_BOUNDS):
    """Running cumulative bucket counts, one wide row per label set."""
    x = ms_to_seconds("processing_time_ms")
    return log.groupBy(*labels).agg(
        *[F.count_if(x <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)],
        F.count(x).alias("count"),
        F.sum(x).alias("sum"),
    )


def hourly_stream(log: DataFrame, delay: str = "1 day") -> DataFrame:
    """Closed hours only: an hour is final once the watermark has passed it."""
    made = log.withWatermark("ts", delay).where(F.col("prediction").isNotNull())
    hours = made.groupBy(F.window("ts", "1 hour")).agg(
        F.count(F.lit(1)).alias("prediction_count"),
        F.avg("prediction").alias("avg_prediction"),
        F.min("prediction").alias("min_prediction"),
        F.max("prediction").alias("max_prediction"),
        F.avg("processing_time_ms").alias("avg_processing_time_ms"),
    )
    return hours.select(hour_text(F.col("window.start")).alias("hour"), *hours.columns[1:])


def rate_stream(
    log: DataFrame, window: str = "5 minutes", step: str = "1 minute", delay: str = "1 day"
) -> DataFrame:
    """Sliding counts in two stateful steps: rows to step-sized cells, cells to windows, so
    only one row per cell is copied into the overlapping windows."""
    cell = (
        log.withWatermark("ts", delay)
        .groupBy(F.window("ts", step))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status_code") >= 400).alias("e"))
    )
    slid = cell.groupBy(F.window(F.window_time("window"), window, step).alias("w")).agg(
        F.sum("n").alias("requests"), F.sum("e").alias("errors")
    )
    return slid.select(F.col("w.start").alias("start_ts"), F.col("w.end").alias("end_ts"), "requests", "errors")


def score_stream(requests: DataFrame, model: PipelineModel, schema: T.StructType | str, rules: RuleSet | str = BUSINESS):
    """Raw requests ``(id, ts, input_data)`` to scored log rows; stateless."""
    parsed = requests.withColumn("_p", parse_payload("input_data", schema)).select(*requests.columns, "_p.*")
    scored = score_validated(model, parsed, rules)
    return scored.select(*requests.columns, "prediction", "status_code", "error_message")


BATCH_STATS_SCHEMA = (
    "endpoint string, shard int, batch_no long, batch_size int, avg_prediction double, min_prediction double, "
    "max_prediction double, prediction_std double, avg_processing_time_ms double"
)


def batch_stats_stream(log: DataFrame, size: int = 10, shards: int = 16) -> DataFrame:
    """Statistics each time ``size`` predictions have been collected; a shorter rest waits.

    Buffers are kept per endpoint and shard, as several serving processes would keep their
    own, so a busy endpoint is spread over ``shards`` tasks.
    """

    def collect(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        made, values, times = state.get if state.exists else (0, [], [])
        values, times = list(values), list(times)
        names = [f.split()[0] for f in BATCH_STATS_SCHEMA.split(", ")]
        for frame in frames:
            out = []
            values += frame["prediction"].tolist()
            times += frame["processing_time_ms"].tolist()
            full = len(values) - len(values) % size
            for i in range(0, full, size):
                v, t = pd.Series(values[i : i + size]), pd.Series(times[i : i + size])
                out.append(
                    (key[0], key[1], made, size, v.mean(), v.min(), v.max(), v.std(ddof=0), t.mean())
                )
                made += 1
            values, times = values[full:], times[full:]
            if out:
                yield pd.DataFrame(out, columns=names)
        state.update((made, values, times))

    made = log.where(F.col("prediction").isNotNull()).select(
        "endpoint",
        hash_bucket("id", buckets=shards).cast("int").alias("shard"),
        F.col("prediction").cast("double"),
        F.col("processing_time_ms").cast("double"),
    )
    return made.groupBy("endpoint", "shard").applyInPandasWithState(
        collect,
        BATCH_STATS_SCHEMA,
        "made long, held array<double>, times array<double>",
        "append",
        GroupStateTimeout.NoTimeout,
    )


# --- sinks ----------------------------------------------------------------------------------------
#
# ``trigger`` takes the arguments of ``DataStreamWriter.trigger``; by default a query processes
# what is there and stops.

DRAIN = {"availableNow": True}


def start_append(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Exactly-once Parquet files."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or DRAIN))
        .start()
    )


def start_new_data_trigger(
    files: DataFrame,
    events_path: str,
    checkpoint: str,
    min_rows: int = 100,
    enabled: bool = True,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A retraining event per new file with enough rows, keyed by batch: a replayed one leaves no second event. Files are told by
    their path; ``stores.start_file_watch`` also sees changed ones."""

    def check(batch: DataFrame, batch_id: int) -> None:
        if not enabled:
            return
        counted = batch.groupBy("file_path").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= min_rows)
        ts = F.current_timestamp().cast("timestamp_ntz")
        columns = retraining_event(ts, "new_data")
        details = F.concat(F.lit("New data file: "), F.col("file_path")).alias("details")
        append_retraining(counted.select(columns[0], columns[1], details, columns[3]), events_path, str(batch_id))

    return (
        files.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN))
        .start()
    )


def start_alerts(
    rates: DataFrame,
    windows_path: str,
    alerts_path: str,
    checkpoint: str,
    percent: float = 5.0,
    hold_seconds: int = 120,
    step_seconds: int = 60,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Error-rate alert with hold time over closed windows of ``rate_stream``.

    Each micro-batch stores its windows together with those of the hold time before them,
    taken from the batch before, and judges the new ones. A batch reads one earlier folder
    only, so its work does not grow with the history, and a replayed batch writes the same.
    """

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = batch.select(F.unix_timestamp("end_ts").alias("tick"), "requests", "errors", F.lit(True).alias("is_new"))
        if batch_id > 0:
            before = spark.read.parquet(f"{windows_path}/batch_id={batch_id - 1}")
            tail = before.where(F.col("tick") >= before.agg(F.max("tick") - hold_seconds).scalar())
            known = known.unionByName(tail.withColumn("is_new", F.lit(False)))
        folder = f"{windows_path}/batch_id={batch_id}"
        known.write.mode("overwrite").parquet(folder)
        stored = spark.read.parquet(folder)
        is_new, tick = F.col("is_new"), F.col("tick")
        judged_to, new_from, start, last = stored.agg(
            F.max(F.when(~is_new, tick)), F.min(F.when(is_new, tick)), F.min(tick), F.max(tick)
        ).first()
        if new_from is None:
            return
        if judged_to is not None:
            new_from = judged_to + step_seconds  # ticks without events between the batches count too
        spine = spark.range(start, last + 1, step_seconds).select(F.col("id").alias("tick"))
        filled = on_spine(stored, spine, ["requests", "errors"])
        values = filled.select("tick", F.try_divide(F.col("errors") * 100.0, F.col("requests")).alias("value"))
        out = alerts.judged(values, "high_error_rate", "warning", F.col("value") > percent, hold_seconds, step_seconds)
        first = F.timestamp_seconds(F.lit(new_from)).cast("timestamp_ntz")
        out.where(F.col("tick_ts") >= first).write.mode("overwrite").parquet(f"{alerts_path}/batch_id={batch_id}")

    return (
        rates.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or DRAIN))
        .start()
    )
