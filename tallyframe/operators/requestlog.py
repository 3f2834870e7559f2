"""Analytics over the prediction-request log.

Columns: ``id, ts, endpoint, method, input_data (JSON text), prediction, processing_time_ms,
status_code, error_message``. ``as_of`` is the end of a look-back window and defaults to the
newest row; ``day`` names a date partition column to prune by where the table has one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.numeric import as_number, round_to
from tallyframe.functions.payload import parse_payload, payload_field
from tallyframe.functions.timing import hour_text, moment, since
from tallyframe.operators.ordering import number_rows

LOG_COLUMNS = (
    "id",
    "ts",
    "endpoint",
    "method",
    "input_data",
    "prediction",
    "processing_time_ms",
    "status_code",
    "error_message",
)
TOP_ROWS = 100_000

AsOf = dt.datetime | Column | None


def prediction_value(log: DataFrame, column: str = "prediction") -> Column:
    """The prediction as a number; logs that keep it as text go through a safe cast."""
    if isinstance(log.schema[column].dataType, T.StringType):
        return as_number(column)
    return F.col(column)


def for_endpoint(log: DataFrame, endpoint: str | None) -> DataFrame:
    return log if not endpoint else log.where(F.col("endpoint") == F.lit(endpoint))


def in_price_range(log: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    value = prediction_value(log)
    if low is not None:
        log = log.where(value >= F.lit(float(low)))
    if high is not None:
        log = log.where(value <= F.lit(float(high)))
    return log


def request_filter(
    log: DataFrame,
    hours: float | None = 24,
    endpoint: str | None = None,
    low: float | None = None,
    high: float | None = None,
    as_of: AsOf = None,
    day: str | None = None,
) -> DataFrame:
    out = log if hours is None else since(log, hours, as_of, day=day)
    return in_price_range(for_endpoint(out, endpoint), low, high)


def with_json_fields(log: DataFrame, criteria: Mapping[str, str | float | int | bool]) -> DataFrame:
    """Rows with a prediction whose payload matches every criterion: text fields as text,
    others as numbers, where true is 1 and false is 0. The payload is parsed once for all fields."""
    if not criteria:
        raise ValueError("no search criteria given")
    fields = list(criteria)
    payload = F.from_json("input_data", T.StructType([T.StructField(f, T.StringType()) for f in fields]))
    out = log.where(F.col("prediction").isNotNull()).withColumn("_payload", payload)
    for f in fields:
        wanted, held = criteria[f], F.col("_payload")[f]
        number = F.when(held == "true", F.lit(1.0)).when(held == "false", F.lit(0.0)).otherwise(as_number(held))
        out = out.where(held == F.lit(wanted) if isinstance(wanted, str) else number == F.lit(float(wanted)))
    return out.drop("_payload")


def decoded_payload(log: DataFrame, schema: T.StructType | str, out: str = "payload") -> DataFrame:
    return log.withColumn(out, parse_payload("input_data", schema))


def log_stats(log: DataFrame, hours: float = 24, endpoint: str | None = None, as_of: AsOf = None, day: str | None = None):
    """Window totals in one aggregate over one scan."""
    rows = for_endpoint(since(log, hours, as_of, day=day), endpoint)
    value = prediction_value(rows)
    total, ok = F.count(F.lit(1)), F.count_if(F.col("status_code") == 200)
    error_rate = F.coalesce(F.try_divide(total - ok, total) * 100, F.lit(0.0))
    return rows.agg(
        total.alias("total_predictions"),
        ok.alias("successful_predictions"),
        F.count("prediction").alias("predictions_with_values"),
        round_to(error_rate, 2).alias("error_rate_percent"),
        round_to(F.coalesce(F.avg("processing_time_ms"), F.lit(0.0)), 2).alias("avg_processing_time_ms"),
        round_to(F.avg(value), 2).alias("avg_prediction_value"),
        round_to(F.min(value), 2).alias("min_prediction_value"),
        round_to(F.max(value), 2).alias("max_prediction_value"),
        F.lit(hours).alias("time_window_hours"),
    )


def log_hourly(log: DataFrame, hours: float = 24, as_of: AsOf = None, day: str | None = None) -> DataFrame:
    """Per hour with at least one prediction, newest first."""
    rows = since(log, hours, as_of, day=day).where(F.col("prediction").isNotNull())
    value = prediction_value(rows)
    return (
        rows.groupBy(hour_text("ts").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("prediction_count"),
            round_to(F.avg(value), 2).alias("avg_prediction"),
            round_to(F.min(value), 2).alias("min_prediction"),
            round_to(F.max(value), 2).alias("max_prediction"),
            round_to(F.avg("processing_time_ms"), 2).alias("avg_processing_time_ms"),
        )
        .orderBy(F.desc("hour"))
    )


def log_count(log: DataFrame, **filters) -> DataFrame:
    return request_filter(log, **filters).agg(F.count(F.lit(1)).alias("total"))


def _newest_first(log: DataFrame) -> list[Column]:
    return [F.col("ts").desc(), F.col("id").desc()]


def recent_predictions(log: DataFrame, limit: int = 100) -> DataFrame:
    """The newest rows; ties on time go by id. Each task keeps its own top rows only."""
    shown = log.select(*[c for c in LOG_COLUMNS if c in log.columns])
    return shown.orderBy(*_newest_first(log)).limit(limit)


def log_page(log: DataFrame, limit: int = 50, offset: int = 0, top_rows: int = TOP_ROWS, **filters) -> DataFrame:
    """One page of the filtered log with the filtered total and ``has_more``.

    Shallow pages are a distributed top-n. A page deeper than ``top_rows`` is cut out of a
    range-partitioned numbering instead, so no task gathers all rows before it.
    """
    rows = request_filter(log, **filters)
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    shown = rows.select(*[c for c in LOG_COLUMNS if c in log.columns])
    if offset + limit <= top_rows:
        page = shown.orderBy(*_newest_first(log)).offset(offset).limit(limit)
    else:
        placed = number_rows(shown, [], _newest_first(log), "_no")
        page = placed.where(F.col("_no").between(offset + 1, offset + limit)).drop("_no")
    return page.withColumn("total", total).withColumn("has_more", F.lit(offset + limit) < F.col("total"))


def log_search(log: DataFrame, criteria: Mapping[str, str | float | int | bool], limit: int = 20) -> DataFrame:
    shown = ["id", "ts", "endpoint", "input_data", "prediction", "processing_time_ms"]
    return with_json_fields(log, criteria).select(*shown).orderBy(*_newest_first(log)).limit(limit)


def service_metrics(log: DataFrame, as_of: AsOf = None, day: str | None = None) -> DataFrame:
    """Totals, last-hour count, average time and share of failed requests, in one pass."""
    end = moment(as_of, log, day=day)
    errors = F.count_if(F.col("status_code") >= 400)
    return log.agg(
        F.count("prediction").alias("total_predictions"),
        F.count_if(F.col("prediction").isNotNull() & (F.col("ts") > end - F.expr("INTERVAL 1 HOUR"))).alias(
            "predictions_last_hour"
        ),
        F.coalesce(F.avg("processing_time_ms"), F.lit(0.0)).alias("average_response_time_ms"),
        F.coalesce(F.try_divide(errors * 100.0, F.count(F.lit(1))), F.lit(0.0)).alias("error_rate_percentage"),
        F.max("ts").alias("last_updated"),
    )


def perf_last_n(log: DataFrame, n: int = 1000) -> DataFrame:
    """Response times over the newest ``n`` requests, counts over all of them."""
    newest = log.select("ts", "id", "processing_time_ms").orderBy(*_newest_first(log)).limit(n)
    times = newest.agg(
        F.struct(
            F.coalesce(F.avg("processing_time_ms"), F.lit(0.0)).alias("avg"),
            F.coalesce(F.max("processing_time_ms"), F.lit(0.0)).alias("max"),
            F.coalesce(F.min("processing_time_ms"), F.lit(0.0)).alias("min"),
        )
    ).scalar()
    errors = F.count_if(F.col("status_code") >= 400)
    counts = log.agg(
        F.count(F.lit(1)).alias("total_requests"),
        errors.alias("total_errors"),
        F.coalesce(F.try_divide(errors * 100.0, F.count(F.lit(1))), F.lit(0.0)).alias("error_rate_percentage"),
    )
    return counts.select(
        "*",
        times["avg"].alias("average_response_time_ms"),
        times["max"].alias("max_response_time_ms"),
        times["min"].alias("min_response_time_ms"),
    )


def outside_two_sigma(log: DataFrame, hours: float | None = 24, as_of: AsOf = None, sigmas: float = 2.0, day: str | None = None) -> DataFrame:
    """Rows whose prediction lies outside mean ± ``sigmas`` sample deviations of the window."""
    rows = log if hours is None else since(log, hours, as_of, day=day)
    rows = rows.where(F.col("prediction").isNotNull())
    value = prediction_value(rows)
    stats = rows.agg(F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))).scalar()
    return rows.where(_outside(value, stats, sigmas))


def _outside(value: Column, stats: Column, sigmas: float) -> Column:
    return (value < stats["mean"] - sigmas * stats["std"]) | (value > stats["mean"] + sigmas * stats["std"])


def outlier_ratio(
    log: DataFrame,
    hours: float = 24,
    as_of: AsOf = None,
    threshold: float = 0.1,
    min_rows: int = 10,
    sigmas: float = 2.0,
    day: str | None = None,
) -> DataFrame:
    """Share of outlying predictions in the window and whether it means degradation.

    Values that cannot be read as numbers count in the denominator only.
    """
    rows = since(log, hours, as_of, day=day).where(F.col("prediction").isNotNull())
    value = prediction_value(rows)
    stats = rows.agg(F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))).scalar()
    counted = rows.agg(
        F.count(F.lit(1)).alias("predictions"), F.count_if(_outside(value, stats, sigmas)).alias("outliers")
    )
    enough = F.col("predictions") >= min_rows
    share = F.try_divide(F.col("outliers"), F.col("predictions"))
    return counted.select(
        "predictions",
        "outliers",
        F.when(enough, share).alias("outlier_ratio"),
        enough.alias("sufficient"),
        F.coalesce(enough & (share > threshold), F.lit(False)).alias("degraded"),
    )


def payload_text_field(log: DataFrame, field: str, out: str) -> DataFrame:
    return log.withColumn(out, payload_field("input_data", field))
