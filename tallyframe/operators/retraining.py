"""Retraining triggers: schedule, degradation and the combined decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.requestlog import AsOf, outlier_ratio

# Event reasons.
REASONS = ("new_data", "performance_degradation", "scheduled_retrain", "manual")
# Recommendation texts.
ADVICE = {
    "degraded": "Model performance has degraded, consider retraining",
    "due": "Scheduled retraining window reached",
}


def schedule(events: DataFrame, as_of: Column, interval_hours: float = 24) -> DataFrame:
    """Hours since the last retraining; due when never or long enough ago."""
    last = events.agg(F.max("ts").alias("last_retrain"))
    hours = F.timestamp_diff("MICROSECOND", F.col("last_retrain"), as_of) / F.lit(3_600_000_000.0)
    return last.withColumn("hours_since", hours).withColumn(
        "due", F.col("last_retrain").isNull() | (F.col("hours_since") >= interval_hours)
    )


def decision(
    log: DataFrame,
    events: DataFrame,
    as_of: Column,
    log_as_of: AsOf = None,
    interval_hours: float = 24,
    threshold: float = 0.1,
    hours: float = 24,
    day: str | None = None,
) -> DataFrame:
    """Degradation goes first, then the schedule. Two one-row subqueries, no join."""
    degraded = outlier_ratio(log, hours, log_as_of, threshold, day=day).select("degraded").scalar()
    due = schedule(events, as_of, interval_hours).select("due").scalar()
    base = events.agg(F.count(F.lit(1)).alias("past_events"))
    reason = F.when(F.col("degraded"), F.lit(REASONS[1])).when(F.col("due"), F.lit(REASONS[2]))
    advice = F.when(F.col("degraded"), F.lit(ADVICE["degraded"])).when(F.col("due"), F.lit(ADVICE["due"]))
    return (
        base.select("past_events", degraded.alias("degraded"), due.alias("due"))
        .withColumn("reason", reason)
        .withColumn("status", F.when(reason.isNotNull(), F.lit("needs_attention")).otherwise(F.lit("healthy")))
        .withColumn("recommendation", advice)
    )


def retraining_event(ts: Column, reason: str, details: str = "") -> list[Column]:
    """The columns of one event row."""
    return [
        ts.alias("ts"),
        F.lit(reason).alias("reason"),
        F.lit(details).alias("details"),
        F.lit("triggered").alias("status"),
    ]
