"""Batch scoring: features, prediction and request-log rows in one projection per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.validation import BUSINESS, CATEGORY_FIELD, NUMERIC_FIELDS, RuleSet, error_text, validate

INPUT_FIELDS = (*NUMERIC_FIELDS, CATEGORY_FIELD)


def score(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Predictions for any number of rows; the input columns stay as they are."""
    predicted = model.transform(df)
    return predicted.select(*[df_col for df_col in df.columns if df_col != out], F.col("prediction").alias(out))


def as_requests(
    scored: DataFrame,
    ts: Column,
    endpoint: str = "batch",
    total_ms: float | None = None,
    fields: Sequence[str] = INPUT_FIELDS,
    key: str | None = None,
) -> DataFrame:
    """Scored rows as request-log rows; the time of the whole batch is shared evenly."""
    share = F.lit(None).cast("double")
    if total_ms is not None:
        share = F.lit(float(total_ms)) / scored.agg(F.count(F.lit(1))).scalar()
    status = F.col("status_code") if "status_code" in scored.columns else F.lit(200)
    message = F.col("error_message") if "error_message" in scored.columns else F.lit(None).cast("string")
    return scored.select(
        (F.col(key).cast("long") if key else F.lit(None).cast("long")).alias("id"),
        ts.alias("ts"),
        F.lit(endpoint).alias("endpoint"),
        F.lit("POST").alias("method"),
        F.to_json(F.struct(*[f for f in fields if f in scored.columns])).alias("input_data"),
        F.col("prediction"),
        share.alias("processing_time_ms"),
        status.alias("status_code"),
        message.alias("error_message"),
    )


def score_batch(model: PipelineModel, df: DataFrame, ts: Column, total_ms: float | None = None, key: str | None = None):
    return as_requests(score(model, df), ts, total_ms=total_ms, key=key)


def score_validated(
    model: PipelineModel, df: DataFrame, rules: RuleSet | str = BUSINESS, out: str = "prediction"
) -> DataFrame:
    """Valid rows get a prediction and status 200, invalid ones their errors and status 400.

    One pass: the prediction of an invalid row is computed with the others and dropped, which
    costs less than reading the input twice.
    """
    checked = validate(df, rules)
    predicted = model.transform(checked)
    return predicted.select(
        *checked.columns,
        F.when(F.col("is_valid"), F.col("prediction")).alias(out),
        F.when(F.col("is_valid"), F.lit(200)).otherwise(F.lit(400)).alias("status_code"),
        error_text().alias("error_message"),
    )
