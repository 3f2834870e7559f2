"""Regression metrics as plain aggregates over ``(key, actual, predicted)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numeric import adjusted_skewness

METRICS = ("mse", "rmse", "mae", "r2", "mape", "max_error")


def pair_by_key(actual: DataFrame, predicted: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return actual.join(predicted, key, "inner")


def residuals(scored: DataFrame, y: str = "y", y_hat: str = "y_hat", out: str = "residual") -> DataFrame:
    return scored.withColumn(out, F.col(y) - F.col(y_hat))


def metric_columns(y: str = "y", y_hat: str = "y_hat") -> dict[str, Column]:
    """Aggregates per metric name. Rows with ``y = 0`` have no percentage error and are left out of it."""
    e = F.col(y) - F.col(y_hat)
    mse = F.avg(e * e)
    paired = F.when(e.isNotNull(), F.col(y))
    return {
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mae": F.avg(F.abs(e)),
        "r2": 1 - F.sum(e * e) / F.nullif(F.count(e) * F.var_pop(paired), F.lit(0.0)),
        "mape": F.avg(F.abs(F.try_divide(e, F.col(y)))) * 100,
        "max_error": F.max(F.abs(e)),
    }


def evaluate(scored: DataFrame, by: Sequence[str] = (), y: str = "y", y_hat: str = "y_hat") -> DataFrame:
    return scored.groupBy(*by).agg(*[c.alias(n) for n, c in metric_columns(y, y_hat).items()])


def summary(scored: DataFrame, y: str = "y", y_hat: str = "y_hat") -> DataFrame:
    """Metrics plus spread and skew of the residuals as ``(metric, value)`` rows."""
    e = F.col(y) - F.col(y_hat)
    measures = metric_columns(y, y_hat) | {"std_residuals": F.stddev_pop(e), "skew_residuals": adjusted_skewness(e)}
    one = scored.agg(*[c.alias(n) for n, c in measures.items()])
    return one.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in measures]))
    )


def residual_histogram(scored: DataFrame, bins: int = 50, y: str = "y", y_hat: str = "y_hat") -> DataFrame:
    """Equal-width bins over the residual range, last bin closed; empty bins are absent."""
    e = residuals(scored, y, y_hat).select("residual").where(F.col("residual").isNotNull())
    ends = e.agg(F.struct(F.min("residual").alias("lo"), F.max("residual").alias("hi"))).scalar()
    width = (ends["hi"] - ends["lo"]) / F.lit(float(bins))
    place = F.floor(F.try_divide(F.col("residual") - ends["lo"], width)).cast("int")
    return (
        e.groupBy(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (ends["lo"] + F.col("bin") * width).alias("low"),
            (ends["lo"] + (F.col("bin") + 1) * width).alias("high"),
            "n",
        )
    )


def scatter_bounds(scored: DataFrame, y: str = "y") -> DataFrame:
    """Ends of the identity line of a predicted-against-actual plot."""
    return scored.agg(F.min(y).alias("line_min"), F.max(y).alias("line_max"), F.count(F.lit(1)).alias("points"))


def fold_summary(per_fold: DataFrame, metrics: Sequence[str] = ("mse", "mae", "r2")) -> DataFrame:
    """Mean and population deviation over folds; errors keep their positive sign."""
    one = per_fold.agg(
        *[x for m in metrics for x in (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))]
    )
    rows = [
        F.struct(F.lit(m).alias("metric"), F.col(f"{m}_mean").alias("mean"), F.col(f"{m}_std").alias("std")) for m in metrics
    ]
    return one.select(F.inline(F.array(*rows)))
