"""Cleaning, column selection and deterministic splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.numeric import as_number, capped, numeric_columns
from tallyframe.operators.quantiles import exact_quantiles


def nan_as_null(df: DataFrame) -> DataFrame:
    """Missing values have one form, NULL. Apply once, where data comes in."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def features_only(df: DataFrame, target: str) -> DataFrame:
    return df.drop(target)


def target_only(df: DataFrame, key: str, target: str) -> DataFrame:
    return df.select(key, target)


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project to a fixed column list; a missing column is an analysis error."""
    return df.select(*columns)


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}


def fill_constants(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None})


def impute_median(df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Fill NULL by the column's exact median; all numeric columns if none are named."""
    columns = numeric_columns(df, exclude) if columns is None else list(columns)
    return fill_constants(df, medians(df, columns))


def dropna_any(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(columns) if columns else None)


def dropna_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows before, rows kept, rows removed."""
    missing = [F.col(c).isNull() for c in (columns or df.columns)]
    bad = missing[0]
    for m in missing[1:]:
        bad = bad | m
    out = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(~bad).alias("rows_kept"))
    return out.withColumn("rows_removed", F.col("rows_before") - F.col("rows_kept"))


def clip_upper(df: DataFrame, column: str, cap: float = 500000.0) -> DataFrame:
    return df.withColumn(column, capped(column, cap))


def clean_table(
    df: DataFrame,
    impute: Sequence[str] = ("total_bedrooms",),
    target: str | None = "median_house_value",
    cap: float = 500000.0,
) -> DataFrame:
    """Impute, drop incomplete rows, cap the target. One extra pass over the imputed columns only."""
    out = dropna_any(impute_median(df, impute))
    return clip_upper(out, target, cap) if target and target in df.columns else out


def coerce_numeric(
    df: DataFrame,
    numeric: Sequence[str],
    category: str | None = None,
    ok: str = "is_numeric",
) -> DataFrame:
    """Numbers held as text to double; ``ok`` tells whether every field of the row could be read."""
    good = F.lit(True)
    for c in numeric:
        good = good & F.col(c).cast("string").try_cast("double").isNotNull()
    casts: dict[str, Column] = {ok: good}
    casts.update({c: as_number(F.col(c).cast("string")) for c in numeric})
    if category:
        casts[category] = F.col(category).cast("string")
    return df.withColumns(casts)


def hash_bucket(key: Column | str, seed: int = 42, buckets: int = 100) -> Column:
    """Bucket of a row key that any engine with md5 can reproduce, whatever the partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets


def split_train_test(
    df: DataFrame, key: Column | str, test_size: float = 0.2, seed: int = 42, out: str = "split"
) -> DataFrame:
    """Label rows ``train`` or ``test``; no shuffle, and a rerun labels every row alike."""
    is_test = hash_bucket(key, seed, 10_000) < int(round(test_size * 10_000))
    return df.withColumn(out, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def fold_of(key: Column | str, folds: int = 5, seed: int = 42) -> Column:
    return hash_bucket(key, seed, folds).cast("int")
