"""Table profiles. Numbers of columns do not matter: cells are stacked as rows of one scan, and pairs
of columns are summed as matrices in one more."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numeric import (
    adjusted_kurtosis,
    adjusted_skewness,
    category_columns,
    numeric_columns,
)
from tallyframe.operators.quantiles import exact_quantiles

def _lit_double(v: float | None) -> Column:
    return F.lit(v).cast("double")


def _stacked(df: DataFrame, columns: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """``column_name, value, is_null``: every cell of the columns as a row, from one scan of any width.

    ``value`` is NULL for columns that are not numeric. One more row per column, with NULL in both fields,
    keeps columns of empty tables in the result of a grouping.
    """
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")).alias("value"),
            F.col(f"`{c}`").isNull().alias("is_null"),
        )
        for c in columns
    ]
    seeds = df.sparkSession.createDataFrame([(c, None, None) for c in columns], "column_name string, value double, is_null boolean")
    return df.select(F.inline(F.array(*cells))).unionByName(seeds)


def _per_column(df: DataFrame, columns: Sequence[str], stats: dict[str, callable]) -> DataFrame:
    """One row per column holding the named aggregates of its values; the table is read once."""
    rows = _stacked(df, columns, columns)
    return rows.groupBy("column_name").agg(*[make("value").alias(stat) for stat, make in stats.items()])


SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a, b, correlation`` for every two of the columns (``a`` not after ``b``, each with itself too) over the
    rows that have both; NULL where one of them is constant there.

    Two scans at any width: one for means, one in which every task sums its centred products as small
    matrices. Only these sums, a row per pair and task, are shuffled.
    """
    columns = list(columns)
    means = _per_column(df, columns, {"mean": F.avg, "low": F.min, "high": F.max}).collect()
    centre = {r.column_name: r.low if r.low == r.high else r.mean for r in means}
    shift = np.array([centre[c] if centre[c] is not None else 0.0 for c in columns])
    first, second = np.triu_indices(len(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), len(columns), len(columns)))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float) - shift
            here = ~np.isnan(x)
            x, here = np.where(here, x, 0.0), here.astype(float)
            total += np.stack([here.T @ here, x.T @ here, here.T @ x, (x * x).T @ here, here.T @ (x * x), x.T @ x])
        arrays = [pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32)), *(pa.array(t[first, second]) for t in total)]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", *SUMS])

    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    parts = numbers.mapInArrow(run, "i int, j int, " + ", ".join(f"{s} double" for s in SUMS))
    sums = parts.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])

    def spread(squares: str, plain: str) -> Column:
        rest = F.col(squares) - F.try_divide(F.col(plain) * F.col(plain), F.col("n"))
        return F.when(rest > F.col(squares) * 1e-12, rest)  # what is left of a constant is rounding

    both = F.sqrt(spread("sxx", "sx") * spread("syy", "sy"))
    shared = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    value = F.when(F.col("i") == F.col("j"), F.when(spread("sxx", "sx").isNotNull(), 1.0)).otherwise(shared / both)
    names = F.array(*[F.lit(c) for c in columns])
    return sums.select(F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), value.alias("correlation"))


def structure(df: DataFrame) -> DataFrame:
    """Row and column counts with the type and family of every column."""
    numeric, category = set(numeric_columns(df)), set(category_columns(df))
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(i).alias("position"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit("numeric" if f.name in numeric else "categorical" if f.name in category else "other").alias(
                    "family"
                ),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.inline(rows), F.col("row_count"), F.lit(len(df.columns)).alias("column_count")
    )


def missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    counts = {f"n{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(columns)}
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()])
    total = F.lit(0).cast("long")
    for i in range(len(columns)):
        total = total + F.col(f"n{i}")
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"n{i}").alias("missing_count"),
                F.coalesce(F.try_divide(F.col(f"n{i}") * 100.0, F.col("rows")), F.lit(0.0)).alias("missing_percent"),
                (F.col(f"n{i}") > 0).alias("has_missing"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return one.select(F.inline(rows), total.alias("total_missing"))


def describe(df: DataFrame, columns: Sequence[str] | None = None, **quantile_options) -> DataFrame:
    """count, mean, std, min, quartiles, max; the quartiles are exact."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], **quantile_options)
    stats = _per_column(
        df,
        columns,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": lambda c: F.min(F.col(c).cast("double")),
            "max": lambda c: F.max(F.col(c).cast("double")),
        },
    )
    return stats.withColumns({q: _by_name(quartiles, i) for i, q in enumerate(("q25", "q50", "q75"))}).select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def _by_name(table: dict[str, list[float | None]], i: int) -> Column:
    out = F.lit(None).cast("double")
    for name, values in table.items():
        out = F.when(F.col("column_name") == name, _lit_double(values[i])).otherwise(out)
    return out


def skewness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    return _per_column(df, columns, {"skewness": adjusted_skewness}).orderBy(F.desc_nulls_last("skewness"), "column_name")


def kurtosis(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    return _per_column(df, columns, {"kurtosis": adjusted_kurtosis}).orderBy(F.desc_nulls_last("kurtosis"), "column_name")


def high_skew(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 1.0) -> DataFrame:
    return skewness(df, columns).where(F.abs("skewness") > threshold)


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full correlation matrix in long form; each pair is computed once and mirrored."""
    pairs = pair_correlations(df, list(columns or numeric_columns(df)))
    one = F.struct(F.col("a").alias("feature_1"), F.col("b").alias("feature_2"), F.col("correlation"))
    other = F.struct(F.col("b").alias("feature_1"), F.col("a").alias("feature_2"), F.col("correlation"))
    return pairs.select(F.inline(F.when(F.col("a") == F.col("b"), F.array(one)).otherwise(F.array(one, other))))


def high_correlations(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """Pairs with a strong correlation, each once, in column order."""
    pairs = pair_correlations(df, list(columns or numeric_columns(df))).where(F.col("a") != F.col("b"))
    pairs = pairs.select(F.col("a").alias("feature_1"), F.col("b").alias("feature_2"), "correlation")
    return pairs.where(F.abs("correlation") > threshold)


def target_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    pairs = pair_correlations(df, list(dict.fromkeys([*columns, target])))
    stats = pairs.where((F.col("a") == target) | (F.col("b") == target)).select(
        F.when(F.col("a") == target, F.col("b")).otherwise(F.col("a")).alias("column_name"), "correlation"
    )
    return stats.where(F.col("column_name").isin(*columns)).orderBy(F.desc_nulls_last("correlation"), "column_name")


def strong_predictors(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, threshold: float = 0.3
) -> DataFrame:
    return target_correlations(df, target, columns).where(F.abs("correlation") > threshold)


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Counts per category value; counted before the shuffle, so hot values do not matter."""
    columns = list(columns or category_columns(df))
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    return (
        df.select(F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("value_count"))
    )


def categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values and the most frequent one (ties: smallest value) per category column."""
    return (
        value_counts(df, columns)
        .groupBy("column_name")
        .agg(
            F.count(F.lit(1)).alias("unique_values"),
            F.min_by("value", F.struct(-F.col("value_count"), F.col("value"))).alias("most_frequent"),
            F.max("value_count").alias("most_frequent_count"),
        )
    )


def scaling_hints(df: DataFrame, columns: Sequence[str] | None = None, min_range: float = 1000.0) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    span = _per_column(
        df, columns, {"value_range": lambda c: F.max(F.col(c).cast("double")) - F.min(F.col(c).cast("double"))}
    )
    return span.where(F.col("value_range") > min_range).withColumn(
        "recommendation", F.lit("StandardScaler or MinMaxScaler recommended")
    )


def feature_insights(
    df: DataFrame,
    ratios: dict[str, tuple[str, str]],
    columns: Sequence[str] | None = None,
    skew_threshold: float = 1.0,
    min_range: float = 1000.0,
) -> DataFrame:
    """What could be engineered: possible ratios, columns to transform, columns to scale."""
    columns = list(columns or numeric_columns(df))
    possible = [name for name, (a, b) in ratios.items() if a in df.columns and b in df.columns]
    measured = _per_column(
        df,
        columns,
        {
            "skewness": adjusted_skewness,
            "value_range": lambda c: F.max(F.col(c).cast("double")) - F.min(F.col(c).cast("double")),
        },
    )

    def hint(kind: str, condition: Column) -> Column:
        return F.when(condition, F.struct(F.lit(kind).alias("kind"), F.col("column_name").alias("name")))

    hints = F.array(
        hint("transform", F.abs("skewness") > skew_threshold), hint("scale", F.col("value_range") > min_range)
    )
    found = measured.select(F.inline(F.array_compact(hints)))
    new = df.sparkSession.createDataFrame([("new_feature", n) for n in possible], "kind string, name string")
    return new.unionByName(found)


def variances(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.01) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    return _per_column(df, columns, {"variance": F.var_pop}).withColumn("is_low", F.col("variance") < threshold)


def boxplot(df: DataFrame, columns: Sequence[str] | None = None, reach: float = 1.5, **quantile_options) -> DataFrame:
    """Quartiles, fences at ``reach`` interquartile ranges, and the rows outside them."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], **quantile_options)
    fences = {}
    for c, (q1, _, q3) in quartiles.items():
        fences[c] = [None, None] if q1 is None else [q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)]
    stats = _per_column(
        df,
        columns,
        {
            "outliers": lambda c: F.count_if((F.col(c) < _by_name(fences, 0)) | (F.col(c) > _by_name(fences, 1)))
        },
    )
    named = {"q1": _by_name(quartiles, 0), "median": _by_name(quartiles, 1), "q3": _by_name(quartiles, 2)}
    named |= {"lower_fence": _by_name(fences, 0), "upper_fence": _by_name(fences, 1)}
    return stats.withColumns(named).select("column_name", *named, "outliers")


def full_profile(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, categories: Sequence[str] | None = None
) -> DataFrame:
    """All sections in long form ``(section, column_name, stat, value)``."""
    columns = list(columns or numeric_columns(df))
    categories = list(categories or category_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    v = F.col("value")
    moments = {
        ("describe", "count"): F.count(v),
        ("describe", "mean"): F.avg(v),
        ("describe", "std"): F.stddev_samp(v),
        ("describe", "min"): F.min(v),
        ("describe", "max"): F.max(v),
        ("distribution", "skewness"): adjusted_skewness("value"),
        ("distribution", "kurtosis"): adjusted_kurtosis("value"),
        ("distribution", "variance"): F.var_pop(v),
    }
    measured = _stacked(df, df.columns, columns).groupBy("column_name").agg(
        F.count("is_null").alias("rows"),
        F.count_if("is_null").alias("missing"),
        *[m.cast("double").alias(f"m{i}") for i, m in enumerate(moments.values())],
    )

    def cell(section: str, column: Column, stat: str, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"), column.alias("column_name"), F.lit(stat).alias("stat"), value.cast("double").alias("value")
        )

    name = F.col("column_name")
    always = [cell("missing", name, "count", F.col("missing"))]
    numbers = [cell(section, name, stat, F.col(f"m{i}")) for i, (section, stat) in enumerate(moments)]
    numbers += [cell("describe", name, stat, _by_name(quartiles, i)) for i, stat in enumerate(("q25", "q50", "q75"))]
    rows = F.when(name == df.columns[0], F.array(cell("structure", F.lit("*"), "rows", F.col("rows"))))
    nothing = F.array().cast("array<struct<section:string,column_name:string,stat:string,value:double>>")
    cells = F.concat(
        F.array(*always), F.coalesce(rows, nothing), F.when(name.isin(*columns), F.array(*numbers)).otherwise(nothing)
    )
    out = measured.select(F.inline(cells))
    own = list(dict.fromkeys([*columns, target]))
    a, b = F.col("a"), F.col("b")
    pairs = pair_correlations(df, own).where(a != b)
    listed = F.array(
        F.when(a.isin(*columns) & b.isin(*columns), F.struct(F.lit("correlation").alias("section"), a.alias("column_name"), b.alias("stat"))),
        F.when(
            (a == target) | (b == target),
            F.struct(
                F.lit("target_correlation").alias("section"),
                F.when(a == target, b).otherwise(a).alias("column_name"),
                F.lit(target).alias("stat"),
            ),
        ),
    )
    out = out.unionByName(
        pairs.select(F.explode(F.array_compact(listed)).alias("p"), "correlation").select("p.*", F.col("correlation").alias("value"))
    )
    if categories:
        counts = value_counts(df, categories).select(
            F.lit("category").alias("section"),
            "column_name",
            F.col("value").alias("stat"),
            F.col("value_count").cast("double").alias("value"),
        )
        out = out.unionByName(counts)
    return out
