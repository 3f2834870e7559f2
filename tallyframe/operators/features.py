"""Feature engineering on columns: stateless builders plus fit / apply pairs.

``fit_*`` functions read the table once and return small driver-side constants, so
``apply`` steps are plain projections that stay in one code-generated stage. The
``lazy_*`` forms keep the statistics inside the plan as a scalar subquery instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numeric import (
    category_columns,
    log1p_or_null,
    numeric_columns,
    ratio,
    right_closed_label,
    sqrt_or_null,
)
from tallyframe.operators.ordering import number_rows

# Ratio features as (numerator, denominator), in the order they are added.
HOUSEHOLD_RATIOS = {
    "bedrooms_per_household": ("total_bedrooms", "households"),
    "population_per_household": ("population", "households"),
    "rooms_per_household": ("total_rooms", "households"),
}
TRAINING_RATIOS = {
    "rooms_per_household": ("total_rooms", "households"),
    "bedrooms_per_room": ("total_bedrooms", "total_rooms"),
    "population_per_household": ("population", "households"),
}
# Right-closed bins; the last label has no upper end.
INCOME_EDGES, INCOME_LABELS = (0, 1.5, 3.0, 4.5, 6.0), ("very_low", "low", "medium", "high", "very_high")
AGE_EDGES, AGE_LABELS = (0, 10, 25, 40), ("new", "recent", "older", "old")
SKEWED = ("total_rooms", "total_bedrooms", "population", "households")
# The model input columns, in order.
EXPECTED_COLUMNS = (
    "longitude",
    "latitude",
    "housing_median_age",
    "total_rooms",
    "total_bedrooms",
    "population",
    "households",
    "median_income",
    "rooms_per_household",
    "bedrooms_per_room",
    "population_per_household",
    "ocean_proximity",
)

ROUNDING = 16 * 2.0**-52
SMALL_CATEGORY = 10_000
MAX_FLAG_COLUMNS = 1_000


def ratio_features(df: DataFrame, ratios: Mapping[str, tuple[str, str]] = HOUSEHOLD_RATIOS) -> DataFrame:
    """Add every ratio whose two inputs exist; a zero denominator gives NULL."""
    present = {n: ratio(a, b) for n, (a, b) in ratios.items() if a in df.columns and b in df.columns}
    return df.withColumns(present) if present else df


def bin_income(df: DataFrame, column: str = "median_income", out: str = "income_category") -> DataFrame:
    return df.withColumn(out, right_closed_label(column, INCOME_EDGES, INCOME_LABELS))


def bin_age(df: DataFrame, column: str = "housing_median_age", out: str = "age_category") -> DataFrame:
    return df.withColumn(out, right_closed_label(column, AGE_EDGES, AGE_LABELS))


def log1p_features(df: DataFrame, columns: Sequence[str] = SKEWED) -> DataFrame:
    return df.withColumns({f"{c}_log": log1p_or_null(c) for c in columns if c in df.columns})


def sqrt_features(df: DataFrame, columns: Sequence[str] = SKEWED) -> DataFrame:
    return df.withColumns({f"{c}_sqrt": sqrt_or_null(c) for c in columns if c in df.columns})


def poly_features(
    df: DataFrame, columns: Sequence[str] = ("median_income", "housing_median_age"), degree: int = 2
) -> DataFrame:
    """Powers 2..degree of each column on its own, without cross terms."""
    powers = {f"{c}_poly_{d}": F.pow(c, F.lit(d)) for c in columns if c in df.columns for d in range(2, degree + 1)}
    return df.withColumns(powers) if powers else df


# --- scaling -----------------------------------------------------------------------------


def _scale_stats(kind: str, c: str) -> tuple[Column, Column]:
    """Aggregates for the shift and the divisor of one column. A column that is constant, or
    constant but for the rounding of doubles, is divided by 1."""
    x = F.col(c).cast("double")
    if kind == "standard":
        shift, spread = F.avg(x), F.stddev_pop(x)
        spread = F.when(spread > ROUNDING * F.abs(shift), spread)
    elif kind == "minmax":
        shift, spread = F.min(x), F.max(x) - F.min(x)
    else:
        raise ValueError("scaler kind must be 'standard' or 'minmax'")
    return shift, F.coalesce(F.nullif(spread, F.lit(0.0)), F.lit(1.0))


def scaler_stats(df: DataFrame, columns: Sequence[str], kind: str = "standard") -> DataFrame:
    """``(column_name, shift, spread)`` from one aggregate over all columns."""
    one = df.agg(*[F.struct(*_scale_stats(kind, c)).alias(f"s{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}.col1").alias("shift"), F.col(f"s{i}.col2").alias("spread"))
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*rows)))


def fit_scaler(df: DataFrame, columns: Sequence[str], kind: str = "standard") -> dict[str, tuple[float, float]]:
    return {r["column_name"]: (r["shift"], r["spread"]) for r in scaler_stats(df, columns, kind).collect()}


def apply_scaler(df: DataFrame, stats: Mapping[str, tuple[float, float]], suffix: str = "_scaled") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


def lazy_scale(
    df: DataFrame, columns: Sequence[str], kind: str = "standard", fit_on: DataFrame | None = None
) -> DataFrame:
    """Scale with the statistics left in the plan: one scalar subquery shared by all columns."""
    stats = (fit_on or df).agg(F.struct(*[F.struct(*_scale_stats(kind, c)).alias(c) for c in columns])).scalar()
    return df.withColumns(
        {f"{c}_scaled": (F.col(c) - stats[c]["col1"]) / stats[c]["col2"] for c in columns}
    )


def scale_features(df: DataFrame, columns: Sequence[str] | None = None, kind: str = "standard", target: str | None = None):
    columns = numeric_columns(df, [target] if target else []) if columns is None else list(columns)
    return lazy_scale(df, columns, kind)


# --- categories --------------------------------------------------------------------------


def categories(df: DataFrame, column: str, cap: int, null_as: str | None = None) -> list[str] | None:
    """Sorted distinct values, or ``None`` when there are more than ``cap``."""
    value = F.coalesce(F.col(column), F.lit(null_as)) if null_as is not None else F.col(column)
    rows = df.select(value.alias("v")).where("v is not null").distinct().limit(cap + 1).collect()
    return None if len(rows) > cap else sorted(r[0] for r in rows)


def category_lists(df: DataFrame, columns: Sequence[str], cap: int) -> dict[str, list[str | None] | None]:
    """Distinct values (NULL included) of several columns from one scan, ``None`` where over ``cap``."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])
    most = (cap + 2) * len(columns)
    rows = df.select(F.inline(cells)).distinct().limit(most).collect() if columns else []
    found: dict[str, list] = {c: [] for c in columns}
    for c, v in rows:
        found[c].append(v)
    if columns and len(rows) == most:
        # Some column is far over the cap, so others may be cut short: ask for each alone.
        found = {c: [r[0] for r in df.select(c).distinct().limit(cap + 2).collect()] for c in columns}
    return {c: None if len(v) > cap + 1 else v for c, v in found.items()}


def one_hot(
    df: DataFrame,
    column: str,
    values: Sequence[str] | None = None,
    drop_first: bool = False,
    max_columns: int = MAX_FLAG_COLUMNS,
) -> DataFrame:
    """One flag column per category. ``drop_first`` gives 0/1 doubles without the alphabetically
    first category; otherwise booleans. NULL and values not seen at fit time set no flag. More categories than
    ``max_columns`` are an error, however the list was made."""
    if values is None:
        values = categories(df, column, max_columns)
    if values is None or len(values) > max_columns:
        raise ValueError(f"{column} has more than {max_columns} categories, too many for one column each")
    flags = {v: F.coalesce(F.col(column) == F.lit(v), F.lit(False)) for v in values}
    if drop_first:
        return df.withColumns({f"{column}_{v}": flags[v].cast("double") for v in list(values)[1:]})
    return df.withColumns({f"{column}_{v}": flag for v, flag in flags.items()})


def fit_label_codes(df: DataFrame, column: str, null_as: str = "nan") -> DataFrame:
    """``(category, code)``: the code is the alphabetical rank. Any number of categories works:
    a short list is ranked on the driver, a long one by range partitioning."""
    short = categories(df, column, SMALL_CATEGORY, null_as)
    if short is not None:
        rows = [(v, i) for i, v in enumerate(short)]
        return F.broadcast(df.sparkSession.createDataFrame(rows, "category string, code int"))
    distinct = df.select(F.coalesce(F.col(column), F.lit(null_as)).alias("category")).distinct()
    ranked = number_rows(distinct, [], ["category"], "code")
    return ranked.select("category", (F.col("code") - 1).cast("int").alias("code"))


def join_codes(
    df: DataFrame, column: str, codes: DataFrame, out: str | None = None, null_as: str = "nan"
) -> DataFrame:
    """Look up fitted codes; a category without one is an error."""
    out = out or f"{column}_encoded"
    key = F.coalesce(df[column], F.lit(null_as))
    known = codes.select(F.col("category").alias("_category"), F.col("code").alias("_code"))
    joined = df.join(known, key == F.col("_category"), "left")
    miss = F.raise_error(F.concat(F.lit(f"unseen category in {column}: "), key)).cast("int")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(F.col("_code"), miss).alias(out))


def label_encode(df: DataFrame, column: str, out: str | None = None, null_as: str = "nan") -> DataFrame:
    return join_codes(df, column, fit_label_codes(df, column, null_as), out, null_as)


def label_code(column: str, values: Sequence[str], null_as: str = "nan") -> Column:
    """Code of a short fitted category list as a map lookup, without a join."""
    table = F.create_map(*[F.lit(x) for i, v in enumerate(values) for x in (v, i)])
    key = F.coalesce(F.col(column), F.lit(null_as))
    return F.coalesce(
        F.try_element_at(table, key), F.raise_error(F.concat(F.lit(f"unseen category in {column}: "), key)).cast("int")
    )


# --- selection and the whole chain -------------------------------------------------------


def high_variance_columns(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> list[str]:
    if not columns:
        return []
    row = df.agg(*[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(columns)]).first()
    return [c for c, v in zip(columns, row) if v is not None and v > threshold]


def select_low_variance(df: DataFrame, target: str | None = None, threshold: float = 0.01) -> DataFrame:
    """Drop numeric columns whose population variance is not above the threshold.

    Kept: the other numeric columns, then all remaining columns, then the target.
    """
    numeric = numeric_columns(df, [target] if target else [])
    kept = high_variance_columns(df, numeric, threshold)
    other = [c for c in df.columns if c not in numeric and c != target]
    return df.select(*kept, *other, *([target] if target and target in df.columns else []))


def encode_categories(
    df: DataFrame, flags: Sequence[str] = ("ocean_proximity",), columns: Sequence[str] | None = None
) -> DataFrame:
    """One-hot for the ``flags`` columns, label codes for text columns named like a category."""
    columns = category_columns(df) if columns is None else list(columns)
    wanted = [c for c in columns if c in flags or "category" in c]
    found = category_lists(df, wanted, SMALL_CATEGORY)
    for c in wanted:
        values = found[c]
        if c in flags:
            df = one_hot(df, c, None if values is None else sorted(v for v in values if v is not None))
        elif values is None:
            df = label_encode(df, c)
        else:
            df = df.withColumn(f"{c}_encoded", label_code(c, sorted({"nan" if v is None else v for v in values})))
    return df


def engineer_features(
    df: DataFrame,
    target: str = "median_house_value",
    keep: Sequence[str] = (),
    transform: bool = True,
    scale: bool = True,
    polynomial: bool = False,
    threshold: float = 0.01,
    ratios: Mapping[str, tuple[str, str]] = HOUSEHOLD_RATIOS,
    skewed: Sequence[str] = SKEWED,
    flags: Sequence[str] = ("ocean_proximity",),
) -> DataFrame:
    """Ratios and bins, log and square root, category codes, powers, scaling, selection.

    ``keep`` names key columns that pass through untouched. Three small reads fit the chain
    (category lists, scaler statistics, variances); the result itself is one projection.
    """
    work = ratio_features(df, ratios)
    if "median_income" in df.columns:
        work = bin_income(work)
    if "housing_median_age" in df.columns:
        work = bin_age(work)
    if transform:
        work = sqrt_features(log1p_features(work, skewed), skewed)
    work = encode_categories(work, flags, [c for c in category_columns(work) if c not in keep])
    if polynomial:
        work = poly_features(work)
    numeric = [c for c in numeric_columns(work, [target]) if c not in keep]
    # The variance of a scaled column follows from its source, so one read decides for both.
    measured = work.agg(
        *[F.struct(*_scale_stats("standard", c), F.var_pop(c)).alias(f"s{i}") for i, c in enumerate(numeric)]
    ).first()
    fitted = {c: measured[i] for i, c in enumerate(numeric)}
    kept = [c for c in numeric if (fitted[c][2] or 0.0) > threshold]
    scaled = [c for c in numeric if (fitted[c][2] or 0.0) / fitted[c][1] ** 2 > threshold] if scale else []
    if scale:
        work = apply_scaler(work, {c: (fitted[c][0], fitted[c][1]) for c in scaled})
    other = [c for c in work.columns if c not in numeric and c not in keep and c != target and not c.endswith("_scaled")]
    return work.select(*keep, *kept, *[f"{c}_scaled" for c in scaled], *other, target)
