"""Profiling queries, over line items and over the feature table."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.catalog.registry import over, query, r, tidy
from tallyframe.operators import profiling
from tallyframe.operators.features import HOUSEHOLD_RATIOS, scaler_stats, select_low_variance
from tallyframe.operators.validation import NUMERIC_FIELDS
from tallyframe.sources import views

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BLOCK = [*NUMERIC_FIELDS, "median_house_value"]


def _lines(spark, folder):
    return views.read_table(spark, folder, "lineitem").select(*LINE, "l_returnflag", "l_linestatus")


def _stack(selects: list[str]) -> str:
    return "\nUNION ALL ".join(selects)


LINE_TYPES = [(c, "double", "numeric") for c in LINE] + [(c, "string", "categorical") for c in ("l_returnflag", "l_linestatus")]


@query("prof_structure", _stack([
    f"SELECT '{c}' AS column_name, {i} AS position, '{t}' AS data_type, '{f}' AS family, count(*) AS row_count, 6 AS column_count FROM lineitem"
    for i, (c, t, f) in enumerate(LINE_TYPES)]))
def _(spark, folder):
    return profiling.structure(_lines(spark, folder))


_ALL_BLOCK = ["block_id", *NUMERIC_FIELDS, "ocean_proximity", "median_house_value"]


@query("prof_missing", over("blocks", "+ m AS (" + _stack([
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, count(*) AS n FROM blocks" for c in _ALL_BLOCK]) + f""")
SELECT column_name, missing_count, {r('missing_count * 100e0 / n')} AS missing_percent, missing_count > 0 AS has_missing,
  CAST((SELECT sum(missing_count) FROM m) AS BIGINT) AS total_missing FROM m"""))
def _(spark, folder):
    return tidy(profiling.missing(views.blocks(spark, folder).select(*_ALL_BLOCK)))


def _describe_sql(c: str, table: str) -> str:
    return f"""SELECT '{c}' AS column_name, count({c}) AS count, {r(f'avg({c})', 4)} AS mean, {r(f'stddev_samp({c})', 4)} AS std,
  {r(f'min({c})', 4)} AS min, {r(f'quantile_cont({c}, 0.25)', 4)} AS q25, {r(f'quantile_cont({c}, 0.5)', 4)} AS q50,
  {r(f'quantile_cont({c}, 0.75)', 4)} AS q75, {r(f'max({c})', 4)} AS max FROM {table}"""


@query("prof_describe", _stack([_describe_sql(c, "lineitem") for c in LINE]))
def _(spark, folder):
    return tidy(profiling.describe(_lines(spark, folder), LINE), 4)


@query("prof_skewness", _stack([f"SELECT '{c}' AS column_name, {r(f'skewness({c})')} AS skewness FROM lineitem" for c in LINE]))
def _(spark, folder):
    return tidy(profiling.skewness(_lines(spark, folder), LINE))


@query("prof_kurtosis", _stack([f"SELECT '{c}' AS column_name, {r(f'kurtosis({c})')} AS kurtosis FROM lineitem" for c in LINE]))
def _(spark, folder):
    return tidy(profiling.kurtosis(_lines(spark, folder), LINE))


@query("prof_high_skew", over("blocks", "+ s AS (" + _stack([
    f"SELECT '{c}' AS column_name, skewness({c}) AS s FROM blocks" for c in BLOCK]) + f""")
SELECT column_name, {r('s')} AS skewness FROM s WHERE abs(s) > 0.1"""))
def _(spark, folder):
    return tidy(profiling.high_skew(views.blocks(spark, folder), BLOCK, 0.1))


@query("sorted_stats", over("blocks", "+ s AS (" + _stack([
    f"SELECT '{c}' AS column_name, {r(f'skewness({c})')} AS s, {r(f'kurtosis({c})')} AS k FROM blocks" for c in BLOCK]) + """)
SELECT 'skewness' AS statistic, column_name, s AS value, row_number() OVER (ORDER BY s DESC NULLS LAST, column_name) AS place FROM s
UNION ALL SELECT 'kurtosis', column_name, k, row_number() OVER (ORDER BY k DESC NULLS LAST, column_name) FROM s"""))
def _(spark, folder):
    """Both sorted lists with the place of each column; the lists have one row per column.
    Rounded before ranking, so that two columns with the same shape tie in every engine."""
    table = views.blocks(spark, folder)
    out = None
    for name, fn in (("skewness", profiling.skewness), ("kurtosis", profiling.kurtosis)):
        part = tidy(fn(table, BLOCK).select(F.lit(name).alias("statistic"), "column_name", F.col(name).alias("value")))
        order = Window.partitionBy("statistic").orderBy(F.desc_nulls_last("value"), "column_name")
        part = part.withColumn("place", F.row_number().over(order).cast("long"))
        out = part if out is None else out.unionByName(part)
    return out


def _corr(a: str, b: str) -> str:
    return f"regr_sxy({a}, {b}) / nullif(sqrt(regr_sxx({a}, {b}) * regr_syy({a}, {b})), 0)"


def _corr_rows(columns: list[str], table: str) -> str:
    rows = [f"SELECT '{x}' AS feature_1, '{y}' AS feature_2, {_corr(a, b)} AS c FROM {table}"
            for a, b in combinations(columns, 2) for x, y in ((a, b), (b, a))]
    rows += [f"SELECT '{c}', '{c}', CASE WHEN var_pop({c}) > 0 THEN 1e0 END FROM {table}" for c in columns]
    return _stack(rows)


@query("prof_corr_matrix", f"WITH m AS ({_corr_rows(LINE, 'lineitem')}) SELECT feature_1, feature_2, {r('c')} AS correlation FROM m")
def _(spark, folder):
    return tidy(profiling.correlations(_lines(spark, folder), LINE))


@query("prof_high_corr", over("blocks", "+ m AS (" + _stack([
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {_corr(a, b)} AS c FROM blocks" for a, b in combinations(BLOCK, 2)]) + f""")
SELECT feature_1, feature_2, {r('c')} AS correlation FROM m WHERE abs(c) > 0.7"""))
def _(spark, folder):
    return tidy(profiling.high_correlations(views.blocks(spark, folder), BLOCK))


_TARGET_ROWS = "+ m AS (" + _stack([
    f"SELECT '{c}' AS column_name, {_corr(c, 'total_rooms')} AS c FROM blocks" for c in BLOCK if c != "total_rooms"]
    + ["SELECT 'total_rooms', CASE WHEN var_pop(total_rooms) > 0 THEN 1e0 END FROM blocks"]) + ")"


@query("prof_target_corr", over("blocks", _TARGET_ROWS + f"\nSELECT column_name, {r('c')} AS correlation FROM m"))
def _(spark, folder):
    return tidy(profiling.target_correlations(views.blocks(spark, folder), "total_rooms", BLOCK))


@query("prof_strong_predictors", over("blocks", _TARGET_ROWS + f"\nSELECT column_name, {r('c')} AS correlation FROM m WHERE abs(c) > 0.3"))
def _(spark, folder):
    return tidy(profiling.strong_predictors(views.blocks(spark, folder), "total_rooms", BLOCK))


_COUNTS = _stack([f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS value_count FROM lineitem WHERE {c} IS NOT NULL GROUP BY 2"
                  for c in ("l_returnflag", "l_linestatus")])


@query("prof_value_counts", _COUNTS)
def _(spark, folder):
    return profiling.value_counts(_lines(spark, folder))


@query("prof_categorical", f"""
WITH c AS ({_COUNTS}), o AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY value_count DESC, value) AS no,
  count(*) OVER (PARTITION BY column_name) AS n FROM c)
SELECT column_name, n AS unique_values, value AS most_frequent, value_count AS most_frequent_count FROM o WHERE no = 1""")
def _(spark, folder):
    return profiling.categorical(_lines(spark, folder))


@query("prof_scaling_hint", "WITH w AS (" + _stack([
    f"SELECT '{c}' AS column_name, max({c}) - min({c}) AS w FROM lineitem" for c in LINE]) + f""")
SELECT column_name, {r('w')} AS value_range, 'StandardScaler or MinMaxScaler recommended' AS recommendation FROM w WHERE w > 1000""")
def _(spark, folder):
    return tidy(profiling.scaling_hints(_lines(spark, folder), LINE))


@query("prof_feature_insights", over("blocks", "+ s AS (" + _stack([
    f"SELECT '{c}' AS name, skewness({c}) AS k, max({c}) - min({c}) AS w FROM blocks" for c in BLOCK]) + """)
SELECT 'new_feature' AS kind, unnest(['bedrooms_per_household', 'population_per_household', 'rooms_per_household']) AS name
UNION ALL SELECT 'transform', name FROM s WHERE abs(k) > 0.1
UNION ALL SELECT 'scale', name FROM s WHERE w > 1000"""))
def _(spark, folder):
    return profiling.feature_insights(views.blocks(spark, folder), HOUSEHOLD_RATIOS, BLOCK, 0.1)


@query("prof_variance", "WITH v AS (" + _stack([
    f"SELECT '{c}' AS column_name, var_pop({c}) AS v FROM lineitem" for c in LINE]) + f""")
SELECT column_name, {r('v', 3)} AS variance, v < 0.01 AS is_low FROM v""")
def _(spark, folder):
    return tidy(profiling.variances(_lines(spark, folder), LINE), 3)


_QUARTILES = _stack([
    f"SELECT '{c}' AS column_name, quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.5) AS m, quantile_cont({c}, 0.75) AS b FROM blocks"
    for c in BLOCK])
_OUTSIDE = _stack([
    f"SELECT '{c}' AS column_name, count(*) AS outliers FROM blocks, q WHERE q.column_name = '{c}' "
    f"AND ({c} < a - 1.5e0 * (b - a) OR {c} > b + 1.5e0 * (b - a))"
    for c in BLOCK])


@query("prof_boxplot", over("blocks", f"""+ q AS ({_QUARTILES}), o AS ({_OUTSIDE})
SELECT column_name, {r('a')} AS q1, {r('m')} AS median, {r('b')} AS q3, {r('a - 1.5e0 * (b - a)')} AS lower_fence,
  {r('b + 1.5e0 * (b - a)')} AS upper_fence, outliers FROM q JOIN o USING (column_name)"""))
def _(spark, folder):
    return tidy(profiling.boxplot(views.blocks(spark, folder), BLOCK))


_FULL = [f"SELECT 'structure' AS section, '*' AS column_name, 'rows' AS stat, CAST(count(*) AS DOUBLE) AS v FROM lineitem"]
_FULL += [f"SELECT 'missing', '{c}', 'count', CAST(count(*) - count({c}) AS DOUBLE) FROM lineitem" for c in [*LINE, "l_returnflag", "l_linestatus"]]
for _c in LINE:
    for _stat, _x in (("count", f"CAST(count({_c}) AS DOUBLE)"), ("mean", f"avg({_c})"), ("std", f"stddev_samp({_c})"), ("min", f"min({_c})"),
                      ("max", f"max({_c})"), ("q25", f"quantile_cont({_c}, 0.25)"), ("q50", f"quantile_cont({_c}, 0.5)"), ("q75", f"quantile_cont({_c}, 0.75)")):
        _FULL.append(f"SELECT 'describe', '{_c}', '{_stat}', {_x} FROM lineitem")
    for _stat, _x in (("skewness", f"skewness({_c})"), ("kurtosis", f"kurtosis({_c})"), ("variance", f"var_pop({_c})")):
        _FULL.append(f"SELECT 'distribution', '{_c}', '{_stat}', {_x} FROM lineitem")
    if _c != "l_extendedprice":
        _FULL.append(f"SELECT 'target_correlation', '{_c}', 'l_extendedprice', {_corr(_c, 'l_extendedprice')} FROM lineitem")
_FULL += [f"SELECT 'correlation', '{a}', '{b}', {_corr(a, b)} FROM lineitem" for a, b in combinations(LINE, 2)]
_FULL += [f"SELECT 'category', '{c}', {c}, CAST(count(*) AS DOUBLE) FROM lineitem GROUP BY {c}" for c in ("l_returnflag", "l_linestatus")]
FULL_SQL = f"WITH p AS ({_stack(_FULL)}) SELECT section, column_name, stat, {r('v', 3)} AS value FROM p"


@query("prof_full", FULL_SQL)
def _(spark, folder):
    return tidy(profiling.full_profile(_lines(spark, folder), "l_extendedprice", LINE), 3)


@query("select_low_variance", """
SELECT l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_tax + 0e0 AS l_tax FROM lineitem""")
def _(spark, folder):
    """The discount goes (variance below 0.01); the tax stays as the target."""
    return tidy(select_low_variance(_lines(spark, folder), "l_tax"), 2)


@query("fit_standard", _stack([
    f"SELECT '{c}' AS column_name, {r(f'avg({c})', 4)} AS shift, {r(f'coalesce(nullif(stddev_pop({c}), 0), 1)', 4)} AS spread FROM lineitem" for c in LINE]))
def _(spark, folder):
    return tidy(scaler_stats(_lines(spark, folder), LINE, "standard"), 4)


@query("fit_minmax", _stack([
    f"SELECT '{c}' AS column_name, {r(f'min({c})')} AS shift, {r(f'coalesce(nullif(max({c}) - min({c}), 0), 1)')} AS spread FROM lineitem" for c in LINE]))
def _(spark, folder):
    return tidy(scaler_stats(_lines(spark, folder), LINE, "minmax"))
