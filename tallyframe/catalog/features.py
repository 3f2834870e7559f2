"""Feature engineering queries over the feature table."""

from __future__ import annotations

from tallyframe.catalog.registry import over, query, r, tidy
from tallyframe.functions.numeric import ms_to_seconds
from tallyframe.functions.payload import error_class
from tallyframe.operators import features
from tallyframe.operators.validation import NUMERIC_FIELDS
from tallyframe.sources import views

HOUSEHOLD_SQL = """total_bedrooms / nullif(households, 0) AS bedrooms_per_household,
  population / nullif(households, 0) AS population_per_household, total_rooms / nullif(households, 0) AS rooms_per_household"""
INCOME_SQL = """CASE WHEN median_income <= 0 THEN NULL WHEN median_income <= 1.5 THEN 'very_low' WHEN median_income <= 3 THEN 'low'
  WHEN median_income <= 4.5 THEN 'medium' WHEN median_income <= 6 THEN 'high' WHEN median_income IS NOT NULL THEN 'very_high' END"""
AGE_SQL = """CASE WHEN housing_median_age <= 0 THEN NULL WHEN housing_median_age <= 10 THEN 'new' WHEN housing_median_age <= 25 THEN 'recent'
  WHEN housing_median_age <= 40 THEN 'older' WHEN housing_median_age IS NOT NULL THEN 'old' END"""
LOG = "CASE WHEN {c} > -1 THEN ln(1e0 + {c}) END"
CATS = ("<1H OCEAN", "INLAND", "ISLAND", "NEAR BAY", "NEAR OCEAN")


def _blocks(spark, folder, *columns):
    table = views.blocks(spark, folder)
    return table.select("block_id", *columns) if columns else table


@query("ratio_features", over("blocks", f"SELECT block_id, {HOUSEHOLD_SQL}, total_bedrooms / nullif(total_rooms, 0) AS bedrooms_per_room FROM blocks"))
def _(spark, folder):
    ratios = features.HOUSEHOLD_RATIOS | {"bedrooms_per_room": features.TRAINING_RATIOS["bedrooms_per_room"]}
    return features.ratio_features(_blocks(spark, folder), ratios).select("block_id", *ratios)


@query("bin_income", over("blocks", f"SELECT block_id, median_income, {INCOME_SQL} AS income_category FROM blocks"))
def _(spark, folder):
    return features.bin_income(_blocks(spark, folder, "median_income"))


@query("bin_age", over("blocks", f"SELECT block_id, housing_median_age, {AGE_SQL} AS age_category FROM blocks"))
def _(spark, folder):
    return features.bin_age(_blocks(spark, folder, "housing_median_age"))


@query("log1p_features", over("blocks", f"SELECT block_id, {', '.join(r(LOG.format(c=c), 9) + f' AS {c}_log' for c in (*features.SKEWED, 'median_income'))} FROM blocks"))
def _(spark, folder):
    columns = [*features.SKEWED, "median_income"]
    return tidy(features.log1p_features(_blocks(spark, folder, *columns), columns).drop(*columns), 9)


@query("sqrt_features", over("blocks", f"""SELECT block_id, {', '.join(
    r(f'CASE WHEN {c} >= 0 THEN sqrt({c}) END', 9) + f' AS {c}_sqrt' for c in (*features.SKEWED, 'median_income'))} FROM blocks"""))
def _(spark, folder):
    columns = [*features.SKEWED, "median_income"]
    return tidy(features.sqrt_features(_blocks(spark, folder, *columns), columns).drop(*columns), 9)


@query("poly_features", over("blocks", f"""SELECT block_id, {', '.join(
    r(f'pow({c}, {d})', 5) + f' AS {c}_poly_{d}' for c in ('median_income', 'housing_median_age') for d in (2, 3))} FROM blocks"""))
def _(spark, folder):
    columns = ["median_income", "housing_median_age"]
    return tidy(features.poly_features(_blocks(spark, folder, *columns), columns, 3).drop(*columns), 5)


@query("ms_to_seconds", over("requests", "SELECT id, processing_time_ms / 1000 AS processing_time_seconds FROM requests"))
def _(spark, folder):
    log = views.requests(spark, folder)
    return log.select("id", ms_to_seconds("processing_time_ms").alias("processing_time_seconds"))


@query("status_error_type", over("requests", """SELECT id, status_code,
  CASE WHEN status_code >= 500 THEN 'server_error' WHEN status_code >= 400 THEN 'client_error' END AS error_type FROM requests"""))
def _(spark, folder):
    return views.requests(spark, folder).select("id", "status_code", error_class("status_code").alias("error_type"))


NUMS = (*NUMERIC_FIELDS,)


def _scaled_sql(columns, shift: str, spread: str, table: str, keys: str) -> str:
    stats = ", ".join(f"{shift.format(c=c)} AS m_{c}, coalesce(nullif({spread.format(c=c)}, 0), 1) AS s_{c}" for c in columns)
    out = ", ".join(r(f"({c} - m_{c}) / s_{c}") + f" AS {c}_scaled" for c in columns)
    return f"+ st AS (SELECT {stats} FROM {table})\nSELECT {keys}, {out} FROM {table}, st"


@query("scale_standard", over("blocks", _scaled_sql(NUMS, "avg({c})", "stddev_pop({c})", "blocks", "block_id")))
def _(spark, folder):
    return tidy(features.lazy_scale(_blocks(spark, folder, *NUMS), NUMS, "standard").drop(*NUMS))


@query("scale_minmax", over("blocks", _scaled_sql(NUMS, "min({c})", "max({c}) - min({c})", "blocks", "block_id")))
def _(spark, folder):
    return tidy(features.lazy_scale(_blocks(spark, folder, *NUMS), NUMS, "minmax").drop(*NUMS))


@query("encode_onehot", over("blocks", f"""SELECT block_id, {', '.join(
    f'''coalesce(ocean_proximity = '{v}', false) AS "ocean_proximity_{v}"''' for v in CATS)} FROM blocks"""))
def _(spark, folder):
    return features.one_hot(_blocks(spark, folder, "ocean_proximity"), "ocean_proximity").drop("ocean_proximity")


@query("encode_onehot_drop_first", over("blocks", f"""SELECT block_id, {', '.join(
    f'''CAST(coalesce(ocean_proximity = '{v}', false) AS DOUBLE) AS "ocean_proximity_{v}"''' for v in CATS[1:])} FROM blocks"""))
def _(spark, folder):
    table = _blocks(spark, folder, "ocean_proximity")
    return features.one_hot(table, "ocean_proximity", drop_first=True).drop("ocean_proximity")




def _code_sql(c: str) -> str:
    return f"code_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT coalesce({c}, 'nan') AS v FROM labelled))"


@query("encode_label", over("blocks", f"""+ labelled AS (SELECT block_id, {INCOME_SQL} AS income_category FROM blocks), {_code_sql('income_category')}
SELECT block_id, income_category, code AS income_category_encoded FROM labelled JOIN code_income_category ON v = coalesce(income_category, 'nan')"""))
def _(spark, folder):
    table = features.bin_income(_blocks(spark, folder, "median_income")).drop("median_income")
    return features.label_encode(table, "income_category")


@query("join_codes", """WITH labelled AS (SELECT p_partkey, p_type FROM part),
  codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT p_brand AS v FROM part))
SELECT p_partkey, p_brand, code AS p_brand_encoded FROM part JOIN codes ON v = p_brand""")
def _(spark, folder):
    part = views.read_table(spark, folder, "part").select("p_partkey", "p_brand")
    return features.join_codes(part, "p_brand", features.fit_label_codes(part, "p_brand"))


_SK = features.SKEWED
_RATIO_NAMES = list(features.HOUSEHOLD_RATIOS)
_NUMERIC = [*NUMERIC_FIELDS, *_RATIO_NAMES, *[f"{c}_{k}" for k in ("log", "sqrt") for c in _SK], "income_category_encoded", "age_category_encoded"]


def engineered_sql(table: str, before: str = "") -> str:
    return over("blocks", f"""+{before}
  labelled AS (SELECT *, {HOUSEHOLD_SQL}, {INCOME_SQL} AS income_category, {AGE_SQL} AS age_category,
    {', '.join(LOG.format(c=c) + f' AS {c}_log' for c in _SK)},
    {', '.join(f'CASE WHEN {c} >= 0 THEN sqrt({c}) END AS {c}_sqrt' for c in _SK)} FROM {table}),
  {_code_sql('income_category')}, {_code_sql('age_category')},
  wide AS (SELECT labelled.*, i.code AS income_category_encoded, a.code AS age_category_encoded FROM labelled
    JOIN code_income_category i ON i.v = coalesce(income_category, 'nan') JOIN code_age_category a ON a.v = coalesce(age_category, 'nan')),
  st AS (SELECT {', '.join(f'avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}' for c in _NUMERIC)} FROM wide)
SELECT block_id, {', '.join((r(c) if not c.endswith('_encoded') else c) + f' AS {c}' for c in _NUMERIC)},
  {', '.join(r(f'({c} - m_{c}) / s_{c}') + f' AS {c}_scaled' for c in _NUMERIC)},
  ocean_proximity, income_category, age_category,
  {', '.join(f'''coalesce(ocean_proximity = '{v}', false) AS "ocean_proximity_{v}"''' for v in CATS)},
  {r('median_house_value')} AS median_house_value FROM wide, st""")


@query("engineer_features", engineered_sql("blocks"))
def _(spark, folder):
    return tidy(features.engineer_features(_blocks(spark, folder), keep=["block_id"]))
