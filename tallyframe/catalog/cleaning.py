"""Cleaning and selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.registry import over, query, r, tidy
from tallyframe.operators import cleaning, features
from tallyframe.functions.numeric import category_columns, numeric_columns
from tallyframe.operators.evaluation import pair_by_key
from tallyframe.operators.validation import NUMERIC_FIELDS
from tallyframe.sources import views

NUMERIC = list(NUMERIC_FIELDS)
ALL = "block_id, longitude, latitude, housing_median_age, total_rooms, total_bedrooms, population, households, median_income, ocean_proximity, median_house_value"
FILL = "coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM blocks)) AS {c}"


@query("split_features_target", over("blocks", """
SELECT f.*, t.median_house_value FROM (SELECT * EXCLUDE (median_house_value) FROM blocks) f
JOIN (SELECT block_id, median_house_value FROM blocks) t USING (block_id)"""))
def _(spark, folder):
    table = views.blocks(spark, folder)
    x = cleaning.features_only(table, "median_house_value")
    y = cleaning.target_only(table, "block_id", "median_house_value")
    return pair_by_key(x, y, "block_id")


@query("select_by_dtype", over("blocks", f"""
SELECT ocean_proximity, {', '.join(r(f'sum({c})', 3) + f' AS {c}' for c in ('total_rooms', 'population', 'households'))},
  count(*) AS n, 'ocean_proximity' AS categorical, 'block_id,{','.join(NUMERIC)},median_house_value' AS numeric
FROM blocks GROUP BY 1"""))
def _(spark, folder):
    table = views.blocks(spark, folder)
    numeric, categorical = numeric_columns(table), category_columns(table)
    sums = [F.sum(c).alias(c) for c in ("total_rooms", "population", "households")]
    grouped = table.groupBy(*categorical).agg(*sums, F.count(F.lit(1)).alias("n"))
    named = grouped.withColumns({"categorical": F.lit(",".join(categorical)), "numeric": F.lit(",".join(numeric))})
    return tidy(named, 3)


RATIOS_SQL = """total_rooms / nullif(households, 0) AS rooms_per_household,
  total_bedrooms / nullif(total_rooms, 0) AS bedrooms_per_room, population / nullif(households, 0) AS population_per_household"""


@query("expected_columns", over("blocks", f"""
SELECT longitude, latitude, housing_median_age, total_rooms, total_bedrooms, population, households, median_income,
  {RATIOS_SQL}, ocean_proximity FROM blocks"""))
def _(spark, folder):
    table = features.ratio_features(views.blocks(spark, folder), features.TRAINING_RATIOS)
    return cleaning.in_order(table, features.EXPECTED_COLUMNS)


@query("impute_median", over("blocks", f"SELECT block_id, {FILL.format(c='total_bedrooms')} FROM blocks"))
def _(spark, folder):
    table = views.blocks(spark, folder).select("block_id", "total_bedrooms")
    return cleaning.impute_median(table, ["total_bedrooms"])


@query("impute_median_all", over("blocks", f"""
SELECT block_id, {', '.join(FILL.format(c=c) for c in NUMERIC)}, ocean_proximity FROM blocks"""))
def _(spark, folder):
    table = views.blocks(spark, folder).drop("median_house_value")
    return cleaning.impute_median(table, exclude=["block_id"])


@query("dropna_any", over("blocks", f"""
SELECT *, (SELECT count(*) FROM blocks WHERE {' OR '.join(f'{c} IS NULL' for c in ALL.split(', '))}) AS rows_removed
FROM blocks WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ALL.split(', '))}"""))
def _(spark, folder):
    table = views.blocks(spark, folder)
    removed = cleaning.dropna_report(table).select("rows_removed").scalar()
    return cleaning.dropna_any(table).withColumn("rows_removed", removed)


@query("clip_upper", over("blocks", """
SELECT block_id, CASE WHEN median_house_value > 300000 THEN 300000e0 ELSE median_house_value END AS median_house_value FROM blocks"""))
def _(spark, folder):
    table = views.blocks(spark, folder).select("block_id", "median_house_value")
    return cleaning.clip_upper(table, "median_house_value", 300000.0)


def clean_sql(cap: float) -> str:
    return f"""+
  filled AS (SELECT * REPLACE ({FILL.format(c='total_bedrooms')}) FROM blocks),
  clean AS (SELECT * REPLACE (CASE WHEN median_house_value > {cap} THEN {cap}e0 ELSE median_house_value END AS median_house_value)
    FROM filled WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ALL.split(', '))})"""


@query("clean_table", over("blocks", clean_sql(300000) + "\nSELECT * FROM clean"))
def _(spark, folder):
    return cleaning.clean_table(views.blocks(spark, folder), cap=300000.0)


@query("coerce_numeric", """
SELECT event_id, event_type || '' AS event_type, TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value,
  TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type <> 'error' AS is_numeric FROM events""")
def _(spark, folder):
    events = views.read_table(spark, folder, "events")
    text = events.select(
        "event_id",
        "event_type",
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.get_json_object("props", "$.k").alias("k"),
    )
    return cleaning.coerce_numeric(text, ["value", "k"], "event_type")


@query("split_train_test", over("blocks", """
SELECT block_id, CASE WHEN CAST('0x' || substr(md5(CAST(block_id AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 10000 < 2000
  THEN 'test' ELSE 'train' END AS split FROM blocks"""))
def _(spark, folder):
    return cleaning.split_train_test(views.blocks(spark, folder), "block_id").select("block_id", "split")


@query("join_fit_stats", f"""
WITH s AS (SELECT avg(l_extendedprice) AS m, coalesce(nullif(stddev_pop(l_extendedprice), 0), 1) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, {r('(l_extendedprice - m) / d')} AS l_extendedprice_scaled FROM lineitem, s""")
def _(spark, folder):
    lines = views.read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return tidy(features.lazy_scale(lines, ["l_extendedprice"]).drop("l_extendedprice"))
