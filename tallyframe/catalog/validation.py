"""Row validation queries over the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.registry import over, query
from tallyframe.operators import validation as val
from tallyframe.sources import views

GE, LE, GT = "Input should be greater than or equal to ", "Input should be less than or equal to ", "Input should be greater than "
ENUM = "ocean_proximity: Input should be 'NEAR BAY', '<1H OCEAN', 'INLAND', 'NEAR OCEAN' or 'ISLAND'".replace("'", "''")
MISSING = "CASE WHEN {c} IS NULL THEN '{c}: Field required'"


def _case(c: str, *checks: tuple[str, str]) -> str:
    arms = "".join(f" WHEN {bad} THEN '{c}: {text}'" for bad, text in checks)
    return MISSING.format(c=c) + arms + " END"


def _range(c: str, low, high=None, *more) -> str:
    checks = [(f"{c} < {low}", f"{GE}{low:g}")] + ([(f"{c} > {high}", f"{LE}{high:g}")] if high is not None else [])
    return _case(c, *checks, *more)


def _legal() -> str:
    return f"""CASE WHEN ocean_proximity IS NULL THEN 'ocean_proximity: Field required'
  WHEN ocean_proximity NOT IN ('NEAR BAY', '<1H OCEAN', 'INLAND', 'NEAR OCEAN', 'ISLAND') THEN '{ENUM}' END"""


def _positive(c: str, *more) -> str:
    return _case(c, (f"{c} <= 0", f"{GT}0"), *more)


BEDROOMS_STRICT = ("total_rooms >= 1 AND total_bedrooms > total_rooms", "Value error, Total bedrooms cannot exceed total rooms")
HOUSEHOLDS_STRICT = ("population >= 1 AND households > population", "Value error, Number of households cannot exceed population")
STRICT = [_range("longitude", -124.6, -114.1), _range("latitude", 32.5, 42.0), _range("housing_median_age", 0, 100), _range("total_rooms", 1)]
STRICT_TAIL = [_range("median_income", 0), _legal()]
STRICT_OWN = [*STRICT, _range("total_bedrooms", 1), _range("population", 1), _range("households", 1), *STRICT_TAIL]
STRICT_CROSS = [*STRICT, _range("total_bedrooms", 1, None, BEDROOMS_STRICT), _range("population", 1), _range("households", 1, None, HOUSEHOLDS_STRICT), *STRICT_TAIL]

BEDROOMS = ("total_rooms > 0 AND total_bedrooms > total_rooms", "Value error, total_bedrooms cannot exceed total_rooms")
SIZE_HIGH = ("population > 0 AND population / households > 20", "Value error, Average household size seems unrealistic (>20 people/household)")
SIZE_LOW = ("population > 0 AND population / households < 0.5", "Value error, Average household size seems unrealistic (<0.5 people/household)")
PLACE = [
    _range("longitude", -180, 180, ("longitude NOT BETWEEN -124.5 AND -114.0", "Value error, Longitude should be within California bounds (-124.5 to -114.0)")),
    _range("latitude", -90, 90, ("latitude NOT BETWEEN 32.0 AND 42.0", "Value error, Latitude should be within California bounds (32.0 to 42.0)")),
    _range("housing_median_age", 0, 100),
    _positive("total_rooms"),
]
BUSINESS_OWN = [*PLACE, _positive("total_bedrooms"), _positive("population"), _positive("households"), _positive("median_income"), _legal()]
BUSINESS = [*PLACE, _positive("total_bedrooms", BEDROOMS), _positive("population"), _positive("households", SIZE_HIGH, SIZE_LOW), _positive("median_income"), _legal()]
DOCUMENTED = [
    _range("longitude", -124.48, -114.13), _range("latitude", 32.53, 42.01), _range("housing_median_age", 1, 52), _range("total_rooms", 1, 50000),
    _range("total_bedrooms", 1, 10000), _range("population", 1, 50000), _range("households", 1, 10000), _range("median_income", 0.5, 15), _legal(),
]


def _errors(cases: list[str]) -> str:
    return "concat_ws('; ', " + ",\n  ".join(cases) + ")"


def business_errors() -> str:
    """SQL text of a row's errors under the business rules; empty for a valid row."""
    return _errors(BUSINESS)


def _rows_sql(cases: list[str]) -> str:
    return over("blocks", f"""+ e AS (SELECT block_id, {_errors(cases)} AS t FROM blocks)
SELECT block_id, t = '' AS is_valid, t AS errors FROM e""")


def _rows(spark, folder, rules):
    checked = val.validate(views.blocks(spark, folder), rules, warn=False)
    return checked.select("block_id", "is_valid", F.coalesce(val.error_text("errors", ""), F.lit("")).alias("errors"))


@query("val_strict", _rows_sql(STRICT_OWN))
def _(spark, folder):
    return _rows(spark, folder, val.STRICT.without_cross())


@query("val_strict_cross", _rows_sql(STRICT_CROSS))
def _(spark, folder):
    return _rows(spark, folder, val.STRICT)


@query("val_business", _rows_sql(BUSINESS_OWN))
def _(spark, folder):
    return _rows(spark, folder, val.BUSINESS.without_cross())


@query("val_business_cross", _rows_sql(BUSINESS))
def _(spark, folder):
    return _rows(spark, folder, val.BUSINESS)


@query("val_documented", _rows_sql(DOCUMENTED))
def _(spark, folder):
    return _rows(spark, folder, val.DOCUMENTED)


@query("val_required_fields", over("blocks", f"""SELECT block_id, {' AND '.join(f'{c} IS NOT NULL' for c in val.NUMERIC_FIELDS)}
  AND coalesce(ocean_proximity IN ('NEAR BAY', '<1H OCEAN', 'INLAND', 'NEAR OCEAN', 'ISLAND'), false) AS ok FROM blocks"""))
def _(spark, folder):
    table = views.blocks(spark, folder)
    return table.select("block_id", val.required_fields_ok(table).alias("ok"))


WARN = """concat_ws('|', CASE WHEN median_income > 15 THEN 'High median income detected - ensure data quality' END,
  CASE WHEN housing_median_age > 50 THEN 'Very old housing detected - prediction may be less accurate' END,
  CASE WHEN total_rooms / nullif(households, 0) > 10 THEN 'High rooms per household ratio - verify data accuracy' END)"""


@query("val_warnings", over("blocks", f"""SELECT block_id, {WARN} AS warnings FROM blocks WHERE {_errors(BUSINESS)} = ''"""))
def _(spark, folder):
    checked = val.validate(views.blocks(spark, folder)).where("is_valid")
    return checked.select("block_id", F.concat_ws("|", "warnings").alias("warnings"))


@query("val_error_report", over("blocks", f"""+ e AS (SELECT block_id, {_errors(STRICT_CROSS)} AS t FROM blocks)
SELECT block_id, 'Input validation failed: ' || t AS message FROM e WHERE t <> ''"""))
def _(spark, folder):
    checked = val.validate(views.blocks(spark, folder), val.STRICT, warn=False)
    return checked.where("not is_valid").select("block_id", val.error_text().alias("message"))


def _types(cases: list[str]) -> str:
    rows = "\nUNION ALL ".join(f"SELECT {c} AS t FROM blocks" for c in cases)
    return f"""+ e AS ({rows}), p AS (SELECT split_part(t, ': ', 1) AS field, substr(t, strpos(t, ': ') + 2) AS m FROM e WHERE t IS NOT NULL)
SELECT field, CASE WHEN m = 'Field required' THEN 'missing' WHEN m LIKE 'Value error%' THEN 'value_error'
  WHEN m LIKE 'Input should be greater than or equal%' THEN 'greater_than_equal' WHEN m LIKE 'Input should be less than or equal%' THEN 'less_than_equal'
  WHEN m LIKE 'Input should be greater than%' THEN 'greater_than' ELSE 'enum' END AS type, count(*) AS failures FROM p GROUP BY 1, 2"""


@query("val_rule_counts", over("blocks", _types(BUSINESS)))
def _(spark, folder):
    return val.rule_counts(val.validate(views.blocks(spark, folder), val.BUSINESS, warn=False))


@query("val_batch", over("blocks", f"""+
  items AS (SELECT block_id, block_id // 7 AS batch, block_id % 7 + 1 AS item, {_errors(BUSINESS)} = '' AS ok, {WARN} AS w FROM blocks),
  texts AS (SELECT batch, item, generate_subscripts(string_split(w, '|'), 1) AS no, unnest(string_split(w, '|')) AS t FROM items WHERE ok AND w <> ''),
  lists AS (SELECT batch, string_agg('Prediction ' || item || ': ' || t, '|' ORDER BY item, no) AS warnings FROM texts GROUP BY 1),
  sizes AS (SELECT batch, count(*) AS batch_size, count(*) FILTER (WHERE NOT ok) AS invalid_items FROM items GROUP BY 1)
SELECT batch, batch_size, invalid_items, invalid_items = 0 AND batch_size <= 1000 AS is_valid,
  CASE WHEN invalid_items = 0 AND batch_size <= 1000 THEN coalesce(warnings, '') ELSE '' END AS warnings FROM sizes LEFT JOIN lists USING (batch)"""))
def _(spark, folder):
    """Batches of seven rows with neighbouring keys."""
    table = views.blocks(spark, folder)
    table = table.withColumn("batch", F.floor(F.col("block_id") / 7)).withColumn("item", F.col("block_id") % 7 + 1)
    out = val.validate_batches(table, "batch", "item")
    return out.drop("size_error").withColumn("warnings", F.concat_ws("|", "warnings"))
