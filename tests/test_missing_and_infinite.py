"""NaN, infinities and item numbers."""

import math

import pytest
from pyspark.sql import functions as F

from tallyframe.functions.payload import parse_payload
from tallyframe.operators import cleaning, validation
from tallyframe.operators.quantiles import exact_quantiles
from tallyframe.sources import tables

INF, NAN = math.inf, math.nan


def expected(values, p):
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    if not known:
        return None
    pos = p * (len(known) - 1)
    low, high = known[math.floor(pos)], known[math.ceil(pos)]
    if low == -INF or low == high:
        return low
    return INF if high == INF else low + (high - low) * (pos - math.floor(pos))


CASES = {
    "nan": [float(k % 17) for k in range(300)] + [NAN] * 200,
    "inf": [float(k) for k in range(300)] + [INF] * 200,
    "both": [-INF] * 150 + [float(k * k % 101) for k in range(200)] + [INF] * 150 + [NAN, None],
    "all_inf": [INF] * 90 + [None],
    "ends": [-INF, INF],
    "none": [NAN, None, NAN],
    "one": [4.0, NAN],
}


@pytest.mark.parametrize("bracket", [1, 20, 50_000])
@pytest.mark.parametrize("case", CASES)
def test_quantiles(spark, case, bracket):
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    frame = spark.createDataFrame([(v,) for v in CASES[case]], "x double")
    got = exact_quantiles(frame, ["x"], shares, bracket_rows=bracket)["x"]
    for p, value in zip(shares, got):
        want = expected(CASES[case], p)
        assert value == want or abs(value - want) < 1e-9, (p, value, want)


def test_one_nan_leaves_the_median(spark):
    frame = spark.range(60_001).select(F.when(F.col("id") == 60_000, F.lit(NAN)).otherwise(F.col("id").cast("double")).alias("x"))
    assert cleaning.medians(frame, ["x"]) == {"x": 29_999.5}


def test_sources_turn_nan_into_null(spark, tmp_path):
    rows = spark.createDataFrame([(1, NAN, "train"), (2, 2.0, "test")], "id long, x double, split string")
    rows.write.parquet(f"{tmp_path}/t.parquet")
    assert tables.read_table(spark, str(tmp_path), "t").filter("x is null").count() == 1
    tables.save_split(rows, f"{tmp_path}/s")
    assert tables.load_split(spark, f"{tmp_path}/s").filter("x is null").count() == 1


def test_payload_nan_is_missing_and_rejected(spark):
    fields = ", ".join(f"{c} double" for c in validation.NUMERIC_FIELDS) + ", ocean_proximity string"
    text = "{" + ", ".join(f'"{c}": NaN' for c in validation.NUMERIC_FIELDS) + ', "ocean_proximity": "INLAND"}'
    parsed = spark.createDataFrame([(text,)], "t string").select(parse_payload("t", fields).alias("p")).select("p.*")
    for rules in ("strict", "business", "documented"):
        row = validation.validate(parsed, rules).first()
        assert not row.is_valid and [e.type for e in row.errors] == ["missing"] * 8


def test_checks_fail_on_nan(spark):
    frame = spark.createDataFrame([(NAN,)], "x double")
    for check in (validation.at_least(0), validation.at_most(9), validation.above(0)):
        assert frame.select(check.holds(F.col("x")).alias("ok")).first().ok is False


def block(spark, rows):
    fields = ", ".join(f"{c} double" for c in validation.NUMERIC_FIELDS)
    return spark.createDataFrame(rows, f"batch string, position int, {fields}, ocean_proximity string")


GOOD = (-122.2, 37.9, 41.0, 880.0, 129.0, 322.0, 126.0)


def test_batches_number_their_items(spark):
    rows = [("a", 1, *GOOD, 16.0, "INLAND"), ("a", 1500, *GOOD, 16.0, "INLAND"), ("b", 7, *GOOD, 3.0, "INLAND")]
    rows += [("c", k, *GOOD, 16.0, "INLAND") for k in range(3)]
    got = {r.batch: r for r in validation.validate_batches(block(spark, rows), "batch", "position", max_size=2).collect()}
    assert [w[:13] for w in got["a"].warnings] == ["Prediction 1:", "Prediction 2:"] and got["a"].is_valid
    assert got["b"].warnings == [] and got["b"].is_valid
    assert not got["c"].is_valid and got["c"].warnings == [] and got["c"].batch_size == 3


def test_requests_without_time_and_id(spark, tmp_path):
    rows = spark.createDataFrame([("predict", 1.0), ("health", 2.0)], "endpoint string, prediction double")
    for k in range(2):
        tables.append_requests(rows, f"{tmp_path}/log")
    got = spark.read.parquet(f"{tmp_path}/log")
    assert got.filter("ts is null or id is null or dt is null").count() == 0
    assert got.select("id").distinct().count() == 2
