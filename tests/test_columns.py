import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.functions.payload import parse_payload
from tallyframe.functions import numeric as num
from tallyframe.functions import payload, timing
from tallyframe.operators import cleaning, features


def values(spark, data, ddl, make):
    return [r[0] for r in spark.createDataFrame([(x,) for x in data], ddl).select(make(F.col("x"))).collect()]


def test_income_bin_edges(spark):
    data = [-1.0, 0.0, 1.5, 1.5000001, 3.0, 4.5, 6.0, 99.0, None]
    got = values(spark, data, "x double", lambda c: num.right_closed_label(c, features.INCOME_EDGES, features.INCOME_LABELS))
    assert got == [None, None, "very_low", "low", "low", "medium", "high", "very_high", None]


def test_age_bin_edges(spark):
    data = [0.0, 10.0, 10.5, 25.0, 40.0, 41.0]
    got = values(spark, data, "x double", lambda c: num.right_closed_label(c, features.AGE_EDGES, features.AGE_LABELS))
    assert got == [None, "new", "recent", "recent", "older", "old"]


def test_bins_agree_with_pandas(spark):
    data = [0.1 * i - 0.5 for i in range(90)]
    got = values(spark, data, "x double", lambda c: num.right_closed_label(c, features.INCOME_EDGES, features.INCOME_LABELS))
    want = pd.cut(pd.Series(data), [0, 1.5, 3, 4.5, 6, math.inf], labels=list(features.INCOME_LABELS))
    assert got == [None if pd.isna(v) else v for v in want]


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 2.0), (None, 2.0)], "total_rooms double, households double")
    assert [r.rooms_per_household for r in features.ratio_features(df).collect()] == [None, 2.5, None]


def test_log_and_sqrt_outside_domain(spark):
    assert values(spark, [-1.0, -2.0, 0.0, None], "x double", num.log1p_or_null) == [None, None, 0.0, None]
    assert values(spark, [-1.0, 4.0, None], "x double", num.sqrt_or_null) == [None, 2.0, None]


def test_cap_keeps_null(spark):
    assert values(spark, [1.0, 9.0, None], "x double", lambda c: num.capped(c, 5)) == [1.0, 5.0, None]


def test_text_numbers(spark):
    assert values(spark, ["abc", "12abc", "1e3", None, "nan"], "x string", num.as_number) == [None, None, 1000.0, None, None]


def test_rounding_half_away(spark):
    assert values(spark, [0.125, -0.125, 2.5], "x double", lambda c: num.round_to(c, 2)) == [0.13, -0.13, 2.5]


def test_error_classes(spark):
    got = values(spark, [200, 399, 400, 499, 500, None], "x int", payload.error_class)
    assert got == [None, None, "client_error", "client_error", "server_error", None]


def test_broken_payload_is_an_empty_record(spark):
    got = values(spark, ['{"a": 1}', "{bad", None], "x string", lambda c: payload.parse_payload(c, "a int, b string"))
    assert [tuple(g) for g in got] == [(1, None), (None, None), (None, None)]


def test_ticks_are_left_open(spark):
    df = spark.sql("SELECT explode(array(TIMESTAMP_NTZ'2024-01-01 00:05:00', TIMESTAMP_NTZ'2024-01-01 00:05:00.000001')) AS ts")
    got = [r[0] for r in df.select(timing.at_second(timing.tick_after("ts", 300)).cast("string")).collect()]
    assert got == ["2024-01-01 00:05:00", "2024-01-01 00:10:00"]


def test_moments_match_pandas(spark):
    data = [1.0, 2.0, 2.5, 8.0, 9.5, None, 30.0]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    got = df.agg(num.adjusted_skewness("x"), num.adjusted_kurtosis("x")).first()
    s = pd.Series(data, dtype=float)
    assert got[0] == pytest.approx(s.skew()) and got[1] == pytest.approx(s.kurtosis())


@pytest.mark.parametrize("data", [[], [1.0], [1.0, 2.0], [5.0] * 6, [None, None]])
def test_moments_of_degenerate_columns(spark, data):
    df = spark.createDataFrame([(x,) for x in data], "x double")
    skew, kurt, corr = df.agg(num.adjusted_skewness("x"), num.adjusted_kurtosis("x"), num.pairwise_corr("x", "x")).first()
    assert skew is None and kurt is None
    assert corr is None or len(set(data)) > 1


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None)], "x double, s string")
    assert [tuple(r) for r in cleaning.nan_as_null(df).collect()] == [(None, "a"), (1.0, None)]


def test_median_fill_clean_and_report(spark):
    rows = [(1.0, 600000.0, "a"), (None, 100.0, "b"), (3.0, None, "c"), (4.0, 5.0, None)]
    df = spark.createDataFrame(rows, "total_bedrooms double, median_house_value double, s string")
    clean = [tuple(r) for r in cleaning.clean_table(df).collect()]
    assert clean == [(1.0, 500000.0, "a"), (3.0, 100.0, "b")]
    assert tuple(cleaning.dropna_report(df).first()) == (4, 1, 3)


def test_coerce_flags_bad_rows(spark):
    df = spark.createDataFrame([("1.5", "x"), ("oops", "y"), (None, "z")], "v string, c string")
    got = [(r.v, r.is_numeric) for r in cleaning.coerce_numeric(df, ["v"], "c").collect()]
    assert got == [(1.5, True), (None, False), (None, False)]


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000)
    a = {r.id: r.split for r in cleaning.split_train_test(df, "id").collect()}
    b = {r.id: r.split for r in cleaning.split_train_test(df.repartition(7), "id").collect()}
    share = sum(v == "test" for v in a.values()) / len(a)
    assert a == b and 0.17 < share < 0.23


def test_wide_payloads_are_parsed_in_one_plan(spark):
    """The expression grows with the number of fields, not with a power of it."""
    names = [f"n{i}" for i in range(60)]
    schema = ", ".join(f"{n} double" for n in names) + ", `a.b` string"
    rows = ['{"n0": 1.5, "n1": "NaN", "n59": 2, "a.b": "x"}', "{broken", None, "{}"]
    frame = spark.createDataFrame([(t,) for t in rows], "t string")
    got = frame.select(parse_payload("t", schema).alias("p")).select("p.n0", "p.n1", "p.n59", F.col("p")["a.b"]).collect()
    assert [tuple(r) for r in got] == [(1.5, None, 2.0, "x")] + [(None, None, None, None)] * 3
