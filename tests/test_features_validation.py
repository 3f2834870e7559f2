import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import features as feat
from tallyframe.operators import validation as val

COLUMNS = [*val.NUMERIC_FIELDS, val.CATEGORY_FIELD]
VALID = (-122.23, 37.88, 41.0, 880.0, 129.0, 322.0, 126.0, 8.3252, "NEAR BAY")
DDL = ", ".join(f"{c} double" for c in val.NUMERIC_FIELDS) + f", {val.CATEGORY_FIELD} string"


def errors(spark, rules, **changes):
    row = dict(zip(COLUMNS, VALID)) | changes
    df = spark.createDataFrame([tuple(row[c] for c in COLUMNS)], DDL)
    return val.validate(df, rules).first()


def fields(row):
    return [e.field for e in row.errors]


@pytest.mark.parametrize("rules", ["strict", "business", "documented"])
def test_valid_record(spark, rules):
    row = errors(spark, rules)
    assert row.is_valid and row.errors == [] and row.warnings == []


def test_invalid_record_in_field_order(spark):
    bad = {"longitude": -200.0, "total_bedrooms": 1000.0, "median_income": -5.0, "ocean_proximity": "INVALID"}
    row = errors(spark, "business", **bad)
    assert fields(row) == ["longitude", "total_bedrooms", "median_income", "ocean_proximity"]
    assert row.errors[0].type == "greater_than_equal" and row.errors[1].type == "value_error"
    assert row.warnings == []


def test_cross_rule_needs_a_valid_partner(spark):
    assert fields(errors(spark, "business", total_rooms=0.0, total_bedrooms=5.0)) == ["total_rooms"]


@pytest.mark.parametrize("ratio,ok", [(0.4, False), (0.5, True), (20.0, True), (20.1, False)])
def test_household_size(spark, ratio, ok):
    row = errors(spark, "business", population=ratio * 100, households=100.0)
    assert row.is_valid == ok and fields(row) == ([] if ok else ["households"])


def test_more_households_than_people(spark):
    assert fields(errors(spark, "strict", population=100.0, households=101.0)) == ["households"]
    assert errors(spark, val.STRICT.without_cross(), population=100.0, households=101.0).is_valid


def test_range_goes_before_custom_rule(spark):
    row = errors(spark, "business", latitude=95.0)
    assert [e.type for e in row.errors] == ["less_than_equal"]
    assert [e.type for e in errors(spark, "business", latitude=50.0).errors] == ["value_error"]


def test_all_warnings(spark):
    row = errors(spark, "business", median_income=16.0, housing_median_age=51.0, total_rooms=1386.0, households=126.0)
    assert len(row.warnings) == 3


def test_missing_column_and_null(spark):
    df = spark.createDataFrame([VALID[:-1]], ", ".join(f"{c} double" for c in val.NUMERIC_FIELDS))
    assert [e.type for e in val.validate(df).first().errors] == ["missing"]
    assert not df.select(val.required_fields_ok(df)).first()[0]
    assert [e.type for e in errors(spark, "strict", total_bedrooms=None).errors] == ["missing"]


def test_error_text(spark):
    row = errors(spark, "strict", latitude=10.0)
    df = spark.createDataFrame([(row.errors,)], f"errors {val.ERROR_TYPE}")
    assert df.select(val.error_text()).first()[0] == (
        "Input validation failed: latitude: Input should be greater than or equal to 32.5"
    )


def batches(spark, sizes, bad=()):
    rows = []
    for b, n in enumerate(sizes):
        for i in range(1, n + 1):
            values = dict(zip(COLUMNS, VALID)) | ({"latitude": 0.0} if (b, i) in bad else {"median_income": 16.0})
            rows.append((b, i, *[values[c] for c in COLUMNS]))
    return spark.createDataFrame(rows, f"batch int, item int, {DDL}")


def test_batch_limits_and_numbered_warnings(spark):
    out = {r.batch: r for r in val.validate_batches(batches(spark, [3, 1001, 12], {(2, 5)}), "batch", "item").collect()}
    assert out[0].is_valid and [w.split(":")[0] for w in out[0].warnings] == ["Prediction 1", "Prediction 2", "Prediction 3"]
    assert not out[1].is_valid and out[1].warnings == [] and "1000" in out[1].size_error
    assert not out[2].is_valid and out[2].invalid_items == 1


def test_batch_arrays_and_empty_batch(spark):
    df = batches(spark, [2])
    held = df.groupBy("batch").agg(F.collect_list(F.struct(*COLUMNS)).alias("items"))
    held = held.unionByName(held.select(F.lit(9).alias("batch"), F.slice("items", 1, 0).alias("items")))
    out = {r.batch: r for r in val.validate_batch_arrays(held, "batch", "items").collect()}
    assert out[0].is_valid and not out[9].is_valid and out[9].batch_size == 0


def test_scaling_matches_population_formula(spark):
    data = pd.DataFrame({"a": [1.0, 2.0, 4.0, None], "b": [3.0] * 4})
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (4.0, 3.0), (None, 3.0)], "a double, b double")
    got = feat.lazy_scale(df, ["a", "b"]).toPandas()
    want = (data.a - data.a.mean()) / data.a.std(ddof=0)
    assert got.a_scaled.tolist()[:3] == pytest.approx(want.tolist()[:3]) and pd.isna(got.a_scaled[3])
    assert got.b_scaled.tolist() == [0.0] * 4
    fitted = feat.apply_scaler(df, feat.fit_scaler(df, ["a", "b"])).toPandas()
    pd.testing.assert_frame_equal(fitted, got)
    low_high = feat.lazy_scale(df, ["a"], "minmax").toPandas().a_scaled
    assert low_high.min() == 0.0 and low_high.max() == 1.0
    with pytest.raises(ValueError):
        feat.lazy_scale(df, ["a"], "other")


def test_one_hot_rows_sum_to_one(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "x string")
    rows = [[r[f"x_{v}"] for v in "abc"] for r in feat.one_hot(df, "x").collect()]
    assert [sum(r) for r in rows] == [1, 1, 0, 1]
    dropped = feat.one_hot(df, "x", drop_first=True)
    assert dropped.columns == ["x", "x_b", "x_c"] and dropped.collect()[1][1:] == (0.0, 0.0)
    unseen = feat.one_hot(spark.createDataFrame([("zz",)], "x string"), "x", ["a", "b"], drop_first=True)
    assert unseen.first()["x_b"] == 0.0
    with pytest.raises(ValueError):
        feat.one_hot(df, "x", max_columns=2)


@pytest.mark.parametrize("small", [10_000, 1], ids=["short list", "ranged"])
def test_label_codes(spark, monkeypatch, small):
    monkeypatch.setattr(feat, "SMALL_CATEGORY", small)
    df = spark.createDataFrame([("high",), ("low",), (None,), ("medium",), ("very_high",), ("very_low",)], "c string")
    got = {r.c: r.c_encoded for r in feat.label_encode(df, "c").collect()}
    assert got == {"high": 0, "low": 1, "medium": 2, None: 3, "very_high": 4, "very_low": 5}


def test_unseen_category_is_an_error(spark):
    codes = feat.fit_label_codes(spark.createDataFrame([("a",)], "c string"), "c")
    with pytest.raises(Exception, match="unseen category"):
        feat.join_codes(spark.createDataFrame([("b",)], "c string"), "c", codes).collect()


def test_selection_keeps_order(spark):
    df = spark.createDataFrame([(1.0, 5.0, "x", 1.0), (2.0, 5.0, "y", 2.0)], "a double, k double, s string, t double")
    assert feat.select_low_variance(df, "t").columns == ["a", "s", "t"]


def test_powers_have_no_cross_terms(spark):
    df = spark.createDataFrame([(3.0, 2.0)], "median_income double, housing_median_age double")
    row = feat.poly_features(df, degree=3).first().asDict()
    assert row["median_income_poly_3"] == 27.0 and len(row) == 6


def test_engineering_chain(spark):
    rows = [tuple(list(VALID[:-1]) + [c, 1000.0 * i]) for i, c in enumerate(["INLAND", "ISLAND", "INLAND"])]
    rows = [tuple(v * (1 + i / 10) if isinstance(v, float) and j < 8 else v for j, v in enumerate(r)) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, f"{DDL}, median_house_value double")
    out = feat.engineer_features(df, polynomial=True)
    assert out.columns[-1] == "median_house_value" and "ocean_proximity_INLAND" in out.columns
    assert "bedrooms_per_household" not in out.columns  # constant ratio: no variance
    scaled = out.select([c for c in out.columns if c.endswith("_scaled")]).toPandas()
    assert abs(scaled.mean()).max() < 1e-9
    assert feat.engineer_features(df, scale=False, transform=False).columns.count("total_rooms_log") == 0


def test_category_lists(spark):
    rows = [(f"k{i}", "x" if i % 2 else None, "one") for i in range(60)]
    df = spark.createDataFrame(rows, "many string, few string, single string")
    assert {k: v if v is None else set(v) for k, v in feat.category_lists(df, ["few", "single"], 5).items()} == {
        "few": {"x", None},
        "single": {"one"},
    }
    got = feat.category_lists(df, ["many", "few", "single"], 5)
    assert got["many"] is None and set(got["few"]) == {"x", None} and got["single"] == ["one"]
