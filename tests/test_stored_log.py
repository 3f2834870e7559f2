"""Look-backs over a log stored by day, and search criteria."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import features, requestlog, retraining, series
from tallyframe.sources import tables

NOW = dt.datetime(2024, 1, 20, 12)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "requests")
    rows = [(k, NOW - dt.timedelta(hours=5 * k), "p", float(k % 7), 10.0, '{"flag": %s, "n": %d}' % (("true", "false", "1")[k % 3], k)) for k in range(80)]
    made = spark.createDataFrame(rows, "id long, ts timestamp_ntz, endpoint string, prediction double, processing_time_ms double, input_data string")
    tables.append_requests(made, path)
    metrics = series.metrics_from_requests(spark.read.parquet(path))
    tables.append_metrics(metrics, path + "-metrics")
    return spark.read.parquet(path), spark.read.parquet(path + "-metrics")


CALLS = {
    "gauges": lambda log, m, **o: series.gauges(log, **o),
    "outlier_ratio": lambda log, m, **o: requestlog.outlier_ratio(log, 48, min_rows=1, **o),
    "outside_two_sigma": lambda log, m, **o: requestlog.outside_two_sigma(log, 48, sigmas=1.0, **o),
    "metric_stats": lambda log, m, **o: series.metric_stats(m, "prediction_value", 48, **o),
    "rate_by_horizon": lambda log, m, **o: series.rate_by_horizon(log, (1, 24, 60), **o),
    "prediction_deviation": lambda log, m, **o: series.prediction_deviation(log, 24, 48, **o),
}


@pytest.mark.parametrize("as_of", [None, NOW - dt.timedelta(hours=30)])
@pytest.mark.parametrize("name", CALLS)
def test_look_backs_prune_days(stored, name, as_of):
    plain = CALLS[name](*stored, as_of=as_of)
    pruned = CALLS[name](*stored, as_of=as_of, day="dt")
    assert sorted(map(str, pruned.drop("dt").collect())) == sorted(map(str, plain.drop("dt").collect()))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: ")[1] for line in plan.split("\n") if "PartitionFilters: [" in line]
    assert any(f.startswith("[isnotnull(dt") or "dt#" in f.split("]")[0] for f in filters)


def test_decision_prunes_days(spark, stored):
    events = spark.createDataFrame([], "ts timestamp_ntz, reason string, details string, status string")
    got = retraining.decision(stored[0], events, F.lit(NOW), NOW, day="dt")
    assert "dt#" in got._jdf.queryExecution().toString() and got.count() == 1


def test_boolean_criteria(stored):
    log = stored[0]
    wanted = {k for k in range(80) if k % 3 in (0, 2)}
    assert {r.id for r in requestlog.with_json_fields(log, {"flag": True}).collect()} == wanted
    assert {r.id for r in requestlog.with_json_fields(log, {"flag": False}).collect()} == set(range(80)) - wanted
    assert [r.id for r in requestlog.with_json_fields(log, {"flag": True, "n": 3}).collect()] == [3]


def test_flag_columns_have_one_limit(spark):
    frame = spark.range(1500).select(F.concat(F.lit("c"), "id").alias("ocean_proximity"))
    for call in (lambda: features.one_hot(frame, "ocean_proximity"), lambda: features.encode_categories(frame)):
        with pytest.raises(ValueError, match="too many for one column each"):
            call()
