import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import evaluation, registry, retraining
from tallyframe.operators.cleaning import hash_bucket, split_train_test
from tallyframe.operators.validation import NUMERIC_FIELDS
from tallyframe.plans import scoring, training, workflow
from tallyframe.session import new_folder
from tallyframe.sources import tables, views
from tallyframe.streaming import jobs

SMALL = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 3, 10, 12, 0)


# --- evaluation and registry ------------------------------------------------------------------


def test_metrics_match_numpy(spark):
    y, p = np.array([3.0, 0.0, 5.0, 8.0]), np.array([2.5, 1.0, 5.5, 6.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, y_hat double")
    row, e = evaluation.evaluate(df).first(), y - p
    assert row.mse == pytest.approx((e**2).mean()) and row.mae == pytest.approx(abs(e).mean())
    assert row.r2 == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    assert row.mape == pytest.approx(100 * np.mean(abs(e[y != 0] / y[y != 0]))) and row.max_error == 2.0
    long = {r.metric: r.value for r in evaluation.summary(df).collect()}
    assert long["std_residuals"] == pytest.approx(e.std()) and long["skew_residuals"] == pytest.approx(pd.Series(e).skew())


def test_residual_bins_match_numpy(spark):
    rng = np.random.default_rng(3)
    e = np.round(rng.normal(size=400), 3)
    df = spark.createDataFrame([(float(v), 0.0) for v in e], "y double, y_hat double")
    got = {r.bin: r.n for r in evaluation.residual_histogram(df).collect()}
    assert sum(got.values()) == 400 and max(got) == 49
    same = spark.createDataFrame([(1.0, 1.0)] * 3, "y double, y_hat double")
    assert [(r.bin, r.n) for r in evaluation.residual_histogram(same).collect()] == [(0, 3)]


def versions(spark):
    rows = [("m", v, s, "READY", f"r{v}", NOW, None) for v, s in (("2", "Staging"), ("9", "Archived"), ("10", "None"))]
    return spark.createDataFrame(
        rows, "name string, version string, stage string, status string, run_id string, creation_ts timestamp_ntz, description string"
    )


def test_versions_are_numbers_and_empty_stages_fall_back(spark):
    got = {r.wanted_stage: (r.version, r.is_fallback) for r in registry.latest_by_stage(versions(spark)).collect()}
    assert got == {"Production": ("10", True), "Staging": ("2", False), "Archived": ("9", False)}
    assert registry.latest_version(versions(spark), "m").first().version == "10"
    assert registry.latest_version(versions(spark), "other").count() == 0


def test_register_and_transition(spark):
    new = registry.register_version(versions(spark), "m", "r", NOW).first()
    first = registry.register_version(versions(spark), "fresh", "r", NOW).first()
    assert (new.version, new.stage, first.version) == ("11", "None", "1")
    moved = registry.transition_stage(versions(spark), "m", "10", "Staging")
    assert {r.version: r.stage for r in moved.collect()} == {"2": "Archived", "9": "Archived", "10": "Staging"}
    kept = registry.transition_stage(versions(spark), "m", "10", "Staging", archive_existing=False)
    assert {r.version: r.stage for r in kept.collect()}["2"] == "Staging"
    with pytest.raises(ValueError):
        registry.transition_stage(versions(spark), "m", "10", "Live")


def test_first_listed_model_wins_a_tie(spark):
    rows = [("b", "b", 1, {"test_r2": 0.5}), ("a", "a", 0, {"test_r2": 0.5}), ("c", "c", 2, {"test_r2": 0.4})]
    runs = spark.createDataFrame(rows, "run_id string, run_name string, ordinal int, metrics map<string,double>")
    assert registry.best_model(runs).first().run_name == "a"
    row = workflow.summarise(0, 5, runs).first()
    assert (row.models_trained, row.best_model, row.expansion_ratio) == (3, "a", 5.0)


def test_schedule_and_decision(spark):
    events = spark.createDataFrame([(NOW,)], "ts timestamp_ntz")
    at = lambda h: F.lit(NOW + dt.timedelta(hours=h))
    assert not retraining.schedule(events, at(23.9)).first().due
    assert retraining.schedule(events, at(24)).first().due
    assert retraining.schedule(events.limit(0), at(0)).first().due
    log = views.requests(spark, SMALL)
    calm = retraining.decision(log, events, at(1), threshold=1.0).first()
    assert (calm.status, calm.reason, calm.recommendation) == ("healthy", None, None)
    assert retraining.decision(log, events, at(30), threshold=1.0).first().reason == "scheduled_retrain"
    assert retraining.decision(log, events, at(30), threshold=0.0, hours=720).first().reason == "performance_degradation"


# --- training -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def houses(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(600):
        people, homes = rng.integers(50, 900), rng.integers(20, 300)
        rooms = float(homes * rng.uniform(3, 8))
        beds = None if i % 40 == 0 else rooms / rng.uniform(4, 6)
        income, kind = rng.uniform(0.5, 9), ["INLAND", "ISLAND", "NEAR BAY"][i % 3]
        value = 40000 * income + 100 * homes + {"INLAND": 0, "ISLAND": 50000, "NEAR BAY": 20000}[kind] + rng.normal(0, 3000)
        row = (i, -120.0 + rng.uniform(0, 5), 35.0 + rng.uniform(0, 5), float(rng.integers(1, 50)), rooms, beds)
        rows.append(tuple(x.item() if hasattr(x, "item") else x for x in (*row, float(people), float(homes), income, kind, value)))
    ddl = "key long, " + ", ".join(f"{c} double" for c in NUMERIC_FIELDS) + ", ocean_proximity string, median_house_value double"
    return spark.createDataFrame(rows, ddl).repartition(3).cache()


@pytest.fixture(scope="module")
def linear(spark, houses):
    return training.train_track(split_train_test(houses, "key"), training.DEFAULT_SPECS[0])


def test_linear_model_matches_least_squares(spark, houses, linear):
    model, run = linear
    labelled = split_train_test(houses, "key")
    full = model.transform(labelled).select("split", "median_house_value", "prediction", "features").toPandas()
    x = np.array([f.toArray() for f in full.features])
    a = np.hstack([x, np.ones((len(x), 1))])
    train = (full.split == "train").to_numpy()
    beta, *_ = np.linalg.lstsq(a[train], full.median_house_value[train], rcond=None)
    assert np.allclose(a @ beta, full.prediction, rtol=1e-6)
    scaled = x[train][:, :11]
    assert np.allclose(scaled.mean(axis=0), 0, atol=1e-9) and np.allclose(scaled.std(axis=0), 1, atol=1e-9)
    assert run.first().metrics["test_r2"] > 0.9


def test_models_beat_the_mean_and_repeat(spark, houses):
    models, runs = training.train_models(houses, "key")
    scores = {r.run_name: r.metrics["test_r2"] for r in runs.collect()}
    assert list(models) == ["Linear_Regression", "Decision_Tree", "Random_Forest"] and min(scores.values()) > 0.5
    again = training.train_models(houses, "key", training.DEFAULT_SPECS[1:2])[1].first()
    assert again.metrics["test_r2"] == pytest.approx(scores["Decision_Tree"], rel=1e-9)
    importance = training.feature_importance(spark, models["Decision_Tree"]).collect()
    assert importance[0].feature == "median_income" and sum(r.importance for r in importance) == pytest.approx(1)


def test_cross_validation(spark, houses):
    per_fold, overall = training.cross_validate(houses, "key", training.DEFAULT_SPECS[0], folds=3)
    folds, means = per_fold.toPandas(), {r.metric: r for r in overall.collect()}
    assert len(folds) == 3 and means["mse"].mean == pytest.approx(folds.mse.mean()) and means["mse"].mean > 0
    assert means["r2"].std == pytest.approx(folds.r2.std(ddof=0))


def test_model_round_trip_and_registry(spark, houses, linear):
    model, _ = linear
    root = new_folder(spark, "registry")
    training.save_model(spark, model, f"{root}/m/10", {"features": training.feature_names(model)})
    loaded, info = training.load_from_registry(spark, versions(spark), "m", "Production", root)
    assert info["version"] == "10" and info["source"] == "registry"
    a = scoring.score(model, houses).toPandas().sort_values("key").prediction
    b = scoring.score(loaded, houses).toPandas().sort_values("key").prediction
    assert np.array_equal(a, b)
    _, info = training.load_from_registry(spark, versions(spark), "other", "Production", root, f"{root}/m/10")
    assert info["source"] == "path"
    with pytest.raises(ValueError):
        training.load_from_registry(spark, versions(spark), "other", "Production", root)


def test_scoring_splits_valid_and_invalid(spark, houses, linear):
    bad = houses.withColumn("latitude", F.when(F.col("key") < 10, 0.0).otherwise(F.col("latitude")))
    out = scoring.score_validated(linear[0], bad, "business").toPandas()
    invalid = out[out.status_code == 400]
    assert set(range(10)) <= set(invalid.key) and invalid.prediction.isna().all() and invalid.error_message.notna().all()
    assert out[out.status_code == 200].prediction.notna().all()
    rows = scoring.score_batch(linear[0], houses, F.lit(NOW), total_ms=600.0, key="key").toPandas()
    assert set(rows.processing_time_ms) == {1.0} and len(rows) == 600


def test_whole_workflow(spark, houses):
    out = workflow.run(houses, "key", specs=training.DEFAULT_SPECS[:1])
    row = out.summary.first()
    assert row.original_features == 9 and row.final_features > 9 and row.best_model == "Linear_Regression"
    assert out.profile.where("section = 'structure'").first().value == 600 and out.engineered.count() == 600


# --- storage ------------------------------------------------------------------------------------


def test_csv_empty_is_null_and_header_is_checked(spark):
    df = spark.createDataFrame([(1.0, None), (None, "x")], "a double, b string")
    path = tables.write_csv(df, new_folder(spark, "csv"))
    assert sorted(map(tuple, tables.read_csv(spark, path, df.schema).collect()), key=str) == [(1.0, None), (None, "x")]
    with pytest.raises(Exception):
        tables.read_csv(spark, path, "other double, b string").collect()


def test_append_defaults(spark):
    rows = spark.createDataFrame([(NOW, "/a", None)], "ts timestamp_ntz, endpoint string, prediction double")
    path = tables.append_requests(rows, new_folder(spark, "log"))
    tables.append_requests(rows, path)
    got = spark.read.parquet(path).collect()
    assert len(got) == 2 and got[0].status_code == 200 and got[0].prediction is None and str(got[0].dt) == "2024-03-10"


def test_scan_prunes_days(spark):
    rows = spark.createDataFrame([(NOW - dt.timedelta(days=i), "/a") for i in range(20)], "ts timestamp_ntz, endpoint string")
    path = tables.append_requests(rows, new_folder(spark, "log"))
    recent = tables.scan_log(spark, path, 48, NOW)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert recent.count() == 2 and "PartitionFilters: [isnotnull(dt" in plan


@pytest.mark.parametrize("hour", [0, 6])
def test_retention_rewrites_one_day_only(spark, hour):
    start = dt.datetime(2024, 3, 1)
    rows = [(start + dt.timedelta(hours=6 * i), "/a") for i in range(40)]
    path = tables.append_requests(spark.createDataFrame(rows, "ts timestamp_ntz, endpoint string"), new_folder(spark, "log"))
    as_of = dt.datetime(2024, 3, 12, hour)
    cutoff = as_of - dt.timedelta(days=5)
    assert tables.apply_retention(spark, path, as_of, 5) == sum(t < cutoff for t, _ in rows)
    assert sorted(r.ts for r in spark.read.parquet(path).collect()) == [t for t, _ in rows if t >= cutoff]
    assert tables.apply_retention(spark, path, as_of, 5) == 0


# --- streaming ------------------------------------------------------------------------------------


def test_new_data_trigger_counts_per_file(spark, tmp_path):
    for name, n in (("small/a.csv", 99), ("b.csv", 100)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x\n" + "\n".join(map(str, range(n))) + "\n")
    (tmp_path / "note.txt").write_text("x\n1\n")
    events, progress = new_folder(spark, "events"), new_folder(spark, "progress")
    files = jobs.new_files(spark, str(tmp_path), "x int")
    jobs.start_new_data_trigger(files, events, progress).awaitTermination()
    got = spark.read.parquet(events).collect()
    assert len(got) == 1 and got[0].details.endswith("b.csv") and got[0].reason == "new_data"
    (tmp_path / "c.csv").write_text("x\n" + "\n".join(map(str, range(150))) + "\n")
    jobs.start_new_data_trigger(jobs.new_files(spark, str(tmp_path), "x int"), events, progress).awaitTermination()
    assert spark.read.parquet(events).count() == 2


def test_trigger_can_be_switched_off(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n" + "\n".join(map(str, range(150))) + "\n")
    events = new_folder(spark, "events")
    stream = jobs.new_files(spark, str(tmp_path), "x int")
    jobs.start_new_data_trigger(stream, events, new_folder(spark, "progress"), enabled=False).awaitTermination()
    with pytest.raises(Exception):
        spark.read.parquet(events)


def test_stream_batches_hold_back_the_rest(spark):
    stream = views.events_as_requests(jobs.table_stream(spark, f"{SMALL}/events*.parquet"))
    out = new_folder(spark, "batches")
    jobs.start_append(jobs.batch_stats_stream(stream, shards=4), out, new_folder(spark, "progress")).awaitTermination()
    got = spark.read.parquet(out).groupBy("endpoint", "shard").count().toPandas().set_index(["endpoint", "shard"])["count"]
    made = views.requests(spark, SMALL).where("prediction is not null")
    sizes = made.groupBy("endpoint", hash_bucket("id", buckets=4).alias("shard")).count().toPandas()
    want = sizes.set_index(["endpoint", "shard"])["count"] // 10
    assert got.to_dict() == {k: v for k, v in want.to_dict().items() if v}


def test_stream_alerts_over_several_batches_match_the_batch_form(spark, tmp_path):
    """Four files, one per micro-batch: holding across batches gives the same alerts as one batch."""
    log = spark.read.parquet(f"{SMALL}/events.parquet")
    source = new_folder(spark, "sliced")
    for i, (lo, hi) in enumerate([(1, 8), (8, 15), (15, 22), (22, 32)]):
        log.where(F.dayofmonth("ts").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(source)

    def alerts_of(files_per_batch):
        stream = views.events_as_requests(jobs.table_stream(spark, source, files_per_batch=files_per_batch))
        rates = jobs.rate_stream(stream, "2 hours", "30 minutes", "1 hour")
        found = new_folder(spark, "alerts")
        jobs.start_alerts(
            rates, new_folder(spark, "windows"), found, new_folder(spark, "progress"), 20.0, 3600, 1800
        ).awaitTermination()
        got = spark.read.parquet(found)
        return got.select("batch_id").distinct().count(), got.drop("batch_id").distinct().toPandas().sort_values("tick_ts")

    one, whole = alerts_of(100)
    many, parts = alerts_of(1)
    assert many > one
    both = whole.merge(parts, on="tick_ts", suffixes=("", "_parts"))
    assert len(both) == len(whole) == len(parts)
    pd.testing.assert_series_equal(both.value, both.value_parts, check_names=False)
    assert (both.firing == both.firing_parts).all() and both.firing.any()
