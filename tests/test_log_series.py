import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.functions.numeric import ms_to_seconds
from tallyframe.operators import alerts, requestlog, series

NOW = dt.datetime(2024, 1, 2, 12, 0, 0)
DDL = (
    "id long, ts timestamp_ntz, endpoint string, method string, input_data string, prediction string, "
    "processing_time_ms double, status_code int, error_message string"
)


def log(spark, rows):
    """Rows as (id, seconds before NOW, prediction text, ms, status)."""
    made = [
        (i, NOW - dt.timedelta(seconds=s), "/a" if i % 2 else "/b", "POST", '{"k": %d}' % i, p, ms, st, None)
        for i, s, p, ms, st in rows
    ]
    return spark.createDataFrame(made, DDL)


def test_stats_of_an_empty_window(spark):
    row = requestlog.log_stats(log(spark, []), 24, as_of=NOW).first()
    assert (row.total_predictions, row.error_rate_percent, row.avg_processing_time_ms) == (0, 0.0, 0.0)
    assert row.avg_prediction_value is None and row.time_window_hours == 24


def test_stats_with_text_predictions_and_cutoff(spark):
    rows = [(1, 0, "100", 10.0, 200), (2, 10, "abc", None, 200), (3, 20, None, 30.0, 500), (4, 86400, "1", 1.0, 200)]
    row = requestlog.log_stats(log(spark, rows), 24, as_of=NOW).first()
    assert (row.total_predictions, row.successful_predictions, row.predictions_with_values) == (3, 2, 2)
    assert (row.error_rate_percent, row.avg_processing_time_ms, row.max_prediction_value) == (33.33, 20.0, 100.0)


def test_zero_is_a_value(spark):
    row = requestlog.log_stats(log(spark, [(1, 0, "0", 0.0, 200)]), as_of=NOW).first()
    assert row.avg_prediction_value == 0.0 and row.min_prediction_value == 0.0


def test_price_filter_on_text(spark):
    rows = [(1, 0, "abc", 1.0, 200), (2, 0, "12abc", 1.0, 200), (3, 0, "1e3", 1.0, 200), (4, 0, None, 1.0, 200)]
    assert [r.id for r in requestlog.in_price_range(log(spark, rows), 10, 2000).collect()] == [3]


@pytest.mark.parametrize("top", [10**6, 0], ids=["top-n", "ranged"])
def test_pages_cover_the_log_once(spark, top):
    data = log(spark, [(i, i % 50, str(i), 1.0, 200) for i in range(130)])
    pages = [requestlog.log_page(data, 40, o, top_rows=top, hours=24, as_of=NOW).collect() for o in (0, 40, 80, 120)]
    assert [len(p) for p in pages] == [40, 40, 40, 10]
    assert [p[0].has_more for p in pages] == [True, True, True, False] and pages[0][0].total == 130
    seen = [r.id for p in pages for r in sorted(p, key=lambda r: (r.ts, r.id), reverse=True)]
    want = sorted(((i % 50, -i, i) for i in range(130)))
    assert seen == [w[2] for w in want]


def test_search(spark):
    data = log(spark, [(i, i, "1", 1.0, 200) for i in range(5)])
    assert [r.id for r in requestlog.log_search(data, {"k": 3}).collect()] == [3]
    assert [r.id for r in requestlog.log_search(data, {"k": "3"}).collect()] == [3]
    with pytest.raises(ValueError):
        requestlog.log_search(data, {})


def test_outliers_need_enough_rows(spark):
    row = requestlog.outlier_ratio(log(spark, [(i, i, str(i), 1.0, 200) for i in range(9)]), as_of=NOW).first()
    assert not row.sufficient and not row.degraded and row.outlier_ratio is None


def test_outliers_match_pandas(spark):
    data = [float(i % 7) for i in range(40)] + [500.0, -400.0]
    row = requestlog.outlier_ratio(log(spark, [(i, i, str(v), 1.0, 200) for i, v in enumerate(data)] + [(99, 1, "x", 1.0, 200)]), as_of=NOW).first()
    s = pd.Series(data)
    want = ((s < s.mean() - 2 * s.std()) | (s > s.mean() + 2 * s.std())).sum()
    assert row.outliers == want and row.outlier_ratio == want / 43


def test_histogram_bounds_are_inclusive(spark):
    data = log(spark, [(i, 0, None, ms, 200) for i, ms in enumerate([1.0, 500.0, 10000.0, 11000.0])])
    hist = {r.le: r.cum_count for r in series.time_histogram(data, []).collect()}
    assert hist["0.001"] == 1 and hist["0.25"] == 1 and hist["0.5"] == 2 and hist["10"] == 3 and hist["+Inf"] == 4
    ordered = [hist[k] for k in sorted(hist, key=lambda k: float("inf") if k == "+Inf" else float(k))]
    assert ordered == sorted(ordered)
    running = series.running_buckets(data, ms_to_seconds("processing_time_ms"), series.TIME_BOUNDS, ["method"])
    assert {r.le: r.cum_count for r in running.collect()} == hist


def test_quantile_interpolation(spark):
    hist = spark.createDataFrame(
        [("a", 1.0, 4), ("a", 2.0, 8), ("a", None, 10), ("b", 1.0, 0), ("b", 2.0, 0), ("b", None, 5)],
        "l string, bound double, cum_count long",
    )
    got = {r.l: r.quantile for r in series.histogram_quantile(hist, 0.5, ["l"]).collect()}
    assert got == {"a": pytest.approx(1.25), "b": 2.0}
    assert {r.l: r.quantile for r in series.histogram_quantile(hist, 0.2, ["l"]).collect()}["a"] == pytest.approx(0.5)


def test_metric_stats_of_an_absent_metric(spark):
    metrics = series.metrics_from_requests(log(spark, [(1, 0, "5", 10.0, 404)]))
    assert {r.metric_name for r in metrics.collect()} == {
        "request_response_time",
        "request_count",
        "error_count",
        "prediction_count",
        "prediction_value",
    }
    assert tuple(series.metric_stats(metrics, "nothing", as_of=NOW).first()) == (0, 0.0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_batches_of_ten_leave_the_rest(spark, limit):
    data = log(spark, [(i, i, "1", 1.0, 200) for i in range(47)])  # 23 on /a, 24 on /b
    out = series.assign_batches(data, 10, window_rows=limit).toPandas()
    sizes = out.groupby(["endpoint", "batch_id"]).size()
    assert sizes.tolist() == [10, 10, 10, 10] and out.batch_id.isna().sum() == 7
    stats = series.batch_stats(spark.createDataFrame(out.dropna(subset=["batch_id"])[["endpoint", "batch_id"]].assign(prediction=2.0, processing_time_ms=1.0)))
    assert {(r.batch_size, r.prediction_std) for r in stats.collect()} == {(10, 0.0)}


def brute_window(times, tick, window):
    return sum(1 for t in times if tick - window < t <= tick)


def test_sliding_counts_match_brute_force(spark):
    offsets = [0, 7, 60, 61, 300, 301, 900, 2400, 2400, 2401]
    data = log(spark, [(i, s, "1", 1.0, 200) for i, s in enumerate(offsets)])
    got = {r.tick: r.requests for r in alerts.windowed_counts(data, 300, 60, {"requests": F.lit(1)}).collect()}
    base = int(NOW.replace(tzinfo=dt.timezone.utc).timestamp())
    times = [base - s for s in offsets]
    assert all(n == brute_window(times, tick, 300) for tick, n in got.items())
    assert 0 in got.values() and len(got) == 41


def test_hold_needs_full_history(spark):
    ticks = spark.createDataFrame([("r", i, a) for i, a in enumerate([True, True, True, False, True, True, True])], "rule string, tick long, active boolean")
    got = [r.f for r in ticks.withColumn("f", alerts.hold("active", 2)).orderBy("tick").collect()]
    assert got == [False, False, True, False, False, False, True]


@pytest.mark.parametrize("steps,stretch", [(0, 5), (3, 5), (9, 4), (3, 10_000)])
def test_firing_across_stretches_matches_brute_force(spark, steps, stretch):
    active = [(i * i) % 11 != 3 and i % 17 != 5 for i in range(120)]
    ticks = spark.createDataFrame([("r", 7200 + 60 * i, a) for i, a in enumerate(active)], "rule string, tick long, active boolean")
    got = [r.firing for r in alerts.with_firing(ticks, "active", steps, 60, stretch=stretch).orderBy("tick").collect()]
    assert got == [i >= steps and all(active[i - steps : i + 1]) for i in range(120)]


def test_silence_fires_the_no_predictions_alert(spark):
    data = log(spark, [(1, 0, "1", 1.0, 200), (2, 3600, "1", 1.0, 200)])
    out = alerts.no_predictions(data).orderBy("tick_ts").collect()
    assert len(out) == 61 and not out[0].firing and out[30].firing and not out[-1].firing
    assert out[19].active is True and out[19].firing is False and out[20].firing is True


def test_error_share_of_an_empty_window_is_unknown(spark):
    data = log(spark, [(1, 0, None, 1.0, 500), (2, 3600, "1", 1.0, 200)])
    out = alerts.high_error_rate(data).orderBy("tick_ts").collect()
    assert out[30].value is None and not out[30].active and out[-1].value == 100.0 and out[-1].active


def test_constant_and_one_row_profiles(spark):
    from tallyframe.operators import profiling

    one = spark.createDataFrame([(5.0, 5.0, "x")], "a double, b double, s string")
    for df in (one, one.limit(0), one.union(one), one.select(F.lit(None).cast("double").alias("a"), "b", "s")):
        assert profiling.correlations(df).where("correlation is not null").count() == 0
        assert profiling.describe(df).count() == 2
        assert profiling.boxplot(df).where("outliers > 0").count() == 0
        assert profiling.full_profile(df, "b").where("section = 'structure'").first().value == df.count()
        assert profiling.missing(df).count() == 3


def test_category_ties_go_to_the_smaller_value(spark):
    from tallyframe.operators import profiling

    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "s string")
    row = profiling.categorical(df).first()
    assert (row.unique_values, row.most_frequent, row.most_frequent_count) == (3, "a", 2)


def test_correlations_match_the_pairwise_aggregate(spark):
    from tallyframe.functions.numeric import pairwise_corr
    from tallyframe.operators import profiling

    df = spark.range(200).select(
        F.rand(1).alias("a"),
        (F.rand(1) * 2 + F.rand(2)).alias("b"),
        F.when(F.rand(3) > 0.3, F.rand(4)).alias("gap"),
        F.when(F.rand(5) > 0.3, F.rand(4)).alias("gap2"),
        F.lit(0.1).alias("constant"),
        (F.rand(6) + 1e6).alias("far"),
    ).cache()
    names = df.columns
    row = df.agg(*[pairwise_corr(x, y).alias(f"{x}|{y}") for x in names for y in names]).first()
    got = {f"{r.feature_1}|{r.feature_2}": r.correlation for r in profiling.correlations(df).collect()}
    assert len(got) == 36
    assert all(got[k] == (pytest.approx(v, abs=1e-6) if v is not None else None) for k, v in row.asDict().items())
    assert {(r.feature_1, r.feature_2) for r in profiling.high_correlations(df).collect()} == {("a", "b")}


@pytest.mark.parametrize("width", [4, 24, 60])
def test_profiles_read_the_table_at_most_three_times(spark, width, tmp_path):
    from tallyframe.operators import profiling

    spark.range(50).select(*[F.rand(k).alias(f"c{k}") for k in range(width)], F.lit("x").alias("kind")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    for made in (profiling.full_profile(df, "c0"), profiling.correlations(df), profiling.describe(df), profiling.boxplot(df)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert 1 <= plan.count("FileScan parquet") <= 3
    empty = profiling.describe(df.limit(0)).collect()
    assert len(empty) == width and all(r["count"] == 0 for r in empty)


def test_a_log_that_stopped_is_judged_up_to_now(spark):
    data = log(spark, [(i, 7200 - 60 * i, "1", 5.0, 200) for i in range(5)] + [(9, 6900, "1", None, 200)])
    for rule in (alerts.no_predictions, alerts.low_volume, alerts.no_runs):
        out = rule(data, window=600, hold_for=600, as_of=NOW).orderBy("tick_ts").collect()
        assert out[-1].tick_ts == NOW and out[-1].firing and not out[0].firing
        assert not any(r.firing for r in rule(data, window=600, hold_for=600).collect())
    slow = alerts.slow_requests(data, 0.001, window=600, hold_for=0, as_of=NOW).orderBy("tick_ts").collect()
    assert slow[0].active and slow[-1].value is None and not slow[-1].active


def test_bucket_columns_give_the_quantile_of_bucket_rows(spark):
    bounds = series.TIME_BOUNDS
    rows = [(k, *sorted((k * 7 + 3 * i) % 11 for i in range(len(bounds) + 1))) for k in range(30)] + [(30, *[0] * 13), (31, *[0] * 12, 4)]
    wide = spark.createDataFrame(rows, "tick int, " + ", ".join(f"b{i} int" for i in range(len(bounds))) + ", n int")
    long = []
    for k, *counts in rows:
        long += [(k, str(b), float(b), c) for b, c in zip(bounds, counts)] + [(k, "+Inf", None, counts[-1])]
    want = series.histogram_quantile(spark.createDataFrame(long, "tick int, le string, bound double, cum_count int"), 0.95, ["tick"])
    got = {r.tick: r.v for r in wide.select("tick", alerts.bucket_quantile(0.95, bounds).alias("v")).collect()}
    assert {k: v for k, v in got.items() if v is not None} == {r.tick: r.quantile for r in want.collect()}


def test_slow_rules_need_one_window(spark):
    plan = alerts.slow_requests(log(spark, [(1, 0, "1", 5.0, 200)]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
