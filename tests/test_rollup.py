"""Rules over a kept rollup against the rules over the whole log, and what they read."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import alerts, rollup

START = dt.datetime(2024, 3, 1, 22, 10, 0)
SCHEMA = "id long, ts timestamp_ntz, status_code int, prediction double, processing_time_ms double"


def log_of(spark, path, days=6, seed=3):
    rng = random.Random(seed)
    rows = []
    for k in range(days * 200):
        at = START + dt.timedelta(seconds=rng.randrange(days * 86400))
        if k % 20 == 0:  # exactly at midnight and on steps
            at = at.replace(hour=0, minute=0, second=0) + dt.timedelta(days=1)
        failed = rng.random() < (0.6 if at.hour % 3 else 0.05)
        rows.append((k, at, 500 if failed else 200, None if failed else 1.0, rng.choice([None, 20.0, 900.0, 20_000.0])))
    log = spark.createDataFrame(rows, SCHEMA).withColumn("dt", F.to_date("ts"))
    log.repartition("dt").write.partitionBy("dt").parquet(path)
    return spark.read.parquet(path)


def rules():
    return [
        alerts.error_rate_rule(30.0, 3600, 900, 300),
        alerts.slow_rule(0.5, 0.5, 3600, 600, 300),
        alerts.low_volume_rule(0.1, 3600, 900, 300),
        alerts.high_volume_rule(0.2, 3600, 300, 300),
        alerts.no_predictions_rule(900, 900, 300),
    ]


def rows_of(df):
    return sorted((r.rule, r.tick_ts, None if r.value is None else round(r.value, 9), r.active, r.firing) for r in df.collect())


@pytest.mark.parametrize("hours", [5, 48, 1000])
def test_recent_ticks_equal_those_of_the_whole_log(spark, tmp_path, hours):
    log = log_of(spark, f"{tmp_path}/log")
    path = rollup.refresh(log, f"{tmp_path}/rollup", rules(), "dt")
    as_of = log.agg(F.max("ts")).first()[0] + dt.timedelta(hours=2)
    start = as_of - dt.timedelta(hours=hours)
    for rule in rules():
        whole = [r for r in rows_of(alerts.over_log(rule, log, as_of)) if r[1] > start]
        assert rows_of(alerts.over_log(rule, log, as_of, start, "dt")) == whole
        assert rows_of(rollup.judge(spark, path, rule, start, as_of)) == whole
        assert whole


def test_a_rule_reads_two_days(spark, tmp_path):
    log = log_of(spark, f"{tmp_path}/log")
    path = rollup.refresh(log, f"{tmp_path}/rollup", rules(), "dt")
    as_of = dt.datetime(2024, 3, 6, 1, 0, 0)
    start = as_of - dt.timedelta(minutes=5)
    for rule in rules():
        for found, column in ((rollup.judge(spark, path, rule, start, as_of), "day"), (alerts.over_log(rule, log, as_of, start, "dt"), "dt")):
            plan = found._jdf.queryExecution().toString()
            assert f"PartitionFilters: [isnotnull({column}" in plan
            found.collect()
            scan = found._jdf.queryExecution().executedPlan().toString()
            assert f"PartitionFilters: [isnotnull({column}" in scan


def test_days_are_replaced(spark, tmp_path):
    log = log_of(spark, f"{tmp_path}/log", 3)
    path = f"{tmp_path}/rollup"
    days = sorted(r.dt for r in log.select("dt").distinct().collect())
    for some in (days[:1], days[:2], days[1:], days[-1:]):
        rollup.refresh(log, path, rules(), "dt", some)
    kept = spark.read.parquet(path)
    whole = spark.read.parquet(rollup.refresh(log, f"{tmp_path}/whole", rules(), "dt"))
    assert kept.exceptAll(whole.select(kept.columns)).count() == 0 and kept.count() == whole.count()
    assert kept.agg(F.sum("requests")).first()[0] == log.count()


def test_shared_sums(spark):
    both = rollup.shared_sums([alerts.low_volume_rule(), alerts.high_volume_rule(), alerts.error_rate_rule()])
    assert sorted(both) == ["errors", "requests"]
    with pytest.raises(ValueError):
        rollup.shared_sums([alerts.log_growth_rule(F.length("a")), alerts.log_growth_rule(F.length("b"))])


def test_empty_rollup(spark, tmp_path):
    log = log_of(spark, f"{tmp_path}/log", 1).where("false")
    found = alerts.over_log(rules()[0], log, START, START - dt.timedelta(hours=1), "dt")
    assert found.count() == 0
