"""Streaming rules against the rules over a stored log, over several batches and restarts."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import alerts
from tallyframe.streaming import jobs, rules

START = dt.datetime(2024, 3, 1, 10, 0, 0)
SCHEMA = "id long, ts timestamp_ntz, status_code int, prediction double, processing_time_ms double, input_data string"


def log_rows(seed, seconds):
    rng = random.Random(seed)
    rows = [(0, START, 200, 1.0, 5.0, "x")]
    for k, s in enumerate(sorted(rng.randrange(1, seconds) for _ in range(seconds // 40))):
        failed = rng.random() < (0.5 if s // 600 % 2 else 0.02)
        moment = START + dt.timedelta(seconds=s if rng.random() < 0.9 else s // 60 * 60)
        rows.append((k + 1, moment, 500 if failed else 200, None if failed else 2.0, rng.choice([None, 20.0, 300.0, 1500.0, 12_000.0]), "y" * rng.randrange(9)))
    return rows


def streamed():
    return [
        rules.error_rate_rule(20.0, 300, 120),
        rules.slow_rule(0.4, 0.5, 300, 120),
        rules.slow_rule(0.9, window=300, hold=180, name="slow_prediction"),
        rules.low_volume_rule(1.2, 600, 300),
        rules.high_volume_rule(1.6, 300, 60),
        rules.silence_rule(120, 120),
        rules.growth_rule(F.length("input_data"), 40.0, 600, 120),
    ]


def stored_rules(log, as_of):
    out = alerts.high_error_rate(log, 20.0, 300, 120, as_of=as_of)
    for part in (
        alerts.slow_requests(log, 0.4, 0.5, 300, 120, as_of=as_of), alerts.slow_prediction(log, 0.9, window=300, hold_for=180, as_of=as_of),
        alerts.low_volume(log, 1.2, 600, 300, as_of=as_of), alerts.high_volume(log, 1.6, 300, 60, as_of=as_of),
        alerts.no_predictions(log, 120, 120, as_of=as_of), alerts.log_growth(log, F.length("input_data"), 40.0, 600, 120, as_of=as_of),
    ):
        out = out.unionByName(part)
    return out


def rounded(df):
    return sorted((r.rule, r.severity, r.tick_ts, None if r.value is None else round(r.value, 9), r.active, r.firing) for r in df.collect())


def drained(spark, folder, log_path, clock_path):
    log = jobs.table_stream(spark, log_path, files_per_batch=1)
    stream = rules.alert_stream(log, streamed(), 60, jobs.table_stream(spark, clock_path), "90 seconds")
    jobs.start_append(stream, f"{folder}/found", f"{folder}/progress").awaitTermination()
    return spark.read.parquet(f"{folder}/found")


def test_batches_restarts_and_silence(spark, tmp_path):
    rows = log_rows(1, 7200)
    log_path, clock_path = f"{tmp_path}/log", f"{tmp_path}/clock"

    def clock(moment, mode="append"):
        spark.createDataFrame([(moment + dt.timedelta(seconds=90),)], "ts timestamp_ntz").coalesce(1).write.mode(mode).parquet(clock_path)

    cuts = [0, len(rows) // 3, len(rows) // 2, len(rows)]
    for a, b in zip(cuts, cuts[1:]):
        spark.createDataFrame(rows[a:b], SCHEMA).coalesce(1).write.mode("append").parquet(log_path)
        clock(rows[b - 1][1])
        found = drained(spark, tmp_path, log_path, clock_path)
    # the log stops: only the clock goes on
    for minutes in (5, 37):
        as_of = rows[-1][1] + dt.timedelta(minutes=minutes)
        clock(as_of)
        found = drained(spark, tmp_path, log_path, clock_path)
    log = spark.createDataFrame(rows, SCHEMA)
    assert rounded(found) == rounded(stored_rules(log, as_of))
    assert {r.rule for r in found.where("firing").collect()} >= {"high_error_rate", "slow_processing", "low_volume", "high_volume", "no_predictions"}
    silent = found.where("rule = 'no_predictions' and firing").agg(F.max("tick_ts")).first()[0]
    assert silent >= as_of - dt.timedelta(minutes=1)
    # nothing new: nothing is written again
    assert drained(spark, tmp_path, log_path, clock_path).count() == found.count()


class Kept:
    """State and timers of one key, as a processor sees them."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, moment):
        self.timers.append(moment)

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_a_long_span_comes_in_frames():
    """Neither the ticks of a batch nor what they return are held at once, and no frame's edge shows."""
    rng, step, window, hold, end = random.Random(3), 60, 5, 2, 45_000
    runs = {t: rng.randrange(3) for t in range(1, end) if rng.random() < 0.2 or 20_000 < t < 20_040} | {1: 2, 19_997: 0}
    judge, kept = rules._Judge({"low": ("info", window, hold, lambda s: s[0], lambda v: v < 1)}, step), Kept()
    judge.init(kept)
    rows = [(t * step, 1, [float(n)]) for t, n in runs.items()] + [(-600, 0, [0.0])]
    rng.shuffle(rows)
    got = []
    for part, watermark in ((rows, 44_000), ([], 45_000)):
        kept.watermark = watermark * step * 1000 + 1500
        frames = [pd.DataFrame(part[a : a + 999], columns=["tick", "real", "sums"]) for a in range(0, len(part), 999)]
        found = judge.handleInputRows(("low",), iter(frames), kept) if part else judge.handleExpiredTimer(("low",), kept, None)
        for frame in found:
            assert len(frame) <= rules.FRAME_TICKS
            got += list(frame.itertuples(index=False, name=None))
    wanted, held = [], 0
    for t in range(1, 45_001):
        value = float(sum(runs.get(t - k, 0) for k in range(window)))
        held = held + 1 if value < 1 else 0
        wanted.append(("low", "info", t * step, value, value < 1, held > hold))
    assert got == wanted and kept.timers[-1] == 45_001 * step * 1000
    assert len(kept.value[2]) <= window


def test_rules_are_checked(spark):
    log = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        rules.alert_stream(log, [rules.error_rate_rule(window=90)], 60)
    with pytest.raises(ValueError):
        rules.alert_stream(log, [rules.silence_rule(), rules.silence_rule()], 60)


def test_quantile():
    assert rules.quantile_of(0.5, [1.0, 2.0], [0, 0], 0) is None
    assert rules.quantile_of(0.5, [1.0, 2.0], [4, 8], 8) == 1.0
    assert rules.quantile_of(0.75, [1.0, 2.0], [4, 8], 8) == 1.5
    assert rules.quantile_of(0.99, [1.0, 2.0], [0, 0], 3) == 2.0
