"""Least squares from sums, held against numpy and against the fitted chain."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators.cleaning import fold_of
from tallyframe.plans import linear, training

SPEC = training.ModelSpec("m", "linear", numeric=("a", "b", "twice", "flat"), ratios={}, log_columns=("b",), category="kind", target="t")


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(1e6, 3, 400), rng.exponential(5, 400)
    kind = rng.integers(0, 3, 400)
    t = 2 * (a - 1e6) - 3 * np.log1p(b) + 4 * (kind == 2) + rng.normal(0, 0.5, 400)
    rows = [(k, float(a[k]), float(b[k]), float(2 * a[k]), 7.0, "uvw"[kind[k]], float(t[k])) for k in range(400)]
    rows += [(400, None, 1.0, 1.0, 7.0, "u", 1.0), (401, 1e6, -1.0, 2e6, 7.0, "v", 1.0), (402, 1e6, 1.0, 2e6, 7.0, None, 1.0)]
    rows += [(403, float("nan"), 1.0, 2e6, 7.0, "v", 1.0), (404, 1e6, 1.0, 2e6, 7.0, "v", None)]
    return spark.createDataFrame(rows, "key long, a double, b double, twice double, flat double, kind string, t double")


def by_hand(rows, train):
    x = np.array([[1, r.a - 1e6, np.log1p(r.b), r.kind == "v", r.kind == "w"] for r in rows], float)
    y = np.array([r.t for r in rows])
    return y - x @ np.linalg.lstsq(x[train], y[train], rcond=None)[0]


def test_folds_equal_separate_fits(made):
    per_fold, summary = linear.cross_validate_sums(made, "key", SPEC, 4)
    rows = made.withColumn("fold", fold_of("key", 4, 42)).where("key < 400").orderBy("key").collect()
    fold = np.array([r.fold for r in rows])
    got = {r.fold: r for r in per_fold.collect()}
    assert set(got) == set(fold)
    for f, r in got.items():
        e = by_hand(rows, fold != f)[fold == f]
        assert r.mse == pytest.approx((e**2).mean(), rel=1e-6) and r.mae == pytest.approx(np.abs(e).mean(), rel=1e-6)
        assert r.max_error == pytest.approx(np.abs(e).max(), rel=1e-6)
    assert {r.metric for r in summary.collect()} == {"mse", "mae", "r2"}


def test_split_fit(made):
    labelled = made.withColumn("split", F.when(F.col("key") % 4 == 0, "test").otherwise("train"))
    fit, scores = linear.train_sums(labelled, SPEC)
    assert fit.coefficients["twice"] == 0 and fit.coefficients["flat"] == 0
    assert fit.coefficients["a"] == pytest.approx(2, abs=0.05) and fit.coefficients["kind_w"] == pytest.approx(4, abs=0.3)
    rows = made.where("key < 400").orderBy("key").collect()
    train = np.arange(400) % 4 != 0
    e = by_hand(rows, train)
    got = {r.split: r.rmse for r in scores.collect()}
    assert got == pytest.approx({"train": np.sqrt((e[train] ** 2).mean()), "test": np.sqrt((e[~train] ** 2).mean())}, rel=1e-6)


def test_folds_equal_the_fitted_chain(made):
    plain = training.ModelSpec("m", "linear", numeric=("a", "b"), ratios={}, log_columns=("b",), category=None, target="t")
    whole = made.where("key < 400")
    wanted = {r.fold: r for r in training.cross_validate(whole, "key", plain, 3)[0].collect()}
    got = {r.fold: r for r in linear.cross_validate_sums(whole, "key", plain, 3)[0].collect()}
    assert set(got) == set(wanted)
    for f, r in got.items():
        assert (r.rmse, r.mae, r.r2) == pytest.approx((wanted[f].rmse, wanted[f].mae, wanted[f].r2), rel=1e-6)


def test_nothing_to_train_on(made):
    assert linear.cross_validate_sums(made.limit(0), "key", SPEC, 3)[0].count() == 0
    assert linear.train_sums(made.where("key = 1").withColumn("split", F.lit("test")), SPEC)[0] is None
    one = linear.cross_validate_sums(made.where("key = 1"), "key", SPEC, 3)[0]
    assert one.count() == 0
