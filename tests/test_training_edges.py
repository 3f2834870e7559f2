"""Training on awkward rows, and models that cannot be loaded."""

import pytest

from tallyframe.plans import training

SPEC = training.ModelSpec("m", "linear", numeric=("x",), ratios={}, log_columns=("x",), category=None, target="y")


def rows(spark, test_rows=1):
    made = [(float(k), 3.0 * k + k % 3, "train") for k in range(1, 40)] + [(-1.0, 5.0, "train"), (-7.0, 5.0, "test")]
    made += [(float(k), 6.0, "test") for k in range(2, 2 + test_rows)]
    return spark.createDataFrame(made, "x double, y double, split string")


@pytest.mark.parametrize("test_rows", [1, 3])
def test_constant_target_and_unloggable_inputs(spark, test_rows):
    _, run = training.train_track(rows(spark, test_rows), SPEC)
    metrics = run.first().metrics
    assert metrics["train_r2"] > 0.5 and metrics["test_rmse"] is not None and metrics["test_r2"] is None


def test_registered_model_that_is_gone(spark, tmp_path):
    model, _ = training.train_track(rows(spark), SPEC)
    training.save_model(spark, model, f"{tmp_path}/kept")
    fields = "name string, version string, stage string, status string, run_id string, creation_ts timestamp_ntz"
    versions = spark.createDataFrame([("m", "3", "Production", "READY", "r", None)], fields)
    _, info = training.load_from_registry(spark, versions, "m", "Production", f"{tmp_path}/registry", f"{tmp_path}/kept")
    assert info["source"] == "path"
    with pytest.raises(Exception):
        training.load_from_registry(spark, versions, "m", "Production", f"{tmp_path}/registry")
