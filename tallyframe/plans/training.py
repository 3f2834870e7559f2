"""Training, tracking, cross-validation, persistence and importance of regression models."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.cleaning import fold_of, split_train_test
from tallyframe.operators.evaluation import evaluate, fold_summary
from tallyframe.operators.features import TRAINING_RATIOS
from tallyframe.operators.validation import CATEGORY_FIELD, NUMERIC_FIELDS
from tallyframe.plans.stages import CategoryFlags, ColumnRecipe, ColumnScaler, MedianFiller

TARGET = "median_house_value"
FEATURES = "features"
# Columns that get log1p before scaling.
LOG_COLUMNS = ("total_rooms", "total_bedrooms", "population", "households", "median_income")
FOLD_SCHEMA = "fold int, mse double, rmse double, mae double, r2 double, mape double, max_error double"


@dataclass(frozen=True)
class ModelSpec:
    """A named candidate: feature columns in raw form and the regressor to put on top."""

    name: str
    kind: str = "linear"  # linear | tree | forest
    numeric: Sequence[str] = NUMERIC_FIELDS
    ratios: Mapping[str, tuple[str, str]] = field(default_factory=lambda: dict(TRAINING_RATIOS))
    log_columns: Sequence[str] = LOG_COLUMNS
    category: str | None = CATEGORY_FIELD
    target: str = TARGET
    options: Mapping[str, object] = field(default_factory=dict)

    def build(self) -> Pipeline:
        numeric = [*self.numeric, *self.ratios]
        stages: list = [MedianFiller(self.numeric)]
        if self.ratios:
            stages.append(ColumnRecipe("ratios", {"ratios": {n: list(ab) for n, ab in self.ratios.items()}}))
        inputs = numeric
        if self.kind == "linear":
            logged = [c for c in self.log_columns if c in numeric]
            plain = [c for c in numeric if c not in logged]
            stages.append(ColumnRecipe("log1p", {"columns": logged}))
            scaled = [f"{c}_log" for c in logged] + plain
            stages.append(ColumnScaler(scaled))
            inputs = [f"{c}_scaled" for c in scaled]
        if self.category:
            flags = CategoryFlags(self.category)
            stages.append(flags)
            inputs = [*inputs, flags.out]
        # Incomplete rows pass through to scoring, where validation decides about them.
        stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="keep"))
        return Pipeline(stages=[*stages, self.regressor()])

    def regressor(self):
        common = {"featuresCol": FEATURES, "labelCol": self.target, "predictionCol": "prediction"}
        if self.kind == "linear":
            return LinearRegression(**common, **{"solver": "normal", "regParam": 0.0, **self.options})
        if self.kind == "tree":
            defaults = {"maxDepth": 10, "minInstancesPerNode": 2, "seed": 42}
            return DecisionTreeRegressor(**common, **{**defaults, **self.options})
        if self.kind == "forest":
            return RandomForestRegressor(**common, **{"numTrees": 20, "maxDepth": 10, "seed": 42, **self.options})
        raise ValueError(f"unknown model kind {self.kind}")


DEFAULT_SPECS = (
    ModelSpec("Linear_Regression", "linear"),
    ModelSpec("Decision_Tree", "tree"),
    ModelSpec("Random_Forest", "forest"),
)


def complete_rows(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Rows a model can be fitted on: a label, a category, logged columns above -1 (at or below it the
    logarithm is missing), and no missing numbers but those the median fill covers in all cases (a
    missing ratio input would stay missing)."""
    needed = [spec.target] + ([spec.category] if spec.category else [])
    out = df.dropna("any", subset=needed)
    for _, (_, bottom) in spec.ratios.items():
        out = out.where(F.coalesce(F.col(bottom), F.lit(1.0)) != 0)
    for c in spec.log_columns:
        out = out.where(F.coalesce(F.col(c), F.lit(0.0)) > -1)
    return out


def train_track(
    labelled: DataFrame, spec: ModelSpec, split: str = "split", run_id: str | None = None, at: dt.datetime | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train rows; one pass over all rows gives both sides' metrics. Returns the
    model and its row for the ``runs`` table."""
    spark = labelled.sparkSession
    usable = complete_rows(labelled, spec)
    model = spec.build().fit(usable.where(F.col(split) == "train"))
    predicted = model.transform(usable).select(split, F.col(spec.target).alias("y"), F.col("prediction").alias("y_hat"))
    scores = {r[split]: r for r in evaluate(predicted, [split]).collect()}
    # a side with one row or a constant target has no r2
    metrics = {f"{s}_{m}": scores[s][m] for s in ("train", "test") if s in scores for m in ("rmse", "r2")}
    metrics = {k: None if v is None else float(v) for k, v in metrics.items()}
    params = {
        "model_type": spec.kind,
        "log_columns": ",".join(spec.log_columns),
        "target": spec.target,
        **{k: str(v) for k, v in spec.options.items()},
    }
    row = [
        (
            run_id or spec.name,
            spec.name,
            "training",
            at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
            metrics,
            params,
            {},
        )
    ]
    schema = (
        "run_id string, run_name string, experiment_id string, ts timestamp_ntz, "
        "metrics map<string,double>, params map<string,string>, tags map<string,string>"
    )
    return model, spark.createDataFrame(row, schema)


def train_models(
    df: DataFrame,
    key: Column | str,
    specs: Sequence[ModelSpec] = DEFAULT_SPECS,
    test_size: float = 0.2,
    seed: int = 42,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """All candidates on one deterministic split; the runs table keeps the listing order."""
    labelled = split_train_test(df, key, test_size, seed).persist()
    models, runs = {}, None
    for i, spec in enumerate(specs):
        models[spec.name], run = train_track(labelled, spec)
        run = run.withColumn("ordinal", F.lit(i))
        runs = run if runs is None else runs.unionByName(run)
    labelled.unpersist()
    return models, runs


def cross_validate(
    df: DataFrame, key: Column | str, spec: ModelSpec, folds: int = 5, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Metrics per fold and their mean and deviation. Fold membership is a hash of the key."""
    data = complete_rows(df, spec).withColumn("fold", fold_of(key, folds, seed)).persist()
    held_out = None
    for f in range(folds):
        model = spec.build().fit(data.where(F.col("fold") != f))
        part = model.transform(data.where(F.col("fold") == f)).select(
            "fold", F.col(spec.target).alias("y"), F.col("prediction").alias("y_hat")
        )
        held_out = part if held_out is None else held_out.unionByName(part)
    rows = evaluate(held_out, ["fold"]).collect()
    data.unpersist()
    per_fold = df.sparkSession.createDataFrame(rows, FOLD_SCHEMA)
    return per_fold, fold_summary(per_fold)


def feature_names(model: PipelineModel) -> list[str]:
    """Names behind the slots of the feature vector."""
    flags = {
        s.getOrDefault("constants")["out"]: s.getOrDefault("constants")
        for s in model.stages
        if isinstance(s, ColumnRecipe) and s.getOrDefault("step") == "flags"
    }
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names: list[str] = []
    for c in assembler.getInputCols():
        names += [f"{flags[c]['column']}_{v}" for v in flags[c]["values"]] if c in flags else [c]
    return names


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(feature, importance)``: tree importances, or absolute coefficients, highest first."""
    top = model.stages[-1]
    if hasattr(top, "featureImportances"):
        scores = top.featureImportances.toArray()
    elif hasattr(top, "coefficients"):
        scores = [abs(v) for v in top.coefficients.toArray()]
    else:
        raise NotImplementedError("model does not support feature importance")
    rows = [(n, float(s)) for n, s in zip(feature_names(model), scores)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


# --- persistence --------------------------------------------------------------------------------


def save_model(spark: SparkSession, model: PipelineModel, path: str, names: Mapping[str, Sequence[str]] | None = None):
    """The fitted chain plus a JSON sidecar with column names."""
    model.write().overwrite().save(f"{path}/model")
    sidecar = json.dumps({k: list(v) for k, v in (names or {}).items()})
    spark.createDataFrame([(sidecar,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/names")
    return path


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict[str, list[str]]]:
    names = json.loads(spark.read.text(f"{path}/names").first()[0])
    return PipelineModel.load(f"{path}/model"), names


def load_from_registry(
    spark: SparkSession, versions: DataFrame, name: str, stage: str, root: str, fallback: str | None = None
) -> tuple[PipelineModel, dict]:
    """The newest version of the stage from ``root/name/version``; the fallback path if there is none, or if
    its files are broken or gone. Without a fallback that is an error."""
    from tallyframe.operators.registry import latest_version

    found = latest_version(versions, name, stage).first()
    if found is not None:
        try:
            model, _ = load_model(spark, f"{root}/{name}/{found['version']}")
            return model, {**found.asDict(), "source": "registry"}
        except (Py4JJavaError, PySparkException):
            if fallback is None:
                raise
    if fallback is None:
        raise ValueError(f"no model {name} in the registry and no fallback path")
    model, _ = load_model(spark, fallback)
    return model, {"name": name, "version": None, "source": "path"}
