"""The whole job in one call: profile, engineer, train, summarise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.features import engineer_features
from tallyframe.operators.profiling import full_profile
from tallyframe.operators.registry import best_model
from tallyframe.plans.training import DEFAULT_SPECS, TARGET, train_models


@dataclass
class Outcome:
    profile: DataFrame | None
    engineered: DataFrame | None
    models: dict[str, PipelineModel]
    runs: DataFrame | None
    summary: DataFrame


def summarise(original: int, final: int, runs: DataFrame) -> DataFrame:
    """Feature counts, expansion, number of models and the best one with its score."""
    top = best_model(runs).agg(F.struct(F.first("run_name").alias("name"), F.first("test_r2").alias("score"))).scalar()
    return runs.agg(F.count(F.lit(1)).alias("models_trained")).select(
        F.lit(original).alias("original_features"),
        F.lit(final).alias("final_features"),
        F.lit(final / max(original, 1)).alias("expansion_ratio"),
        "models_trained",
        top["name"].alias("best_model"),
        top["score"].alias("best_score"),
    )


def run(
    df: DataFrame,
    key: str,
    target: str = TARGET,
    specs=DEFAULT_SPECS,
    profile: bool = True,
    engineer: bool = True,
    **feature_options,
) -> Outcome:
    inputs = df.drop(key)
    report = full_profile(inputs, target) if profile else None
    engineered = engineer_features(df, target, keep=[key], **feature_options) if engineer else None
    models, runs = train_models(df, key, specs)
    original = len(inputs.columns) - 1
    final = len(engineered.columns) - 2 if engineered is not None else original
    return Outcome(report, engineered, models, runs, summarise(original, final, runs))
