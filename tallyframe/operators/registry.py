"""Model registry as tables: ``models``, ``model_versions`` and ``runs``.

Versions are text but ordered as numbers. All functions return new tables; nothing is
changed in place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAGES = ("Production", "Staging", "Archived")


def version_number(c: str = "version") -> Column:
    return F.col(c).cast("long")


def _newest(condition: Column | None = None) -> Column:
    """Version row with the highest number (aggregate)."""
    row = F.struct("version", "stage", "status", "run_id", "creation_ts")
    order = version_number()
    if condition is not None:
        row, order = F.when(condition, row), F.when(condition, order)
    return F.max_by(row, order)


def latest_by_stage(versions: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Per model and stage the newest version there, or the newest of all if the stage is empty.

    One aggregate per model with map-side combine, whatever the number of versions.
    """
    wide = versions.groupBy("name").agg(
        _newest().alias("_any"), *[_newest(F.col("stage") == s).alias(f"s{i}") for i, s in enumerate(stages)]
    )
    rows = [
        F.struct(
            F.lit(s).alias("wanted_stage"),
            F.col(f"s{i}").isNull().alias("is_fallback"),
            F.coalesce(F.col(f"s{i}"), F.col("_any")).alias("v"),
        )
        for i, s in enumerate(stages)
    ]
    return wide.select("name", F.inline(F.array(*rows))).select("name", "wanted_stage", "is_fallback", "v.*")


def latest_version(versions: DataFrame, name: str, stage: str = "Production") -> DataFrame:
    return latest_by_stage(versions.where(F.col("name") == name), [stage])


def with_run(versions: DataFrame, runs: DataFrame) -> DataFrame:
    return versions.join(runs, "run_id", "left")


def model_info(versions: DataFrame, name: str | None = None) -> DataFrame:
    """All versions of a model (or of every model), one row each, marked with the stages they
    are the newest for. Rows stay rows: a model with very many versions is no large array."""
    if name is not None:
        versions = versions.where(F.col("name") == name)
    marks = latest_by_stage(versions).select("name", "version", "wanted_stage")
    marks = marks.groupBy("name", "version").agg(F.array_sort(F.collect_set("wanted_stage")).alias("latest_for"))
    return versions.join(marks, ["name", "version"], "left").withColumn(
        "latest_for", F.coalesce("latest_for", F.array().cast("array<string>"))
    )


def list_models(versions: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """One row per model with the newest version of each stage."""
    wide = versions.groupBy("name").agg(
        _newest()["version"].alias("_any"),
        *[_newest(F.col("stage") == s)["version"].alias(f"s{i}") for i, s in enumerate(STAGES)],
    )
    out = wide.select(
        "name", *[F.coalesce(F.col(f"s{i}"), F.col("_any")).alias(f"latest_{s.lower()}") for i, s in enumerate(STAGES)]
    )
    return out if models is None else models.join(out, "name", "left")


def register_version(
    versions: DataFrame, name: str, run_id: str, at: dt.datetime, description: str | None = None, status: str = "READY"
) -> DataFrame:
    """The row to append for a new version: highest number of the model plus one, no stage."""
    top = versions.where(F.col("name") == name).agg(F.coalesce(F.max(version_number()), F.lit(0)).alias("top"))
    return top.select(
        F.lit(name).alias("name"),
        (F.col("top") + 1).cast("string").alias("version"),
        F.lit("None").alias("stage"),
        F.lit(status).alias("status"),
        F.lit(run_id).alias("run_id"),
        F.lit(at).alias("creation_ts"),
        F.lit(description).cast("string").alias("description"),
    )


def transition_stage(
    versions: DataFrame, name: str, version: str, stage: str, archive_existing: bool = True
) -> DataFrame:
    """Versions with one stage changed; others in the target stage are archived on request."""
    if stage not in (*STAGES, "None"):
        raise ValueError(f"unknown stage {stage}")
    ours = F.col("name") == name
    moved = F.when(ours & (F.col("version") == version), F.lit(stage))
    if archive_existing:
        moved = moved.when(ours & (F.col("stage") == stage), F.lit("Archived"))
    return versions.withColumn("stage", moved.otherwise(F.col("stage")))


def compare_models(runs: DataFrame, metric: str = "test_r2") -> DataFrame:
    """Candidates with their scores, best first; ``ordinal`` breaks ties by listing order."""
    return runs.select(
        "run_id", "run_name", "ordinal", F.col("metrics")[metric].alias(metric), F.col("metrics")["test_rmse"].alias("test_rmse")
    ).orderBy(F.desc_nulls_last(metric), "ordinal")


def best_model(runs: DataFrame, metric: str = "test_r2") -> DataFrame:
    return compare_models(runs, metric).limit(1)
