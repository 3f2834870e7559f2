"""Evaluation, registry, training, scoring and retraining queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.catalog.cleaning import clean_sql
from tallyframe.catalog.features import engineered_sql
from tallyframe.catalog.log import OUTLIER_SQL
from tallyframe.catalog.registry import over, query, r, tidy
from tallyframe.catalog.validation import business_errors
from tallyframe.functions.timing import newest
from tallyframe.operators import evaluation, registry, retraining
from tallyframe.plans import linear, scoring, training, workflow
from tallyframe.plans.stages import feature_stages
from tallyframe.operators.cleaning import clean_table, split_train_test
from tallyframe.session import new_folder
from tallyframe.sources import tables, views

# --- evaluation ---------------------------------------------------------------------------------

METRIC_SQL = {
    "mse": "avg((y - y_hat) * (y - y_hat))",
    "rmse": "sqrt(avg((y - y_hat) * (y - y_hat)))",
    "mae": "avg(abs(y - y_hat))",
    "r2": "1 - sum((y - y_hat) * (y - y_hat)) / nullif(count(*) * var_pop(y), 0)",
    "mape": "avg(abs((y - y_hat) / nullif(y, 0))) * 100",
    "max_error": "max(abs(y - y_hat))",
}
DIGITS = {"mse": 0, "rmse": 3, "mae": 3, "r2": 6, "mape": 4, "max_error": 3}


@query("join_actual_predicted", over("scored", "SELECT key, y, y_hat FROM scored"))
def _(spark, folder):
    return evaluation.pair_by_key(views.actual_totals(spark, folder), views.estimated_totals(spark, folder), "key")


@query("eval_regression", over("scored", f"SELECT {', '.join(f'{r(x, DIGITS[m])} AS {m}' for m, x in METRIC_SQL.items())} FROM scored"))
def _(spark, folder):
    return tidy(evaluation.evaluate(views.scored(spark, folder)), 6, DIGITS)


@query("eval_residuals", over("scored", f"SELECT key, {r('y - y_hat', 4)} AS residual FROM scored"))
def _(spark, folder):
    return tidy(evaluation.residuals(views.scored(spark, folder)).select("key", "residual"), 4)


@query("eval_summary", over("scored", "+ m AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {x} AS v FROM scored" for m, x in (METRIC_SQL | {"std_residuals": "stddev_pop(y - y_hat)", "skew_residuals": "skewness(y - y_hat)"}).items())
    + f") SELECT metric, CASE WHEN metric = 'mse' THEN {r('v', 0)} ELSE {r('v', 3)} END AS value FROM m"))
def _(spark, folder):
    from tallyframe.functions.numeric import round_to

    out = evaluation.summary(views.scored(spark, folder))
    value = F.when(F.col("metric") == "mse", round_to("value", 0)).otherwise(round_to("value", 3)) + F.lit(0.0)
    return out.select("metric", value.alias("value"))


@query("eval_residual_hist", over("scored", f"""+ e AS (SELECT y - y_hat AS x FROM scored), s AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 50e0 AS w FROM e),
  b AS (SELECT CAST(least(coalesce(floor((x - lo) / nullif(w, 0)), 0), 49) AS INTEGER) AS bin, count(*) AS n FROM e, s GROUP BY 1)
SELECT bin, {r('lo + bin * w', 3)} AS low, {r('lo + (bin + 1) * w', 3)} AS high, n FROM b, s"""))
def _(spark, folder):
    return tidy(evaluation.residual_histogram(views.scored(spark, folder)), 3)


@query("eval_scatter_bounds", over("scored", "SELECT min(y) AS line_min, max(y) AS line_max, count(*) AS points FROM scored"))
def _(spark, folder):
    return evaluation.scatter_bounds(views.scored(spark, folder))


# --- registry -----------------------------------------------------------------------------------

LATEST = """+ ranked AS (SELECT *, row_number() OVER (PARTITION BY name, stage ORDER BY CAST(version AS BIGINT) DESC) AS in_stage,
    row_number() OVER (PARTITION BY name ORDER BY CAST(version AS BIGINT) DESC) AS overall FROM versions),
  wanted AS (SELECT name, s.wanted_stage FROM (SELECT DISTINCT name FROM versions) CROSS JOIN (SELECT unnest(['Production', 'Staging', 'Archived']) AS wanted_stage) s),
  latest AS (SELECT w.name, w.wanted_stage, a.version IS NULL AS is_fallback, coalesce(a.version, o.version) AS version, coalesce(a.stage, o.stage) AS stage,
    coalesce(a.status, o.status) AS status, coalesce(a.run_id, o.run_id) AS run_id, coalesce(a.creation_ts, o.creation_ts) AS creation_ts
    FROM wanted w LEFT JOIN ranked a ON a.name = w.name AND a.stage = w.wanted_stage AND a.in_stage = 1 JOIN ranked o ON o.name = w.name AND o.overall = 1)"""


@query("latest_version_by_stage", over("versions", LATEST + "\nSELECT * FROM latest"))
def _(spark, folder):
    return registry.latest_by_stage(views.model_versions(spark, folder))


@query("join_version_run", over("versions runs", """SELECT name, version, stage, run_id, run_name, experiment_id, test_r2, model_type, kind
FROM versions LEFT JOIN runs USING (run_id)"""))
def _(spark, folder):
    joined = registry.with_run(views.model_versions(spark, folder), views.runs(spark, folder))
    return joined.select(
        "name",
        "version",
        "stage",
        "run_id",
        "run_name",
        "experiment_id",
        F.col("metrics")["test_r2"].alias("test_r2"),
        F.col("params")["model_type"].alias("model_type"),
        F.col("tags")["kind"].alias("kind"),
    )


@query("compare_models", over("runs", "SELECT run_id, run_name, ordinal, test_r2, test_rmse FROM runs"))
def _(spark, folder):
    return registry.compare_models(views.runs(spark, folder))


@query("best_model", over("runs", "SELECT run_id, run_name, ordinal, test_r2, test_rmse FROM runs ORDER BY test_r2 DESC NULLS LAST, ordinal LIMIT 1"))
def _(spark, folder):
    return registry.best_model(views.runs(spark, folder))


@query("register_version", over("versions", """SELECT 'Brand#1' AS name, CAST(coalesce(max(CAST(version AS BIGINT)), 0) + 1 AS VARCHAR) AS version, 'None' AS stage,
  'READY' AS status, 'r1' AS run_id, TIMESTAMP '2024-06-01 00:00:00' AS creation_ts, 'retrained' AS description FROM versions WHERE name = 'Brand#1'"""))
def _(spark, folder):
    at = F.expr("TIMESTAMP_NTZ'2024-06-01 00:00:00'")
    return registry.register_version(views.model_versions(spark, folder), "Brand#1", "r1", at, "retrained")


@query("transition_stage", over("versions", """SELECT name, version, CASE WHEN name = 'Brand#1' AND version = '3' THEN 'Production'
  WHEN name = 'Brand#1' AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage, run_id FROM versions"""))
def _(spark, folder):
    moved = registry.transition_stage(views.model_versions(spark, folder), "Brand#1", "3", "Production")
    return moved.select("name", "version", "stage", "run_id")


@query("model_info", over("versions", LATEST + """, marks AS (SELECT name, version, string_agg(wanted_stage, ',' ORDER BY wanted_stage) AS latest_for FROM latest GROUP BY 1, 2)
SELECT v.name, v.version, v.stage, v.status, v.run_id, v.creation_ts, v.description, coalesce(latest_for, '') AS latest_for FROM versions v LEFT JOIN marks USING (name, version)"""))
def _(spark, folder):
    out = registry.model_info(views.model_versions(spark, folder))
    return out.withColumn("latest_for", F.concat_ws(",", "latest_for"))


@query("list_models", over("versions", LATEST + """
SELECT name, max(version) FILTER (WHERE wanted_stage = 'Production') AS latest_production, max(version) FILTER (WHERE wanted_stage = 'Staging') AS latest_staging,
  max(version) FILTER (WHERE wanted_stage = 'Archived') AS latest_archived FROM latest GROUP BY 1"""))
def _(spark, folder):
    return registry.list_models(views.model_versions(spark, folder))


@query("workflow_summary", over("runs", """+ b AS (SELECT run_name, test_r2 FROM runs ORDER BY test_r2 DESC NULLS LAST, ordinal LIMIT 1)
SELECT 9 AS original_features, 14 AS final_features, 14 / 9e0 AS expansion_ratio, (SELECT count(*) FROM runs) AS models_trained, run_name AS best_model, test_r2 AS best_score FROM b"""))
def _(spark, folder):
    return workflow.summarise(9, 14, views.runs(spark, folder))


# --- retraining ---------------------------------------------------------------------------------


def _events(spark, folder):
    """Errors stand for past retrainings."""
    log = views.requests(spark, folder).where(F.col("endpoint") == "signup")
    return log.select("ts", F.lit("manual").alias("reason"))


@query("retrain_schedule", over("requests", f"""SELECT max(ts) AS last_retrain, {r("epoch_us((SELECT as_of FROM clock)) / 3600000000e0 - epoch_us(max(ts)) / 3600000000e0")} AS hours_since,
  (epoch_us((SELECT as_of FROM clock)) - epoch_us(max(ts))) >= 24 * 3600000000 AS due FROM requests WHERE endpoint = 'signup'"""))
def _(spark, folder):
    return tidy(retraining.schedule(_events(spark, folder), newest(views.requests(spark, folder))))


@query("retrain_decision", over("requests", OUTLIER_SQL.format(h=720) + """,
  d AS (SELECT (SELECT predictions >= 10 AND outliers / predictions > 0.04 FROM o) AS degraded, count(*) AS past_events,
    epoch_us((SELECT as_of FROM clock)) - epoch_us(max(ts)) >= 24 * 3600000000 AS due FROM requests WHERE endpoint = 'signup')
SELECT past_events, degraded, due, CASE WHEN degraded THEN 'performance_degradation' WHEN due THEN 'scheduled_retrain' END AS reason,
  CASE WHEN degraded OR due THEN 'needs_attention' ELSE 'healthy' END AS status,
  CASE WHEN degraded THEN 'Model performance has degraded, consider retraining' WHEN due THEN 'Scheduled retraining window reached' END AS recommendation FROM d"""))
def _(spark, folder):
    log = views.requests(spark, folder)
    return retraining.decision(log, _events(spark, folder), newest(log), threshold=0.04, hours=720)


# --- training and scoring -------------------------------------------------------------------------

# The feature table is built from orders, so it explains the room count and not the price.
ROOMS = {
    "numeric": (
        "longitude", "latitude", "housing_median_age", "total_bedrooms", "population", "households", "median_income", "median_house_value",
    ),
    "ratios": {"population_per_household": ("population", "households")},
    "log_columns": ("population", "households"),
    "target": "total_rooms",
}


@query("pipeline_summary")
def _(spark, folder):
    """The summary of a run: its feature counts are those of the engineered table."""
    return tidy(workflow.run(_data(spark, folder), "block_id", ROOMS["target"], [_spec("linear"), _spec("tree")]).summary, 4)


HASH = "CAST('0x' || substr(md5(CAST(block_id AS VARCHAR) || '|42'), 1, 8) AS BIGINT)"


def _data(spark, folder):
    """Written once: training passes over it many times."""
    path = new_folder(spark, "training")
    views.blocks(spark, folder).write.parquet(path)
    return clean_table(spark.read.parquet(path))


def _spec(kind: str, **options) -> training.ModelSpec:
    return training.ModelSpec(kind, kind, options=options, **ROOMS)


def _trained(spark, folder, kind: str, **options):
    labelled = split_train_test(_data(spark, folder), "block_id")
    return labelled, training.train_track(labelled, _spec(kind, **options))


def _metrics(runs):
    names = ("train_rmse", "train_r2", "test_rmse", "test_r2")
    return tidy(runs.select("run_name", *[F.col("metrics")[n].alias(n) for n in names]), 4)


# All inputs: in SQL each input in turn is taken out of the target and of the inputs after it.
ROOM_INPUTS = [f"ln(1e0 + {c})" if c in ROOMS["log_columns"] else c for c in ROOMS["numeric"]]
ROOM_INPUTS += [f"{a} / {b}" for a, b in ROOMS["ratios"].values()]
ROOM_INPUTS += [f"CAST(ocean_proximity = '{c}' AS INTEGER)" for c in ("INLAND", "ISLAND", "NEAR BAY", "NEAR OCEAN")]


def _rest_sql(groups: str, trained: str) -> str:
    """``rest (block_id, part, f, w, y, e)``: what the inputs leave of the target, fitted per ``f`` to the rows where ``trained`` holds."""
    n = len(ROOM_INPUTS)
    tables = [f"""
  x AS (SELECT block_id, {HASH} AS part, total_rooms AS y, {', '.join(f'{x} AS x{k}' for k, x in enumerate(ROOM_INPUTS))} FROM clean),
  w AS (SELECT *, CAST({trained} AS INTEGER) AS w FROM x, (SELECT unnest({groups}) AS f)),
  m AS (SELECT block_id, part, f, w, y, y - sum(w * y) OVER p / sum(w) OVER p AS e,
    {', '.join(f'x{k} - sum(w * x{k}) OVER p / sum(w) OVER p AS x{k}' for k in range(n))} FROM w WINDOW p AS (PARTITION BY f)),
  s0 AS (SELECT *, {', '.join(f'sum(w * x{k} * x{k}) OVER p AS d{k}' for k in range(n))} FROM m WINDOW p AS (PARTITION BY f))"""]
    for k in range(n):
        own = f"sum(w * x{k} * x{k}) OVER p"
        less = lambda z: f"{z} - CASE WHEN {own} > 1e-9 * d{k} THEN x{k} * sum(w * x{k} * {z}) OVER p / {own} ELSE 0 END AS {z}"
        later = range(k + 1, n)
        columns = ["block_id", "part", "f", "w", "y", less("e"), *(less(f"x{j}") for j in later), *(f"d{j}" for j in later)]
        tables.append(f"\n  s{k + 1} AS (SELECT {', '.join(columns)} FROM s{k} WINDOW p AS (PARTITION BY f))")
    return ",".join(tables) + f",\n  rest AS (SELECT block_id, part, f, w, y, e FROM s{n})"


SPLIT_FIT = clean_sql(500000) + "," + _rest_sql("[0]", "part % 10000 >= 2000")
FOLDS = clean_sql(500000) + "," + _rest_sql("[0, 1, 2, 3, 4]", "part % 5 <> f") + """,
  per_fold AS (SELECT f, avg(e * e) AS mse, avg(abs(e)) AS mae, 1 - sum(e * e) / (count(*) * var_pop(y)) AS r2 FROM rest WHERE w = 0 GROUP BY f)
"""


def sides_sql(more: str = "") -> str:
    return over("blocks", SPLIT_FIT + f""",
  side AS (SELECT w, {r('sqrt(avg(e * e))', 4)} AS rmse, {r('1 - sum(e * e) / (count(*) * var_pop(y))', 4)} AS r2 FROM rest GROUP BY w)
SELECT 'linear' AS run_name{more}, a.rmse AS train_rmse, a.r2 AS train_r2, b.rmse AS test_rmse, b.r2 AS test_r2
  FROM side a, side b WHERE a.w = 1 AND b.w = 0""")


def folds_sql(digits: int) -> str:
    parts = [f"SELECT '{m}' AS metric, {r(f'avg({m})', digits)} AS mean, {r(f'stddev_pop({m})', digits)} AS std FROM per_fold" for m in ("mse", "mae", "r2")]
    return over("blocks", FOLDS + "\nUNION ALL ".join(parts))


@query("train_linear", sides_sql())
def _(spark, folder):
    return _metrics(_trained(spark, folder, "linear")[1][1])


@query("train_tree")
def _(spark, folder):
    return _metrics(_trained(spark, folder, "tree")[1][1])


@query("train_forest")
def _(spark, folder):
    return _metrics(_trained(spark, folder, "forest")[1][1])


@query("train_candidates")
def _(spark, folder):
    """All candidates on one split, best first."""
    _, runs = training.train_models(_data(spark, folder), "block_id", [_spec("linear"), _spec("tree"), _spec("forest")])
    return tidy(registry.compare_models(runs), 4)


@query("train_track", sides_sql(", 'linear' AS model_type"))
def _(spark, folder):
    """The recorded run of a linear model of all inputs."""
    run = _trained(spark, folder, "linear")[1][1]
    return _metrics(run).join(run.select("run_name", F.col("params")["model_type"].alias("model_type")), "run_name")


# The library's solver and the SQL differ in the last digits of a squared error and of a prediction.
@query("eval_cv", folds_sql(3))
def _(spark, folder):
    return tidy(training.cross_validate(_data(spark, folder), "block_id", _spec("linear"), 5)[1], 3)


@query("eval_cv_all", folds_sql(4))
def _(spark, folder):
    """Five folds of a linear model of all inputs, all fitted from one table of sums."""
    return tidy(linear.cross_validate_sums(_data(spark, folder), "block_id", _spec("linear"), 5)[1], 4)


@query("train_linear_sums", over("blocks", SPLIT_FIT + f"""
SELECT CASE w WHEN 1 THEN 'train' ELSE 'test' END AS split, {r('sqrt(avg(e * e))', 4)} AS rmse, {r('avg(abs(e))', 4)} AS mae,
  {r('1 - sum(e * e) / (count(*) * var_pop(y))', 4)} AS r2 FROM rest GROUP BY w"""))
def _(spark, folder):
    """Both sides' metrics of a linear model of all inputs."""
    labelled = split_train_test(_data(spark, folder), "block_id")
    return tidy(linear.train_sums(labelled, _spec("linear"))[1].select("split", "rmse", "mae", "r2"), 4)


@query("feature_importance")
def _(spark, folder):
    model = _trained(spark, folder, "tree")[1][0]
    return tidy(training.feature_importance(spark, model), 4)


# One feature per number and ratio, and one per category but the first.
FEATURE_COUNT = f"{len(ROOMS['numeric']) + len(ROOMS['ratios'])} + count(DISTINCT ocean_proximity) - 1"


@query("model_save_load", over("blocks", clean_sql(500000) + f"\nSELECT count(*) AS n, 0 AS differing, {FEATURE_COUNT} AS features FROM clean"))
def _(spark, folder):
    """Rows whose prediction by the reloaded model differs from the original's: none."""
    data, (model, _) = _trained(spark, folder, "linear")
    path = training.save_model(spark, model, new_folder(spark, "model"), {"features": training.feature_names(model)})
    again, names = training.load_model(spark, path)
    before = scoring.score(model, data, "a").select("block_id", "a")
    after = scoring.score(again, data, "b").select("block_id", "b")
    return before.join(after, "block_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("a") != F.col("b")).alias("differing"),
        F.lit(len(names["features"])).alias("features"),
    )


@query("transformers_save_load", engineered_sql("clean", clean_sql(500000).lstrip("+") + ","))
def _(spark, folder):
    """Feature rows of a chain fitted, saved and loaded again."""
    from pyspark.ml import Pipeline

    data = _data(spark, folder)
    fitted = Pipeline(stages=feature_stages(keep=["block_id"])).fit(data)
    path = training.save_model(spark, fitted, new_folder(spark, "features"), {"original": data.columns})
    again, _ = training.load_model(spark, path)
    return tidy(again.transform(data))


@query("score_batch", over("blocks", SPLIT_FIT + f"""
SELECT c.block_id AS id, TIMESTAMP '2024-02-01 00:00:00' AS ts, 'batch' AS endpoint, 'POST' AS method, population, {r('y - e', 1)} AS prediction,
  {r('1000e0 / (SELECT count(*) FROM clean)', 4)} AS processing_time_ms, 200 AS status_code FROM clean c JOIN rest USING (block_id)"""))
def _(spark, folder):
    """Log rows of a table scored by a model of all inputs; one input is read back from the logged payload."""
    data, (model, _) = _trained(spark, folder, "linear")
    rows = scoring.score_batch(model, data, F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'"), total_ms=1000.0, key="block_id")
    logged = F.get_json_object("input_data", "$.population").cast("double").alias("population")
    return tidy(rows.select("id", "ts", "endpoint", "method", logged, "prediction", "processing_time_ms", "status_code"), 4, {"prediction": 1})


def validated_sql(key: str) -> str:
    return over("blocks", SPLIT_FIT + f""", b AS (SELECT *, {business_errors()} AS t FROM blocks)
SELECT block_id AS {key}, CASE WHEN t = '' THEN {r('y - e', 1)} END AS prediction, CASE WHEN t = '' THEN 200 ELSE 400 END AS status_code,
  CASE WHEN t <> '' THEN 'Input validation failed: ' || t END AS error_message FROM b LEFT JOIN rest USING (block_id)""")


@query("score_validated", validated_sql("block_id"))
def _(spark, folder):
    model = _trained(spark, folder, "linear")[1][0]
    scored = scoring.score_validated(model, views.blocks(spark, folder))
    return tidy(scored.select("block_id", "prediction", "status_code", "error_message"), 1)


@query("score_validated_log", over("blocks", """+ v AS (SELECT *, longitude BETWEEN -124.5 AND -114.0 AND latitude BETWEEN 32.0 AND 42.0 AND housing_median_age BETWEEN 0 AND 100
    AND total_rooms > 0 AND total_bedrooms > 0 AND total_bedrooms <= total_rooms AND population > 0 AND households > 0
    AND population / households BETWEEN 0.5 AND 20 AND median_income > 0 AND ocean_proximity IS NOT NULL AS ok FROM blocks)
SELECT CASE WHEN coalesce(ok, false) THEN 200 ELSE 400 END AS status_code, count(*) AS requests, count(*) FILTER (WHERE coalesce(ok, false)) AS predictions,
  count(*) FILTER (WHERE NOT coalesce(ok, false)) AS messages FROM v GROUP BY 1"""))
def _(spark, folder):
    """Scored rows appended to the log and read back: both outcomes are logged."""
    model = _trained(spark, folder, "linear")[1][0]
    scored = scoring.score_validated(model, views.blocks(spark, folder))
    rows = scoring.as_requests(scored, F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'"), key="block_id")
    path = tables.append_requests(rows, new_folder(spark, "requests"))
    return tables.scan_log(spark, path).groupBy("status_code").agg(
        F.count(F.lit(1)).alias("requests"), F.count("prediction").alias("predictions"), F.count("error_message").alias("messages")
    )
