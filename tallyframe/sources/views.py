"""Views of a star schema with an event table as the engine's input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.validation import OCEAN_PROXIMITY
from tallyframe.sources.tables import read_table

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CATEGORIES = tuple(sorted(OCEAN_PROXIMITY))


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """One feature row per customer from its orders and their lines.

    Lines are reduced per order before the join and orders per customer after it, so a
    customer or order with very many rows is combined on the map side.
    """
    lines = (
        read_table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("qty_r"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    # Prices have two decimals: adding cents as integers makes the mean independent of order.
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    per_customer = (
        orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("qty").alias("qty"),
            F.sum("qty_r").alias("qty_r"),
            F.sum("lines").alias("lines"),
            F.sum(cents).alias("cents"),
        )
    )
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    segment = F.create_map(*[F.lit(x) for pair in zip(SEGMENTS, CATEGORIES) for x in pair])
    return customer.join(per_customer, customer["c_custkey"] == per_customer["o_custkey"], "left").select(
        F.col("c_custkey").alias("block_id"),
        (F.lit(-124.4) + F.lit(0.4) * F.col("c_nationkey")).alias("longitude"),
        (F.lit(32.0) + F.lit(0.4) * F.col("c_nationkey")).alias("latitude"),
        (F.col("c_custkey") % 60).cast("double").alias("housing_median_age"),
        (F.col("qty") / 10).alias("total_rooms"),
        (F.col("qty_r") / 5).alias("total_bedrooms"),
        F.col("lines").cast("double").alias("population"),
        F.col("orders").cast("double").alias("households"),
        (F.col("c_acctbal") / 1000).alias("median_income"),
        F.try_element_at(segment, F.col("c_mktsegment")).alias("ocean_proximity"),
        (F.col("cents") / (F.col("orders") * 100.0)).alias("median_house_value"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return events_as_requests(read_table(spark, folder, "events"))


def events_as_requests(events: DataFrame) -> DataFrame:
    """The event table as a prediction-request log; a plain projection, also over a stream."""
    k = F.get_json_object("props", "$.k").try_cast("int")  # one field: stays in generated code
    failed = F.col("event_type") == "error"
    status = F.when(failed, F.when(k % 2 == 0, 500).otherwise(400)).otherwise(200)
    legal = F.array(*[F.lit(c) for c in CATEGORIES])
    return events.select(
        F.col("event_id").alias("id"),
        "ts",
        F.col("event_type").alias("endpoint"),
        F.lit("POST").alias("method"),
        F.col("props").alias("input_data"),
        F.when(~failed, F.col("value") * 1000).alias("prediction"),
        k.cast("double").alias("processing_time_ms"),
        status.alias("status_code"),
        F.when(failed, F.concat(F.lit("status "), status.cast("string"))).alias("error_message"),
        F.get(legal, (F.col("user_id") % 5).cast("int")).alias("location_type"),
    )


def model_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of models named by brand, numbered by key within the brand."""
    from tallyframe.operators.ordering import number_rows

    part = read_table(spark, folder, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    numbered = number_rows(part, ["p_brand"], ["p_partkey"], "n")
    stages = F.array(*[F.lit(s) for s in ("Production", "Staging", "Archived", "None")])
    return numbered.select(
        F.col("p_brand").alias("name"),
        F.col("n").cast("string").alias("version"),
        F.get(stages, F.col("p_size") % 4).alias("stage"),
        F.lit("READY").alias("status"),
        F.col("p_partkey").cast("string").alias("run_id"),
        F.timestamp_add("MINUTE", F.col("p_partkey") * 7, F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")).alias("creation_ts"),
        F.concat(F.lit("build "), F.col("p_partkey").cast("string")).alias("description"),
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    return part.select(
        F.col("p_partkey").cast("string").alias("run_id"),
        F.concat(F.lit("run_"), F.col("p_partkey").cast("string")).alias("run_name"),
        F.col("p_type").alias("experiment_id"),
        F.col("p_partkey").alias("ordinal"),
        F.timestamp_add("MINUTE", F.col("p_partkey") * 7, F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")).alias("ts"),
        F.create_map(
            F.lit("test_r2"),
            F.col("p_retailprice") / 10000,
            F.lit("test_rmse"),
            F.lit(100000.0) - F.col("p_retailprice"),
        ).alias("metrics"),
        F.create_map(F.lit("model_type"), F.col("p_brand"), F.lit("max_depth"), F.col("p_size").cast("string")).alias(
            "params"
        ),
        F.create_map(F.lit("kind"), F.col("p_type")).alias("tags"),
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Actual order totals paired with an estimate from the order lines, both exact to a cent."""
    return actual_totals(spark, folder).join(estimated_totals(spark, folder), "key", "inner")


def actual_totals(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("y"))


def estimated_totals(spark: SparkSession, folder: str) -> DataFrame:
    cents = F.sum(F.round(F.col("l_extendedprice") * 100).cast("long"))
    lines = read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(cents.alias("cents"))
    return lines.select(F.col("l_orderkey").alias("key"), (F.col("cents") / 100.0).alias("y_hat"))
