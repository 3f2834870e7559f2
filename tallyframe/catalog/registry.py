"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.numeric import round_to
from tallyframe.session import use_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under a key, with its SQL if there is one."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(use_settings(spark), folder)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def tidy(df: DataFrame, digits: int = 6, special: Mapping[str, int] | None = None) -> DataFrame:
    """Round doubles so that the order of additions does not show, and drop the sign of zero."""
    special = special or {}
    return df.select(
        *[
            (round_to(f.name, special.get(f.name, digits)) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def r(x: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"(round(({x}) * 1e{digits}) / 1e{digits} + 0e0)"


SEGMENT_CASE = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '<1H OCEAN' WHEN 'BUILDING' THEN 'INLAND'
    WHEN 'FURNITURE' THEN 'ISLAND' WHEN 'HOUSEHOLD' THEN 'NEAR BAY' WHEN 'MACHINERY' THEN 'NEAR OCEAN' END"""

_VIEWS = {
    "blocks": f"""
  li AS (SELECT l_orderkey, sum(l_quantity) AS qty, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS qty_r,
           count(*) AS lines FROM lineitem GROUP BY 1),
  per_customer AS (SELECT o_custkey, count(*) AS orders_n, sum(qty) AS qty, sum(qty_r) AS qty_r, sum(lines) AS lines,
           sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
         FROM orders LEFT JOIN li ON o_orderkey = l_orderkey GROUP BY 1),
  blocks AS (SELECT c_custkey AS block_id, -124.4e0 + 0.4e0 * c_nationkey AS longitude,
           32.0e0 + 0.4e0 * c_nationkey AS latitude, CAST(c_custkey % 60 AS DOUBLE) AS housing_median_age,
           qty / 10 AS total_rooms, qty_r / 5 AS total_bedrooms, CAST(lines AS DOUBLE) AS population,
           CAST(orders_n AS DOUBLE) AS households, c_acctbal / 1000 AS median_income,
           {SEGMENT_CASE} AS ocean_proximity, CAST(cents AS DOUBLE) / (orders_n * 100e0) AS median_house_value
         FROM customer LEFT JOIN per_customer ON c_custkey = o_custkey)""",
    "requests": """
  ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
  requests AS (SELECT event_id AS id, ts, event_type AS endpoint, 'POST' AS method, props AS input_data,
           CASE WHEN event_type <> 'error' THEN value * 1000 END AS prediction, CAST(k AS DOUBLE) AS processing_time_ms,
           CASE WHEN event_type <> 'error' THEN 200 WHEN k % 2 = 0 THEN 500 ELSE 400 END AS status_code,
           CASE WHEN event_type = 'error' THEN 'status ' || CASE WHEN k % 2 = 0 THEN '500' ELSE '400' END END AS error_message,
           (['<1H OCEAN', 'INLAND', 'ISLAND', 'NEAR BAY', 'NEAR OCEAN'])[user_id % 5 + 1] AS location_type
         FROM ev),
  clock AS (SELECT max(ts) AS as_of FROM requests)""",
    "versions": """
  versions AS (SELECT p_brand AS name, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS VARCHAR) AS version,
           CASE p_size % 4 WHEN 0 THEN 'Production' WHEN 1 THEN 'Staging' WHEN 2 THEN 'Archived' ELSE 'None' END AS stage,
           'READY' AS status, CAST(p_partkey AS VARCHAR) AS run_id,
           TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey * 7) AS creation_ts,
           'build ' || p_partkey AS description FROM part)""",
    "runs": """
  runs AS (SELECT CAST(p_partkey AS VARCHAR) AS run_id, 'run_' || p_partkey AS run_name, p_type AS experiment_id,
           p_partkey AS ordinal, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey * 7) AS ts,
           p_retailprice / 10000 AS test_r2, 100000e0 - p_retailprice AS test_rmse,
           p_brand AS model_type, CAST(p_size AS VARCHAR) AS max_depth, p_type AS kind FROM part)""",
    "scored": """
  est AS (SELECT l_orderkey AS key, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100e0 AS y_hat
          FROM lineitem GROUP BY 1),
  scored AS (SELECT o_orderkey AS key, o_totalprice AS y, y_hat FROM orders JOIN est ON o_orderkey = key)""",
}


def over(views: str, body: str) -> str:
    """SQL over the named views (blank-separated); ``body`` may go on with more named queries."""
    joined = ",".join(_VIEWS[v] for v in views.split())
    body = body.strip()
    glue = "," if body.startswith("+") else ""
    return f"WITH {joined.strip()}{glue}\n{body.lstrip('+')}"
