"""Row numbering inside groups that may hold most of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import ensure_checkpoint_dir

WINDOW_ROWS = 1_000_000
BROADCAST_RUNS = 200_000
_POSITION_BITS = 33


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    out: str = "row_no",
    size_out: str | None = None,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add a 1-based row number per ``keys`` in ``order`` (which must be total inside a group),
    and the size of the group as ``size_out``.

    While the largest group is small a window does it. Otherwise rows are range-partitioned
    on keys and order together, so a hot key spreads over many tasks, and each task's
    numbers are shifted by the rows of the same key in earlier partitions.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest, how_many = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    if keys and (largest or 0) <= window_rows:
        group = Window.partitionBy(*keys)
        numbers = {out: F.row_number().over(group.orderBy(*order)).cast("long")}
        if size_out:
            numbers[size_out] = F.count(F.lit(1)).over(group)
        return df.withColumns(numbers)
    return _number_by_range(df, list(keys), order, out, size_out, how_many)


def _number_by_range(df, keys, order, out, size_out, how_many):
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_mid", _POSITION_BITS))
        .checkpoint()  # range bounds are sampled: number and offset must see the same placement
    )
    # One row per (partition, key) that meet: at most partitions + distinct keys.
    runs = placed.groupBy("_part", *keys).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("_part").alias("_run_part"),
        *[F.col(k).alias(f"_run_{k}") for k in keys],
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_n").over(group).alias("_size"),
    )
    if parts + how_many <= BROADCAST_RUNS:
        runs = F.broadcast(runs)
    same = [F.col("_part") == F.col("_run_part")] + [F.col(k).eqNullSafe(F.col(f"_run_{k}")) for k in keys]
    numbers = [(F.col("_mid") + F.col("_shift")).cast("long").alias(out)]
    if size_out:
        numbers.append(F.col("_size").alias(size_out))
    return placed.join(runs, same, "inner").select(*df.columns, *numbers)
