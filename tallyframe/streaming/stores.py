"""Sinks that keep their size: running totals with snapshots, and a watch over files that also sees changed ones.

All parts live in numbered slots that are overwritten in turn, so nothing has to be deleted, a replayed batch writes
the same again, and what a reader needs is never the part that is being written.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyframe.operators.retraining import retraining_event
from tallyframe.sources.tables import append_retraining
from tallyframe.streaming.jobs import DRAIN

COMPACT_EVERY = 10
FILES_AT_ONCE = 1000
SEEN = "file_path string, modified timestamp, length long"

# --- running totals -----------------------------------------------------------------------------


def start_totals(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    compact_every: int = COMPACT_EVERY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The newest row per key of an update-mode stream.

    A batch writes its changed rows to one of ``2 * compact_every`` slots. After every ``compact_every`` batches the newest
    rows become a snapshot, and then a pointer of one row is moved to it; snapshots and pointers have two slots each,
    so the last ones stay whole until the new ones are. A crash in between leaves the old pointer, whose changes are still in their
    slots. Reading costs a snapshot and that many slots, however many batches there were.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        slot = batch_id % (2 * compact_every)
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{path}/changes/slot={slot}")
        if batch_id == 0:
            _point(spark, path, 0, -1)
        if (batch_id + 1) % compact_every == 0:
            number = (batch_id + 1) // compact_every
            found = _newest(spark, path, keys, batch_id)
            found.write.mode("overwrite").parquet(f"{path}/snapshots/slot={number % 2}")
            _point(spark, path, number, batch_id)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**(trigger or DRAIN))
        .start()
    )


def _point(spark: SparkSession, path: str, number: int, up_to: int) -> None:
    """Snapshot ``number`` holds all batches up to ``up_to``."""
    one = spark.range(1).select(F.lit(number).cast("long").alias("number"), F.lit(up_to).cast("long").alias("up_to"))
    one.coalesce(1).write.mode("overwrite").parquet(f"{path}/pointer/slot={number % 2}")


def _newest(spark: SparkSession, path: str, keys: Sequence[str], before: int | None = None) -> DataFrame:
    """The newest rows with their ``batch_id``; ``before`` leaves out a snapshot of that batch or a later one."""
    pointers = spark.read.parquet(f"{path}/pointer")
    if before is not None:
        pointers = pointers.where(F.col("up_to") < before)
    number, up_to = pointers.orderBy(F.desc("up_to")).select("number", "up_to").first()
    rows = spark.read.parquet(f"{path}/changes").drop("slot").where(F.col("batch_id") > up_to)
    if up_to >= 0:
        rows = rows.unionByName(spark.read.parquet(f"{path}/snapshots/slot={number % 2}"))
    last = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    return rows.withColumn("_no", F.row_number().over(last)).where("_no = 1").drop("_no")


def totals(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of ``start_totals``."""
    return _newest(spark, path, keys).drop("batch_id")


# --- watched files ------------------------------------------------------------------------------


def file_states(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``file_path, modified, length`` of the files below a folder; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    meta = F.col("_metadata")
    return found.select(
        meta["file_path"].alias("file_path"), meta["file_modification_time"].alias("modified"), meta["file_size"].alias("length")
    )


def start_file_watch(
    clock: DataFrame,
    folder: str,
    schema: T.StructType | str,
    events_path: str,
    state_path: str,
    checkpoint: str,
    min_rows: int = 100,
    enabled: bool = True,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A retraining event per new or changed file with enough rows, looked for at every batch of ``clock``.

    The files seen are a table of path, time and length in two slots; a batch compares the folder with the slot of the
    batch before and then writes its own. Events are keyed by batch, so a replayed batch leaves one event per file; they bear the
    file's time. Only new and changed files are read.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = file_states(spark, folder)
        before = spark.createDataFrame([], SEEN)
        if batch_id > 0:
            before = spark.read.schema(SEEN).parquet(f"{state_path}/slot={(batch_id - 1) % 2}")
        now.write.mode("overwrite").parquet(f"{state_path}/slot={batch_id % 2}")
        if not enabled:
            return
        seen = spark.read.schema(SEEN).parquet(f"{state_path}/slot={batch_id % 2}")
        changed = seen.join(before, ["file_path", "modified", "length"], "left_anti").toLocalIterator()
        part = 0
        while some := list(islice(changed, FILES_AT_ONCE)):
            rows = spark.read.schema(schema).option("header", True).csv([r["file_path"] for r in some])
            meta = F.col("_metadata")
            own = rows.select(meta["file_path"].alias("file_path"), meta["file_modification_time"].alias("modified"))
            enough = own.groupBy("file_path", "modified").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= min_rows)
            columns = retraining_event(F.col("modified").cast("timestamp_ntz"), "new_data")
            details = F.concat(F.lit("New data file: "), F.col("file_path")).alias("details")
            append_retraining(enough.select(columns[0], columns[1], details, columns[3]), events_path, f"{batch_id}-{part}")
            part += 1

    return (
        clock.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint).trigger(**(trigger or DRAIN)).start()
    )
