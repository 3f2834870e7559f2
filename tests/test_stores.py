"""Stores of streams: size, replays and crashes."""

import os

import pytest
from pyspark.sql import functions as F

from tallyframe.streaming import jobs, stores


def add(spark, path, number):
    rows = [(f"k{number % 3}", number), ("all", number), (None, 1)]
    spark.createDataFrame(rows, "k string, v long").coalesce(1).write.mode("append").parquet(path)


def drained(spark, folder, every):
    stream = jobs.table_stream(spark, f"{folder}/in", files_per_batch=1).groupBy("k").agg(F.sum("v").alias("v"))
    stores.start_totals(stream, f"{folder}/out", f"{folder}/progress", ["k"], every).awaitTermination()


def expected(spark, folder):
    return sorted((r.k or "", r.v) for r in spark.read.parquet(f"{folder}/in").groupBy("k").agg(F.sum("v").alias("v")).collect())


def held(spark, folder):
    return sorted((r.k or "", r.v) for r in stores.totals(spark, f"{folder}/out", ["k"]).collect())


def test_reading_does_not_grow_with_batches(spark, tmp_path):
    folder, files = str(tmp_path), []
    for k in range(14):
        add(spark, f"{folder}/in", k)
        if k in (1, 6, 9, 13):
            drained(spark, folder, 2)
            assert held(spark, folder) == expected(spark, folder)
            files.append(len(stores.totals(spark, f"{folder}/out", ["k"]).inputFiles()))
    assert len(os.listdir(f"{folder}/out/changes")) == 4 and len(os.listdir(f"{folder}/out/snapshots")) == 2
    assert files[-1] <= files[1] + 2


@pytest.mark.parametrize("fails_at", [1, 2, 3])
def test_crash_between_snapshot_and_pointer(spark, tmp_path, monkeypatch, fails_at):
    folder, point, calls = str(tmp_path), stores._point, []

    def broken(session, path, number, up_to):
        if number:
            calls.append(number)
            if len(calls) == fails_at:
                raise OSError("lost")
        point(session, path, number, up_to)

    monkeypatch.setattr(stores, "_point", broken)
    for k in range(7):
        add(spark, f"{folder}/in", k)
    with pytest.raises(Exception, match="lost"):
        drained(spark, folder, 2)
    done = held(spark, folder)  # still readable
    assert dict(done)["all"] == sum(range(2 * fails_at))
    drained(spark, folder, 2)
    assert held(spark, folder) == expected(spark, folder)


def look(spark, folder, clock_rows):
    clock = f"{folder}/clock"
    for _ in range(clock_rows):
        spark.range(1).select(F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'").alias("ts")).coalesce(1).write.mode("append").parquet(clock)
    ticks = jobs.table_stream(spark, clock, files_per_batch=1)
    stores.start_file_watch(ticks, f"{folder}/data", "x int", f"{folder}/events", f"{folder}/seen", f"{folder}/progress").awaitTermination()
    return sorted((r.batch.split("-")[0], r.details.rsplit("/", 1)[1]) for r in spark.read.parquet(f"{folder}/events").selectExpr("string(batch) AS batch", "details").collect())


def put(path, rows, stamp):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("x\n" + "\n".join(map(str, range(rows))) + "\n")
    os.utime(path, (stamp, stamp))


def test_changed_files_and_replays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "FILES_AT_ONCE", 2)
    data = tmp_path / "data"
    for name, rows in (("a.csv", 150), ("b.csv", 99), ("deep/c.csv", 100), ("d.csv", 120), ("note.txt", 500)):
        put(data / name, rows, 1_700_000_000)
    assert look(spark, tmp_path, 1) == [("0", "a.csv"), ("0", "c.csv"), ("0", "d.csv")]
    put(data / "b.csv", 130, 1_700_000_000)  # longer, but of the same time
    put(data / "deep" / "c.csv", 100, 1_700_000_900)  # only touched
    (data / "d.csv").unlink()
    first = [("0", "a.csv"), ("0", "c.csv"), ("0", "d.csv")]
    assert look(spark, tmp_path, 2) == first + [("1", "b.csv"), ("1", "c.csv")]
    times = {r.ts for r in spark.read.parquet(f"{tmp_path}/events").collect()}
    assert len(times) == 2
    # a batch whose commit is lost is done again
    commits = sorted((tmp_path / "progress" / "commits").glob("[0-9]*"))
    (tmp_path / "progress" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    commits[-1].unlink()
    assert look(spark, tmp_path, 0) == first + [("1", "b.csv"), ("1", "c.csv")]
