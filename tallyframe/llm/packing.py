"""Best-fit packing of tokenized documents through patterns of lengths.

Only the histogram of piece lengths reaches the driver (``size`` counts, whatever the input). Patterns of
two or three lengths that fill a sequence are fitted to it by non-negative least squares and rounded;
what is left is packed best fit first on counts. The family of patterns (pairs, pairs and triples, none)
that needs the fewest sequences is taken. The plan is a list of runs: pieces ``start .. start +
count - 1`` of a length go to consecutive sequences at one offset. A piece finds its run by its length
and its rank among pieces of that length, which is its rank within its task plus the count of all tasks
before, so equal lengths are spread over all tasks and token ids are never moved.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tallyframe.llm.tokens import encoder
from tallyframe.session import new_folder

SIZE, END_ID = 2048, 0
PATTERN_STEP = 64  # triples hold at least one length that is a multiple of this
FIT_ROUNDS = 150


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids: all full but, possibly, the first."""
    first = n - size * ((n - 1) // size)
    return [(0, first)] + [(at, size) for at in range(first, n, size)]


def pieces_of(docs: DataFrame, vocabulary: str, size: int, doc_id: str, text: str) -> DataFrame:
    """One row per piece: its document, place, ids (little-endian bytes), task and rank in the task among equal lengths."""
    names = ["doc_id", "piece", "start", "length", "ids", "task", "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, task = encoder(vocabulary), TaskContext.get().partitionId()
        end, seen = END_ID.to_bytes(4, "little"), np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            out, held = ([], [], [], [], [], []), 0
            for i, one in enumerate(batch.column(1)):
                ids = ids_of(one.as_py()) + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    row = (i, piece, start, length, ids[4 * start : 4 * (start + length)], int(seen[length]))
                    seen[length] += 1
                    for values, value in zip(out, row):
                        values.append(value)
                held += len(ids)
                if held > 1 << 22 or i + 1 == len(batch):
                    rows, piece_no, starts, lengths, parts, ranks = out
                    columns = [pa.array(piece_no, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())]
                    columns += [pa.array(parts, pa.binary()), pa.array([task] * len(rows), pa.int32()), pa.array(ranks, pa.int64())]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], names)
                    out, held = ([], [], [], [], [], []), 0

    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string"))
    return own.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary, task int, rank long")


# --- the plan --------------------------------------------------------------------------------------


def patterns(counts: np.ndarray, size: int) -> np.ndarray:
    """Rows of three lengths (0: none) that fill a sequence exactly and occur in the histogram."""
    have = counts > 0
    have[0] = True
    a, b = np.meshgrid(np.arange(size + 1), np.arange(0, size + 1, PATTERN_STEP), indexing="ij")
    rows = np.stack([a.ravel(), b.ravel(), size - a.ravel() - b.ravel()], axis=1)
    rows = rows[rows[:, 2] >= 0]
    rows = np.unique(np.sort(rows, axis=1), axis=0)
    rows = rows[(rows[:, 1] > 0) & have[rows].all(axis=1)]
    return rows


def fit(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Repeats of every pattern by non-negative least squares (multiplicative updates keep them positive)."""
    n = len(counts)
    target = counts.astype(float)
    target[0] = 0

    def used(x):
        y = np.bincount(rows.ravel(), weights=np.repeat(x, rows.shape[1]), minlength=n)
        y[0] = 0
        return y

    x = target[np.where(rows == 0, n - 1, rows)].min(axis=1) / max(1, len(rows) / 64)
    goal = target[rows].sum(axis=1)
    for _ in range(FIT_ROUNDS):
        x *= goal / np.maximum(used(x)[rows].sum(axis=1), 1e-12)
    return x


def plan(counts: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, int]:
    """Runs ``(length, start rank, count, first sequence, offset)`` and the number of sequences.

    Rounded patterns can use up lengths that a better mixture needs, so each family is packed to the end
    and the shortest plan wins; of equals the one with more patterns.
    """
    rows = patterns(counts, size)
    families = [rows, rows[rows[:, 0] == 0], rows[:0]]
    return min((packed(counts, size, family) for family in families), key=lambda one: one[1])


def packed(counts: np.ndarray, size: int, rows: np.ndarray) -> tuple[np.ndarray, int]:
    """The plan that begins with fitted repeats of the patterns ``rows``."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    begin = np.zeros(len(left), dtype=np.int64)
    runs: list[tuple] = []
    sequences = 0

    def take(length: int, count: int, sequence: int, offset: int) -> None:
        runs.append((length, begin[length], count, sequence, offset))
        begin[length] += count
        left[length] -= count

    if len(rows):
        x = fit(rows, left)
        order = np.argsort(-x, kind="stable")
        repeats = np.diff(np.floor(np.cumsum(x[order]) + 0.5), prepend=0).astype(np.int64)
        for row, times in zip(rows[order[repeats > 0]].tolist(), repeats[repeats > 0].tolist()):
            lengths = [v for v in row if v]
            times = min([times, *(int(left[v]) // lengths.count(v) for v in lengths)])
            if times > 0:
                offset = 0
                for v in reversed(lengths):
                    take(v, times, sequences, offset)
                    offset += v
                sequences += times

    # what is left: longest first into the fullest sequences it fits in, many at a time
    open_: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free places -> (first sequence, how many)
    for length in range(size, 0, -1):
        for free in range(length, size):
            while left[length] and open_.get(free):
                first, many = open_[free].pop()
                now = min(many, int(left[length]))
                take(length, now, first, size - free)
                open_[free - length].append((first, now))
                if many > now:
                    open_[free].append((first + now, many - now))
            if not left[length]:
                break
        each = size // length
        for fill in (each, int(left[length]) % each):
            many = int(left[length]) // fill if fill else 0
            if many:
                for k in range(fill):
                    take(length, many, sequences, k * length)
                open_[size - fill * length].append((sequences, many))
                sequences += many
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5), sequences


def _place(ranked: DataFrame, runs: np.ndarray) -> DataFrame:
    """Sequence and offset of every piece. The runs are bounded by lengths and patterns, not by rows."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.drop("length_rank").schema)
    key = (runs[:, 0] << 44) + runs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            at = batch.schema.get_field_index("length_rank")
            rank = batch.column(at).to_numpy(zero_copy_only=False)
            found = runs[np.searchsorted(key, (length << 44) + rank, side="right") - 1] if len(runs) else runs
            sequence = found[:, 3] + rank - found[:, 1]
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for i, c in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(found[:, 4])], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    size: int = SIZE,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, on request, ``ids``.

    A document is its ids and an end id; a null or empty text is the end id alone. Longer documents are
    cut into pieces of ``size`` of which only the first may be shorter. Rows are packed as they are: ids
    that are null or repeat make no difference. An empty table gives no pieces. Other columns are not read.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "pieces")
    pieces_of(docs, vocabulary, size, doc_id, text).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)

    by_task = stored.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(size + 1, dtype=np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row.length] = row.n
    runs, _ = plan(histogram, size)

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    columns = ["doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), *(["ids"] if with_ids else [])]
    ranked = stored.select(*columns, "task", "rank").join(before, ["task", "length"])
    ranked = ranked.withColumn("length_rank", F.col("rank") + F.col("before")).drop("task", "rank", "before")
    return _place(ranked, runs)
