"""Ranked lexical search that scores every distinct bag of query terms once.

To the items of a query set a document is what it holds of their vocabulary: how often each of the terms occurs,
and a number ``m`` made of its length. Documents are cut down to that bag, bags of equal hash are compared, and a class of
documents with equal bag and ``m`` is scored once. All weights are whole numbers, so sums are exact, and members of
a class have one score: only its first members by document id can be among the best.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.session import new_folder

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
BEST = 50
VOCABULARY_BYTES = 64 << 20  # text of items whose terms are searched in one pass; more items take more passes
ITEMS_AT_ONCE, CLASSES_AT_ONCE, CELLS_AT_ONCE = 256, 1024, 1 << 22
CLASS = ["h", "m", "first_id"]


def terms(text: str | None) -> list[bytes]:
    """Maximal stretches of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased."""
    return TERM.findall((text or "").encode().lower())


def bags(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n, h, bag``: number of terms of every row, and of the vocabulary's the numbers (ascending) with
    their counts, as 32-bit integers in one string of bytes, and a hash of it. A bag may be empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            counts, found, hashes = [], [], []
            for value in batch.column(1):
                own = terms(value.as_py())
                tf = Counter(map(vocabulary.get, own))
                tf.pop(None, None)
                bag = np.array(sorted(tf.items()), dtype="<i4").tobytes()
                counts.append(len(own))
                found.append(bag)
                hashes.append(xxh64_intdigest(bag) - (1 << 63))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "h", "bag"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, f"doc_id {kind}, n long, h long, bag binary")


def document_frequencies(found: DataFrame) -> DataFrame:
    """``term, df`` of the bags: combined in each task, so a row per term and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            joined = np.frombuffer(b"".join(x.as_py() for x in batch.column(0)), dtype="<i4")
            numbers, times = np.unique(joined[::2], return_counts=True)
            held.update(dict(zip(numbers.tolist(), times.tolist())))
        if held:
            yield pa.RecordBatch.from_pydict({"term": pa.array(held.keys(), pa.int32()), "df": pa.array(held.values(), pa.int64())})

    each = found.select("bag").mapInArrow(run, "term int, df long")
    return each.groupBy("term").agg(F.sum("df").alias("df"))


def class_members(found: DataFrame, best: int) -> DataFrame:
    """``h, m, first_id, doc_id, place, bag``: the first ``best`` documents of every class of equal bags and ``m``.

    Rows meet by the hash, and the bags themselves are compared. Each task sends at most ``best`` rows of a class.
    """
    same = "PARTITION BY h, m, bag ORDER BY doc_id"
    ranked = found.filter(F.length("bag") > 0).withColumn("place", F.expr(f"row_number() OVER ({same})")).filter(F.col("place") <= best)
    return ranked.withColumn("first_id", F.expr(f"first_value(doc_id) OVER ({same})")).select(*CLASS, "doc_id", "place", "bag")


class Best:
    """The best classes of every item among those seen so far: score, then smallest first document."""

    def __init__(self, items: int, best: int):
        self.best, self.items = best, items
        self.held: tuple[np.ndarray, ...] = tuple(np.zeros(0, dtype=np.int64) for _ in range(5))

    def add(self, item: np.ndarray, score: np.ndarray, *classes: np.ndarray) -> None:
        rows = [np.concatenate(x) for x in zip(self.held, (item, score, *classes))]
        order = np.lexsort((rows[2], -rows[1], rows[0]))
        sorted_items = rows[0][order]
        place = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items)
        keep = order[place < self.best]
        self.held = tuple(x[keep] for x in rows)


def scored(classes: DataFrame, items: list[tuple[int, np.ndarray]], weights: np.ndarray, best: int) -> DataFrame:
    """``item, score`` and the class of each item's ``best`` classes, found in every task.

    ``items`` are numbers with those of their terms. Counts become whole-number parts of a score; their products with the
    weights are summed in doubles, which is exact as every sum stays below 2**53.
    """
    blocks = []
    for at in range(0, len(items), ITEMS_AT_ONCE):
        part = items[at : at + ITEMS_AT_ONCE]
        columns = np.unique(np.concatenate([t for _, t in part]))
        factor = np.zeros((len(columns), len(part)))
        for k, (_, own) in enumerate(part):
            factor[np.searchsorted(columns, own), k] = weights[own]
        blocks.append((np.array([i for i, _ in part]), columns, factor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Best(len(numbers), best) for numbers, _, _ in blocks]
        for batch in batches:
            for at in range(0, batch.num_rows, CLASSES_AT_ONCE):
                part = batch.slice(at, CLASSES_AT_ONCE)
                each = [np.frombuffer(x.as_py(), dtype="<i4").reshape(-1, 2) for x in part.column(3)]
                if not each:
                    continue
                flat = np.concatenate(each).astype(np.int64)
                h, m, first_id = (part.column(k).to_numpy() for k in range(3))
                row = np.repeat(np.arange(len(each)), [len(x) for x in each])
                value = (1_000_000_000 * flat[:, 1]) // (1000 * flat[:, 1] + 20 * m[row])
                for best_of, (numbers, columns, factor) in zip(kept, blocks):
                    column = np.searchsorted(columns, flat[:, 0])
                    column[column == len(columns)] = 0
                    here = columns[column] == flat[:, 0]
                    step = max(1, CELLS_AT_ONCE // len(columns))
                    for low in range(0, len(each), step):
                        own = here & (row >= low) & (row < low + step)
                        matrix = np.zeros((min(step, len(each) - low), len(columns)))
                        matrix[row[own] - low, column[own]] = value[own]
                        score = (matrix @ factor).astype(np.int64)
                        i, k = np.nonzero(score > 0)
                        best_of.add(numbers[k], score[i, k], first_id[low + i], h[low + i], m[low + i])
        for best_of in kept:
            names = ["item", "score", "first_id", "h", "m"]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in best_of.held], names)

    kind = "item long, score long, first_id long, h long, m long"
    return classes.select(*CLASS[:2], "first_id", "bag").mapInArrow(run, kind)


def item_blocks(items: DataFrame, item_id: str, text: str, most: int) -> Iterator[dict[int, set[bytes]]]:
    """The terms of every item, in blocks of items that hold about ``most`` bytes of text."""
    known = items.filter(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(F.col(item_id).cast("long").alias("item"), F.col(text).cast("string").alias("text"))
    size = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()["size"]
    number = -(-size // most)
    for k in range(number):
        own: dict[int, set[bytes]] = {}
        for row in known.filter(F.pmod(F.xxhash64("item"), F.lit(number)) == k).toLocalIterator():
            own.setdefault(row["item"], set()).update(terms(row["text"]))
        if any(own.values()):
            yield {i: t for i, t in own.items() if t}


def best_documents(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    vocabulary_bytes: int = VOCABULARY_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of every item with a score above 0, all if fewer.

    With N documents that hold a term, L terms in all of them, n in one document, tf occurrences of a term in it and df documents
    that hold the term, a document scores the sum of ``floor(1000 ln((2N+2)/(2df+1))) * (10**9 tf div (1000 tf + 20 m))``
    over the item's terms, with ``m = 50 + 50 n N div L``. Equal scores go by ascending document id.

    Null and empty texts hold no terms. Rows without a document id or item id take no part. Rows that repeat a document
    id are documents of their own, with a rank each; rows that repeat an item id are one item. Texts are
    read whole. An item whose terms no document holds, or only null or empty ones, gives no rows, as do empty tables. Other
    columns are not read, so their names do not clash. Items are held by every task, so they are searched in blocks of
    ``vocabulary_bytes`` of text, each in a pass of its own: there is no limit to their number.
    """
    spark = docs.sparkSession
    known = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = [_block(spark, known, own, best) for own in item_blocks(items, item_id, item_text, vocabulary_bytes)]
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _block(spark: SparkSession, docs: DataFrame, items: dict[int, set[bytes]], best: int) -> DataFrame:
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*items.values())))}
    path = new_folder(spark, "bags")
    bags(docs, vocabulary).write.parquet(path)
    found = spark.read.parquet(path)
    total = found.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n, length = total["docs"], total["terms"] or 1
    # as many rows as the vocabulary has terms, which the block of items bounds
    df = {r["term"]: r["df"] for r in document_frequencies(found).toLocalIterator()}
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(k, 0) + 1))) for k in range(len(vocabulary))], dtype=np.int64)
    ids = [(i, np.array(sorted(vocabulary[t] for t in own), dtype=np.int64)) for i, own in sorted(items.items())]

    path = new_folder(spark, "classes")
    sized = found.withColumn("m", F.expr(f"50 + (50 * n * {n}L) div {length}L"))
    class_members(sized, best).write.parquet(path)
    members = spark.read.parquet(path)
    by_item = "PARTITION BY item ORDER BY score DESC, first_id"
    tops = scored(members.filter("place = 1"), ids, weights, best)
    tops = tops.withColumn("place", F.expr(f"row_number() OVER ({by_item})")).filter(F.col("place") <= best).drop("place")
    rows = tops.join(members.drop("bag", "place"), CLASS)
    ranked = rows.withColumn("rank", F.expr("row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)"))
    return ranked.filter(F.col("rank") <= best).select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
