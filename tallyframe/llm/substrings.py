"""Repeated word passages: winnowed anchors as seeds, extended to all windows they stand for.

Of the ``min_words - anchor_words + 1`` anchors (hashes of ``anchor_words`` consecutive words) inside a
window of ``min_words`` words the smallest, the leftmost of equals, is the window's seed, so equal
windows have equal seeds at the same place. One row is kept per seed: the stretch of windows that it
stands for and the hash of the whole stretch. Seeds that occur once are dropped by a count that
combines before the shuffle (and most of them before any, by a bitmap of fixed size of those that repeat); the others are compared as whole stretches, each with the first of its
kind; only firsts of kinds that share a seed are looked at window by window, from their texts.
No two occurrences are ever paired: each is compared with the earliest alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.words import WORD_BASE, Sums, Texts, pieces, signed
from tallyframe.session import new_folder

MIN_WORDS, ANCHOR_WORDS = 20, 8
BITMAP_BITS = 1 << 26  # 8 MB in every task, whatever the size of the table
KIND = ["h", "shape", "context"]


def _seeds(texts: Texts, min_words: int, anchor_words: int) -> tuple[np.ndarray, ...]:
    """Per seed: row, first window (word index in its row), place of the seed in that window, further
    windows, hash of the seed's words, hash of the stretch."""
    n = len(texts.starts)
    empty = np.zeros(0, dtype=np.int64)
    if n < min_words:
        return (empty,) * 4 + (empty.astype(np.uint64),) * 2
    sums = Sums(texts.word_hashes(), WORD_BASE)
    at = np.arange(n - anchor_words + 1)
    anchors = sums.of(at, at + anchor_words)
    width = min_words - anchor_words + 1
    seed = np.lib.stride_tricks.sliding_window_view(anchors, width).argmin(axis=1) + np.arange(n - min_words + 1)
    row = texts.row_of_words()
    inside = np.flatnonzero(row[: n - min_words + 1] == row[min_words - 1 :])  # windows of one document
    if not len(inside):
        return (empty,) * 4 + (empty.astype(np.uint64),) * 2
    of = seed[inside]
    head = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(row[inside], prepend=-1) != 0))
    lo = inside[head]
    hi = inside[np.append(head[1:], len(inside)) - 1]
    rows = row[lo]
    place = of[head]
    return rows, lo - texts.firsts[rows], place - lo, hi - lo, anchors[place], sums.of(lo, hi + min_words)


def seeds(docs: DataFrame, min_words: int, anchor_words: int, bitmap: np.ndarray | None = None) -> DataFrame:
    """``doc, lo, shape, h, context`` per seed of every text of ``docs`` (columns ``doc, text``).

    ``shape`` is the place of the seed in the stretch's first window times 256, plus the further windows. With a ``bitmap``
    only seeds whose bit is set.
    """
    names = ["doc", "lo", "shape", "h", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, _, offsets, data in pieces(batch.column(1)):
                found = _seeds(Texts(offsets, data), min_words, anchor_words)
                if bitmap is not None:
                    bit = found[4] % np.uint64(BITMAP_BITS)
                    here = bitmap[bit // np.uint64(64)] >> bit % np.uint64(64) & np.uint64(1) == 1
                    found = tuple(x[here] for x in found)
                rows, lo, left, span, h, context = found
                arrays = [lo.astype(np.int32), (left * 256 + span).astype(np.int32), signed(h), signed(context)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows + first)), *map(pa.array, arrays)], names)

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc {kind}, lo int, shape int, h long, context long")


def bitmap_of(hashes: DataFrame) -> np.ndarray:
    """One bit per value of ``h`` modulo ``BITMAP_BITS``: combined in Spark to one row per 64 bits that are not all zero."""
    bit = F.pmod("h", F.lit(BITMAP_BITS))
    word = F.expr("shiftleft(1L, cast(bit % 64 AS INT))")
    words = hashes.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("at")).agg(F.bit_or(word).alias("bits")).toArrow()
    out = np.zeros(BITMAP_BITS // 64, dtype=np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _list(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of every element, and the fields of all elements, of a list of structs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    fields = {flat.type.field(i).name: flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)}
    return np.repeat(np.arange(len(column)), lengths), fields


def _windows_of(joined: DataFrame, min_words: int) -> DataFrame:
    """One row per window of the stretches listed in ``parts``: seed, place, hash, document, start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, offsets, data in pieces(batch.column(1)):
                texts = Texts(offsets, data)
                sums = Sums(texts.word_hashes(), WORD_BASE)
                row, part = _list(batch.column(2).slice(first, end - first))
                left, times = part["shape"].astype(np.int64) // 256, part["shape"].astype(np.int64) % 256 + 1
                shift = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                row = np.repeat(row, times)
                lo = np.repeat(part["lo"].astype(np.int64), times) + shift
                start = texts.firsts[row] + lo
                arrays = [
                    np.repeat(part["h"], times),
                    (np.repeat(left, times) - shift).astype(np.int16),
                    signed(sums.of(start, start + min_words)),
                    lo.astype(np.int32),
                ]
                ids = batch.column(0).take(pa.array(row + first))
                yield pa.RecordBatch.from_arrays([*map(pa.array, arrays), ids], ["h", "offset", "window", "lo", "doc"])

    kind = joined.schema["doc"].dataType.simpleString()
    return joined.mapInArrow(run, f"h long, offset short, window long, lo int, doc {kind}")


def _without(joined: DataFrame) -> DataFrame:
    """Texts less the words covered by ``parts``."""
    names = ["doc", "n_words", "n_removed", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, offsets, data in pieces(batch.column(1)):
                texts = Texts(offsets, data)
                row, part = _list(batch.column(2).slice(first, end - first))
                change = np.zeros(len(texts.starts) + 1, dtype=np.int64)
                if len(row):
                    start = texts.firsts[row] + part["lo"]
                    np.add.at(change, start, 1)
                    np.add.at(change, start + part["n"], -1)
                gone = np.cumsum(change)[:-1] > 0
                sums = np.concatenate([[0], np.cumsum(gone)])
                removed = sums[texts.firsts[1:]] - sums[texts.firsts[:-1]]
                joined_text, begins, ends = texts.joined()
                kept = []
                for i in range(texts.rows):
                    a, b = int(texts.firsts[i]), int(texts.firsts[i + 1])
                    if removed[i] == 0:
                        kept.append(joined_text[begins[a] : ends[b - 1]] if b > a else b"")
                        continue
                    stay = np.flatnonzero(~gone[a:b]) + a
                    breaks = np.flatnonzero(np.diff(stay) > 1)
                    heads, tails = stay[np.append(0, breaks + 1)] if len(stay) else [], stay[np.append(breaks, -1)] if len(stay) else []
                    kept.append(b" ".join(joined_text[begins[x] : ends[y]] for x, y in zip(heads, tails)))
                arrays = [pa.array(texts.counts.astype(np.int64)), pa.array(removed.astype(np.int64))]
                text = pa.array(kept, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), *arrays, text], names)

    kind = joined.schema["doc"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc {kind}, n_words long, n_removed long, text string")


def _stored(rows: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared folder and read again: a join with them can then be split where it is skewed."""
    path = new_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def drop_repeated_passages(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    anchor_words: int = ANCHOR_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: every document less the passages that occur earlier.

    Words are maximal runs of other bytes than ASCII white space. A word goes if a window of
    ``min_words`` consecutive words covers it whose words also start earlier: in a document of a smaller
    id, or earlier in the same one. Windows are judged on the input. The kept words are joined by one
    space. Null and empty texts give zero words and an empty text. Ids should be unique; rows that
    repeat an id and its text all get the result of that document. Rows without an id are left out of
    comparisons and keep all words. Other columns are not read. ``min_words`` may be up to 255.
    """
    named = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    # both joins with the texts below read this one frame, so Spark shuffles the texts once
    known = named.filter(F.col("doc").isNotNull())
    often = seeds(known, min_words, anchor_words).groupBy("h").agg(F.count("*").alias("n"))
    often = _stored(often.filter("n > 1").select("h"), "seed-hashes")
    found = seeds(known, min_words, anchor_words, bitmap_of(often))
    found = _stored(found.join(often, "h", "left_semi"), "seeds")

    kinds = found.groupBy(*KIND).agg(F.min(F.struct("doc", "lo")).alias("first"))
    kinds = kinds.select(*KIND, F.col("first.doc").alias("doc0"), F.col("first.lo").alias("lo0"))
    later = (F.col("doc") != F.col("doc0")) | (F.col("lo") != F.col("lo0"))
    whole = found.join(kinds, KIND).filter(later).select("doc", "lo", (F.col("shape") % 256 + min_words).alias("n"))

    several = kinds.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    firsts = kinds.join(several, "h", "left_semi").select(F.col("doc0").alias("doc"), F.col("lo0").alias("lo"), "shape", "h")
    parts = firsts.groupBy("doc").agg(F.collect_list(F.struct("lo", "shape", "h")).alias("parts"))
    windows = _windows_of(known.join(parts, "doc"), min_words)
    key = ["h", "offset", "window"]
    earliest = windows.groupBy(*key).agg(F.min(F.struct("doc", "lo")).alias("first"), F.count("*").alias("times"))
    earliest = earliest.filter("times > 1").select(*key, F.col("first.doc").alias("doc0"), F.col("first.lo").alias("lo0"))
    single = windows.join(earliest, key).filter(later).select("doc", "lo", F.lit(min_words).alias("n"))

    gone = whole.unionByName(single).groupBy("doc").agg(F.collect_list(F.struct("lo", "n")).alias("parts"))
    nameless = named.filter(F.col("doc").isNull()).withColumn("parts", F.lit(None).cast(gone.schema["parts"].dataType))
    return _without(known.join(gone, "doc", "left").unionByName(nameless)).withColumnRenamed("doc", doc_id)
