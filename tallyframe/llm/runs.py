"""Periodic runs of words, found as maximal pairs of equal stretches.

A run of period q is a stretch whose words q apart are equal and which cannot be extended. Its two
copies, shifted by q, are a maximal pair: equal stretches with different words before and
after them. Maximal pairs are read from the LCP-interval tree of the document's suffixes, bottom-up: an
interval of value l holds the places where one stretch of l words begins, two places in different child
intervals with different words on the left are a maximal pair of length l, and if they lie q words apart with
q <= l the stretch from the first place to the second copy's end is a run of length q + l. So intervals below half the
least length are never looked at, and every interval keeps its places in order, as a whole and per left
word, so that only places close enough are met.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

LEAST_WORDS = 12
PIECE_WORDS = 1 << 16  # words whose suffixes are sorted at once; a longer document is a piece of its own
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
RUN = "struct<start:long,length:long,period:long>"


def suffix_order(keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes of a piece in order, and the rank of every place among stretches of 1, 2, 4, ... words.

    ``keys`` are numbers of words, of other values in every document, with one more of its own after each
    document; so no stretch found twice crosses a document's end. Places told apart keep their rank and
    are not sorted again.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [rank.astype(np.int32)], 1
    alone = new & np.append(new[1:], True)
    open_ = order[~alone]
    while len(open_):
        ahead = open_ + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + second
        at = np.argsort(key, kind="stable")
        places, key = open_[at], key[at]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        group = rank[places]
        head = np.ones(len(key), dtype=bool)
        head[1:] = group[1:] != group[:-1]
        index = np.arange(len(key))
        rank = rank.copy()
        rank[places] = group + np.maximum.accumulate(np.where(new, index, 0)) - np.maximum.accumulate(np.where(head, index, 0))
        levels.append(rank.astype(np.int32))
        step *= 2
        alone = new & np.append(new[1:], True)
        open_ = places[~alone]
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order, levels


def common_words(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Number of equal words from each place of ``a`` and ``b``, which differ."""
    n = len(levels[0])
    found = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + found, b + found
        inside = (x < n) & (y < n)
        same = inside & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        found[same] += 1 << k
    return found


class Places:
    """The places of one interval in order, as a whole and per word on their left."""

    __slots__ = ("all", "of")

    def __init__(self, place: int, left: int):
        self.all, self.of = [place], {left: [place]}

    def near(self, place: int, left: int, reach: int) -> Iterator[int]:
        """Places at most ``reach`` away with another left word."""
        everyone, own = self.all, self.of.get(left, ())
        i, end = bisect_left(everyone, place - reach), bisect_right(everyone, place + reach)
        while i < end:
            k = bisect_left(own, everyone[i]) if own else 0
            if k == len(own) or own[k] != everyone[i]:
                yield everyone[i]
                i += 1
                continue
            # the neighbours of the same left word follow one another in both lists: leap over them
            here, step = 0, 1
            while step:
                there = here + step
                if k + there < len(own) and i + there < end and own[k + there] == everyone[i + there]:
                    here, step = there, step * 2
                else:
                    step //= 2
            i += here + 1

    def add(self, other: Places) -> None:
        for left, places in other.of.items():
            own = self.of.get(left)
            if own is None:
                self.of[left] = places
            else:
                for place in places:
                    insort(own, place)
        for place in other.all:
            insort(self.all, place)


def _merged(a: Places, b: Places, value: int, found: list[tuple[int, int, int]]) -> Places:
    """Both sets as one, after their maximal pairs of ``value`` words and at most that distance are noted."""
    if len(a.all) < len(b.all):
        a, b = b, a
    for left, places in b.of.items():
        for place in places:
            for other in a.near(place, left, value):
                found.append((place, other, value) if place < other else (other, place, value))
    a.add(b)
    return a


def maximal_pairs(places: Sequence[int], values: Sequence[int], lefts: Sequence[int]) -> list[tuple[int, int, int]]:
    """``first, second, length`` of maximal pairs not farther apart than they are long, among places that
    are neighbours in suffix order; ``values[k]`` is what the places k and k + 1 have in common."""
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, Places]] = []  # open intervals: value, places of the children seen so far
    current = Places(places[0], lefts[0])
    for k, value in enumerate(values):
        while stack and stack[-1][0] > value:
            depth, held = stack.pop()
            current = _merged(held, current, depth, found)
        if stack and stack[-1][0] == value:
            current = _merged(stack.pop()[1], current, value, found)
        stack.append((value, current))
        current = Places(places[k + 1], lefts[k + 1])
    while stack:
        depth, held = stack.pop()
        current = _merged(held, current, depth, found)
    return found


def runs_of(numbers: list[np.ndarray], least: int) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of every run, by start and then period, for documents given as numbers of their words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in numbers]
    sizes = np.array([len(x) for x in numbers])
    if not sizes.sum():
        return out
    # a value of its own ends every document
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    doc = np.repeat(np.arange(len(numbers)), sizes + 1)
    words = np.concatenate([y for x in numbers for y in (x, [-1])])
    width = int(words.max(initial=0)) + 2
    keys = doc * width + words + 1
    order, levels = suffix_order(keys)
    half = -(-least // 2)
    value = np.zeros(len(order), dtype=np.int64)
    value[:-1] = common_words(order[:-1], order[1:], levels)
    deep = value >= half  # place k and the next one belong to one interval
    if not deep.any():
        return out
    first = np.flatnonzero(deep & ~np.append(False, deep[:-1]))
    last = np.flatnonzero(~deep & np.append(False, deep[:-1]))
    # leave out groups none of whose places are closer than they have words in common
    group = np.repeat(np.arange(len(first)), last - first + 1)
    at = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    most = np.maximum.reduceat(value, np.ravel(np.column_stack([first, last])))[::2]
    by_place = np.lexsort((order[at], group))
    gaps = np.diff(order[at][by_place])
    close = (group[1:] == group[:-1]) & (gaps <= most[group[1:]])
    kept = np.unique(group[1:][close])
    pairs: dict[int, dict[tuple[int, int], int]] = {}
    lefts = np.where(np.isin(order, starts), -2, words[order - 1])
    for g in kept.tolist():
        a, b = int(first[g]), int(last[g])
        d = int(doc[order[a]])
        own = pairs.setdefault(d, {})
        for i, j, length in maximal_pairs(order[a : b + 1].tolist(), value[a:b].tolist(), lefts[a : b + 1].tolist()):
            period = j - i
            if period <= length and period + length >= least:
                stretch = (i - int(starts[d]), period + length)
                # multiples of a period mark the same stretch again
                own[stretch] = min(own.get(stretch, period), period)
    for d, own in pairs.items():
        out[d] = sorted(((start, length, period) for (start, length), period in own.items()), key=lambda run: (run[0], run[2]))
    return out


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words less those behind the first period of a run."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: its runs of ``least`` words or more by start and then period, and
    the words left when of every run only the first period is kept, joined by one space.

    Words are what white space separates, compared byte by byte. Null and empty texts have no words, no runs and an
    empty ``collapsed``. Every row stands alone: rows that repeat an id, or have none, each give a row. Texts
    are read whole; memory grows with the longest one (about 200 bytes a word). Other columns are not read, so their names do
    not clash. An empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting, first, size = [], 0, 0
            for k, value in enumerate(batch.column(1)):
                words = WORD.findall((value.as_py() or "").encode())
                waiting.append(words)
                size += len(words)
                if size >= PIECE_WORDS or k + 1 == batch.num_rows:
                    yield _rows(batch.column(0).slice(first, len(waiting)), waiting, least)
                    waiting, first, size = [], k + 1, 0

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string"
    )


def _rows(ids: pa.Array, texts: list[list[bytes]], least: int) -> pa.RecordBatch:
    number: dict[bytes, int] = {}
    numbers = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for words in texts]
    runs = runs_of(numbers, least)
    left = [b" ".join(kept_words(words, own)).decode() for words, own in zip(texts, runs)]
    flat = [r for own in runs for r in own]
    places = np.concatenate([[0], np.cumsum([len(own) for own in runs])]).astype(np.int32)
    fields = [pa.array([r[i] for r in flat], pa.int64()) for i in range(3)]
    lists = pa.ListArray.from_arrays(pa.array(places), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    counts = pa.array([len(words) for words in texts], pa.int64())
    return pa.RecordBatch.from_arrays([ids, counts, lists, pa.array(left, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def longest(runs: Column) -> Column:
    """The run of greatest length; of equals the one of smallest start, then period. Null if there is none."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(ranked)


def digest(runs: Column) -> Column:
    """SHA-256 of ``start,length,period`` and a line end for every run."""
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256)


def with_planted_periods(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text``: every tenth document by the CRC-32 of its id repeats some of its words from one place on.

    With h the CRC-32, g = h div 10 and n words, the words from a = g mod n on become the p words found there again and
    again, p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    own = docs.select(doc_id, text, (h % 10 == 0).alias("picked"), F.floor(h / 10).alias("g"))
    # an explode of one row, so that the words are made once and not for each of them
    chosen = own.select("*", F.explode(F.array(F.when(F.col("picked"), words))).alias("words")).withColumn("n", F.size("words"))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    chosen = chosen.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i)
    changed = F.transform("words", lambda w, i: F.get("words", place(i).cast("int")))
    return chosen.select(doc_id, F.when(F.col("picked") & (F.col("n") > 0), F.array_join(changed, " ")).otherwise(F.col(text)).alias(text))
