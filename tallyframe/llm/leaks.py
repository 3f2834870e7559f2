"""Benchmark passages in documents, found by q-gram counts in diagonal bands and banded alignment.

An item of ``m`` bytes that occurs with at most ``k`` edits shares at least ``m - q + 1 - k * q`` q-grams with
the place where it occurs (the q-gram lemma), all on ``k + 1`` neighbouring diagonals. Shared q-grams are
counted in bands of diagonals that overlap by ``k``, so one band holds them all; bands that reach the bound
are aligned with the item, and kept if the edits fit the budget. No region within budget can be missed.

Items are searched in blocks of bounded size, each broadcast to a pass over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.words import pieces

Q = 8
EDIT_SHARE = 0.1
MIN_BYTES = 16  # shorter items would turn up by chance
BLOCK_BYTES = 4_000_000  # of items that are searched in one pass
TABLE_BITS = 22

# Letters and digits stay (capitals become small), all other ASCII becomes a space; other bytes stay.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[:128] = 32
PLAIN[48:58], PLAIN[97:123], PLAIN[65:91] = np.arange(48, 58), np.arange(97, 123), np.arange(97, 123)


def normalized(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with runs of spaces and marks as one space: bytes, their places in ``data``, new offsets."""
    plain = PLAIN[data]
    space = plain == 32
    again = np.zeros(len(data), dtype=bool)
    again[1:] = space[1:] & space[:-1]
    again[offsets[(offsets > 0) & (offsets < len(data))]] = False
    place = np.flatnonzero(~again)
    return plain[place], place, np.searchsorted(place, offsets)


def grams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return np.ndarray((n,), dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,)).copy()


class Index:
    """q-grams of a block of items."""

    def __init__(self, ids: list, texts: list[str], edit_share: float):
        kept = []
        for item, text in zip(ids, texts):
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            plain = normalized(np.array([0, len(raw)]), raw)[0].tobytes().strip()
            if len(plain) >= MIN_BYTES:
                kept.append((item, plain))
        self.ids = [item for item, _ in kept]
        self.plain = [np.frombuffer(plain, dtype=np.uint8) for _, plain in kept]
        self.size = np.array([len(p) for p in self.plain], dtype=np.int64)
        #: edits allowed: the share, but never so many that no shared q-gram would be needed
        self.edits = np.minimum((self.size * edit_share).astype(np.int64), np.maximum((self.size - Q) // Q, 0))
        self.bound = self.size - Q + 1 - self.edits * Q
        self.width = np.maximum(64, 1 << np.ceil(np.log2(self.edits + 1)).astype(np.int64))
        parts = [grams(p) for p in self.plain]
        of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        at = np.concatenate([np.arange(len(p)) for p in parts]) if parts else np.zeros(0, dtype=np.int64)
        values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
        order = np.argsort(values, kind="stable")
        self.values, self.of, self.at = values[order], of[order], at[order]
        self.table = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.table[self._slot(self.values)] = True

    @staticmethod
    def _slot(values: np.ndarray) -> np.ndarray:
        return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def bands(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """``(row, item, first diagonal)`` of the bands with enough shared q-grams. A diagonal is the place
        in the row's text less the place in the item."""
        values = grams(data)
        place = np.flatnonzero(self.table[self._slot(values)])
        values = values[place]
        lo, hi = np.searchsorted(self.values, values, "left"), np.searchsorted(self.values, values, "right")
        place, lo, times = place[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        row = np.searchsorted(offsets, place, "right") - 1
        inside = place + Q <= offsets[row + 1]
        place, lo, times, row = place[inside], lo[inside], times[inside], row[inside]
        hit = np.repeat(lo, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        row, item = np.repeat(row, times), self.of[hit]
        diagonal = np.repeat(place, times) - offsets[row] - self.at[hit]
        width = self.width[item]
        band = diagonal // width
        before = diagonal - band * width < self.edits[item]  # also within reach of the band before
        row, item, band, at = (
            np.concatenate([x, y[before]]) for x, y in ((row, row), (item, item), (band, band - 1), (self.at[hit], self.at[hit]))
        )
        if not len(row):
            return []
        base = int(band.min())
        spread = int(band.max()) - base + 1
        key = (row * len(self.ids) + item) * spread + band - base
        near, counts = np.unique(key, return_counts=True)
        near = near[counts >= self.bound[near // spread % len(self.ids)]]
        slot = np.minimum(np.searchsorted(near, key), max(len(near) - 1, 0))
        kept = near[slot] == key if len(near) else np.zeros(0, dtype=bool)
        # a q-gram of the item counts once, however often the band repeats it
        longest = int(self.size.max())
        key, counts = np.unique(np.unique(key[kept] * longest + at[kept]) // longest, return_counts=True) if len(near) else (near, near)
        pair, band = key // spread, key % spread + base
        row, item = pair // len(self.ids), pair % len(self.ids)
        enough = counts >= self.bound[item]
        row, item, band = row[enough], item[enough], band[enough]
        return list(zip(row.tolist(), item.tolist(), (band * self.width[item]).tolist()))

    def align(self, text: np.ndarray, item: int, diagonal: int) -> tuple[int, int, int] | None:
        """Start, end and edits of the best place for an item in a band, or None if it takes too many."""
        plain, allowed = self.plain[item], int(self.edits[item])
        begin = max(diagonal, 0)
        end = min(diagonal + int(self.width[item]) + 2 * allowed + len(plain), len(text))
        region = text[begin:end]
        found = region.tobytes().find(plain.tobytes())
        if found >= 0:
            return begin + found, begin + found + len(plain), 0
        if allowed == 0:
            return None
        got = edit_ends(plain, region, diagonal - begin, diagonal - begin + int(self.width[item]) + allowed, allowed)
        if got is None:
            return None
        edits, last = got
        _, back = edit_ends(plain[::-1], region[:last][::-1], -allowed, allowed, allowed, fixed=True)
        return begin + last - back, begin + last, edits


def edit_ends(
    item: np.ndarray, region: np.ndarray, lowest: int, highest: int, allowed: int, fixed: bool = False
) -> tuple[int, int] | None:
    """Fewest edits that turn ``item`` into a stretch of ``region``, and where the first such stretch ends;
    None if they are more than ``allowed``.

    Stretches start anywhere, or at the beginning if ``fixed``, and stay on the diagonals (place in
    ``region`` less place in ``item``) from ``lowest`` to ``highest``.
    """
    d = np.arange(lowest, highest + 1)
    far = len(item) + len(region) + 1
    cost = np.where((d >= 0) & (d <= len(region)), d if fixed else 0, far)
    padded = np.full(len(item) + len(d) + max(-lowest, 0) + len(region) + 1, -1, dtype=np.int16)
    shift = max(-lowest, 0)
    padded[shift : shift + len(region)] = region
    for i, byte in enumerate(item):
        at = i + lowest + shift
        step = cost + (padded[at : at + len(d)] != byte)
        np.minimum(step[:-1], cost[1:] + 1, out=step[:-1])
        cost = np.minimum.accumulate(step - d) + d
        if lowest + i + 1 < 0 or highest + i + 1 > len(region):
            cost[(d + i + 1 < 0) | (d + i + 1 > len(region))] = far
        if i % 8 == 7 and cost.min() > allowed:
            return None
    best = int(cost.argmin())
    return (int(cost[best]), int(d[best]) + len(item)) if cost[best] <= allowed else None


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    edit_share: float = EDIT_SHARE,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, item_id, start, end, edits``: every place of a document that holds a benchmark item.

    Small and capital ASCII letters are equal, and runs of ASCII marks and spaces count as one space. An item
    may differ by ``edit_share`` of its bytes. ``start`` and ``end`` count characters of the original text; of
    places of one item that overlap the one with fewest edits stays, the first of equals. Null texts hold nothing; null
    items, and items of fewer than ``MIN_BYTES`` bytes, are not searched. Rows of either table that repeat are
    treated one by one; rows without a document id are found like others.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-total // block_bytes))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string"))
    kinds = own.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    item_type = pa.int64() if kinds[1] in ("bigint", "int", "smallint", "tinyint") else pa.string()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start long, end long, edits int"
    out = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect() if blocks > 1 else items.collect()
        index = Index([r.item_id for r in part], [r.text for r in part], edit_share)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, _, offsets, data in pieces(batch.column(1)):
                    plain, place, at = normalized(offsets, data)
                    found = []
                    for row, item, diagonal in index.bands(plain, at):
                        got = index.align(plain[at[row] : at[row + 1]], item, diagonal)
                        if got:
                            found.append((row, item, *got))
                    rows = []
                    taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
                    for row, item, start, end, edits in sorted(found, key=lambda x: (x[0], x[1], x[4], x[2])):
                        known = taken.setdefault((row, item), [])
                        if all(end <= a or b <= start for a, b in known):
                            known.append((start, end))
                            rows.append((row, item, start, end, edits))
                    if not rows:
                        continue
                    spans = []
                    for row, _, start, end, _ in rows:
                        head, lo, hi = offsets[row], place[at[row] + start], place[at[row] + end - 1] + 1
                        spans.append([int(np.count_nonzero((data[head:x] & 0xC0) != 0x80)) for x in (lo, hi)])
                    columns = [
                        batch.column(0).take(pa.array([first + r[0] for r in rows])),
                        pa.array([index.ids[r[1]] for r in rows], item_type),
                        pa.array([s for s, _ in spans], pa.int64()),
                        pa.array([e for _, e in spans], pa.int64()),
                        pa.array([r[4] for r in rows], pa.int32()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "start", "end", "edits"])

        found = own.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("doc_id", doc_id)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; rows without an id stay. Other columns may have any names."""
    leaks = find_leaks(docs, benchmark, doc_id=doc_id, text=text).select(F.col(doc_id).alias("_leak")).distinct()
    return docs.join(leaks, docs[doc_id] == leaks["_leak"], "left_anti")
