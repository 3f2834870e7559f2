"""Near copies by SimHash fingerprints, joined through vantage-point trees.

Two fingerprints of 64 bits that differ in at most ``radius`` bits differ in at most
``radius // blocks`` bits within one of ``blocks`` disjoint bit blocks. The Hamming distance inside a
block is a metric, so each block gets a vantage-point tree of its own and is searched with that
much smaller radius: a node sends a fingerprint to the near side if its distance to the vantage
point is at most the node's limit, and a searching fingerprint to both sides only if the triangle
inequality leaves both open. The upper levels are built on the driver from a bounded sample and
say which shard holds a fingerprint and which shards it must search; the lower levels are built
inside the shards. Every pair that is met is checked on all 64 bits, so links are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.components import components
from tallyframe.llm.words import Texts, pieces, signed
from tallyframe.session import ensure_checkpoint_dir

SEED = 42
SAMPLE_ROWS = 20_000  # fingerprints that shape the upper levels of the trees
SHARD_ROWS = 20_000  # fingerprints a shard should hold
LEAF_ROWS = 96
PAIRS_AT_ONCE = 1 << 20

# Eight counters of one byte in a 64-bit word: the bits of a byte, one per counter. A counter holds LANE_ROWS ones.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
LANE_ROWS, PART_ROWS = 255, 1 << 16


def _hashes(text: bytes, starts: list[int], ends: list[int]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(text[s:e], SEED) for s, e in zip(starts, ends)), dtype=np.uint64, count=len(starts))


def _shingles(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of all rows one after the other, and their number per row."""
    joined, begins, ends = texts.joined()
    counts = texts.counts
    shingles = np.where(counts == 0, 0, np.maximum(counts - words + 1, 1))
    if not shingles.any():
        return np.zeros(0, dtype=np.uint64), shingles
    first_shingle = np.cumsum(shingles) - shingles
    place = np.arange(int(shingles.sum())) - np.repeat(first_shingle, shingles) + np.repeat(texts.firsts[:-1], shingles)
    last = np.minimum(place + words - 1, np.repeat(texts.firsts[1:], shingles) - 1)
    return _hashes(joined, begins[place].tolist(), ends[last].tolist()), shingles


def _fingerprints(hashes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """64 bits per row: bits set in more than half of the hashes of the row's shingles."""
    if not len(hashes):
        return np.zeros(len(shingles), dtype=np.uint64)
    first_shingle = np.cumsum(shingles) - shingles
    rows = np.repeat(np.arange(len(shingles)), shingles)
    run = (np.arange(len(hashes)) - np.repeat(first_shingle, shingles)) % LANE_ROWS
    ones = np.zeros((len(shingles), 64), dtype=np.int64)
    for at in range(0, len(hashes), PART_ROWS):
        part = hashes[at : at + PART_ROWS]
        begin = run[at : at + PART_ROWS] == 0
        begin[0] = True
        heads = np.flatnonzero(begin)
        lanes = np.add.reduceat(SPREAD[part.view(np.uint8).reshape(-1, 8)], heads, axis=0)
        np.add.at(ones, rows[at + heads], lanes.view(np.uint8).reshape(len(heads), 64))
    set_bits = (2 * ones > shingles[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row: 64 bits as a signed number. A text without words (or null) has zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, offsets, data in pieces(batch.column(1)):
                got = _fingerprints(*_shingles(Texts(offsets, data, lower=True), words))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(signed(got))], ["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, f"doc_id {kind}, fp long")


@dataclass(frozen=True)
class Rule:
    """What links two texts: shingles of ``words`` words whose fingerprints differ in at most ``radius``
    of 64 bits, found through ``blocks`` trees."""

    words: int = 5
    radius: int = 4
    blocks: int = 3


# --- trees ---------------------------------------------------------------------------------------


def masks_of(blocks: int) -> list[int]:
    """Disjoint bit masks that cover 64 bits."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]


def _distance(x: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((x ^ vantage) & mask).astype(np.int16)


def _split(values: np.ndarray, mask: np.uint64, radius: int) -> tuple[np.uint64, int] | None:
    """The vantage point and limit that keep both sides and the overlap small, or None if nothing is gained."""
    best = None
    for vantage in values[:: max(1, len(values) // 5)][:6]:
        of_distance = np.bincount(_distance(values, vantage, mask), minlength=66)
        near = np.cumsum(of_distance)
        for limit in np.unique(np.searchsorted(near, [len(values) // 3, len(values) // 2, 2 * len(values) // 3])):
            inside = int(near[limit])
            if not 0 < inside < len(values):
                continue
            to_near, to_far = int(near[min(limit + radius, 65)]), len(values) - int(near[limit - radius]) if limit >= radius else len(values)
            work = inside * to_near + (len(values) - inside) * to_far
            if best is None or work < best[0]:
                best = (work, vantage, int(limit))
    if best is None or best[0] > 0.9 * len(values) ** 2:
        return None
    return best[1], best[2]


def build_tree(sample: np.ndarray, mask: int, radius: int, leaf: int) -> list[tuple]:
    """Nodes as ``(vantage, limit, near child, far child)``; a leaf is ``(shard,)``."""
    nodes: list[tuple] = []
    shards = 0

    def grow(values: np.ndarray) -> int:
        nonlocal shards
        at = len(nodes)
        nodes.append(())
        cut = _split(values, np.uint64(mask), radius) if len(values) > leaf else None
        if cut is None:
            nodes[at] = (shards,)
            shards += 1
        else:
            near = _distance(values, cut[0], np.uint64(mask)) <= cut[1]
            nodes[at] = (*cut, grow(values[near]), grow(values[~near]))
        return at

    grow(sample)
    return nodes


def route(nodes: list[tuple], values: np.ndarray, mask: int, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard: the rows that must search it, and which of them it holds."""
    stack = [(0, np.arange(len(values)), np.ones(len(values), dtype=bool))]
    while stack:
        at, rows, home = stack.pop()
        if not len(rows):
            continue
        if len(nodes[at]) == 1:
            yield nodes[at][0], rows, home
            continue
        vantage, limit, near, far = nodes[at]
        d = _distance(values[rows], vantage, np.uint64(mask))
        inside = d <= limit
        to_near, to_far = d <= limit + radius, d > limit - radius
        stack.append((near, rows[to_near], home[to_near] & inside[to_near]))
        stack.append((far, rows[to_far], home[to_far] & ~inside[to_far]))


def shard_links(values: np.ndarray, home: np.ndarray, mask: int, rule: Rule) -> np.ndarray:
    """For every row of a shard the first row it is linked to, directly or through others."""
    inner = rule.radius // rule.blocks
    nodes = build_tree(np.unique(values), mask, inner, LEAF_ROWS)
    root = np.arange(len(values))
    for _, asking, at_home in route(nodes, values, mask, inner):
        held = asking[home[asking] & at_home]
        step = max(1, PAIRS_AT_ONCE // max(len(asking), 1))
        for at in range(0, len(held), step):
            part = held[at : at + step]
            i, j = np.nonzero(np.bitwise_count(values[part, None] ^ values[None, asking]) <= rule.radius)
            _join(root, part[i], asking[j])
    return root


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give both ends of every link the smallest root of the two, until nothing changes."""
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def fingerprint_links(distinct: DataFrame, rule: Rule, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``a, b``: links between first documents that connect all fingerprints the rule links (a spanning set of them).

    ``distinct`` has one row per fingerprint (``first_doc, fp``) and should be stored: it is read twice. The upper
    trees come from at most ``sample_rows`` of them, whatever the size of the table.
    """
    total = distinct.count()
    share = min(1.0, sample_rows / max(total, 1))
    picked = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = np.array([r.fp for r in picked.select("fp").limit(2 * sample_rows).collect()], dtype=np.int64).view(np.uint64)
    inner, masks = rule.radius // rule.blocks, masks_of(rule.blocks)
    leaf = max(64, int(SHARD_ROWS * len(sample) / max(total, 1)))
    trees = [build_tree(sample, mask, inner, leaf) for mask in masks]
    kind = distinct.schema["first_doc"].dataType.simpleString()
    names = ["block", "shard", "home", "doc", "fp"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for block, (nodes, mask) in enumerate(zip(trees, masks)):
                for shard, rows, home in route(nodes, values, mask, inner):
                    n, at = len(rows), pa.array(rows)
                    own = [np.full(n, block, np.int32), np.full(n, shard, np.int32), home]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, own), batch.column(0).take(at), batch.column(1).take(at)], names)

    def link(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc", kind="stable")
        ids, values = part["doc"].to_numpy(), part["fp"].to_numpy(np.int64).view(np.uint64)
        root = shard_links(values, part["home"].to_numpy(bool), masks[key[0]], rule)
        moved = np.flatnonzero(ids[root] != ids)
        return pd.DataFrame({"a": ids[moved], "b": ids[root[moved]]})

    dealt = distinct.select("first_doc", "fp").mapInArrow(deal, f"block int, shard int, home boolean, doc {kind}, fp long")
    return dealt.groupBy("block", "shard").applyInPandas(link, f"a {kind}, b {kind}")


def near_copies(docs: DataFrame, rule: Rule, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id``: every document, its fingerprint and the smallest document it is linked to.

    Equal fingerprints meet in one row before anything is compared, so copies cost nothing. Texts that are null or without
    words have fingerprint zero and link like any other; rows without a document id take no part; rows that repeat one are
    linked as their texts are. Columns of other names are not read, so they do not clash. An empty table gives an empty one.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    known = docs.filter(F.col(doc_id).isNotNull())
    of_doc = fingerprints(known, rule.words, doc_id, text).checkpoint()
    distinct = of_doc.groupBy("fp").agg(F.min("doc_id").alias("first_doc")).checkpoint()
    linked = components(fingerprint_links(distinct, rule)).select(F.col("node").alias("first_doc"), "root")
    classes = distinct.join(linked, "first_doc", "left").select("fp", F.coalesce("root", "first_doc").alias("component_id"))
    return of_doc.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, rule: Rule, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` less all but the smallest document of each component.

    Rows without a document id stay. Of rows that repeat both id and text one stays. Rows are carried whole, so their columns may
    have any type and name. An empty table gives an empty one.
    """
    gone = near_copies(docs, rule, doc_id, text).filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("sig"))
    kept = rows.filter("id is not null").join(gone, F.col("id") == F.col("gone"), "left_anti").dropDuplicates(["id", "sig"])
    return kept.unionByName(rows.filter("id is null")).select("row.*")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
