"""Nearest vectors by cosine: probed lists, scanned in column blocks with early abandoning.

Vectors are dealt to lists by their nearest centre. A query looks through the lists of its nearest
centres; there the rotated unit vectors are compared column block by column block, and a candidate is
abandoned as soon as its partial distance, were the rest like it, would exceed the query's bound
with high confidence. What is left is scored exactly, in double precision, on the original vectors.

Centres, rotation and the number of lists to probe come from a bounded sample; every vector is
indexed. Long lists are cut into blocks, and the queries of a list into groups, so that one task never holds more
than a block and a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyframe.session import new_folder

SAMPLE_ROWS = 10_000
SAMPLE_QUERIES = 400
SAMPLE_RECALL = 0.985  # aimed at on the sample when the number of probes is chosen
BLOCK_ROWS, GROUP_ROWS = 4096, 1024
COLUMNS = 16
CONFIDENCE = 2.1  # standard deviations of the abandoning test
SEED_ROWS = 64  # rows of a block that give every query its first bound
FIT_ROUNDS = 12
SEED = 7


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, v``: vectors that take part, as arrays of double."""
    v = F.col(embedding).cast("array<double>")
    own = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null and size(v) > 0")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    own = own.filter(good)
    sizes = own.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return own.filter(F.size("v") == (sizes.n if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _level(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near one: no rounding, no overflow in squares."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def centres(sample: np.ndarray, lists: int) -> np.ndarray:
    """Unit centres of a sample of unit vectors (spherical k-means)."""
    rng = np.random.default_rng(SEED)
    found = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(FIT_ROUNDS):
        near = (sample @ found.T).argmax(axis=1)
        total = np.zeros_like(found)
        np.add.at(total, near, sample)
        length = np.linalg.norm(total, axis=1)
        found = np.where(length[:, None] > 1e-12, total / np.maximum(length, 1e-12)[:, None], found)
    return found


def probes_needed(sample: np.ndarray, found: np.ndarray, k: int) -> int:
    """Fewest lists with which queries from the sample find their neighbours within the sample."""
    rng = np.random.default_rng(SEED)
    queries = rng.permutation(len(sample))[:SAMPLE_QUERIES]
    near = sample[queries] @ sample.T
    near[np.arange(len(queries)), queries] = -2
    k = min(k, len(sample) - 1)
    if k < 1:
        return len(found)
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    home = (sample @ found.T).argmax(axis=1)
    order = np.argsort(np.argsort(-(sample[queries] @ found.T), axis=1), axis=1)
    place = np.sort(np.take_along_axis(order, home[best], axis=1).ravel())
    return int(place[min(len(place) - 1, int(np.ceil(SAMPLE_RECALL * len(place))))]) + 1


def scan(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, rotation: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and exact cosine of the ``k`` best rows of a block for every query."""
    rotated_q, rotated_x = _unit(queries) @ rotation, _unit(rows) @ rotation
    n, dims = rotated_x.shape
    first = min(n, SEED_ROWS)
    head = 2 - 2 * rotated_q @ rotated_x[:first].T
    head[query_ids[:, None] == ids[None, :first]] = 9
    bound = np.partition(head, k - 1, axis=1)[:, k - 1] if first > k else np.full(len(queries), 9.0)
    qi, xi = np.nonzero(head <= bound[:, None] + 1e-9)
    found_q, found_x = [qi], [xi]
    if n > first:
        x = rotated_x[first:]
        norms = np.cumsum(x**2, axis=1)
        partial = norms[:, COLUMNS - 1 if dims >= COLUMNS else -1][None, :] - 2 * rotated_q[:, :COLUMNS] @ x[:, :COLUMNS].T
        partial += (rotated_q[:, :COLUMNS] ** 2).sum(axis=1)[:, None]
        qi, xi = np.nonzero(partial <= _limit(bound, COLUMNS, dims)[:, None])
        distance = partial[qi, xi]
        for at in range(COLUMNS, dims, COLUMNS):
            part = slice(at, at + COLUMNS)
            distance = distance + ((rotated_q[qi, part] - x[xi, part]) ** 2).sum(axis=1)
            keep = distance <= _limit(bound, at + COLUMNS, dims)[qi]
            qi, xi, distance = qi[keep], xi[keep], distance[keep]
        found_q.append(qi)
        found_x.append(xi + first)
    qi, xi = np.concatenate(found_q), np.concatenate(found_x)
    other = query_ids[qi] != ids[xi]
    qi, xi = qi[other], xi[other]
    queries, rows = _level(queries), _level(rows)
    score = (queries[qi] * rows[xi]).sum(axis=1) / (np.sqrt((queries**2).sum(axis=1))[qi] * np.sqrt((rows**2).sum(axis=1))[xi])
    order = np.lexsort((ids[xi], -score, qi))
    qi, xi, score = qi[order], xi[order], score[order]
    start = np.flatnonzero(np.diff(qi, prepend=-1) != 0)
    rank = np.arange(len(qi)) - np.repeat(start, np.diff(np.append(start, len(qi))))
    return qi[rank < k], xi[rank < k], score[rank < k]


def _limit(bound: np.ndarray, seen: int, dims: int) -> np.ndarray:
    """Largest partial distance over ``seen`` columns that still may end within the bound."""
    if seen >= dims:
        return bound + 1e-9
    return bound * seen / dims * (1 + CONFIDENCE / np.sqrt(seen)) ** 2


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", probes: int | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``vectors`` found for each row of ``queries``.

    The score is the cosine in double precision; equal scores go to the smaller id. Rows with the query's own
    id are no candidates. Vectors that are null, zero, of another length than most, or that hold null or
    non-finite components take no part, nor do rows without an id. With fewer candidates than ``k`` all
    are returned. Of rows that repeat an id and a vector each counts. Other columns are not read.
    """
    spark = vectors.sparkSession
    own, asking = usable(vectors, vec_id, embedding), usable(queries, vec_id, embedding)
    total = own.count()
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    picked = own.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(2 * SAMPLE_ROWS)
    schema = "query_id long, rank int, vec_id long, score double"
    if total == 0:
        return spark.createDataFrame([], schema)
    sample = _unit(np.array([r.v for r in picked.select("v").collect()] or [own.first().v]))
    lists = int(max(1, min(len(sample) // 16, np.sqrt(total))))
    middle = centres(sample, lists)
    wanted = probes or probes_needed(sample, middle, k)
    rotation = np.linalg.qr(np.random.default_rng(SEED).normal(size=(sample.shape[1],) * 2))[0]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = (_unit(_matrix(batch.column(1))) @ middle.T).argmax(axis=1) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), *batch.columns], ["list", "vec_id", "v"])

    path = new_folder(spark, "lists")
    own.mapInArrow(deal, "list int, vec_id long, v array<double>").write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = np.zeros(len(middle), dtype=np.int64)
    for row in stored.groupBy("list").count().collect():
        sizes[row["list"]] = row["count"]
    blocks = np.maximum(1, -(-sizes // BLOCK_ROWS))
    # queries spread over the lists about as the vectors do
    groups = np.maximum(1, np.ceil(2 * asking.count() * min(1.0, wanted / len(middle)) / GROUP_ROWS)).astype(np.int64) * np.ones_like(blocks)

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every vector once for each group of its list's queries, in a block of its list."""
        for batch in batches:
            near = batch.column(0).to_numpy()
            ids = batch.column(1).to_numpy()
            times = groups[near]
            row = np.repeat(np.arange(len(near)), times)
            group = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            block = _spread(ids, 3)[row] % blocks[near[row]]
            taken = batch.take(pa.array(row))
            columns = [taken.column(0), pa.array(block.astype(np.int32)), pa.array(group.astype(np.int32)), taken.column(1), taken.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every query once for each block of the lists it probes: the nearest, and more until they can hold ``k`` others."""
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                ids, q = batch.column(0).to_numpy(), _unit(_matrix(batch.column(1)))
                order = np.argsort(-(q @ middle.T), axis=1, kind="stable")
                held = np.cumsum(sizes[order], axis=1)
                probe = np.maximum(wanted, 1 + (held < k + 1).sum(axis=1))
                chosen = np.arange(order.shape[1])[None, :] < probe[:, None]
                row, near = np.repeat(np.arange(len(ids)), chosen.sum(axis=1)), order[chosen]
                times = blocks[near]
                block = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                row, near = np.repeat(row, times), np.repeat(near, times)
                group = _spread(ids, 5)[row] % groups[near]
                taken = batch.take(pa.array(row))
                columns = [pa.array(x.astype(np.int32)) for x in (near, block, group)]
                yield pa.RecordBatch.from_arrays([*columns, taken.column(0), taken.column(1)], names)

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        left = left.sort_values("vec_id", kind="stable")
        x, ids = np.stack(left["v"].to_numpy()), left["vec_id"].to_numpy()
        out = []
        for at in range(0, len(right), GROUP_ROWS):
            part = right.iloc[at : at + GROUP_ROWS]
            q, query_ids = np.stack(part["v"].to_numpy()), part["vec_id"].to_numpy()
            qi, xi, score = scan(q, query_ids, x, ids, rotation, k)
            out.append(pd.DataFrame({"query_id": query_ids[qi], "vec_id": ids[xi], "score": score}))
        return pd.concat(out)

    names = ["list", "block", "group", "vec_id", "v"]
    kinds = "list int, block int, group int, vec_id long, v array<double>"
    data, searched = stored.mapInArrow(copies, kinds), asking.mapInArrow(ask, kinds)
    key = ["list", "block", "group"]
    found = data.groupBy(*key).cogroup(searched.groupBy(*key)).applyInPandas(look, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _spread(ids: np.ndarray, salt: int) -> np.ndarray:
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(8)).astype(np.int64)
