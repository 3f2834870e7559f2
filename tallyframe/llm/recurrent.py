"""Log-likelihood of whole documents under a gated recurrent language model.

Word counts come from all learning documents; the commonest words are the network's vocabulary, all
others stand for themselves within buckets by their spelling. A network (one gated recurrent layer, output
factored into classes and words within them) is fitted with truncated backpropagation: each task
trains on its own documents from the weights all share, and the weights are averaged after each
round. Every learning document is read in one of the rounds. Scoring carries the state from window to window through a document, from its first word to its end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyframe.llm.toxicity import held_out
from tallyframe.llm.words import Texts, pieces, signed
from tallyframe.session import new_folder

HIDDEN, CLASSES = 16, 32  # units, and classes of as many entries each
PREFIXES = 64
BUCKETS = 2 * PREFIXES
TABLE_WORDS = 200_000  # commonest words whose counts every task holds; all others are joined
WINDOW, LANES = 16, 512
ROUNDS = 3  # each over its share of the learning documents, by hash
RATE = 0.02
PIECE = 1 << 21
SCORED_BYTES = 1 << 24  # texts laid into lanes together: the longest costs as many steps as it has words, whatever is beside it


def _tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and spelling bucket (first two bytes, mark at the end) of every word."""
    first = texts.data[texts.starts].astype(np.int64)
    second = np.where(texts.ends - texts.starts > 1, texts.data[np.minimum(texts.starts + 1, len(texts.data) - 1)], 0) if len(first) else first
    last = texts.data[texts.ends - 1] if len(first) else first
    mark = (last < 128) & ~((last >= 97) & (last <= 122)) & ~((last >= 48) & (last <= 57))
    return texts.word_hashes(), (first * 37 + second * 11) % PREFIXES * 2 + mark


def word_counts(docs: DataFrame) -> DataFrame:
    """``h, bucket, n``: how often every word occurs in all texts of ``docs`` (column ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, offsets, data in pieces(batch.column(0), PIECE):
                hashes, bucket = _tokens(Texts(offsets, data, lower=True))
                found, at, n = np.unique(hashes, return_index=True, return_counts=True)
                columns = [pa.array(signed(found)), pa.array(bucket[at].astype(np.int32)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["h", "bucket", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(run, "h long, bucket int, n long")
    return rows.groupBy("h").agg(F.max("bucket").alias("bucket"), F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """Counts that every task needs: the commonest words by hash, and sums over all words."""

    hashes: np.ndarray  # ascending
    log_count: np.ndarray  # log10(count + 1)
    entry: np.ndarray  # place in the network's vocabulary, or -1
    bucket_entry: np.ndarray
    bucket_log: np.ndarray  # log10 of the bucket's words and occurrences, plus one
    end_entry: int
    documents: int
    tokens: int
    distinct: int
    start: np.ndarray  # counts of the network's entries

    @staticmethod
    def of(counts: DataFrame, documents: int) -> Lexicon:
        # the least count of the table comes from a histogram of a few hundred bins, so no task sends what is not kept
        level = F.floor(F.log2("n") * 16).cast("int")
        bins = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect()
        held, least = 0, 1 << 20
        for row in bins:
            held += row.words
            if held > TABLE_WORDS:
                break
            least = row.level
        top = counts.filter(level >= least).toPandas().sort_values(["n", "h"], ascending=[False, True], ignore_index=True)
        sums = {r.bucket: (r.n, r.v) for r in counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
        words = min(len(top), CLASSES * CLASSES - BUCKETS - 1)
        inside = top.iloc[:words]
        n, v = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for b, (total, kinds) in sums.items():
            n[b], v[b] = total, kinds
        all_n, all_v = int(n.sum()), int(v.sum())
        np.subtract.at(n, inside.bucket.to_numpy(np.int64), inside.n.to_numpy())
        np.subtract.at(v, inside.bucket.to_numpy(np.int64), 1)
        weight = np.concatenate([inside.n.to_numpy(float), n, [documents]])
        rank = np.empty(len(weight), dtype=np.int64)  # classes hold entries of like frequency
        rank[np.argsort(-weight, kind="stable")] = np.arange(len(weight))
        start = np.zeros(CLASSES * CLASSES)
        start[rank] = weight
        entry = np.full(len(top), -1)
        entry[:words] = rank[:words]
        hashes = top.h.to_numpy(np.int64).view(np.uint64)
        order = np.argsort(hashes)
        return Lexicon(
            hashes[order], np.log10(top.n.to_numpy(float) + 1)[order], entry[order], rank[words : words + BUCKETS], np.log10(n + v + 1),
            int(rank[-1]), documents, all_n + documents, all_v + (documents > 0), start,
        )

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the table, and whether the word is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def entries(self, hashes: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        inside = self.entry >= 0  # few of the table's words, so they are searched alone
        if not inside.any():
            return self.bucket_entry[bucket]
        keys = self.hashes[inside]
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, self.entry[inside][at], self.bucket_entry[bucket])


# --- network ---------------------------------------------------------------------------------------


SHAPES = {
    "input": (CLASSES * CLASSES, 3 * HIDDEN),
    "state": (HIDDEN, 3 * HIDDEN),
    "class_w": (HIDDEN, CLASSES),
    "class_b": (CLASSES,),
    "word_w": (CLASSES, HIDDEN, CLASSES),
    "word_b": (CLASSES, CLASSES),
}


def first_weights(start: np.ndarray) -> dict[str, np.ndarray]:
    """Small random weights; the constants give every entry its share of all tokens."""
    rng = np.random.default_rng(10)
    net = {k: rng.normal(0, 0.1, s).astype(np.float32) for k, s in SHAPES.items()}
    share = (start + 0.1).reshape(CLASSES, CLASSES)
    net["class_b"] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
    net["word_b"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    return net


def pack(net: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([net[k].ravel() for k in SHAPES]).astype(np.float32).tobytes()


def unpack(data: bytes | np.ndarray) -> dict[str, np.ndarray]:
    flat = np.frombuffer(data, dtype=np.float32) if isinstance(data, bytes) else data
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape).copy()
        at += size
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def run_window(net: dict, x: np.ndarray, keep: np.ndarray, h: np.ndarray, cache: list | None = None) -> np.ndarray:
    """States after each of the inputs ``x`` (steps times lanes); ``keep`` is 0 where a document begins.

    Inside, and in ``cache``, units come before lanes, so that every operation runs along the lanes.
    """
    given = np.ascontiguousarray(net["input"][x].transpose(0, 2, 1))
    state = np.ascontiguousarray(net["state"].T)
    out = np.empty((len(x), HIDDEN, x.shape[1]), dtype=np.result_type(given, h))
    h = h.T
    for t in range(len(x)):
        h = h * keep[t]
        before = state @ h
        gates = _sigmoid(given[t, : 2 * HIDDEN] + before[: 2 * HIDDEN])
        update, reset = gates[:HIDDEN], gates[HIDDEN:]
        new = np.tanh(given[t, 2 * HIDDEN :] + reset * before[2 * HIDDEN :])
        if cache is not None:
            cache.append((h, before[2 * HIDDEN :], update, reset, new))
        h = new + update * (h - new)
        out[t] = h
    return out.transpose(0, 2, 1)


def softmax(x: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of the target of every column, and all probabilities (in the place of ``x``) times their sum, with it as last row."""
    x[:-1] -= x[:-1].max(axis=0)
    picked = x[target, np.arange(len(target))]
    np.exp(x[:-1], out=x[:-1])
    x[:-1].sum(axis=0, out=x[-1])
    return picked - np.log(x[-1]), x


def _slopes(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gradient of the negative log probability by what went into ``softmax``, in place."""
    x[:-1] /= x[-1]
    x[target, np.arange(len(target))] -= 1
    return x[:-1]


def predict(net: dict, states: np.ndarray, y: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of every target, and on request the gradient by states (others are added to ``grads``)."""
    order = np.argsort((y // CLASSES).astype(np.int16), kind="stable")
    kind, word = np.divmod(y[order], CLASSES)
    edges = np.searchsorted(kind, np.arange(CLASSES + 1))
    classes = [(c, slice(edges[c], edges[c + 1])) for c in np.flatnonzero(np.diff(edges)).tolist()]
    mine = states[order]
    of_class, of_word = (np.empty((CLASSES + 1, len(y)), dtype=states.dtype) for _ in range(2))
    np.matmul(net["class_w"].T, mine.T, out=of_class[:-1])
    of_class[:-1] += net["class_b"][:, None]
    for c, part in classes:
        np.add(net["word_w"][c].T @ mine[part].T, net["word_b"][c][:, None], out=of_word[:-1, part])
    (log_class, of_class), (log_word, of_word) = softmax(of_class, kind), softmax(of_word, word)
    out = np.empty(len(y), dtype=states.dtype)
    out[order] = log_class + log_word
    if grads is None:
        return out, None
    d = _slopes(of_class, kind)
    grads["class_w"] += (d @ mine).T
    grads["class_b"] += d.sum(axis=1)
    slope = d.T @ net["class_w"].T
    d = _slopes(of_word, word)
    for c, part in classes:
        own = d[:, part]
        grads["word_w"][c] += (own @ mine[part]).T
        grads["word_b"][c] += own.sum(axis=1)
        slope[part] += own.T @ net["word_w"][c].T
    back = np.empty_like(slope)
    back[order] = slope
    return out, back


class Trainer:
    """Truncated backpropagation over windows, with Adam."""

    def __init__(self, net: dict[str, np.ndarray], rate: float = RATE):
        self.net, self.rate, self.steps, self.seen = net, rate, 0, 0
        self.mean = {k: np.zeros_like(v) for k, v in net.items()}
        self.square = {k: np.zeros_like(v) for k, v in net.items()}

    def step(self, x: np.ndarray, y: np.ndarray, keep: np.ndarray, h: np.ndarray) -> np.ndarray:
        """One update by the targets ``y`` of a window; those below 0 are none."""
        net, cache = self.net, []
        grads = {k: np.zeros_like(v) for k, v in net.items()}
        states = run_window(net, x, keep, h, cache)
        flat, wanted = states.reshape(-1, HIDDEN), y.ravel()
        inside = slice(None) if wanted.min() >= 0 else wanted >= 0
        count = len(wanted[inside])
        slope = np.zeros_like(flat)
        slope[inside] = predict(net, flat[inside], wanted[inside], grads)[1]
        slope = np.ascontiguousarray(slope.reshape(states.shape).transpose(0, 2, 1))
        before_h, before_n, update, reset, new = (np.stack(one) for one in zip(*cache))
        stay = 1 - update
        by_new, by_update = stay * (1 - new * new), stay * update * (before_h - new)
        by_reset = by_new * before_n * reset * (1 - reset)
        by_state = by_new * reset
        carried = np.zeros_like(slope[0])
        d_state = np.empty((len(x), 3 * HIDDEN, x.shape[1]), dtype=slope.dtype)
        d_new = np.empty_like(slope)
        for t in range(len(x) - 1, -1, -1):
            d = slope[t] + carried
            np.multiply(d, by_update[t], out=d_state[t, :HIDDEN])
            np.multiply(d, by_reset[t], out=d_state[t, HIDDEN : 2 * HIDDEN])
            np.multiply(d, by_state[t], out=d_state[t, 2 * HIDDEN :])
            np.multiply(d, by_new[t], out=d_new[t])
            carried = (d * update[t] + net["state"] @ d_state[t]) * keep[t]
        grads["state"] += np.matmul(before_h, d_state.transpose(0, 2, 1)).sum(axis=0)
        d_input = d_state
        d_input[:, 2 * HIDDEN :] = d_new
        order = np.argsort(x.ravel().astype(np.int16), kind="stable")
        given = x.ravel()[order]
        heads = np.flatnonzero(np.diff(given, prepend=-1))
        d_input = d_input.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN)[order]
        grads["input"][given[heads]] += np.add.reduceat(d_input, heads, axis=0)
        self.steps += 1
        self.seen += count
        for k, g in grads.items():
            g = np.clip(g / count * 16, -1, 1)
            self.mean[k] = 0.9 * self.mean[k] + 0.1 * g
            self.square[k] = 0.99 * self.square[k] + 0.01 * g * g
            scale = np.sqrt(self.square[k] / (1 - 0.99**self.steps)) + 1e-6
            net[k] -= self.rate * self.mean[k] / (1 - 0.9**self.steps) / scale
        return states[-1]

    def documents(self, tokens: np.ndarray, end: int) -> None:
        """Documents one after the other, each with its end, cut into lanes that are read side by side.

        Every token is a target once. A lane begins after the last token of the lane before, with no state.
        """
        if not len(tokens):
            return
        lanes = max(1, min(LANES, len(tokens) // (4 * WINDOW)))
        length = -(-len(tokens) // lanes)
        y, x = np.full(lanes * length, -1), np.full(lanes * length, end)
        y[: len(tokens)], x[1 : len(tokens)] = tokens, tokens[:-1]
        y, x = y.reshape(lanes, length).T, x.reshape(lanes, length).T
        h = np.zeros((lanes, HIDDEN), dtype=np.float32)
        for at in range(0, length, WINDOW):
            part = slice(at, at + WINDOW)
            h = self.step(x[part], y[part], (x[part] != end).astype(np.float32), h)


def with_ends(texts: Texts, entries: np.ndarray, end: int) -> np.ndarray:
    """Entries of all rows, each row followed by the end."""
    return np.insert(entries, texts.firsts[1:], end)


def fit(docs: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> tuple[dict[str, np.ndarray], int]:
    """Weights after some rounds that together read every learning document (columns ``doc_id, text``), and the tokens they read."""
    net, tokens = first_weights(lexicon.start), 0
    tasks = max(1, docs.rdd.getNumPartitions())
    groups = max(1, int(np.ceil(np.sqrt(tasks))))
    for k in range(rounds):
        packed, rate = pack(net), RATE / (1 + k)

        def run(batches: Iterator[pa.RecordBatch], packed: bytes = packed, rate: float = rate) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(unpack(packed), rate)
            for batch in batches:
                for _, _, offsets, data in pieces(batch.column(0), PIECE):
                    texts = Texts(offsets, data, lower=True)
                    trainer.documents(with_ends(texts, lexicon.entries(*_tokens(texts)), lexicon.end_entry), lexicon.end_entry)
            group = TaskContext.get().partitionId() % groups
            columns = [pa.array([group], pa.int32()), pa.array([trainer.seen], pa.int64()), pa.array([pack(trainer.net)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["group", "seen", "net"])

        def mean(part: pd.DataFrame) -> pd.DataFrame:
            seen = int(part.seen.sum())
            total = sum(np.frombuffer(n, np.float32).astype(float) * s for n, s in zip(part.net, part.seen)) / max(seen, 1)
            return pd.DataFrame({"seen": [seen], "net": [np.asarray(total, np.float32).tobytes()]})

        chosen = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k).select(F.col("text").cast("string"))
        trained = chosen.mapInArrow(run, "group int, seen long, net binary").filter("seen > 0")
        parts = trained.groupBy("group").applyInPandas(mean, "seen long, net binary").collect()
        seen = sum(r.seen for r in parts)
        tokens += seen
        if seen:
            net = unpack((sum(np.frombuffer(r.net, np.float32).astype(float) * r.seen for r in parts) / seen).astype(np.float32))
    return net, tokens


def score_rows(net: dict, texts: Texts, entries: np.ndarray, end: int) -> np.ndarray:
    """Natural log probability of every row with its end."""
    return score_tokens(net, with_ends(texts, entries, end), texts.counts + 1, end)


def score_tokens(net: dict, tokens: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """Natural log probability of every row, given as so many of all ``tokens``. Rows are laid into lanes one after the other."""
    begin = np.cumsum(counts) - counts
    lanes = max(1, min(LANES, len(counts)))
    order = np.argsort(-counts, kind="stable")
    load, lane_rows = np.zeros(lanes, dtype=np.int64), [[] for _ in range(lanes)]
    for row in order.tolist():
        lane = int(load.argmin())
        lane_rows[lane].append(row)
        load[lane] += counts[row]
    by_load = np.argsort(-load, kind="stable")
    load = load[by_load]
    steps = int(load[0]) if len(load) else 0
    where = np.full((steps, lanes), -1, dtype=np.int32)
    for lane, source in enumerate(by_load.tolist()):
        at = 0
        for row in lane_rows[source]:
            where[at : at + counts[row], lane] = np.arange(begin[row], begin[row] + counts[row])
            at += counts[row]
    got = np.zeros(len(tokens), dtype=np.float64)
    h = np.zeros((lanes, HIDDEN), dtype=np.float32)
    window = 2 * WINDOW
    for at in range(0, steps, window):
        active = int(np.searchsorted(-load, -at, "left"))
        part = where[at : at + window, :active]
        inside = part >= 0
        y = np.where(inside, tokens[part], end)
        earlier = where[at - 1, :active] if at else np.full(active, -1)
        x = np.vstack([np.where(earlier >= 0, tokens[earlier], end)[None, :], y[:-1]])
        states = run_window(net, x, (x != end).astype(np.float32), h[:active])
        h = states[-1]
        got[part[inside]] = predict(net, states[inside], y[inside])[0]
    return np.add.reduceat(got, begin) if len(counts) else got


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, held_fold: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Small and capital ASCII letters are equal; every text ends with one more token. ``base_score`` is the
    log10 probability under add-one word frequencies of the learning documents, ``score`` that under
    the network. A word outside the network's vocabulary has the probability of its bucket times its add-one
    frequency among the bucket's words. Null and empty texts are the end alone. Rows without an id are held out;
    rows that repeat are scored one by one. Without learning documents counts are zero. Other columns are not read.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    own = own.withColumn("held_out", F.coalesce(held_out(F.col("doc_id"), folds, held_fold), F.lit(True)))
    learning = own.filter("not held_out")
    path = new_folder(spark, "words")
    word_counts(learning).write.parquet(path)
    counts = spark.read.parquet(path)
    lexicon = Lexicon.of(counts, learning.count())
    net, _ = fit(learning, lexicon)

    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "base", "model", "rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            held, size = [], 0
            for first, end, offsets, data in pieces(batch.column(1), PIECE):
                texts = Texts(offsets, data, lower=True)
                hashes, bucket = _tokens(texts)
                at, known = lexicon.look_up(hashes)
                log_count = np.where(known, lexicon.log_count[at] if len(lexicon.log_count) else 0.0, 0.0)
                outside = np.ones(len(hashes), dtype=bool)
                if len(lexicon.entry):
                    outside = ~(known & (lexicon.entry[at] >= 0))

                def per_row(values, texts=texts):
                    sums = np.concatenate([[0], np.cumsum(values)])
                    return sums[texts.firsts[1:]] - sums[texts.firsts[:-1]]

                # the sums below lack the words that are not in the table; those are joined
                inside_bucket = per_row(np.where(outside, log_count - lexicon.bucket_log[bucket], 0.0))
                rest = np.flatnonzero(~known)
                starts = np.searchsorted(rest, texts.firsts).astype(np.int32)
                n = texts.rows
                columns = [
                    pa.array(row + np.arange(n)),
                    batch.column(0).slice(first, n),
                    batch.column(2).slice(first, n),
                    pa.array(texts.counts.astype(np.int64) + 1),
                    pa.array(per_row(known.astype(np.int64)) + int(lexicon.documents > 0)),
                    pa.array(per_row(log_count) + np.log10(lexicon.documents + 1)),
                    pa.array(np.full(n, np.log10(lexicon.tokens + lexicon.distinct + 1))),
                    inside_bucket,
                    pa.ListArray.from_arrays(pa.array(starts), pa.array(signed(hashes[rest]))),
                ]
                held.append((with_ends(texts, lexicon.entries(hashes, bucket), lexicon.end_entry), texts.counts + 1, columns))
                row, size = row + n, size + len(data)
                if size < SCORED_BYTES and end < len(batch):
                    continue
                tokens, counts = (np.concatenate([one[k] for one in held]) for k in (0, 1))
                model, begin = score_tokens(net, tokens, counts, lexicon.end_entry) / np.log(10), 0
                for _, counts, columns in held:
                    columns[7] = pa.array(model[begin : begin + len(counts)] + columns[7])
                    begin += len(counts)
                    yield pa.RecordBatch.from_arrays(columns, names)
                held, size = [], 0

    kind = own.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, base double, model double, rest array<long>"
    path = new_folder(spark, "scores")
    own.select("doc_id", "text", "held_out").mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    rest = stored.select("row", F.explode("rest").alias("h")).join(counts.select("h", "n"), "h")
    rest = rest.groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("more_logs"))
    all_rows = stored.drop("rest").join(rest, "row", "left").withColumn("more_logs", F.coalesce("more_logs", F.lit(0.0)))
    return all_rows.select(
        F.col("doc_id").alias(doc_id),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more_logs") - F.col("n_tokens") * F.col("base")).alias("base_score"),
        (F.col("model") + F.col("more_logs")).alias("score"),
    )
