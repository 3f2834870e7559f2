"""Toxicity by weak supervision: many word and pattern voters, a label model, a linear classifier.

1. Stems (words and their beginnings) that set toxic texts apart are counted over all labelled learning rows.
2. The strongest stems and some patterns of writing are voters. A generative model (each voter fires at one rate in
   toxic and another in clean texts) is fitted by expectation maximisation over all learning rows,
   labelled or not; voters that fire together within a class share one vote's worth of weight.
3. A logistic classifier over more stems is fitted to the posterior labels of a bounded sample.

Every step is a pass of Spark tasks that return sums; the driver holds counts per stem or voter alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.llm.words import BYTE_BASE, BYTE_VALUE, Sums, Texts, mixed, pieces, signed
from tallyframe.session import new_folder

STEM_BYTES = (4, 5, 6, 7, 8)
STEMS, VOTERS = 4096, 128  # stems the classifier sees, and how many of them (the strongest) vote
FIT_ROWS = 20_000  # expected rows of the sample that the classifier is fitted to
LABEL_ROWS = 1_000_000  # up to here labels (16 bytes a row) are broadcast
EM_ROUNDS = 5
LIFT = 5.0

# Bytes cut off the ends of a word.
MARKS = np.zeros(256, dtype=bool)
MARKS[[ord(c) for c in ".,;:!?\"'()[]|*"]] = True

PATTERNS = ("capitals", "exclaims", "digits", "marks", "short", "long_words")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == fold


def _stems(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word, and of its beginnings, in all texts."""
    starts, ends = texts.starts.copy(), texts.ends.copy()
    for _ in range(3):
        cut = (ends > starts) & MARKS[texts.data[ends - 1]] if len(ends) else np.zeros(0, dtype=bool)
        ends = ends - cut
        cut = (ends > starts) & MARKS[texts.data[np.minimum(starts, len(texts.data) - 1)]] if len(ends) else cut
        starts = starts + cut
    rows = texts.row_of_words()
    sums = Sums(BYTE_VALUE[texts.data], BYTE_BASE)
    some = ends > starts
    all_rows, all_hashes = [rows[some]], [sums.of(starts[some], ends[some])]
    for n in STEM_BYTES:
        some = ends - starts >= n
        all_rows.append(rows[some])
        all_hashes.append(mixed(sums.of(starts[some], starts[some] + n) + np.uint64(n)))
    return np.concatenate(all_rows), np.concatenate(all_hashes)


def _patterns(texts: Texts, raw: np.ndarray) -> np.ndarray:
    """Rows times ``PATTERNS``: how a text is written, as yes or no."""

    def share(flag):
        sums = np.concatenate([[0], np.cumsum(flag)])
        return (sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]) / np.maximum(np.diff(texts.offsets), 1)

    words = np.maximum(texts.counts, 1)
    exclaims = share(raw == 33) * np.diff(texts.offsets)
    return np.stack(
        [
            share((raw >= 65) & (raw <= 90)) > 0.3,
            exclaims >= 3,
            share((raw >= 48) & (raw <= 57)) > 0.1,
            share(MARKS[raw]) > 0.1,
            texts.counts < 20,
            np.diff(texts.offsets) / words > 9,
        ],
        axis=1,
    )


def stem_counts(labelled: DataFrame) -> DataFrame:
    """``stem, toxic, clean``: documents of either label that hold a stem (columns ``text, toxic``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for first, end, offsets, data in pieces(batch.column(0), 1 << 20):
                rows, hashes = _stems(Texts(offsets, data, lower=True))
                order = np.lexsort((rows, hashes))
                rows, hashes = rows[order], hashes[order]
                new = (np.diff(hashes, prepend=hashes[:1] - np.uint64(1)) != 0) | (np.diff(rows, prepend=-1) != 0)
                rows, hashes = rows[new], hashes[new]
                if not len(rows):
                    continue
                stems, group = np.unique(hashes, return_inverse=True)
                toxic = np.bincount(group, weights=label[first + rows], minlength=len(stems)).astype(np.int64)
                clean = np.bincount(group, minlength=len(stems)) - toxic
                yield pa.RecordBatch.from_arrays([*map(pa.array, (signed(stems), toxic, clean))], ["stem", "toxic", "clean"])

    counted = labelled.select(F.col("text").cast("string"), F.col("toxic").cast("long")).mapInArrow(run, "stem long, toxic long, clean long")
    return counted.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def pick_stems(counts: DataFrame, toxic: int, clean: int, stems: int = STEMS) -> list[int]:
    """The stems that tell most, strongest first: more frequent in toxic texts than chance would make
    any of all the stems tested (likelihood ratio, against the logarithm of their number), and at least
    ``LIFT`` times as frequent as in clean texts: in large tables slight differences are certain too, and
    many weak voters together would outvote the silence of the strong ones."""
    tested = counts.filter(F.col("toxic") + F.col("clean") >= 3)
    number = tested.count()
    n, share = F.col("toxic") + F.col("clean"), toxic / (toxic + clean)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (part(F.col("toxic"), n * share) + part(F.col("clean"), n * (1 - share)))
    lift = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1))
    strong = tested.filter(lift >= LIFT).withColumn("ratio", ratio).filter(F.col("ratio") > 2 * np.log(max(number, 1)))
    return [r.stem for r in strong.orderBy(F.desc("ratio"), "stem").limit(stems).collect()]


def hits(docs: DataFrame, stems: list[int]) -> DataFrame:
    """``doc_id, hits``: which of the stems, and after them of ``PATTERNS``, every text has (columns ``doc_id, text``)."""
    wanted = np.array(stems, dtype=np.int64).view(np.uint64)
    order = np.argsort(wanted)
    keys = wanted[order]
    likely = np.zeros(1 << 16, dtype=bool)
    likely[(keys >> np.uint64(48)).astype(np.int64)] = True
    n_all = len(stems) + len(PATTERNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, offsets, data in pieces(batch.column(1)):
                texts = Texts(offsets, data, lower=True)
                rows, hashes = _stems(texts)
                maybe = np.flatnonzero(likely[(hashes >> np.uint64(48)).astype(np.int64)])
                rows, hashes = rows[maybe], hashes[maybe]
                at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
                true = keys[at] == hashes if len(keys) else np.zeros(0, dtype=bool)
                found = rows[true] * n_all + order[at[true]]
                row, pattern = np.nonzero(_patterns(texts, data))
                found = np.unique(np.concatenate([found, row * n_all + len(stems) + pattern]).astype(np.int64))
                starts = np.searchsorted(found, np.arange(texts.rows + 1) * n_all)
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array((found % n_all).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), lists], ["doc_id", "hits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, hits array<int>")


# --- label model -------------------------------------------------------------------------------------


def _rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), lengths), column.flatten().to_numpy(zero_copy_only=False)


class LabelModel:
    """Class share, firing rates of voters in clean and toxic texts, and the weight of each vote."""

    def __init__(self, voters: np.ndarray, width: int):
        self.voters, self.width = voters, width
        self.share, self.rates = 0.5, np.full((2, len(voters)), 0.5)
        self.weights = np.ones(len(voters))
        self.place = np.full(width, -1)
        self.place[voters] = np.arange(len(voters))

    def votes(self, column: pa.Array) -> np.ndarray:
        rows, found = _rows_of(column)
        out = np.zeros((len(column), len(self.voters)), dtype=np.float64)
        at = self.place[found] if len(found) else found
        out[rows[at >= 0], at[at >= 0]] = 1
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        # a voter that stays silent abstains: most know the words of one language or topic only
        fired = (np.log(self.rates[1]) - np.log(self.rates[0])) * self.weights
        odds = np.log(self.share) - np.log1p(-self.share) + votes @ fired
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def sums(self, table: DataFrame, known_only: bool) -> np.ndarray:
        """Per class: expected rows, fired votes of each voter, and of each pair of voters."""
        n = len(self.voters)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, 1 + n + n * n))
            for batch in batches:
                for at in range(0, len(batch), 2000):
                    part = batch.slice(at, 2000)
                    votes = self.votes(part.column(0))
                    label = part.column(1).to_numpy(zero_copy_only=False).astype(float)
                    toxic = np.where(np.isnan(label), 0 if known_only else self.posterior(votes), label)
                    for k, weight in enumerate((np.where(np.isnan(label), 0, 1 - label) if known_only else 1 - toxic, toxic)):
                        pairs = (votes * weight[:, None]).T @ votes
                        total[k] += np.concatenate([[weight.sum()], weight @ votes, pairs.ravel()])
            names = ["class", "place", "value"]
            for k in (0, 1):
                at = np.flatnonzero(total[k])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k)), pa.array(at), pa.array(total[k][at])], names)

        out = np.zeros((2, 1 + n + n * n))
        parts = table.select("hits", F.col("toxic").cast("double")).mapInArrow(run, "class long, place long, value double")
        for row in parts.groupBy("class", "place").agg(F.sum("value").alias("value")).collect():
            out[row["class"], row.place] = row.value
        return out

    def fit(self, table: DataFrame, rounds: int = EM_ROUNDS) -> None:
        """From labelled rows first, then from all of them."""
        for k in range(rounds + 1):
            got, n = self.sums(table, known_only=k == 0), len(self.voters)
            rows = got[:, 0]
            before = self.rates
            self.share = float(np.clip((rows[1] + 0.5) / (rows.sum() + 1), 1e-6, 1 - 1e-6))
            self.rates = (got[:, 1 : n + 1] + 0.5) / (rows[:, None] + 1)
            pairs = got[:, n + 1 :].reshape(2, n, n) / np.maximum(rows[:, None, None], 1e-9)
            spread = self.rates * (1 - self.rates)
            correlation = (pairs - self.rates[:, :, None] * self.rates[:, None, :]) / np.sqrt(spread[:, :, None] * spread[:, None, :])
            together = np.clip(correlation.max(axis=0), 0, 1)
            np.fill_diagonal(together, 1)
            together[together < 0.2] = 0
            self.weights = 1 / np.maximum((together**2).sum(axis=1), 1)
            if k and np.abs(self.rates - before).max() < 1e-4:
                break


def fit_linear(rows: np.ndarray, columns: np.ndarray, target: np.ndarray, width: int, rounds: int = 300) -> np.ndarray:
    """Logistic weights (the last is the constant) for 0/1 features given as pairs of row and column."""
    weights, speed = np.zeros(width + 1), np.zeros(width + 1)
    n = max(len(target), 1)
    often = np.bincount(columns, minlength=width) / n
    for _ in range(rounds):
        logit = np.bincount(rows, weights=weights[columns], minlength=len(target)) + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(logit, -500, 500))) - target
        slope = np.bincount(columns, weights=error[rows], minlength=width) / n
        slope = np.append(slope / np.sqrt(often + 1e-4) + 1e-3 * weights[:-1], error.mean())
        speed = 0.9 * speed + slope
        weights = weights - 0.5 * speed
    return weights


def score_texts(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    folds: int = 5,
    held_fold: int = 0,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Nothing is learned from rows whose id has a CRC of ``held_fold`` modulo ``folds``. Null and empty texts are
    scored by the patterns alone. A null label is no label; of several labels of an id, toxic wins. Rows
    without an id are scored but not learned from. Without a toxic and a clean label there are no
    voters, and every score is the share of toxic labels. Other columns are not read.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    truth = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    truth = truth.filter(~held_out(F.col("doc_id"), folds, held_fold)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # copies of a text count once, or every word of a much copied toxic text would look toxic
    hashed = own.select("doc_id", F.xxhash64("text").alias("same")).join(truth, "doc_id")
    once = hashed.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")).select("doc_id", "toxic")
    path = new_folder(spark, "labels")
    once.write.parquet(path)
    once = spark.read.parquet(path)
    small = once.count() <= LABEL_ROWS
    labelled = own.join(F.broadcast(once) if small else once, "doc_id").select("text", "toxic")
    by_label = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = by_label.get(1, 0), by_label.get(0, 0)
    stems = pick_stems(stem_counts(labelled), toxic, clean) if toxic and clean else []

    path = new_folder(spark, "hits")
    out = F.coalesce(held_out(F.col("doc_id"), folds, held_fold), F.lit(True))
    hits(own, stems).withColumn("held_out", out).write.parquet(path)
    stored = spark.read.parquet(path)
    width = len(stems) + len(PATTERNS)
    if not stems:
        weights = np.append(np.zeros(width), np.log((toxic + 1e-6) / (clean + 1e-6)) if toxic + clean else -30.0)
    else:
        path = new_folder(spark, "learning")
        stored.filter("not held_out").join(truth, "doc_id", "left").select("doc_id", "hits", "toxic").write.parquet(path)
        learning = spark.read.parquet(path)
        voters = np.append(np.arange(min(VOTERS, len(stems))), np.arange(len(stems), width))
        model = LabelModel(voters, width)
        model.fit(learning)
        share = min(1.0, fit_rows / max(learning.count(), 1))
        sample = learning.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("hits", "toxic")
        got = sample.toArrow().combine_chunks()
        column = pa.array(got.column("hits").to_pylist(), pa.list_(pa.int32()))
        known = got.column("toxic").to_numpy().astype(float)
        posterior = model.posterior(model.votes(column)) if len(column) else np.zeros(0)
        rows, columns = _rows_of(column)
        weights = fit_linear(rows, columns, np.where(np.isnan(known), posterior, 0.1 * posterior + 0.9 * known), width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = _rows_of(batch.column(1))
            logit = np.bincount(rows, weights=weights[found], minlength=len(batch)) + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
            columns = [batch.column(0), batch.column(2), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    kind = own.schema["doc_id"].dataType.simpleString()
    scored = stored.select("doc_id", "hits", "held_out").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
    return scored.withColumnRenamed("doc_id", doc_id)


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic; rows without an id stay. Other columns may have any names."""
    toxic = score_texts(docs, labels, doc_id, text).filter("predicted = 1").select(F.col(doc_id).alias("_toxic")).distinct()
    return docs.join(toxic, docs[doc_id] == toxic["_toxic"], "left_anti")
