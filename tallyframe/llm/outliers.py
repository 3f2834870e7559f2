"""Documents whose statistics lie far from those of their language and source, told by robust estimates.

For every language and source the mean and covariance of five transformed statistics come from the
minimum covariance determinant: of the rows, those three quarters are sought whose covariance has the smallest
determinant. From several starts, concentration steps take the mean and covariance of the rows nearest to the
last estimate until no determinant falls by a thousandth; the best start goes on, and all rows within the 97.5 %
ellipse of its (rescaled) estimate give the final one. A document is rejected by its Mahalanobis distance.

DataFrame functions only. A step is two aggregates combined before the shuffle: how many rows lie at which distance (in
bins of 1/32 of an e-fold, so that the nearest rows of a group need no sorting), then sums and products of the rows
up to the bin that completes three quarters. Estimates stay a table, one row per group.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.session import new_folder

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
#: Transformed statistics and the least deviation each is judged by. It is added to the covariance, as most statistics
#: are zero for most documents and would make it singular.
LEAST_DEVIATION = {"word_length": 0.05, "symbols": 0.05, "dup_lines": 0.5, "repeats": 0.15, "words": 0.5}
NAMES = list(LEAST_DEVIATION)
SHARE = 0.75  # of the rows whose covariance is to have the smallest determinant
LEAST_ROWS = 40  # smaller groups of a language are judged together, and if still smaller, with those of all
TAIL = 1e-4  # of normal rows that the limit would reject
STARTS, START_ROWS = 4, 15
BINS = 32
STEPS = 12
TOLERANCE = 1e-3  # steps end when no logarithm of a determinant falls by more
GRAIN = 1024  # statistics are multiples of 1/1024, so that their sums do not depend on the order of rows


def chi_square_share(x: float, p: int) -> float:
    """Share of a chi-square distribution of ``p`` degrees of freedom below ``x``."""
    share, k = (math.erf(math.sqrt(x / 2)), 1) if p % 2 else (1 - math.exp(-x / 2), 2)
    while k < p:
        share -= (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1)
        k += 2
    return share


def chi_square_limit(share: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_share(middle, p) < share else (low, middle)
    return high


def widening(share: float, p: int) -> float:
    """What the covariance of the nearest ``share`` of normal rows has to be multiplied by."""
    return share / chi_square_share(chi_square_limit(share, p), p + 2)


# --- statistics ----------------------------------------------------------------------------------


def _made(rows: DataFrame, **columns: Column) -> DataFrame:
    """Further columns, made once: an explode of one row keeps later steps from making them again for each use."""
    own = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_made")
    return rows.select("*", own).select(*[f"`{c}`" for c in rows.columns], "_made.*")


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", by: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` of every row.

    Repeated three-word windows are told by a 64-bit hash of their words within one text.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(by[0]).alias("lang"), F.col(by[1]).alias("source"), body.alias("body"))
    rows = _made(
        rows,
        ws=F.filter(F.split("body", SPACE), lambda w: w != ""),
        ls=F.filter(F.split("body", "\n", -1), lambda x: x.rlike(WORD)),
        n_symbols=F.regexp_count("body", F.lit(SYMBOL)).cast("long"),
    )
    windows = F.transform("ws", lambda w, i: F.xxhash64(w, F.get("ws", i + 1), F.get("ws", i + 2)))
    rows = _made(
        rows.drop("body"),
        n_words=F.size("ws").cast("long"),
        word_chars=F.length(F.array_join("ws", "")).cast("long"),
        n_dup_lines=(F.size("ls") - F.size(F.array_distinct("ls"))).cast("long"),
        hs=F.slice(windows, 1, F.greatest(F.size("ws") - 2, F.lit(0))),
    )
    # most texts repeat no window: only the others are sorted
    placed = F.sort_array(F.transform("hs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = _made(rows.drop("ws", "ls"), ss=F.when(F.size(F.array_distinct("hs")) < F.size("hs"), placed).otherwise(nothing))
    alike = lambda x, k: (x["h"] == F.get("ss", k - 1)["h"]) | (x["h"] == F.get("ss", k + 1)["h"])
    places = F.sort_array(F.transform(F.filter("ss", alike), lambda x: x["i"]))
    rows = _made(rows.drop("hs"), at=places)
    covered = F.transform("at", lambda i, k: F.coalesce(F.least(F.get("at", k + 1) - i, F.lit(3)), F.lit(3)))
    rows = rows.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", "lang", "source", *names, failed.alias("base_failed"))


def _vector() -> dict[str, Column]:
    """The transformed statistics: logarithms of sizes, angles of shares."""
    n = F.greatest("n_words", F.lit(1))
    angle = lambda part, whole: F.asin(F.sqrt(F.least(part / F.greatest(whole, F.lit(1)), F.lit(1.0))))
    own = {
        "word_length": F.log(F.greatest("word_chars", F.lit(1)) / n),
        "symbols": angle(F.col("n_symbols"), F.col("word_chars")),
        "dup_lines": F.log1p("n_dup_lines"),
        "repeats": angle(F.col("n_repeat_words"), n),
        "words": F.log(n),
    }
    return {name: F.round(column * GRAIN) / GRAIN for name, column in own.items()}


def grouped(stats: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """``stats`` with its transformed statistics, the group ``g`` of every row and the number ``n_group`` of rows it is estimated from.

    A group is a language and source; those of fewer than ``least_rows`` rows form one per language, and where these are too few,
    one of all. Nulls are values of their own. Rows of a group that is still too small have no ``g``.
    """
    counts = stats.filter("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    counts = counts.withColumn("small", F.col("n") < least_rows)
    pool = F.sum(F.when(F.col("small"), F.col("n")).otherwise(0))
    counts = counts.withColumn("in_lang", pool.over(Window.partitionBy("lang")))
    level = F.when(~F.col("small"), 0).when(F.col("in_lang") >= least_rows, 1).otherwise(2)
    counts = counts.withColumn("level", level)
    name = F.to_json(F.struct("level", F.when(F.col("level") < 2, F.col("lang")).alias("lang"), F.when(F.col("level") < 1, F.col("source")).alias("source")))
    counts = counts.withColumn("g", name)
    sizes = counts.groupBy("g").agg(F.sum("n").alias("n_group")).filter(F.col("n_group") >= least_rows)
    groups = counts.join(sizes, "g").select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "g", "n_group")
    same = stats["lang"].eqNullSafe(F.col("_lang")) & stats["source"].eqNullSafe(F.col("_source"))
    return stats.join(groups, same, "left").drop("_lang", "_source").withColumns(_vector())


# --- estimates -----------------------------------------------------------------------------------


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def estimates(rows: DataFrame, keys: list[str], factor: float = 1.0) -> DataFrame:
    """Per key: ``m0..`` the mean, ``l00, l10, l11, ..`` the lower triangle whose square is ``factor`` times the covariance plus
    the least deviations, and ``det``, the logarithm of its determinant."""
    sums = [F.sum(n).alias(f"s{i}") for i, n in enumerate(NAMES)]
    products = [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"q{i}{j}") for i, j in _pairs()]
    out = rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums, *products)
    out = out.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(len(NAMES))})
    floor = list(LEAST_DEVIATION.values())
    for i, j in _pairs():
        cell = factor * (F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
        cell = cell + floor[i] ** 2 if i == j else cell
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), cell)
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(floor[i] ** 2))) if i == j else rest / F.col(f"l{j}{j}"))
    det = reduce(lambda a, b: a + b, [2 * F.log(f"l{i}{i}") for i in range(len(NAMES))])
    return out.select(*keys, *[f"m{i}" for i in range(len(NAMES))], *[f"l{i}{j}" for i, j in _pairs()], det.alias("det"))


def with_distance(rows: DataFrame, found: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with ``d2``, the square of the Mahalanobis distance to the estimate of their key."""
    out = rows.join(found, keys, how)
    for i, name in enumerate(NAMES):
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"z{k}"), range(i), F.col(name) - F.col(f"m{i}"))
        out = out.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    d2 = reduce(lambda a, b: a + b, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(NAMES))])
    return out.withColumn("d2", d2).drop(*[f"z{i}" for i in range(len(NAMES))])


def concentrated(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One step: the estimates from those rows of each group and start that are nearest to the last ones."""
    keys = ["g", "start"]
    binned = with_distance(rows, found, ["g"]).withColumn("bin", F.floor(BINS * F.log(F.col("d2") + 1e-6)))
    each = binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    up_to = F.sum("n").over(Window.partitionBy(*keys).orderBy("bin"))
    each = each.withColumns({"up_to": up_to, "whole": F.sum("n").over(Window.partitionBy(*keys))})
    limits = each.filter(F.col("up_to") >= SHARE * F.col("whole")).groupBy(*keys).agg(F.min("bin").alias("limit"))
    near = with_distance(rows, found.join(limits, keys), ["g"])
    return estimates(near.filter(F.floor(BINS * F.log(F.col("d2") + 1e-6)) <= F.col("limit")), keys)


def _stored(found: DataFrame) -> DataFrame:
    """Written and read again, so that joins know its size and no plan grows from step to step."""
    path = new_folder(found.sparkSession, "estimates")
    found.write.parquet(path)
    return found.sparkSession.read.parquet(path)


def robust_estimates(rows: DataFrame) -> DataFrame:
    """One estimate per group ``g`` of ``rows``, which have the transformed statistics and should be stored: each step reads them."""
    # start 0 takes all rows, every other one about START_ROWS of the group, by a hash of the id
    draw = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(STARTS), F.expr(f"n_group div {START_ROWS}"))) + 1
    starts = F.when(draw <= STARTS, F.array(F.lit(0).cast("long"), draw)).otherwise(F.array(F.lit(0).cast("long")))
    found = _stored(estimates(rows.select("g", *NAMES, F.explode(starts).alias("start")), ["g", "start"]))
    narrow = rows.select("g", *NAMES)
    for _ in range(2):
        found = _stored(concentrated(narrow, found))
    best = found.groupBy("g").agg(F.min(F.struct("det", "start")).alias("best"))
    found = found.join(best, "g").filter(F.col("start") == F.col("best.start")).drop("best")
    for _ in range(STEPS):
        new = _stored(concentrated(narrow, found))
        fell = new.join(found.select("g", F.col("det").alias("old")), "g").filter(F.col("det") < F.col("old") - TOLERANCE)
        found = new
        if fell.isEmpty():
            break
    p = len(NAMES)
    # the least deviations are no part of the estimated covariance, so the limit is widened instead of it
    inside = with_distance(narrow, found.drop("start", "det"), ["g"])
    inside = inside.filter(F.col("d2") <= widening(SHARE, p) * chi_square_limit(0.975, p))
    return _stored(estimates(inside.select("g", *NAMES), ["g"], widening(0.975, p)).drop("det"))


def judge_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    by: tuple[str, str] = ("lang", "source"),
    least_rows: int = LEAST_ROWS,
    tail: float = TAIL,
) -> DataFrame:
    """``doc_id, lang, source``, the statistics of every row, ``base_failed``, ``d2`` and ``kept``.

    A row is rejected if it fails a base rule (fewer than 50 words, or more than half of them in repeated windows of three), or if
    its squared distance ``d2`` to the robust estimate of its group is above what a normal row exceeds with probability ``tail``.
    Estimates come from the rows that pass the base rules. Null and empty texts have no words, so they fail. Null languages and
    sources are groups of their own. Rows that repeat an id, or have none, are judged one by one. Where fewer than
    ``least_rows`` rows can be put together there is no estimate, ``d2`` is null and all that pass the base rules are
    kept. Texts are read whole; an empty table gives an empty one. Other columns are not read, so their names do not clash.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "statistics")
    text_statistics(docs, doc_id, text, by).write.parquet(path)
    rows = grouped(spark.read.parquet(path), least_rows)
    path = new_folder(spark, "vectors")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    found = robust_estimates(rows.filter("not base_failed and g is not null"))
    far = F.col("d2") > chi_square_limit(1 - tail, len(NAMES))
    out = with_distance(rows, found, ["g"], "left")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kept = ~F.col("base_failed") & ~F.coalesce(far, F.lit(False))
    return out.select("doc_id", "lang", "source", *names, "base_failed", "d2", kept.alias("kept"))
