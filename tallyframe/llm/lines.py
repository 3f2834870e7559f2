"""Repeated runs of lines, found through winnowed fingerprints with DataFrame functions alone.

Of every ``min_lines`` consecutive line hashes the smallest (the leftmost of equals) is a
fingerprint, so two documents that share a run of ``min_lines`` lines share a fingerprint at the
same place of the run. A fingerprint stands for a stretch: all windows it is the minimum of. Stretches
that agree with an earlier one on both sides of the fingerprint repeat it as a whole; only the first
of each kind is looked at window by window. Nothing is paired within a group: a run that a third of
all documents share costs one combined row per task and one row per occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KIND = ["h", "left", "span", "context"]


def _hash_arrays(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc, sig, lines, places, hs``: all lines, and place and hash of those that are not blank."""
    own = docs.filter(F.col(text).isNotNull())
    own = own.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("sig"), F.split(text, "\n", -1).alias("lines"))
    places = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.trim(F.get("lines", i)) != "")
    own = own.withColumn("places", places)
    return own.withColumn("hs", F.transform("places", lambda i: F.xxhash64(F.get("lines", i))))


def fingerprints(docs: DataFrame, min_lines: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per selected fingerprint: its hash, the stretch it stands for, and hashes of the
    whole stretch (``context``) and of each window in it (``windows``)."""
    w = min_lines
    # no filter on the size of hs: it would be pushed down and repeat all that hs is made of
    own = _hash_arrays(docs, doc_id, text).select("doc", "sig", "hs")
    starts = F.when(F.size("hs") >= w, F.sequence(F.lit(0), F.size("hs") - w)).otherwise(F.array().cast("array<int>"))

    def least(i):
        window = F.slice("hs", i + 1, w)
        return (i + F.array_position(window, F.array_min(window)) - 1).cast("int")

    own = own.withColumn("at", F.transform(starts, least))
    heads = F.filter(starts, lambda i: (i == 0) | (F.get("at", i) != F.get("at", i - 1)))
    own = own.withColumn("heads", heads)
    stretches = F.transform(
        "heads", lambda lo, k: F.struct(lo.alias("lo"), F.coalesce(F.get("heads", k + 1) - 1, F.size("hs") - w).alias("hi"))
    )
    each = own.select("doc", "sig", "hs", "at", F.explode(stretches).alias("s")).select("*", "s.lo", "s.hi")
    return each.select(
        "doc",
        "sig",
        "lo",
        F.get("hs", F.get("at", "lo")).alias("h"),
        (F.get("at", "lo") - F.col("lo")).alias("left"),
        (F.col("hi") - F.col("lo")).alias("span"),
        F.xxhash64(F.slice("hs", F.col("lo") + 1, F.col("hi") - F.col("lo") + w)).alias("context"),
        F.transform(F.sequence("lo", "hi"), lambda i: F.xxhash64(F.slice("hs", i + 1, w))).alias("windows"),
    )


def repeated_stretches(prints: DataFrame, min_lines: int) -> DataFrame:
    """``doc, sig, lo, n``: stretches of lines whose every window also starts earlier."""
    place = F.struct("doc", "lo", "sig", "windows")
    kinds = prints.groupBy(*KIND).agg(F.min(place).alias("first"))
    firsts = kinds.select(*KIND, F.col("first.doc").alias("doc0"), F.col("first.lo").alias("lo0"))
    later = (F.col("doc") != F.col("doc0")) | (F.col("lo") != F.col("lo0"))
    whole = prints.drop("windows").join(firsts, KIND).filter(later)
    whole = whole.select("doc", "sig", "lo", (F.col("span") + min_lines).alias("n"))

    first = kinds.select("h", "left", "first.*").select("*", F.posexplode("windows").alias("shift", "window"))
    first = first.select(
        "h", (F.col("left") - F.col("shift")).alias("offset"), "window", "doc", "sig", (F.col("lo") + F.col("shift")).alias("lo")
    )
    key = ["h", "offset", "window"]
    earliest = first.groupBy(*key).agg(F.min(F.struct("doc", "lo")).alias("first"), F.count("*").alias("times"))
    earliest = earliest.filter("times > 1").select(*key, F.col("first.doc").alias("doc0"), F.col("first.lo").alias("lo0"))
    single = first.join(earliest, key).filter(later).select("doc", "sig", "lo", F.lit(min_lines).alias("n"))
    return whole.unionByName(single)


def drop_repeated_lines(
    docs: DataFrame, min_lines: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs``, with ``text`` less its repeated runs, and ``n_lines``, ``n_removed``.

    A line goes if it lies in a run of ``min_lines`` consecutive lines that also starts earlier: in a
    document of a smaller id, or further up in the same one. Runs are judged on the input. Lines that are
    empty or hold only spaces take no part and stay. Null texts stay null with zero lines; rows without a
    document id are left as they are and make nobody's run earlier. An id should be unique: rows that
    repeat id and text count as one document, other texts of the same id are kept apart. Columns named
    like the working columns of this module do not clash.
    """
    known = docs.filter(F.col(doc_id).isNotNull())
    prints = fingerprints(known, min_lines, doc_id, text)
    runs = repeated_stretches(prints, min_lines)
    gone = F.flatten(F.collect_list(F.sequence("lo", F.col("lo") + F.col("n") - 1)))
    gone = runs.groupBy("doc", "sig").agg(F.array_distinct(gone).alias("_gone"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    left = docs.select(row, F.col(doc_id).alias("doc"), F.xxhash64(text).alias("sig"), F.col(text).alias("_text"))
    out = left.join(gone, ["doc", "sig"], "left")
    out = out.withColumn("_lines", F.split("_text", "\n", -1))
    full = F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: F.trim(F.get("_lines", i)) != "")
    out = out.withColumn("_full", F.when(F.col("_text").isNotNull(), full))
    places = F.transform("_gone", lambda i: F.get("_full", i))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), places)
    kept = F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
    # the explode of one row keeps filters on the result from being pushed down, where they would split the
    # text again for each of its lines
    made = F.struct(
        F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(kept).alias("text"),
        F.coalesce(F.size("_full"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
    out = out.select("_row", F.explode(F.array(made)).alias("_made"))
    same = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in (text, "n_lines", "n_removed")]
    return out.select(*same, F.col("_made.text").alias(text), "_made.n_lines", "_made.n_removed")
