"""Ranked search against a plain form."""

import math
import random
import re
from collections import Counter

import pytest

from tallyframe.llm import search

SCHEMA = "doc_id long, text string, h long, m string, bag string, n string, item long, score string, place int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def frame(spark, rows):
    """Rows with columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, t, 1, "m", "b", "n", 2, "s", 3) for i, t in rows], SCHEMA)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def plain(rows, items, best):
    own = [(i, Counter(terms(t))) for i, t in rows if i is not None]
    own = [(i, c) for i, c in own if c]
    n, length = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    asked = {}
    for k, text in items:
        if k is not None:
            asked.setdefault(k, set()).update(terms(text))
    out = set()
    for k, wanted in asked.items():
        scores = []
        for i, c in own:
            m = 50 + 50 * sum(c.values()) * n // length
            score = 0
            for t in wanted:
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, i))
        out |= {(k, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:best])}
    return out


def tables(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(40)] + ["É", "é", "İ", "ß9", "A", "a", "日本"]
    rows = [(0, None), (1, ""), (2, " ..,\x00 "), (3, "A_a-É é"), (4, "w1 " * 60_000)]
    rows += [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocab, k=rng.randrange(60)))) for i in range(5, 200)]
    rows += [(i, rows[10 + i % 3][1].replace("w0", "w0")) for i in range(300, 500)]  # large classes
    rows += [(i, rows[20][1] + f" other{i}") for i in range(500, 560)]  # of one bag, but for words that no item has
    rows += [(20, rows[20][1]), (20, rows[30][1]), (None, rows[20][1])]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randrange(1, 12)))) for k in range(20)]
    return rows, items + [(50, None), (51, ""), (52, "unheard of"), (3, "w5 W5 é"), (None, "w1"), (53, rows[12][1])]


@pytest.mark.parametrize("best,bound", [(50, search.VOCABULARY_BYTES), (3, 200)])
def test_best_documents(spark, best, bound):
    rows, items = tables(best)
    asked = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, doc_id string")
    got = search.best_documents(frame(spark, rows).repartition(5), asked, best, vocabulary_bytes=bound)
    assert got.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
    found = got.collect()
    wanted = plain(rows, items, best)
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted) > 30


def test_equal_hashes_are_compared(spark, monkeypatch):
    import xxhash

    rows, items = tables(1)
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda bag: 1 << 63)
    bags = search.bags(frame(spark, rows), {t.encode(): k for k, t in enumerate(sorted({t for _, i in items for t in terms(i)}))})
    members = search.class_members(bags.selectExpr("doc_id", "0L AS h", "1L AS m", "bag"), 5).collect()
    firsts = {bytes(r.bag) for r in members}
    assert len(firsts) > 100 and max(Counter(bytes(r.bag) for r in members).values()) == 5


def test_no_rows(spark):
    rows, items = tables(2)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert search.best_documents(frame(spark, []), asked).count() == 0
    assert search.best_documents(frame(spark, rows), asked.limit(0)).count() == 0
    assert search.best_documents(frame(spark, rows[:3]), asked).count() == 0
