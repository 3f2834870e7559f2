"""Periodic runs against a search of all periods."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest

from tallyframe.llm import catalog, runs

SCHEMA = "doc_id long, text string, runs string, words long, n long, a long, p long, g long, picked string, best long, start string"


def frame(spark, rows):
    """Rows with columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4, 5, "y", 6, "z") for i, t in rows], SCHEMA)


def plain_runs(words, least):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def sequences(seed):
    rng = random.Random(seed)
    fib = [0, 1]
    while len(fib) < 90:
        fib += fib[: len(fib) // 2 + 1]
    out = [[], [0], [0] * 11, [0] * 12, [0] * 50, [0, 1] * 40, fib, [bin(i).count("1") % 2 for i in range(100)]]
    out += [[rng.randrange(2) for _ in range(rng.randrange(150))] for _ in range(30)]
    for _ in range(30):
        unit = [rng.randrange(3) for _ in range(rng.randrange(1, 12))]
        some = (unit * 20)[: rng.randrange(20, 150)]
        for _ in range(rng.randrange(3)):
            some[rng.randrange(len(some))] = 9
        out.append(some)
    return out


@pytest.mark.parametrize("least", [2, 5, 12, 30])
def test_runs_of_numbers(least):
    docs = sequences(least)
    got = runs.runs_of([np.array(d, dtype=np.int64) for d in docs], least)
    assert got == [plain_runs(d, least) for d in docs]


def test_one_word_very_often():
    assert runs.runs_of([np.zeros(60_000, dtype=np.int64)], 12) == [[(0, 60_000, 1)]]


def rows_of(seed):
    texts = [" ".join("ab cé"[x % 5] if x < 5 else f"w{x}" for x in d).replace("   ", " q ") for d in sequences(seed)]
    return list(enumerate([None, "", " \n\t", "One word", "x\x0by  x\ny " * 9, *texts, texts[-1], "long tail " * 30_000]))


def test_runs_of_texts(spark):
    rows = rows_of(3)
    got = {r.doc_id: r for r in runs.periodic_runs(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows[:-1]:
        words = brute.words(text)
        expected = plain_runs(words, 12)
        assert [tuple(r) for r in got[i].runs] == expected
        assert (got[i].n_words, got[i].collapsed) == (len(words), collapsed(words, expected))
    assert [tuple(r) for r in got[rows[-1][0]].runs] == [(0, 60_000, 2)]


def test_repeated_nameless_and_no_rows(spark):
    rows = [(1, "a b " * 8), (1, "a b " * 8), (None, "c " * 12), (2, "c " * 11)]
    got = sorted((r.doc_id or 0, len(r.runs)) for r in runs.periodic_runs(frame(spark, rows)).collect())
    assert got == [(0, 1), (1, 1), (1, 1), (2, 0)]
    assert runs.periodic_runs(frame(spark, [])).count() == 0


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query(spark, tmp_path):
    rng = random.Random(5)
    rows = rows_of(4)[:-1]
    rows += [(i, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 90)))) for i in range(len(rows), 400)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in catalog.op13_maximal_pair_runs(spark, str(tmp_path)).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for i, text in rows:
        words = planted(i, brute.words(text))
        found = plain_runs(words, 12)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        digits = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        assert got[i] == (len(found), *digits, sha(listed), sha(collapsed(words, found)))
