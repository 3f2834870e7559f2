"""Text statistics and robust distances against plain forms."""

import math
import random
from collections import Counter

import brute
import numpy as np
import pytest

from tallyframe.llm import catalog, outliers

SCHEMA = "doc_id long, text string, lang string, source string, g string, n int, start int, d2 string, kept string, ws string, body int"


def frame(spark, rows):
    """Rows (id, text, lang, source) with columns whose names the operator uses itself."""
    return spark.createDataFrame([(*row, "g", 1, 2, "d", "k", "w", 3) for row in rows], SCHEMA)


def statistics(text):
    words = brute.words(text)
    threes = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if threes[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if brute.words(x)]
    chars = sum(len(w.decode()) for w in words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), chars, symbols, len(lines) - len(set(lines)), len(covered), failed


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "en", "ir", "oté")]
    rows = [(0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t\x0b ", None, None), (3, "one two one two one two", "en", "b"), (4, "# | " * 40, "en", "a")]
    rows += [(5, "a b c a b c " * 20, "en", "a"), (6, "x " * 40_000 + "y z", "en", "a"), (7, " ".join(f"w{k}" for k in range(50)) + "\r\n\r\n", None, "a")]
    for i in range(8, n):
        words = [rng.choice(vocab) + rng.choice(vocab) for _ in range(rng.randrange(30, 300))]
        if rng.random() < 0.1:
            words = [rng.choice(["###", "$$|", w]) for w in words]
        if rng.random() < 0.2:
            words[30:30] = words[:20]
        lines, at = [], 0
        while at < len(words):
            step = rng.randrange(4, 15)
            lines.append(" ".join(words[at : at + step]))
            at += step
        lang = rng.choice(["en", "en", "de", None])
        rows.append((i, "\n".join(lines), lang, rng.choice("aaab" if lang == "en" else "abcdefghij")))
    return rows + [(n, *rows[-1][1:]), (n, *rows[-1][1:]), (None, *rows[-2][1:])]


def test_statistics(spark):
    rows = corpus(1, 150)
    got = outliers.text_statistics(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    expected = Counter((i, lang, source, *statistics(text)) for i, text, lang, source in rows)
    assert Counter(tuple(r) for r in got) == expected


def vector(n, chars, symbols, dups, repeats):
    angle = lambda a, b: math.asin(math.sqrt(min(a / max(b, 1), 1)))
    own = [math.log(max(chars, 1) / max(n, 1)), angle(symbols, chars), math.log1p(dups), angle(repeats, n), math.log(max(n, 1))]
    return [math.floor(x * 1024 + 0.5) / 1024 for x in own]


def plain_estimate(v, factor):
    return v.mean(0), factor * np.cov(v.T, bias=True) + np.diag(np.array(list(outliers.LEAST_DEVIATION.values())) ** 2)


def plain_distance(v, found):
    d = v - found[0]
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(found[1]), d)


def nearest(v, found):
    bins = np.floor(32 * np.log(plain_distance(v, found) + 1e-6))
    limit = np.sort(bins)[math.ceil(0.75 * len(v)) - 1]
    return plain_estimate(v[bins <= limit], 1.0)


def plain_robust(groups):
    """Final estimates of all groups, given as (vectors, starts): steps go on until no group's determinant falls."""
    det = lambda f: np.linalg.slogdet(f[1])[1]
    last = []
    for v, starts in groups:
        found = [plain_estimate(v[s], 1.0) for s in starts]
        for _ in range(2):
            found = [nearest(v, f) for f in found]
        last.append(min(found, key=det))
    for _ in range(outliers.STEPS):
        new = [nearest(v, f) for (v, _), f in zip(groups, last)]
        falls = any(det(a) < det(b) - outliers.TOLERANCE for a, b in zip(new, last))
        last = new
        if not falls:
            break
    limit = outliers.widening(0.75, 5) * outliers.chi_square_limit(0.975, 5)
    return [plain_estimate(v[plain_distance(v, f) <= limit], outliers.widening(0.975, 5)) for (v, _), f in zip(groups, last)]


def test_distances(spark):
    rows = [r for r in corpus(2, 500) if r[0] is not None][:-1]
    got = {r.doc_id: r for r in outliers.judge_documents(frame(spark, rows)).collect()}
    passed = {r[0]: vector(*statistics(r[1])[:5]) for r in rows if not statistics(r[1])[5]}
    sizes = Counter((r[2], r[3]) for r in rows if r[0] in passed)
    level = {k: 0 if n >= 40 else 1 for k, n in sizes.items()}
    groups = {}
    for i, _, lang, source in rows:
        if i in passed:
            groups.setdefault((lang, source) if level[lang, source] == 0 else lang, []).append(i)
    big = {k: ids for k, ids in groups.items() if len(ids) >= 40}
    assert len(big) >= 3
    # the hash that draws the other starts
    hashed = {r.doc_id: r.h for r in spark.createDataFrame([(i,) for i in passed], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()}
    rejected, parts = 0, []
    for ids in big.values():
        v = np.array([passed[i] for i in ids])
        draw = np.array([hashed[i] % max(4, len(ids) // 15) for i in ids])
        starts = [np.arange(len(ids))] + [np.flatnonzero(draw == k) for k in range(4) if (draw == k).any()]
        parts.append((v, starts))
    for ids, (v, _), found in zip(big.values(), parts, plain_robust(parts)):
        d2 = plain_distance(v, found)
        assert [got[i].d2 for i in ids] == pytest.approx(d2.tolist(), rel=1e-6, abs=1e-9)
        assert [got[i].kept for i in ids] == (d2 <= outliers.chi_square_limit(0.9999, 5)).tolist()
        rejected += int((d2 > outliers.chi_square_limit(0.9999, 5)).sum())
    assert rejected > 10
    assert not any(got[r[0]].kept for r in rows if r[0] not in passed)


def test_chi_square():
    # tabled values
    assert outliers.chi_square_limit(0.975, 5) == pytest.approx(12.8325, abs=1e-4)
    assert outliers.chi_square_limit(0.95, 4) == pytest.approx(9.4877, abs=1e-4)


def test_repeated_rows_and_few_rows(spark):
    rows = corpus(3, 30)
    got = outliers.judge_documents(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    # too few rows for an estimate: the base rules alone decide
    assert all(r.d2 is None and r.kept == (not r.base_failed) for r in got)
    assert outliers.judge_documents(frame(spark, [])).count() == 0


def test_group_of_copies(spark):
    """Copies that hold most of a group do not make its other clean rows outliers."""
    rng = random.Random(4)
    clean = lambda k: " ".join(f"{rng.choice('bcdf')}ar{rng.choice('aeiou')}{rng.randrange(30)}" for _ in range(120))
    copy = clean(0)
    rows = [(i, copy if i % 4 else clean(i), "en", "s") for i in range(300)] + [(300, "$$$ |||| ## " * 2 + clean(1).replace("a", "#"), "en", "s")]
    got = {r.doc_id: r.kept for r in outliers.judge_documents(frame(spark, rows)).collect()}
    assert [i for i, kept in got.items() if not kept] == [300]


def test_query(spark, tmp_path):
    rows = [r for r in corpus(5, 120) if r[0] is not None]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.op11_covariance_outliers(spark, str(tmp_path))
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert not {"Python", "Pandas", "Arrow"} & set(got._jdf.queryExecution().executedPlan().toString().split())
    assert Counter((r.doc_id, *r[1:7]) for r in got.collect()) == Counter((i, *statistics(t)) for i, t, _, _ in rows)
