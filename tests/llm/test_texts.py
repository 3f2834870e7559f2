"""Operators on texts against plain forms, over awkward rows."""

import random

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import leaks, lines, packing, recurrent, simhash, substrings, tokens, toxicity
from tallyframe.llm.catalog import vocabulary

SCHEMA = "doc_id long, text string, h long, doc string, sig long, n_removed string"


def frame(spark, rows):
    """Rows with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 7, "x", 1, "y") for i, t in rows], SCHEMA)


def awkward(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(12)] + ["é", "ö.", "A", "a"]
    long = " ".join(rng.choice(vocab) for _ in range(4000))
    passage = [rng.choice(vocab) for _ in range(40)]
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, long), (5, long), (6, "same same " * 40), (7, "A b\nc"), (8, "a B\x0bC")]
    for i in range(9, n):
        w = [rng.choice(vocab) for _ in range(rng.randrange(80))]
        if rng.random() < 0.5:
            w[len(w) // 2 : len(w) // 2] = passage[rng.randrange(10) : 40 - rng.randrange(10)]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    return rows + [(n, rows[-1][1]), (n + 1, rows[4][1] + " tail")]


@pytest.mark.parametrize("size,anchor", [(20, 4), (8, 3), (5, 5)])
def test_passages(spark, size, anchor):
    rows = awkward(size)
    got = substrings.drop_repeated_passages(frame(spark, rows), size, anchor).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in got} == brute.repeated_passages(rows, size)


def test_passages_of_repeated_and_nameless_rows(spark):
    text = " ".join(map(str, range(30)))
    rows = [(1, text), (1, text), (None, text), (2, text), (3, None)]
    got = sorted((r.doc_id or 0, r.n_removed) for r in substrings.drop_repeated_passages(frame(spark, rows)).collect())
    assert got == [(0, 0), (1, 0), (1, 0), (2, 30), (3, 0)]
    assert substrings.drop_repeated_passages(frame(spark, [])).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3])
def test_lines(spark, size):
    rng = random.Random(size)
    pool = ["a", "b", "c", " ", "", "d é"]
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "x" * 50_000)]
    rows += [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for i in range(4, 60)]
    rows.append((60, "\n".join(str(k % 50) for k in range(400))))
    got = lines.drop_repeated_lines(frame(spark, rows).drop("n_removed"), size).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got} == brute.repeated_lines(rows, size)


def test_lines_keep_rows_and_columns(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (None, "a\nb"), (2, "a\nb\nc")]
    got = lines.drop_repeated_lines(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text, r.h, r.doc) for r in got) == [
        (0, "a\nb", 7, "x"), (1, "a\nb", 7, "x"), (1, "a\nb", 7, "x"), (2, "c", 7, "x"),
    ]
    assert lines.drop_repeated_lines(frame(spark, [])).count() == 0


@pytest.mark.parametrize("size,radius,blocks", [(4, 4, 3), (2, 9, 5), (1, 0, 1)])
def test_fingerprints(spark, size, radius, blocks):
    rng = random.Random(radius)
    rows = awkward(radius)
    for i in range(100, 140):  # near copies
        w = (rng.choice(rows[9:40])[1] or "").split()
        if w:
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    got = simhash.near_copies(frame(spark, rows), simhash.Rule(size, radius, blocks))
    got = {r.doc_id: (r.f, r.component_id) for r in got.select("*", simhash.hex_digits(F.col("fp")).alias("f")).collect()}
    assert got == brute.linked(rows, size, radius)


def test_one_of_each(spark):
    base = [f"t{k}" for k in range(2000)]
    near = base[:100] + ["new"] + base[101:]
    rows = [(3, " ".join(base)), (1, " ".join(near)), (2, "other words here"), (4, " ".join(base)), (4, " ".join(base)), (None, "x"), (None, "x"), (5, None), (6, "")]
    rows += [(7, "some words"), (7, "some words"), (7, "quite another row of words")]
    table = frame(spark, rows).withColumns({"gone": F.lit("g"), "row": F.create_map(F.lit("k"), F.lit(1)), "id": F.lit(8), "fp": F.lit(9)})
    kept = simhash.one_of_each(table, corpus_pipeline.NEAR_COPIES)
    assert kept.schema == table.schema
    wanted = brute.linked([r for r in rows[:5]] + [(2, rows[2][1]), (5, None), (6, "")], 4, 4)
    assert wanted[3][1] == wanted[4][1] == 1 and wanted[6][1] == 5
    texts = {(r.doc_id or 0, r.text or "") for r in kept.collect()}
    assert texts == {(0, "x"), (1, " ".join(near)), (2, "other words here"), (5, ""), (7, "quite another row of words"), (7, "some words")}
    assert kept.count() == 7
    assert simhash.one_of_each(table.limit(0), corpus_pipeline.NEAR_COPIES).count() == 0


def test_trees_send_neighbours_to_one_shard():
    import numpy as np

    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    near = values ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64))
    for mask in simhash.masks_of(3):
        nodes = simhash.build_tree(np.unique(values), mask, 1, 50)
        assert len(nodes) > 10
        home = {}
        for shard, rows, held in simhash.route(nodes, values, mask, 1):
            home.update({int(r): shard for r in rows[held]})
        assert len(home) == len(values)
        reached = {i: set() for i in range(len(near))}
        for shard, rows, _ in simhash.route(nodes, near, mask, 1):
            for r in rows:
                reached[int(r)].add(shard)
        assert all(home[i] in reached[i] for i in home)


def test_leaks(spark):
    rng = random.Random(5)
    letters = "abcdefghij "
    items = [(k, "".join(rng.choice(letters) for _ in range(rng.randrange(60, 200))).strip()) for k in range(12)]
    rows, planted = [(0, None), (1, ""), (2, "short")], set()
    for i in range(3, 60):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(400)))
        if i % 2:
            k, item = rng.choice(items)
            t = list(item)
            for _ in range(int(len(t) * rng.choice([0, 0.04, 0.08, 0.2]))):
                p = rng.randrange(len(t))
                t[p : p + rng.choice([0, 1, 1])] = rng.choice(letters)
            text = text[: len(text) // 2] + "".join(t).upper() + text[len(text) // 2 :]
        rows.append((i, text))
    bench = spark.createDataFrame(items + [(50, None), (51, "tiny"), (3, items[3][1])], "item_id long, text string")
    found = leaks.find_leaks(frame(spark, rows), bench).collect()

    def plain(text):
        import numpy as np

        raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
        return leaks.normalized(np.array([0, len(raw)]), raw)[0].tobytes()

    wanted = set()
    for i, text in rows:
        for k, item in items:
            p = plain(item).strip()
            allowed = min(int(len(p) * 0.1), (len(p) - leaks.Q) // leaks.Q)
            if brute.leak_distance(p, plain(text)) <= allowed:
                wanted.add((i, k))
    assert {(r.doc_id, r.item_id) for r in found} == wanted and len(wanted) > 10
    blocks = leaks.find_leaks(frame(spark, rows), bench, block_bytes=500).collect()
    assert sorted(blocks) == sorted(found)
    text = dict(rows)
    for r in found:
        if r.edits == 0:
            assert plain(text[r.doc_id][r.start : r.end]).strip() == plain(dict(items)[r.item_id]).strip()
    assert leaks.find_leaks(frame(spark, []), bench).count() == 0
    assert leaks.drop_contaminated(frame(spark, rows), bench).count() == len(rows) - len({i for i, _ in wanted})
    assert leaks.find_leaks(frame(spark, rows), bench.limit(0)).count() == 0


def test_filters_leave_clashing_columns_alone(spark):
    text = "the quick brown fox jumps over the lazy dog near the river bank"
    docs = spark.createDataFrame([(1, text, 5, "x"), (2, "nothing of the kind is here", 6, "y"), (None, text, 7, "z")], "doc_id long, text string, _leak int, _toxic string")
    bench = spark.createDataFrame([(9, text)], "item_id long, text string")
    kept = leaks.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r["_leak"], r["_toxic"]) for r in kept.collect()) == [(6, "y"), (7, "z")]
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r["_leak"] for r in kept.collect()) == [5, 6, 7]


def test_packing(spark):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    rng = random.Random(1)
    odd = ["", None, " lead", "two  spaces", "end ", "x\n y", "don't stop", "日本 𝒳 é", "a" * 3000, "<|endoftext|>", "a <|endoftext|> b", " x<|endoftext|><|endoftext|>  y\n", "tab\tnew\n\nline", "  x"]
    rows = [(i, t) for i, t in enumerate(odd)] + [(i, " ".join(rng.choice(["alpha", "Beta", "9", "é,"]) for _ in range(rng.randrange(900)))) for i in range(20, 80)]
    rows += [(80, "b " * 9000), (80, "b " * 9000), (None, "nameless")]
    got = packing.pack_documents(frame(spark, rows), vocabulary("byte_bpe_50k.json"), 128).collect()
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    wanted = []
    for (i, t), e in zip(rows, tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        ids = np.array(e.ids + [0], dtype="<u4")
        for k, (s, n) in enumerate(packing.cut(len(ids), 128)):
            assert n == 128 or k == 0
            wanted.append((i or -1, k, s, n, ids[s : s + n].tobytes(), zlib.crc32(ids[s : s + n].tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, bytes(r.ids), r.ids_crc32) for r in got) == sorted(wanted)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 128
    assert dict(packing.pack_documents(frame(spark, rows), vocabulary("byte_bpe_50k.json")).dtypes)["piece"] == "int"
    assert len(places) <= 1.05 * sum(r.length for r in got) / 128 + 2
    assert packing.pack_documents(frame(spark, []), vocabulary("byte_bpe_50k.json")).count() == 0


def test_plan_places_every_piece():
    import numpy as np

    for seed in range(5):
        rng = np.random.default_rng(seed)
        counts = np.bincount(rng.integers(1, 65, 500 * seed), minlength=65) if seed else np.zeros(65, dtype=np.int64)
        runs, sequences = packing.plan(counts, 64)
        assert np.array_equal(np.bincount(runs[:, 0], weights=runs[:, 2], minlength=65), counts)
        assert sequences >= counts @ np.arange(65) / 64


def test_plan_is_no_worse_than_best_fit_alone():
    import numpy as np

    rng = np.random.default_rng(3)
    size = 512
    samples = {
        "even": rng.integers(1, size + 1, 20_000),
        "many short": rng.geometric(1 / 90, 20_000),
        "skewed": np.exp(rng.normal(4.2, 1, 20_000)).astype(int),
        "middle": rng.integers(160, 380, 20_000),
        "four lengths": rng.choice([75, 175, 262, 375], 20_000),
    }
    for name, lengths in samples.items():
        counts = np.bincount(np.clip(lengths, 1, size), minlength=size + 1)
        runs, sequences = packing.plan(counts, size)
        assert sequences <= packing.packed(counts, size, packing.patterns(counts, size)[:0])[1], name
        assert np.array_equal(np.bincount(runs[:, 0], weights=runs[:, 2], minlength=size + 1), counts), name
        assert sequences >= counts @ np.arange(size + 1) / size


def test_encoder_is_shared():
    assert tokens.encoder(vocabulary("byte_bpe_50k.json")) is tokens.encoder(vocabulary("byte_bpe_50k.json"))


def test_language_model(spark):
    rows = awkward(2) + [(200 + k, "the cat sat on the mat " * (1 + k % 5)) for k in range(60)]
    got = {r.doc_id: r for r in recurrent.score_documents(frame(spark, rows)).collect()}
    for i, (out, n, known, total, base) in brute.add_one(rows).items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    repeated = [r for i, r in got.items() if i >= 200 and r.held_out]
    assert sum(r.score for r in repeated) > sum(r.base_score for r in repeated)
    again = recurrent.score_documents(frame(spark, [(None, "a b"), (None, "a b"), (9, None)])).collect()
    assert sorted(r.n_tokens for r in again) == [1, 3, 3]
    assert recurrent.score_documents(frame(spark, [])).count() == 0


def test_network_learns_from_every_token(spark):
    """No learning document, and no token left over after cutting into lanes, is passed over."""
    import numpy as np

    words = [f"w{k}" for k in range(40)]
    rows = [(k, " ".join(words[(k + j) % 40] for j in range(k % 90))) for k in range(300)]
    learning = frame(spark, rows).repartition(3)
    lexicon = recurrent.Lexicon.of(recurrent.word_counts(learning), len(rows))
    _, seen = recurrent.fit(learning, lexicon)
    assert seen == lexicon.tokens == sum(k % 90 + 1 for k, _ in rows)
    for n in (0, 1, 15, 63, 64, 129, 5003):
        trainer = recurrent.Trainer(recurrent.first_weights(np.ones(1024)))
        trainer.documents(np.arange(n) % 7, 0)
        assert trainer.seen == n


def test_scores_do_not_depend_on_rows_scored_together():
    import numpy as np

    rng = np.random.default_rng(2)
    net = recurrent.first_weights(rng.random(1024))
    counts = rng.integers(1, 60, 700)
    tokens = rng.integers(1, 1024, counts.sum())
    tokens[np.cumsum(counts) - 1] = 0
    whole = recurrent.score_tokens(net, tokens, counts, 0)
    cut = counts[:300].sum()
    parts = [recurrent.score_tokens(net, tokens[:cut], counts[:300], 0), recurrent.score_tokens(net, tokens[cut:], counts[300:], 0)]
    assert np.allclose(whole, np.concatenate(parts), atol=1e-3)


def test_network_gradients():
    import numpy as np

    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in recurrent.first_weights(rng.random(recurrent.CLASSES**2)).items()}
    x, y = rng.integers(0, 1024, (5, 3)), rng.integers(0, 1024, (5, 3))
    keep, h = (rng.random((5, 3)) > 0.3).astype(float), rng.normal(size=(3, recurrent.HIDDEN))

    def loss():
        return -recurrent.predict(net, recurrent.run_window(net, x, keep, h).reshape(-1, recurrent.HIDDEN).astype(float), y.ravel())[0].sum()

    trainer = recurrent.Trainer({k: v.copy() for k, v in net.items()}, rate=0.0)
    trainer.step(x, y, keep, h)
    for name in ("state", "class_w", "input"):
        flat = net[name].reshape(-1)
        for at in np.argsort(-np.abs(trainer.mean[name].reshape(-1)))[:3]:
            slope = trainer.mean[name].reshape(-1)[at] * 10 / 16 * x.size
            if abs(trainer.mean[name].reshape(-1)[at]) > 0.0999:
                continue  # clipped
            old = flat[at]
            flat[at] = old + 1e-2
            up = loss()
            flat[at] = old - 1e-2
            down = loss()
            flat[at] = old
            assert abs((up - down) / 2e-2 - slope) < 0.05 * max(1, abs(slope)), name


def test_network_scores_do_not_depend_on_the_lanes():
    import numpy as np

    from tallyframe.llm.words import Texts

    rng = np.random.default_rng(1)
    net = recurrent.first_weights(rng.random(1024))
    raw = [b"a b c", b"", b"x " * 70, b"q r"]
    offsets = np.cumsum([0] + [len(r) for r in raw])
    texts = Texts(offsets, np.frombuffer(b"".join(raw), dtype=np.uint8))
    entries = rng.integers(1, 1024, len(texts.starts))
    whole = recurrent.score_rows(net, texts, entries, 0)
    for k, r in enumerate(raw):
        one = Texts(np.array([0, len(r)]), np.frombuffer(r, dtype=np.uint8))
        alone = recurrent.score_rows(net, one, entries[texts.firsts[k] : texts.firsts[k + 1]], 0)
        assert abs(alone[0] - whole[k]) < 1e-3
