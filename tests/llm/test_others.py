"""Search, counts, pages, toxicity and the pipeline."""

import math
import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import counts, neighbours, pages, toxicity
from tallyframe.llm.catalog import QUERIES, vocabulary

SMALL = "/root/testdata/sf0.001"


def exact(rows, query, k):
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 8]
    own = dict(good).get(query)
    if own is None:
        return []
    q = np.array(own, float)
    scored = []
    for i, v in good:
        if i != query:
            v = np.array(v, float)
            scored.append((-(q * v).sum() / (np.sqrt((q**2).sum()) * np.sqrt((v**2).sum())), i))
    return sorted(scored)[:k]


def test_nearest(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(700, 8)))]
    rows += [(700 + i, rows[3][1]) for i in range(9)] + [(720, None), (721, [0.0] * 8), (722, [1.0, None] + [1.0] * 6)]
    rows += [(723, [math.nan] + [1.0] * 7), (724, [math.inf] + [1.0] * 7), (725, [1.0] * 5), (726, []), (None, [1.0] * 8)]
    frame = spark.createDataFrame([(i, v, 1, "z") for i, v in rows], "vec_id long, embedding array<double>, list int, v string")
    wanted = [i for i, _ in rows if i is not None and (i % 25 == 0 or i in (3, 705, 721, 722))]
    got = neighbours.nearest(frame, frame.filter(F.col("vec_id").isin(wanted)), k=5).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    known = [r for r in rows if r[0] is not None]
    hits = total = 0
    for q in wanted:
        best = exact(known, q, 5)
        mine = found.get(q, [])
        assert len(mine) == len(best) and mine == sorted(mine)
        hits += len({i for _, i in mine} & {i for _, i in best})
        total += len(best)
        right = {i: s for s, i in exact(known, q, 999)}
        assert all(right[i] == s for s, i in mine)
    assert hits >= 0.9 * total
    everywhere = neighbours.nearest(frame, frame.filter("vec_id = 3"), k=5, probes=10_000).collect()
    assert [r.vec_id for r in sorted(everywhere, key=lambda r: r["rank"])] == [700, 701, 702, 703, 704]


def test_nearest_with_very_large_and_small_components(spark):
    rows = [(0, [1e200, 1e200]), (1, [3e200, 1e200]), (2, [2e-200, 1e-200]), (3, [-1e300, 1e300])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, frame.filter("vec_id = 0"), k=5).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [2, 1, 3]
    for r, wanted in zip(got, (3 / math.sqrt(10), 2 / math.sqrt(5), 0.0)):
        assert abs(r.score - wanted) < 1e-15


def test_nearest_in_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    assert neighbours.nearest(empty, empty).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], schema)
    assert [(r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(two, two).orderBy("query_id").collect()] == [(0, 1, 1), (1, 1, 0)]


def test_counts(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = vocabulary("piece_bpe_32k.model")
    tokenizer = Tokenizer(models.Unigram(counts.unigram_vocabulary(path), unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    texts = ["", " ", "  a", "a  b ", "<s> x <0x0A>", "日本語テキスト 𝒳", "a\n\nb", "▁x▁", "\n", "a" * 5000, "Hello, world! don't", "émigré naïve Ärger"]
    rng = random.Random(2)
    texts += ["".join(rng.choice("abcdeé ▁\n.A漢") for _ in range(80)) for _ in range(200)]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(900, None, 5), (None, "a b", 5), (0, "", 5)]
    got = counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int"), path).collect()
    wanted = [len(e.ids) for e in tokenizer.encode_batch([t or "" for _, t, _ in rows])]
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens) for r in got) == sorted(
        (r[0] if r[0] is not None else -1, n) for r, n in zip(rows, wanted)
    )


def test_piece_counts_break_ties_as_the_tokenizer_does():
    from tokenizers import Tokenizer, models

    rng = random.Random(7)
    for _ in range(40):
        entries = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))) for _ in range(6)} | {"▁", "▁a"}
        listed = [("<unk>", 0.0)] + [(e, float(-rng.randrange(1, 3))) for e in sorted(entries)]
        model = Tokenizer(models.Unigram(listed, unk_id=0, byte_fallback=False))
        mine = counts.PieceCounts(listed)
        for _ in range(30):
            word = "▁" + "".join(rng.choice("ab") for _ in range(rng.randrange(12)))
            found = model.encode(word).tokens
            if all(t in entries for t in found):
                assert mine.best(word)[1] == len(found), (listed, word, found)


PAGE = (
    "<!DOCTYPE html><html><head><title>{0}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul><li><a href='/{0}'>menu {0}</a></li></ul></nav><div class='ad box'>buy {0}</div>{1}<h1>{0}</h1>"
    "<p>first &amp; {0} <b>bold {0}</b>\n text {0}<p>second&nbsp;{0}<aside>by the way {0}</aside>{2}"
    "<section id='comments'><p>reader {0}</p></section><footer>&copy; {0}</footer>"
)


@pytest.mark.parametrize("element", [True, False])
def test_pages(spark, element):
    rows = []
    for k in range(40):
        name = f"n{k}"
        rows.append((k, f"https://Site.example/{k}", PAGE.format(name, "<article>" if element else "<div>", "</article>" if element else "</div>")))
    rows += [(100, None, None), (101, "", ""), (102, "https://few.example/", "<p>alone <!-- no --> here"), (3, *rows[3][1:])]
    rows += [(103, "https://few.example/2", "plain < text &lt;b&gt;"), (104, "https://Site.example/x", "<article><p>unclosed")]
    rows += [(105, "https://Site.example/long", "<article><p>" + "word " * 50_000 + "</p></article>")]
    frame = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, tags int")
    got = {r.page_id: r.text for r in pages.extract_pages(frame).collect()}
    for k in range(40):
        assert got[k] == f"n{k}\nfirst & n{k} bold n{k} text n{k}\nsecond n{k}", element
    assert got[100] == "" and got[101] == ""
    assert got[102] == "alone here" and got[103] == "plain < text <b>"
    if element:
        assert got[104] == "unclosed" and got[105] == ("word " * 50_000).strip()
    assert pages.extract_pages(frame).count() == len(rows)
    assert pages.extract_pages(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "mark",
    [
        "<div class='content no-sidebar'>|</div>",
        "<main class='has-sidebar'>|</main>",
        "<div id='page-with-header'>|</div>",
        "<article class='post related-3'>|</article>",
        "<div data-class='menu'>|</div>",
        "<div title='hidden gem'>|</div>",
        "<div class='sidebar-layout'><main>|</main></div>",
        "<div class='widget'>|</div>",
    ],
)
def test_marks_do_not_discard_the_article(mark):
    body = "<h1>Title of it</h1><p>" + "Long text of the article. " * 9 + "</p><div class='ad main-nav'>Buy this</div>"
    page = "<body><div class='site-nav'>Home</div>" + mark.replace("|", body) + "<div class='widget'>Weather</div></body>"
    text = pages._text_of(page, pages.Tags(), {}, None, set())
    assert text == "Title of it\n" + ("Long text of the article. " * 9).strip()


def test_page_events_end_on_broken_markup():
    tags = pages.Tags()
    for html in ("<" * 2000, "<a href='" * 500, "<!-- " * 300, "<script>" * 50, "</p>" * 100, "<div " + "x='" * 3000):
        assert isinstance(pages.events(html, tags), list)


def toxic_rows(n=3000):
    rng = random.Random(1)
    plain = [f"word{k}" for k in range(400)]
    bad = ["slurone", "slurtwo", "nastyx", "nastyq"]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.15
        if toxic:
            for b in rng.sample(bad, 2):
                w.insert(rng.randrange(len(w)), b)
        docs.append((i, " ".join(w)))
        if rng.random() < 0.5:
            labels.append((i, int(toxic)))
        docs[-1] += (int(toxic),)
    return docs, labels


def test_toxicity(spark):
    docs, labels = toxic_rows()
    extra = [(-1, None, 0), (-2, "", 0), (-3, "slurone nastyx " + "word1 " * 30_000, 1), (None, "slurtwo slurone", 1)]
    frame = spark.createDataFrame([(i, t, "hits") for i, t, _ in docs + extra + docs[:1]], "doc_id long, text string, hits string")
    told = spark.createDataFrame(labels + [(5, None), (None, 1), labels[0]], "doc_id long, toxic int")
    got = toxicity.score_texts(frame, told).collect()
    assert len(got) == len(docs) + 5
    truth = {i: y for i, _, y in docs + extra}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert sum(r.predicted == truth[r.doc_id] for r in got) > 0.99 * len(got)
    assert {r.doc_id for r in got if r.doc_id is not None and r.doc_id < 0 and r.predicted} == {-3}
    kept = toxicity.drop_toxic(frame, told)
    assert kept.columns == frame.columns and kept.filter("doc_id is null").count() == 1


def test_toxicity_learns_nothing_from_held_out_rows(spark):
    docs, labels = toxic_rows(1200)
    frame = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string")
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    schema = "doc_id long, toxic int"
    a, b = (
        {r.doc_id: r.score for r in toxicity.score_texts(frame, spark.createDataFrame(x, schema)).collect()} for x in (labels, flipped)
    )
    assert a == b


def test_toxicity_without_labels(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity.score_texts(frame, none).collect()] == [0, 0]
    assert toxicity.score_texts(frame.limit(0), none).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == docs.columns, name
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        kept = [r.doc_id for r in after.select("doc_id").collect()]
        assert len(set(kept)) == len(kept) and set(kept) <= ids and len(kept) > 0.7 * len(ids), name
        before = after
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in got} == set(kept)


@pytest.mark.parametrize("name", ["op1_qgram_decontamination", "op7_weak_toxicity"])
def test_queries_cover_every_row(spark, name):
    got = QUERIES[name](spark, SMALL)
    if name.startswith("op7"):
        assert got.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    else:
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
        items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
        found = {(r.doc_id, r.item_id) for r in got.collect()}
        assert {(d, i) for d, t in texts.items() for i, x in items.items() if x in t} <= found


def _div_page(k: int, body: str, wrap: str = "%s") -> str:
    inner = (
        f'<div class="menu"><a href="/">Home</a></div><h1>Headline {k}</h1><div class="txt">{body}</div>'
        '<div class="legal">All rights reserved by the owner of this host</div>'
    )
    return f"<html><body>{wrap % inner}</body></html>"


def _long(k: int) -> str:
    return " ".join(f"word{(k * 7919 + i * 31) % 997}" for i in range(900))


@pytest.mark.parametrize("wrap", ["%s", '<form id="page">%s</form>'], ids=["plain", "form"])
def test_pages_of_div_only_hosts_keep_headlines(spark, wrap):
    rows = [(k, f"http://divs.example/{k}", _div_page(k, _long(k), wrap)) for k in range(8)]
    got = {r.page_id: r.text for r in pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Headline {k}\n{_long(k)}" for k in range(8)}


def test_copies_on_a_host_are_no_template(spark):
    rows = [(k, f"http://copies.example/{k}", _div_page(min(k, 2), _long(min(k, 2)))) for k in range(6)]
    got = {r.page_id: r.text for r in pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Headline {min(k, 2)}\n{_long(min(k, 2))}" for k in range(6)}


def test_small_forms_stay_beside(spark):
    html = _div_page(1, _long(1)).replace("</body>", "<form>Write to us here</form></body>")
    assert "Write" not in pages._text_of(html, pages.Tags(), {}, None, set())
