"""The operators of this folder as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm import counts, leaks, lines, neighbours, outliers, packing, pages, recurrent, runs, search, simhash, substrings, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op9_simhash_vp")
def op9_simhash_vp(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of four-word shingles and the components of links at four or fewer bits."""
    found = simhash.near_copies(table(spark, folder, "documents"), simhash.Rule(words=4, radius=4))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_pattern_packing")
def op4_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    docs = table(spark, folder, "documents")
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), packing.SIZE, with_ids=False)


@query(
    "op6_seed_extend",
    r"""
    WITH cut AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), windows AS (
      SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS words
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM cut WHERE len(ws) >= 20)
    ), later AS (
      SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, p) > 1
    ), gone AS (
      SELECT DISTINCT doc_id, p + k AS i FROM (SELECT doc_id, p, unnest(range(20)) AS k FROM later)
    ), each AS (
      SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM cut
    ), kept AS (
      SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) FILTER (WHERE g.i IS NULL) AS text, count(g.i) AS n_removed
      FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id
    )
    SELECT c.doc_id, CAST(len(c.ws) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
      sha256(coalesce(k.text, '')) AS kept_sha256
    FROM cut c LEFT JOIN kept k ON k.doc_id = c.doc_id
    """,
)
def op6_seed_extend(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of every document less its passages of 20 words that start earlier."""
    kept = substrings.drop_repeated_passages(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


MIN_LINES = 2


@query(
    "op8_line_winnowing",
    """
    WITH cut AS (
      SELECT doc_id, generate_subscripts(ls, 1) AS place, unnest(ls) AS line
      FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)
    ), numbered AS (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i FROM cut WHERE trim(line) <> ''
    ), pairs AS (
      SELECT doc_id, i, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS next_line FROM numbered
    ), later AS (
      SELECT doc_id, i FROM pairs WHERE next_line IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, i) > 1
    ), gone AS (
      SELECT doc_id, i FROM later UNION SELECT doc_id, i + 1 FROM later
    ), marked AS (
      SELECT c.doc_id, c.place, c.line, n.i, g.i AS gone_i
      FROM cut c LEFT JOIN numbered n USING (doc_id, place) LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.i = n.i
    ), kept AS (
      SELECT doc_id, string_agg(line, chr(10) ORDER BY place) FILTER (WHERE gone_i IS NULL) AS text,
        count(i) AS n_lines, count(gone_i) AS n_removed
      FROM marked GROUP BY doc_id
    )
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
      coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
    FROM documents d LEFT JOIN kept k USING (doc_id)
    """,
)
def op8_line_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the runs of two or more lines that also start earlier."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs, MIN_LINES).select("doc_id", "text", "n_lines", "n_removed")


@query("op7_weak_toxicity")
def op7_weak_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of all documents, learned from the rows that are not held out."""
    return toxicity.score_texts(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op1_qgram_decontamination")
def op1_qgram_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every place of a document that holds a benchmark item within a tenth of edits."""
    return leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_viterbi_counts")
def op3_viterbi_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Number of unigram pieces of every document."""
    return counts.token_counts(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op5_template_extraction")
def op5_template_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = pages.extract_pages(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op2_adaptive_scan")
def op2_adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth one."""
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


@query("op10_gated_recurrent")
def op10_gated_recurrent(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document under word frequencies and under the network."""
    return recurrent.score_documents(table(spark, folder, "documents"))


@query("op13_maximal_pair_runs")
def op13_maximal_pair_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of twelve words or more of every document, after the periods planted by its id."""
    found = runs.periodic_runs(runs.with_planted_periods(table(spark, folder, "documents")), 12)
    best = found.withColumn("best", runs.longest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        runs.digest(F.col("runs")).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_bag_search",
    r"""
    WITH cut AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
    ), total AS (
      SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS terms FROM cut WHERE len(ts) > 0
    ), sized AS (
      SELECT doc_id, ts, 50 + (50 * len(ts) * docs) // terms AS m FROM cut, total WHERE len(ts) > 0
    ), asked AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
    ), held AS (
      SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(ts) AS term FROM sized)
      WHERE term IN (SELECT term FROM asked) GROUP BY ALL
    ), weights AS (
      SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, total GROUP BY term, docs
    ), scores AS (
      SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM asked JOIN held USING (term) JOIN weights USING (term) GROUP BY ALL
    )
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 50
    """,
)
def op12_bag_search(spark: SparkSession, folder: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return search.best_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 50)


@query("op11_covariance_outliers")
def op11_covariance_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Text statistics of every document and whether it is kept."""
    found = outliers.judge_documents(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2"
    )
