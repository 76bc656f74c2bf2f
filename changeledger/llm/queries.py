"""One query per training-data operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeledger.session import configure

from . import bpe, decontamination, digests, language_id, line_dedup, merkle, neighbours, ngram_join, quality, ranked_search, suffix_dedup, toxicity
from .batches import fold_is, id_and_text, small_batches, stored
from .token_counts import learn_scores, token_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(function: Query) -> Query:
    """Register under the function's name, on a session configured for the package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(small_batches(configure(spark)), sf_dir)

    QUERIES[function.__name__] = run
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_and_text(_table(spark, sf_dir, "documents"))


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_documents(spark, sf_dir)).drop("kept")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    scores = learn_scores(documents, BYTE_RANKS, public_tokenizers.PATTERN)
    return token_counts(documents, BYTE_RANKS, public_tokenizers.PATTERN, scores)


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    kept = line_dedup.drop_boilerplate(pages, distinct_texts=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def _learned_labels(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """(doc_id, label) outside the held-out fold."""
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").cast("bigint"), F.col(column).cast("int").alias("label"))
    return labels.filter(~fold_is(F.col("doc_id"), 3, 1))


def _scored(found: DataFrame, threshold: float) -> DataFrame:
    held_out = fold_is(F.col("doc_id"), 3, 1).alias("held_out")
    return found.select("doc_id", held_out, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    model = toxicity.fit(documents, _learned_labels(spark, sf_dir, "toxic"))
    return _scored(toxicity.predict(documents, model), 0.7)


#: Links of 3-word shingles at a Jaccard similarity of 0.9 or more.
JOIN_SIMILARITY = ngram_join.Similarity(words=3, least=90, scale=100)


@query
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(_documents(spark, sf_dir), JOIN_SIMILARITY)


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.with_token_ids(_documents(spark, sf_dir), BYTE_RANKS, public_tokenizers.PATTERN).drop("text")
    return bpe.digest(bpe.with_decoded_bytes(encoded, BYTE_RANKS))


def learn_languages(documents: DataFrame) -> language_id.Learned:
    """From the documents outside the held-out fold."""
    learned = documents.filter(F.col("doc_id").isNotNull() & ~fold_is(F.col("doc_id"), 4, 2))
    labelled = id_and_text(learned).withColumn("lang", F.lit(None)) if "lang" not in documents.columns else learned.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"), "lang")
    return language_id.fit(labelled, BYTE_RANKS, public_tokenizers.PATTERN)


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = learn_languages(_table(spark, sf_dir, "documents"))
    found = language_id.predict(_documents(spark, sf_dir), model, BYTE_RANKS)
    return found.select("doc_id", fold_is(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(quality.measure(_documents(spark, sf_dir)), "quality-statistics")
    model = quality.fit(measured, _learned_labels(spark, sf_dir, "quality"))
    return _scored(quality.predict(measured, model), 0.5)


@query
def op10_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


@query
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = digests.edited_likeness(_documents(spark, sf_dir))
    in_hex = {name: F.lower(F.hex(name)) for name in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(in_hex)


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = id_and_text(_table(spark, sf_dir, "benchmark"), "item_id").withColumnRenamed("doc_id", "item_id")
    return ranked_search.ranked(_documents(spark, sf_dir), items)


ORACLE_SQL["op4_line_dedup"] = f"""
WITH lines AS (
    SELECT doc_id, source, i, string_split(text, chr(10))[i] AS line
    FROM documents, range(1, len(string_split(coalesce(text, ''), chr(10))) + 1) AS r(i)
    WHERE text IS NOT NULL
), texts AS (
    SELECT d.doc_id, d.source,
        CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(trim(line, ' '), chr(10) ORDER BY i) FILTER (trim(line, ' ') <> ''), '') END AS same
    FROM documents d LEFT JOIN lines l ON d.doc_id = l.doc_id GROUP BY d.doc_id, d.source, d.text
), totals AS (
    SELECT source, count(*) AS pages FROM (SELECT DISTINCT source, same FROM texts) GROUP BY source
), on_pages AS (
    SELECT DISTINCT t.source, same, trim(line, ' ') AS line FROM lines l JOIN texts t ON l.doc_id = t.doc_id WHERE trim(line, ' ') <> ''
), boilerplate AS (
    SELECT p.source, line
    FROM on_pages p JOIN totals t ON p.source IS NOT DISTINCT FROM t.source
    GROUP BY p.source, line, pages
    HAVING count(*) > {line_dedup.MAX_RATIO} * pages AND count(*) >= {line_dedup.MIN_PAGES}
), marked AS (
    SELECT l.doc_id, l.i, l.line, b.line IS NOT NULL AS gone
    FROM lines l LEFT JOIN boilerplate b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line, ' ') = b.line
), kept AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

ORACLE_SQL["op6_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 2], ' ') END AS s
    FROM words, range(1, greatest(len(w) - 1, 2)) AS r(i)
    WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * n_both >= 90 * (x.n + y.n - n_both)
), edges AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(start, node) AS (
    SELECT DISTINCT a, a FROM edges
    UNION
    SELECT start, b FROM reach JOIN edges ON node = a
), least AS (
    SELECT start, min(node) AS component_id FROM reach GROUP BY start
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.start = d.doc_id
"""

ORACLE_SQL["op11_merkle_manifest"] = r"""
WITH RECURSIVE fields AS (
    SELECT doc_id, lang, n_chars,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS before,
        coalesce(strlen(text) || ':' || text, '-') AS after,
        xor(list_reduce(
            flatten([[ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')]),
            lambda c, x : CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END,
            4294967295::BIGINT), 4294967295::BIGINT) % 7 = 0 AS is_tampered
    FROM documents
), leaves AS (
    SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf, tampered
    FROM (SELECT doc_id, lang,
        sha256(before || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') || after) AS leaf,
        sha256(before || coalesce(strlen((n_chars + is_tampered::INT)::VARCHAR) || ':' || (n_chars + is_tampered::INT)::VARCHAR, '-') || after) AS tampered
        FROM fields)
), langs AS (
    SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM leaves GROUP BY lang
), built(tree, level, i, hash) AS (
    SELECT tree, 0, i, leaf FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang
    UNION ALL
    SELECT tree, level + 1, i // 2, sha256(string_agg(hash, '' ORDER BY i))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS nodes FROM built) AS below
    WHERE nodes > 1 GROUP BY tree, level, i // 2
), subroots AS (
    SELECT tree, level, hash FROM (SELECT *, max(level) OVER (PARTITION BY tree) AS top FROM built) AS b WHERE level = top
), over(level, i, hash) AS (
    SELECT 0, tree, hash FROM subroots
    UNION ALL
    SELECT level + 1, i // 2, sha256(string_agg(hash, '' ORDER BY i))
    FROM (SELECT *, count(*) OVER () AS nodes FROM over) AS below WHERE nodes > 1 GROUP BY level, i // 2
), nodes AS (
    SELECT tree, level, i, hash FROM built UNION ALL SELECT -1, level, i, hash FROM over
), climb(doc_id, leaf, tree, level, i, top, lang_tree, folded, proof) AS (
    SELECT doc_id, leaf, g.tree, 0, i, s.level, g.tree, tampered, ''
    FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang JOIN subroots s ON s.tree = g.tree
    UNION ALL
    SELECT c.doc_id, c.leaf, CASE WHEN c.level = c.top THEN -1 ELSE c.tree END, CASE WHEN c.level = c.top THEN 0 ELSE c.level + 1 END,
        CASE WHEN c.level = c.top THEN c.lang_tree ELSE c.i // 2 END,
        CASE WHEN c.level = c.top THEN (SELECT max(level) FROM over) ELSE c.top END, c.lang_tree,
        CASE WHEN c.level = c.top THEN c.folded WHEN c.i % 2 = 1 THEN sha256(n.hash || c.folded) ELSE sha256(c.folded || coalesce(n.hash, '')) END,
        CASE WHEN c.level = c.top THEN c.proof ELSE c.proof || coalesce(n.hash, '') END
    FROM climb c LEFT JOIN nodes n ON n.tree = c.tree AND n.level = c.level AND n.i = xor(c.i, 1)
    WHERE NOT (c.tree = -1 AND c.level = c.top)
)
SELECT doc_id, leaf, s.hash AS subroot, r.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.hash AS verified
FROM climb c JOIN subroots s ON s.tree = c.lang_tree JOIN (SELECT hash FROM over WHERE level = (SELECT max(level) FROM over)) r ON true
WHERE c.tree = -1 AND c.level = c.top
"""

ORACLE_SQL["op13_ranked_search"] = r"""
WITH words AS (
    SELECT doc_id, row_number() OVER () AS d,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), sizes AS (
    SELECT d, doc_id, len(w) AS n FROM words WHERE len(w) > 0
), corpus AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes
), tfs AS (
    SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM words) GROUP BY d, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tfs, corpus GROUP BY term, n_docs
), asked AS (
    SELECT i, item_id, term, count(*) AS repeats
    FROM (SELECT row_number() OVER () AS i, item_id,
        unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark)
    GROUP BY i, item_id, term
), scores AS (
    SELECT i, item_id, s.d, doc_id, CAST(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked a JOIN weights g ON a.term = g.term JOIN tfs t ON t.term = a.term JOIN sizes s ON s.d = t.d, corpus
    GROUP BY i, item_id, s.d, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
"""
