"""The registered queries of this package and, where SQL can express them, their results in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, hard_negatives, html_template, jaccard_join, language_id, packing, sharding, source_divergence, token_matrix,
               tokens, toxicity, url_filter, vector_graph, warc)
from .common import fold, shared_folder, staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the folds other than 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    held = fold("doc_id", 4) == 2
    filters = language_id.fit(docs.where(~held).select("text", "lang"))
    seen = language_id.identify(docs.select("doc_id", "text"), filters)
    return seen.select("doc_id", held.alias("held_out"), "language.lang_pred", "language.score", "language.coverage")


def op2_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from the labelled folds other than 0 of 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = fold("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held))
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "toxicity.score", F.col("toxicity.toxic").cast("int").alias("predicted"),
        F.size("toxicity.segments").alias("n_segments"))


def op3_suffix_array_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "leak.n_words", "leak.n_hit", "leak.n_items", "leak.items_sha256", "leak.contaminated")


def op4_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of 4096 ids as possible."""
    cut = tokens.pieces(table(spark, sf_dir, "documents"))
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_minhash_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all documents whose five-word shingles are at least 0.8 similar."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op9_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed id matrices of all documents, written, and every segment as cut out of them again."""
    matrix = staged(token_matrix.pack_matrices(table(spark, sf_dir, "documents")))
    return token_matrix.segments_of(matrix)


def op6_pruned_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for every twentieth one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vector_graph.search(vector_graph.index(vectors), vectors.where(F.pmod("vec_id", F.lit(20)) == 0), 20)


def op7_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_template.extract(table(spark, sf_dir, "pages"), out="text").select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, as read back from the archives."""
    path = shared_folder(spark)
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op10_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes; equal texts are one group."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"))
    return sharding.shard_by_bytes(docs, 40, weight="size", group=("text_hash",)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_anchor_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector and its positives."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.mine(rows, F.pmod("vec_id", F.lit(50)) == 0)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences between the sources of every language, and the terms that mark each source."""
    return source_divergence.divergences(source_divergence.stripes(table(spark, sf_dir, "documents")))


def op13_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page, by rule or by the two language models."""
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words CROSS JOIN (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
found AS (SELECT doc_id, item, n, i FROM doc_windows JOIN item_windows USING (n, g)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP11_SQL = """
WITH plain AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM plain a JOIN plain b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
uses AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM uses GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
pair_groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT lang, source, term, coalesce(n, 0) AS n
  FROM pair_groups JOIN kept USING (lang)
    LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM uses GROUP BY ALL) USING (lang, source, term)),
sizes AS (SELECT lang, source, sum(n)::HUGEINT AS total, count(*) AS v FROM cells GROUP BY ALL),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 1)) // (total + v) AS p
  FROM cells JOIN sizes USING (lang, source)),
whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM cells GROUP BY ALL)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
found AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM pair_groups g JOIN pair_groups h ON h.lang = g.lang AND h.source <> g.source
    LEFT JOIN apart ON apart.lang = g.lang AND apart.source = g.source AND apart.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_bitmask": op1_language_bitmask,
    "op2_toxic_segments": op2_toxic_segments,
    "op3_suffix_array_leaks": op3_suffix_array_leaks,
    "op4_linear_grouping": op4_linear_grouping,
    "op5_minhash_forest_join": op5_minhash_forest_join,
    "op6_pruned_graph_search": op6_pruned_graph_search,
    "op7_template_extraction": op7_template_extraction,
    "op8_warc_roundtrip": op8_warc_roundtrip,
    "op9_token_matrix": op9_token_matrix,
    "op10_histogram_shards": op10_histogram_shards,
    "op11_anchor_lists": op11_anchor_lists,
    "op12_source_divergence": op12_source_divergence,
    "op13_url_models": op13_url_models,
}
ORACLE: dict[str, str] = {
    "op3_suffix_array_leaks": OP3_SQL, "op11_anchor_lists": OP11_SQL, "op12_source_divergence": OP12_SQL}
