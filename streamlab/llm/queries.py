"""The named queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlab.llm import alignment, ann, decontaminate, divergence, exact_dedup, language_model, mixing, passages, quality, sentence_pieces, simhash, toxicity, warc
from streamlab.llm.common import checkpointed, crc_of_id, fresh_folder, read_table

#: The public vocabulary files; read on the driver.
PIECE_MODEL = os.environ.get("PIECE_MODEL") or public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = os.environ.get("BYTE_MODEL") or public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function
    return add


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.mark(read_table(spark, sf_dir, "documents"), settings=simhash.CLOSE)
    return marked.select(F.col("id").alias("doc_id"), F.lower(F.hex("print")).alias("fingerprint"), "component_id")


@query("op7_exact_dedup", r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
            sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
        FROM documents
    ), k AS (
        SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
            count(*) OVER (PARTITION BY text_sha256) AS group_size
        FROM d
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark, fresh_folder(spark, "digests"))
    marking = exact_dedup.mark(read_table(spark, sf_dir, "documents"), index)
    marking.commit()
    return marking.rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query("op8_mixing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(read_table(spark, sf_dir, "documents"))
    return planned.select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op10_warc", r"""
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
        FROM pages
    ), r AS (
        SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to
    FROM r
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archive(read_table(spark, sf_dir, "pages"), fresh_folder(spark, "warc"))
    return warc.read_records(index).drop("url", "payload")


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the labels whose crc32(doc_id) mod 5 is not 0."""
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    scored = quality.classify(read_table(spark, sf_dir, "documents"), labels.where(crc_of_id("id") % 5 != 0))
    return scored.select(
        F.col("id").alias("doc_id"), (crc_of_id("id") % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op5_ann")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every vector whose id is divisible by 20."""
    vectors = ann.valid_vectors(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return ann.search(vectors, vectors.where("id % 20 = 0"))


@query("op3_sentence_pieces")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text and decodes the ids again; ``round_trip`` compares with the text, marks taken as blanks."""
    model = sentence_pieces.read_model(PIECE_MODEL)
    rows = sentence_pieces.round_trip(read_table(spark, sf_dir, "documents"), model)
    return rows.select(F.col("id").alias("doc_id"), F.size("ids").alias("n_tokens"), "ids", "round_trip", "decoded_sha256")


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the labels whose crc32(doc_id) mod 3 is not 1."""
    documents = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    machine = toxicity.fit(documents, labels.where(crc_of_id("id") % 3 != 1))
    scored = toxicity.score(documents, machine)
    return scored.select(
        F.col("id").alias("doc_id"), (crc_of_id("id") % 3 == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op6_language_model")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents whose crc32(doc_id) mod 5 is not 1."""
    scored = language_model.score(read_table(spark, sf_dir, "documents"), crc_of_id("doc_id") % 5 != 1)
    return scored.select(
        F.col("id").alias("doc_id"), (crc_of_id("id") % 5 == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op9_passages")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op13_decontaminate", f"""
    WITH d AS (SELECT row_number() OVER () AS n, doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[k:k + 9], ' ') AS gram
        FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS k FROM i WHERE len(w) > 0)
    ), found AS (
        SELECT n, k, size, gram FROM (
            SELECT n, k, size, array_to_string(w[k:k + size - 1], ' ') AS gram
            FROM (SELECT n, w, unnest(generate_series(1, len(w))) AS k FROM d), (SELECT DISTINCT size FROM windows)
            WHERE k + size - 1 <= len(w))
        WHERE gram IN (SELECT gram FROM windows)
    ), hit AS (
        SELECT n, count(DISTINCT p) AS n_hit FROM (SELECT n, unnest(generate_series(k, k + size - 1)) AS p FROM found) GROUP BY n
    ), items AS (
        SELECT n, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
        FROM found JOIN windows USING (gram) GROUP BY n
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (n) LEFT JOIN items USING (n)
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return marked.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query("op12_divergence", r"""
    WITH d AS (
        SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), t AS (SELECT n, lang, source, unnest(terms) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS lang_cnt FROM t GROUP BY ALL HAVING count(DISTINCT n) >= 3),
    c AS (SELECT lang, source, term, count(*) AS cnt FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    v AS (SELECT lang, count(*) AS v, sum(lang_cnt) AS lang_n FROM kept GROUP BY lang),
    g AS (
        SELECT lang, source, coalesce(sum(cnt), 0) AS n
        FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL
    ), p AS (
        SELECT g.lang, g.source, kept.term, coalesce(cnt, 0) AS cnt,
            1 + (1000000000::HUGEINT * (coalesce(cnt, 0) + 1)) // (n + v)::HUGEINT AS p,
            1 + (1000000000::HUGEINT * (lang_cnt + 1)) // (lang_n + v)::HUGEINT AS q
        FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
    ), pair_sums AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), parts AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE cnt > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts
    )
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read_table(spark, sf_dir, "documents"))


@query("op11_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = alignment.read_tokenizers(BYTE_MODEL, public_tokenizers.PATTERN, PIECE_MODEL)
    return alignment.align(read_table(spark, sf_dir, "documents"), files).withColumnRenamed("id", "doc_id")
