"""The queries of the ten operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, html_text, language, licenses, lm_score, mixing, near_dedup, token_count, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, whose source stands for the host, and pages, in one result."""
    docs = _read(spark, sf_dir, "documents")
    model = language.fit(docs)
    own = docs.select("doc_id", F.lit(None).cast("bigint").alias("page_id"), "text", F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"), F.col("source").alias("site"))
    pages = language.page_rows(_read(spark, sf_dir, "pages"))
    web = pages.select(F.lit(None).cast("bigint").alias("doc_id"), F.col("id").alias("page_id"), "text", "declared", "suffix", "host", "site")
    return language.identify(own.unionByName(web), model, ["doc_id", "page_id"])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(_read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_document_tokens(_read(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_read(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(_read(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents with their domain: language and quality."""
    own = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return own.join(docs.select("doc_id", "lang").where("doc_id is not null"), "doc_id").select("doc_id", F.concat_ws("/", F.coalesce("lang", F.lit("und")), F.col("quality").cast("string")).alias("domain"))


def targets(model) -> dict:
    """Nine tenths to good text and one to the rest, English as much as the other languages together."""
    out = {}
    for name in (c for c in model.classes if c is not None):
        out[name] = (0.9 if name.endswith("/1") else 0.1) * (3.0 if name.startswith("en/") else 1.0)
    return out


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = mixing.fit(docs, domains(docs, _read(spark, sf_dir, "labels")))
    return mixing.mix(docs, model, targets(model)).select("doc_id", "n_tokens", "rate", "copies", "domain")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"), shingle=2).select("doc_id", "n_shingles", "component_id", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_dedup, op2_language_id, op3_toxicity, op4_lm_scoring, op5_token_counts, op6_license_scan, op7_html_extraction, op8_decontamination, op9_source_mixing, op10_near_dedup)
}

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PRINT = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op8_decontamination": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '{_ALNUM}') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '{_ALNUM}') AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, len(w[i:i + 12]) AS size, array_to_string(w[i:i + 12], ' ') AS words
            FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT size FROM windows),
        spots AS (
            SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
            FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)),
        found AS (SELECT s.doc_id, s.i, s.size, windows.item_id FROM spots s JOIN windows USING (size, words)),
        hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + size)) AS t(j) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op10_near_dedup": f"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '{_PRINT}') AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 1], ' ')) AS g
            FROM d, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS t(i) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
        reach AS (SELECT doc_id AS a, doc_id AS z FROM d UNION SELECT links.b, z FROM reach JOIN links ON reach.a = links.a),
        root AS (SELECT a, min(z) AS z FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, root.z AS component_id, d.doc_id = root.z AS kept
        FROM d LEFT JOIN n USING (doc_id) JOIN root ON root.a = d.doc_id""",
}
