"""The registered query of each operator, with its production parameters, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import (
    ann, fim, html_extract, jaccard, langid, mixing, neardup, packing, sharding, token_counts, toxicity, warc, whitening,
)
from tabwright.llm.common import held_out

WORDS = r"[^\x20\x09-\x0D]+"


#: Where this package is installed or checked out.
ROOT = str(Path(__file__).resolve().parents[2])
#: Bytes of a batch that goes to a Python worker: set where the session has Spark's default, which is eight times as much.
BATCH, DEFAULT_BATCH, SMALL_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Python workers have to find this package, also where only the driver's path names it.
    seen = spark.sparkContext.environment
    if ROOT not in seen.get("PYTHONPATH", "").split(os.pathsep):
        seen["PYTHONPATH"] = os.pathsep.join(filter(None, [seen.get("PYTHONPATH"), ROOT]))
    if spark.conf.get(BATCH) == f"{DEFAULT_BATCH}b":
        spark.conf.set(BATCH, SMALL_BATCH)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def language_model(spark: SparkSession, folder: str) -> langid.Model:
    docs = table(spark, folder, "documents")
    return langid.fit(docs.where(~held_out(F.col("doc_id"), 4, 2)))


def toxicity_model(spark: SparkSession, folder: str, max_rows: int = 20_000) -> toxicity.Model:
    """Learnt from about ``max_rows`` labels, drawn by their id, and the whole texts of these documents.

    The bound of the sample bounds the broadcast of its ids and labels as well.
    """
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    labels = labels.where(~held_out(F.col("doc_id"), 3, 1)).where("toxic IS NOT NULL")
    share = min(1.0, max_rows / max(labels.count(), 1))
    drawn = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.fit(docs.join(F.broadcast(drawn), "doc_id"), max_rows=2 * max_rows)


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), keep_ids=False, added=packing.ADDED)


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.components(table(spark, folder, "documents"), words=3, threshold=(9, 10))
    return found.select("doc_id", "n_shingles", "component_id")


def op3_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.main_text(table(spark, folder, "pages"))


def op5_cube_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, folder))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


def op7_jump_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op8_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.links(table(spark, folder, "embeddings"), threshold=0.93)


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = langid.predict(docs, language_model(spark, folder))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write(table(spark, folder, "pages"), "page_id", "url", "html")
    found = warc.resolved(warc.read(spark, archives))
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fim.transform(table(spark, folder, "documents"), unit="line", seed=7, rate=100, spm=50, keep_output=False)


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    found = token_counts.token_counts(table(spark, folder, "documents"))
    whole = found.select("doc_id", "n_bytes", F.coalesce(F.try_element_at("counts", F.lit(-1)), F.lit(0)).cast("long").alias("n_tokens"))
    return whole.withColumn("over_limit", F.col("n_tokens") > 1024)


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"), most=4, steps=256)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_best_fit_packing, op2_ngram_jaccard, op3_prefix_forest, op4_html_text, op5_cube_mixing, op6_toxicity, op7_jump_sharding, op8_embedding_neardup, op9_language_id, op10_warc,
        op11_fill_in_middle, op12_token_counts, op13_embedding_whitening,
    )
}
ORACLES: dict[str, str] = {
    "op10_warc": """
        WITH rows AS (
            SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages
        ), firsts AS (SELECT digest, min(page_id) AS first FROM rows WHERE bytes >= 100 GROUP BY digest)
        SELECT page_id, bytes AS payload_bytes, rows.digest AS payload_digest,
               CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM rows LEFT JOIN firsts ON rows.digest = firsts.digest
    """,
    "op11_fill_in_middle": """
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents
        ), drawn AS (
            SELECT doc_id, text, string_split(text, chr(10)) AS parts, length(text) - length(replace(text, chr(10), '')) AS breaks,
                   CAST('0x' || substr(hex, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(hex, 9, 8) AS BIGINT) AS h2,
                   CAST('0x' || substr(hex, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(hex, 25, 8) AS BIGINT) AS h4 FROM hashed
        ), counted AS (
            SELECT *, breaks + CASE WHEN text = '' OR ends_with(text, chr(10)) THEN 0 ELSE 1 END AS n FROM drawn
        ), cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM counted
        ), placed AS (
            SELECT *, CASE WHEN a = 0 THEN 0 WHEN a > breaks THEN length(text) ELSE length(array_to_string(parts[1:a], chr(10))) + 1 END AS p,
                   CASE WHEN b = 0 THEN 0 WHEN b > breaks THEN length(text) ELSE length(array_to_string(parts[1:b], chr(10))) + 1 END AS q,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || substr(text, 1, p) || '<S>' || substr(text, q + 1) || '<M>' || substr(text, p + 1, q - p)
                      ELSE '<S>' || substr(text, q + 1) || '<P>' || substr(text, 1, p) || '<M>' || substr(text, p + 1, q - p) END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM placed
    """,
}
