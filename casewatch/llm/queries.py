"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewatch.llm import (
    bpe,
    centroids,
    embeddings,
    html_extract,
    licenses,
    mixing,
    oracle,
    packing,
    prefix_trie,
    quality_gam,
    quality_rules,
    simhash,
    url_filters,
    warc,
)
from casewatch.llm.common import shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", "n_chars")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("row.doc_id", *(f"verdict.{n}" for n in names))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_gam.score(documents, quality_gam.train(documents, labels))
    return scored.select(
        "row.doc_id", quality_gam.held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted"
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive = warc.write(pages, shared_folder(spark))
    return warc.fetch(archive, pages, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_counts(table(spark, sf_dir, "documents"), vocabulary_file())


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source/language/hundred/id.txt, every fiftieth one its folder's LICENSE."""
    doc_id = F.col("doc_id")
    name = F.when(doc_id % 50 == 0, "LICENSE").otherwise(F.concat(doc_id.cast("string"), F.lit(".txt")))
    folder = F.concat_ws("/", "source", "lang", F.floor(doc_id / 100).cast("string"))
    files = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws("/", folder, name).alias("path"))
    return licenses.scan(files).select(
        "row.doc_id", "row.path", "license", "similarity", "effective_license", "inherited_from"
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), vocabulary_file())
    digests = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests).placed.select("row.*", "sequence_id", "offset")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.described(centroids.cluster(table(spark, sf_dir, "embeddings")))


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file, which is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_simhash, op2_html_extraction, op3_embedding_dedup, op4_quality_rules, op5_url_filters, op6_quality_classifier, op7_mixing, op8_warc, op9_bpe, op10_license_scan, op11_prefix_trie, op12_best_fit_packing, op13_centroid_clustering)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
