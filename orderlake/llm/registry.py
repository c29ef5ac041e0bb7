"""The contract queries of the training-data operators, one ``opN_<name>`` each, and their DuckDB SQL.

A query applies its operator, with production parameters, to its whole table and derives
the contract's digest columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from orderlake.config import scratch_path
from orderlake.llm import (decontamination, jaccard_join, langid, manifest, mixing, packing, prefix_trie, quality_mil,
                           repetition, sharding, sql, toxicity, url_filter, warc)
from orderlake.llm.common import held_out, ship_package
from orderlake.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    copies = mixing.curriculum(mixing.plan(docs))
    taken = F.aggregate("epochs", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return copies.where(F.coalesce("epoch", F.lit(0)) == 0).select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), "position")


def op2_url_lm_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    placed = docs.select("doc_id", sharding.size_of(F.col("text")).alias("size"),
                         sharding.text_crc32(F.col("text")).alias("text_crc32"), F.lit("bytes").alias("law"),
                         sharding.plan(docs).alias("shard"))
    return sharding.slots(placed, "shard", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    hits = decontamination.hit_words(F.col("_found"))
    items = F.col("_found.items")
    return found.select("doc_id", F.col("_found.n_words").alias("n_words"), hits.alias("n_hit"),
                        F.size(items).cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort(items)).cast("binary"), 256).alias("items_sha256"),
                        (hits > 0).alias("contaminated"))


# Scores from which a document counts as label 1.
GOOD_FROM = 0.3
TOXIC_FROM = 0.5


def op4_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_mil.train(docs, read_table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_mil.score(docs, model).alias("score"))
            .withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int")))


def op5_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", repetition.repetition(F.col("text")).alias("m"))
    m = F.col("m")
    return docs.select("doc_id", *[m[f].alias(f) for f in repetition.FIELDS if f != "longest_repeat"],
                       repetition.base_failed(m).alias("base_failed"),
                       (~repetition.base_failed(m) & repetition.passes(m)).alias("kept"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return warc.read_archives(spark, path, payloads=False).drop("url")


def op8_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = docs.select("doc_id", langid.identify(docs, langid.train(docs)).alias("found"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("found.lang").alias("lang_pred"),
                        F.col("found.score").alias("score"), F.col("found.rejected").alias("rejected"))


def op9_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity.score(docs, model).alias("score"))
            .withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int")))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rows = manifest.manifest(manifest.leaves_of(docs, changed=manifest.tampered(F.col("doc_id"))))
    return (rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root",
                        manifest.proof(F.col("path")).alias("proof_sha256"),
                        manifest.fold(F.col("shown"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op12_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = packing.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"), rebuild=True)


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_mix_sources, op2_url_lm_ratio, op3_kd_shards, op4_quality_mil, op5_suffix_repetition, op6_decontaminate,
    op7_warc_revisits, op8_language_centroids, op9_toxicity_bigru, op10_jaccard_join, op11_merkle_manifest,
    op12_bm25_packing, op13_prefix_trie)}


def _shipping(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict[str, Query]:
    return {**{name: _shipping(q) for name, q in QUERIES.items()}, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    pipeline = corpus_pipeline.ORACLE_SQL
    return {**sql.ORACLES, **({"pipeline": pipeline} if pipeline else {})}
