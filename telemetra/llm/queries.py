"""Registered queries of the corpus operators: each applies its operator to a whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.llm import (bitplanes, decontaminate, hmm, language, line_dedup, merkle, packing, quality_pu, secrets,
                           simhash, syncmer, topk, toxicity)
from telemetra.llm.common import is_remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_report(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op4_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = is_remainder("doc_id", 3, 1)
    trusted = labels.filter(~held & (F.col("quality") == 1))
    model = quality_pu.train(docs.filter(~held), trusted)
    return docs.select("doc_id", held.alias("held_out"), quality_pu.scored(spark, model, F.col("text")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_toxicity_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = is_remainder("doc_id", 5, 0)
    model = toxicity.train(docs, labels.filter(~held))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return toxicity.scored(model, rows).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = is_remainder("doc_id", 4, 2)
    model = language.train(docs.filter(~held))
    return docs.select("doc_id", held.alias("held_out"), language.identify(spark, model, F.col("text")).alias("r")) \
        .select("doc_id", "held_out", "r.lang_pred", "r.score")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op9_syncmer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmer.fingerprint_report(table(spark, sf_dir, "documents"))


def op10_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("train", ~is_remainder("doc_id", 10, 0))
    return hmm.score(docs, "train").withColumn("held_out", ~F.col("train")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_nra_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % topk.QUERY_MODULUS == 0, F.lit(False)))


def op12_bitplane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.cluster_report(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_line_dedup, op2_secret_scan, op3_decontaminate, op4_quality_pu, op5_hilbert_packing,
        op6_toxicity_gbt, op7_language_id, op8_simhash, op9_syncmer, op10_hmm_lm,
        op11_nra_topk, op12_bitplane_clusters, op13_merkle_manifest)}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.SQL, "op2_secret_scan": secrets.sql(), "op3_decontaminate": decontaminate.sql(),
            "op11_nra_topk": topk.SQL, "op12_bitplane_clusters": bitplanes.sql(), "op13_merkle_manifest": merkle.SQL}
