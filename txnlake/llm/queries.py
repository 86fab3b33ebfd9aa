"""The driver's queries over the operators of this subpackage: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm import centroids, decontaminate, line_dedup, maxscore, multi_index, packing, pii, ppm_langid, prefix_trie, sharding, simhash_trie, toxicity_mil, warc
from txnlake.llm.oracle import ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    every = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(every).alias("spans"), F.size("added").alias("n_added"))


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def op2_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "distance", "start", "end")


def op3_ppm_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False))
    model = ppm_langid.train(docs.where(~held_out))
    found = ppm_langid.predict(docs, model, keep=(held_out.alias("held_out"),))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.report(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("kept").cast("long").alias("n_kept"), F.array_join(F.col("kept").cast("array<string>"), ",").alias("kept_lines"))


def op5_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    model = toxicity_mil.train(docs, _table(spark, sf_dir, "labels").where(~held_out))
    found = toxicity_mil.predict(docs, model, keep=(held_out.alias("held_out"),))
    return found.select("doc_id", "held_out", "score", "predicted", F.to_json("sentences").alias("sentences"))


def op6_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_trie.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op10_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = maxscore.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_trie.shared_heads_trie(_table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = multi_index.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op13_float32_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.report(_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_cgk_decontamination": op2_cgk_decontamination,
    "op3_ppm_langid": op3_ppm_langid,
    "op4_line_dedup": op4_line_dedup,
    "op5_toxicity_mil": op5_toxicity_mil,
    "op6_warc_dictionary": op6_warc_dictionary,
    "op7_nnls_packing": op7_nnls_packing,
    "op8_label_propagation": op8_label_propagation,
    "op9_simhash_trie": op9_simhash_trie,
    "op10_maxscore": op10_maxscore,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_multi_index": op12_multi_index,
    "op13_float32_centroids": op13_float32_centroids,
}
