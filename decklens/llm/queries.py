"""Thin queries of the corpus operators: {name: (Spark callable, DuckDB SQL or None)}."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decklens.llm import decontam, dedup, fingerprints, langid, merkle, packing, pii, quality, secrets, sharding, simhash, spelling, toxicity
from decklens.llm.common import crc32_text, read_table


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read_table(spark, sf_dir, "documents").select("doc_id", "text"), crc32_text(F.col("doc_id")) % 3 == 1
    model = quality.fit(docs, read_table(spark, sf_dir, "labels").filter(~held))
    return _decided(quality.score(docs, model), held)


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read_table(spark, sf_dir, "documents"), crc32_text(F.col("doc_id")) % 4 == 2
    model = langid.fit(docs.filter(~held))
    return langid.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as long)").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(F.expr(pii.written("base")), 256).alias("base_sha256"), F.expr(pii.written("spans")).alias("spans"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def op1_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("hash")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edits(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read_table(spark, sf_dir, "documents").select("doc_id", "text"), crc32_text(F.col("doc_id")) % 5 == 0
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels").filter(~held))
    return _decided(toxicity.score(docs, model), held)


def _decided(scored: DataFrame, held) -> DataFrame:
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc32_text(F.col("doc_id")) % 5 == 0
    found = secrets.scan(read_table(spark, sf_dir, "documents"), train=~held)
    return found.select("doc_id", "start", "stop", F.sha2("value", 256).alias("value_sha256"), "label", held.alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("is_secret"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(read_table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = spelling.variants(spelling.word_counts(docs, deleted=199), min_count=5, min_length=6, ratio=5)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicates(read_table(spark, sf_dir, "documents"), longest=True)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.when(crc32_text(F.col("doc_id")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": tampered})
    return (found.withColumn("folded_root", merkle.folded(F.col("changed_leaf"), F.col("path")))
            .select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))


REGISTRY = {
    "op1_decontam": (op1_decontam, decontam.ORACLE),
    "op2_fingerprints": (op2_fingerprints, None),
    "op3_toxicity": (op3_toxicity, None),
    "op4_packing": (op4_packing, None),
    "op5_quality": (op5_quality, None),
    "op6_langid": (op6_langid, None),
    "op7_pii": (op7_pii, None),
    "op8_simhash": (op8_simhash, None),
    "op9_secrets": (op9_secrets, None),
    "op10_sharding": (op10_sharding, None),
    "op11_spelling": (op11_spelling, spelling.ORACLE),
    "op12_dedup": (op12_dedup, dedup.ORACLE),
    "op13_merkle": (op13_merkle, merkle.ORACLE),
}
