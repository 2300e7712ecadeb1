"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

language         rows whose text is null or has no letter go (decklens.llm.langid)
near_duplicates  one document of each SimHash component stays (decklens.llm.simhash)
decontamination  documents that contain a benchmark item go (decklens.llm.decontam)
personal_data    personal data in the texts is replaced by its kind (decklens.llm.pii)
packing          what is left is packed into sequences of 2048 tokens (decklens.llm.packing)

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from decklens.llm import decontam, langid, packing, pii, simhash
from decklens.llm.common import Scratch, read_table
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.known_language(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", pack)]

#: The stages are hashes, learned profiles and token ids, which SQL does not express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, before = read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        out = scratch.table(stage(spark, docs, sf_dir))
        scratch.drop(before)
        docs = before = out
    return STAGES[-1][1](spark, docs, sf_dir)
