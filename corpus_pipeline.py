"""A corpus pipeline of four stages: quality rules, exact dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return documents as they came, without those they reject. Each
works on all that the stage before kept, and its result is written before the next one reads it.

Near-dedup is the SimHash operator at a similarity: it links documents whose sets of 5-word shingles have a Jaccard similarity of at least
0.8, each link verified; of each component the document with the smallest id stays. (The 3 bits of 64 are for the operator's own query.) Exact dedup
keeps the largest id of equal texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyweft.llm import exact_dedup, packing, quality_rules, simhash_similar
from skyweft.llm.shared import fresh_path, scratch
from skyweft.llm.tokenizing import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.survivors(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_similar.survivors(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_digests(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("simhash_near_dedup", near), ("best_fit_packing", pack)]
#: Shingle sets and packing can't be put in SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
