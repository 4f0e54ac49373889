"""From documents to packed training rows, in five stages.

Each stage takes what its predecessor kept: poor documents go, one document of each
near-duplicate group stays, documents that hold a benchmark item go, sources are
repeated or thinned to their target weights, and the rest becomes rows of token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.columns import set_aside
from tallyhouse.llm.decontamination import decontaminated
from tallyhouse.llm.jaccard_join import one_per_group
from tallyhouse.llm.mixing import ADDED, mix_sources
from tallyhouse.llm.packing import pack_tokens
from tallyhouse.llm.quality_rules import RULE_COLUMNS, quality_rules, rejected_ids, trusted_ids
from tallyhouse.sources.scratch import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, back = set_aside(docs, RULE_COLUMNS)
    judged = quality_rules(docs, trusted_ids(spark, sf_dir), distinct_texts=True, rejected=rejected_ids(spark, sf_dir))
    return judged.where("kept").select(*back)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more."""
    return one_per_group(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def repeat_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, back = set_aside(docs, [*ADDED, "_copy"])
    mixed = mix_sources(docs).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*back)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_tokens(docs)


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_copy),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", repeat_sources),
    ("token-ID / binary output", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialize(docs)
    return docs


#: Hashes, tokens and links have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
