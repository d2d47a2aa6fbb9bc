"""The corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing to target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller writes it as Parquet and rereads it as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairquarry.llm import bpe, exact_dedup, mixing, simhash, toxicity
from pairquarry.llm.shared import materialize
from pairquarry.operators import tables


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold, learned from the labels outside of the held-out quarter."""
    model = toxicity.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each different text, that with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more), that with the smallest id."""
    return simhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of each row. All ids are decoded again; ids that don't give the text stop the run."""
    path = bpe.default_path()
    return bpe.encode_documents(docs, path, verify=True).select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [("toxicity", reject_toxic), ("exact dedup", drop_exact), ("simhash near-dedup", drop_near), ("mix sources", mix), ("bpe encode", encode)]

#: Scores and fingerprints are beyond SQL; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = len(tables.WRITTEN)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        # What the stage wrote on its way, and its input, are no longer needed.
        tables.drop_written(spark, first, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
