"""Exact dedup by skew-safe combining.

Every task deduplicates its own rows (map-side partial aggregation), salted digest groups are merged, and the
winners of the salts are combined globally. The whole text is a grouping key at every stage, so equality of
content is always compared, never inferred from the digest. A text with any number of copies sends at most one
row per task into the first shuffle and one per salt into the second.

Results for odd input: null text counts as empty; a null id sorts lowest and wins only a group of null ids;
rows that repeat both id and text count as copies of one document, of which the one whose other columns come first
(as JSON) is kept; an empty table gives an empty result; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairquarry.llm.shared import materialize, text_of

SALTS = 32


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def merged_groups(base: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, text) groups of base(doc_id, text, digest): largest id and number of rows."""
    salted = (
        base.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "salt", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return salted.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per id and text: doc_id, keep_id, group_size, sha, and the number of input rows that have both."""
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("digest", digest(F.col("text")))
    groups = materialize(
        merged_groups(base, salts)
        .groupBy("digest")
        .agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("variants")),
        "exact-groups",
    )
    # Different texts under one digest don't occur with SHA-256; a weaker digest sends them down the second way, joined by text.
    plain = groups.where("variants = 1").drop("variants")
    collided = groups.where("variants > 1").select("digest")
    hashed = base if digest is sha256 else base.withColumn("sha", sha256(F.col("text")))
    sha = F.col("digest") if digest is sha256 else F.col("sha")
    rows = hashed.select("doc_id", "digest", sha.alias("sha")).groupBy("doc_id", "digest", "sha").agg(F.count(F.lit(1)).alias("copies"))
    found = rows.join(plain, "digest").select("doc_id", "keep_id", "group_size", "sha", "copies")
    if not collided.isEmpty():
        clash = hashed.join(collided, "digest", "left_semi")
        by_text = merged_groups(clash.select("doc_id", "text", "digest"), salts)
        copies = clash.select("doc_id", "digest", "text", sha.alias("sha")).groupBy("doc_id", "digest", "text", "sha").agg(F.count(F.lit(1)).alias("copies"))
        found = found.unionByName(copies.join(by_text, ["digest", "text"]).select("doc_id", "keep_id", "group_size", "sha", "copies"))
    return found


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept and text_sha256 of its text."""
    copy = exact_rows(docs, id_col, text_col, digest, salts).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return copy.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """docs with one row for each different text, that with the largest id; all columns stay."""
    winners = exact_rows(docs, id_col, text_col, salts=salts).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = materialize(winners.select(F.col("doc_id").alias("kept_id"), F.col("sha").alias("kept_sha"), (F.col("copies") > 1).alias("repeated")), "exact-kept")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), sha256(text_of(text_col)).alias("sha"))
    on = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha"))
    single = rows.join(kept.where("NOT repeated"), on, "left_semi").select("row.*")
    if kept.where("repeated").isEmpty():
        return single
    # Only rows that repeat id and text are grouped once more.
    again = rows.join(kept.where("repeated"), on, "left_semi").groupBy("id", "sha").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return single.unionByName(again.select("row.*"))


def op6_exact_dedup(spark, sf_dir):
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
