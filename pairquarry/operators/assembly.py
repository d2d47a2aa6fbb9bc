"""Flat dataset rows out of labels, pairs, metadata, comments and contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairquarry.functions import text
from pairquarry.operators.mining import first_wins, null_safe_join
from pairquarry.operators.reviews import days_between, plain_title

UNNAMED = "(unnamed)"


def pending_metadata(pending: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pending records with their metadata, and error rows for those without."""
    errors = pending.join(metadata.select("pr"), "pr", "left_anti").select("pr", F.lit("no metadata").alias("error"))
    return pending.join(metadata, "pr"), errors


def people(comments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per record: who reviewed (inline comments and reviews, no bots), in order, and remarks by people that aren't blank."""
    inline = comments.where("NOT is_bot").select("pr", "author", F.lit(1).alias("n"))
    formal = reviews.where("NOT is_bot").select("pr", "author", (F.length(text.strip(F.col("body"))) > 0).cast("int").alias("n"))
    return inline.unionByName(formal).groupBy("pr").agg(F.array_sort(F.collect_set("author")).alias("reviewers"), F.sum("n").cast("long").alias("n_remarks"))


def dataset_rows(labels: DataFrame, pairs: DataFrame, metadata: DataFrame, remarks: DataFrame, contexts: DataFrame, url: str, extracted_on: Column | None = None) -> DataFrame:
    """High-value labels with their pair and metadata, remarks and context where there are any.

    labels, pairs: pr, declaration, file_path (null names match); labels also verdict, summary, categories, position.
    The first label of a (pr, declaration) counts, whatever its file.
    """
    high = labels.where("verdict = 'HIGH_VALUE'")
    joined = null_safe_join(high, pairs, ["pr", "declaration", "file_path"], "inner").join(metadata, "pr").join(remarks, "pr", "left").join(contexts, "pr", "left")
    none = F.array().cast("array<string>")
    flat = joined.select(
        F.concat(F.lit(url), F.col("pr").cast("string")).alias("pr_url"), "pr", plain_title(F.col("title")).alias("pr_title"), F.coalesce("declaration", F.lit(UNNAMED)).alias("declaration_name"), "file_path", "position",
        "initial", "final", text.line_count(F.col("initial")).alias("initial_lines"), text.line_count(F.col("final")).alias("final_lines"), (F.col("initial_signature") != F.col("final_signature")).alias("signature_changed"),
        F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("categories", none).alias("categories"), F.coalesce("reviewers", none).alias("reviewers"), F.coalesce("n_remarks", F.lit(0)).alias("n_remarks"),
        F.coalesce("base_sha", F.lit("")).alias("base_sha"), F.date_format("created_at", "yyyy-MM-dd").alias("created"), F.round(days_between(F.col("created_at"), F.col("closed_at")), 2).alias("review_days"), (extracted_on if extracted_on is not None else F.current_date()).alias("extraction_date"),
    )
    return first_wins(flat, ["pr", "declaration_name"], ["position", "file_path"]).withColumn("line_delta", F.col("final_lines") - F.col("initial_lines"))


def evaluation_row(length_ratio: Column, similarity: Column) -> list[Column]:
    """The derived numbers of an evaluation row, rounded to four places."""
    return [F.round(length_ratio, 4).alias("length_ratio"), F.round(similarity, 4).alias("code_similarity"), F.lit(False).alias("signature_changed")]


def prompt(row_title: Column, declaration: Column, initial: Column, final: Column, context: Column) -> Column:
    """What a judge is shown of a pair, section by section."""
    part = lambda head, body: F.concat(F.lit(f"## {head}\n"), body)
    return F.concat_ws("\n\n", part("Request", row_title), part("Declaration", F.coalesce(declaration, F.lit(UNNAMED))), part("Before", initial), part("After", final), part("Remarks", context))
