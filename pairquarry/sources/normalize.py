"""Raw answers of a code host as records: nested logins flattened, missing authors named, contents decoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairquarry.operators.reviews import decoded_content, is_bot, login_or_ghost

USER = "struct<login:string>"
RAW = {
    "review_comment": f"id long, user {USER}, path string, position long, original_position long, body string, created_at string, in_reply_to_id long, pull_request_review_id long, diff_hunk string",
    "issue_comment": f"id long, user {USER}, body string, created_at string",
    "review": f"id long, user {USER}, state string, body string, submitted_at string",
    "commit": f"sha string, author {USER}, commit struct<message:string,author:struct<name:string,date:string>>, parents array<struct<sha:string>>",
    "file": "filename string, additions long, deletions long",
    "content": "content string, encoding string",
}


def parsed(raw: DataFrame, record: str, kind: str) -> DataFrame:
    """raw with its JSON column parsed as `r`; records that don't parse are left out."""
    return raw.withColumn("r", F.from_json(record, RAW[kind])).where(F.col("r").isNotNull())


def _text(column: str) -> Column:
    return F.coalesce(column, F.lit(""))


def review_comments(raw: DataFrame, pr: str, record: str = "record") -> DataFrame:
    author = login_or_ghost(F.col("r.user.login"))
    return parsed(raw, record, "review_comment").select(
        pr, "r.id", author.alias("author"), _text("r.path").alias("path"), "r.position", "r.original_position", _text("r.body").alias("body"), F.to_timestamp("r.created_at").alias("created_at"),
        "r.in_reply_to_id", F.col("r.pull_request_review_id").alias("review_id"), _text("r.diff_hunk").alias("diff_hunk"), is_bot(author).alias("is_bot"),
    )


def issue_comments(raw: DataFrame, pr: str, record: str = "record") -> DataFrame:
    author = login_or_ghost(F.col("r.user.login"))
    return parsed(raw, record, "issue_comment").select(pr, "r.id", author.alias("author"), _text("r.body").alias("body"), F.to_timestamp("r.created_at").alias("created_at"), is_bot(author).alias("is_bot"))


def reviews(raw: DataFrame, pr: str, record: str = "record") -> DataFrame:
    author = login_or_ghost(F.col("r.user.login"))
    return parsed(raw, record, "review").select(pr, "r.id", author.alias("author"), "r.state", _text("r.body").alias("body"), F.to_timestamp("r.submitted_at").alias("submitted_at"), is_bot(author).alias("is_bot"))


def commits(raw: DataFrame, pr: str, record: str = "record") -> DataFrame:
    """The author is the login, else the name in the commit, else ghost."""
    return parsed(raw, record, "commit").select(
        pr, "r.sha", F.col("r.commit.message").alias("message"), login_or_ghost(F.col("r.author.login"), F.col("r.commit.author.name")).alias("author"),
        F.to_timestamp("r.commit.author.date").alias("date"), F.col("r.parents.sha").alias("parents"),
    )


def files(raw: DataFrame, pr: str, record: str = "record") -> DataFrame:
    return parsed(raw, record, "file").select(pr, F.col("r.filename").alias("path"), "r.additions", "r.deletions")


def contents(raw: DataFrame, *keys: str, record: str = "record") -> DataFrame:
    """Text of a file at a revision; null where it is missing, empty or not base64. Line breaks inside base64 are dropped."""
    plain = F.regexp_replace("r.content", r"\s", "")
    return parsed(raw, record, "content").select(*keys, decoded_content(plain, F.col("r.encoding")).alias("content"))
