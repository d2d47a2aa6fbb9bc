"""Scans of review records landed as JSON: explicit schemas, never inferred, bad lines skipped or fatal as each file asks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "struct<kind:string,name:string,signature:string,body:string,full_text:string,file_path:string,start_line:int,end_line:int,line_count:int>"
SCHEMAS = {
    "metadata": "number long, title string, author string, state string, bors_status string, created_at timestamp, closed_at timestamp, additions long, deletions long, changed_files long, commit_count long, review_count long, "
    "comment_count long, review_thread_count long, labels array<string>, files array<struct<path:string,additions:long,deletions:long>>, head_ref string, head_sha string, base_ref string",
    "extraction": "number long, reviews array<struct<id:long,author:string,state:string,body:string,submitted_at:timestamp,is_bot:boolean>>, "
    "review_comments array<struct<id:long,author:string,path:string,position:long,original_position:long,body:string,created_at:timestamp,in_reply_to_id:long,review_id:long,diff_hunk:string,is_bot:boolean>>, "
    "issue_comments array<struct<id:long,author:string,body:string,created_at:timestamp,is_bot:boolean>>, commits array<struct<sha:string,message:string,author:string,date:timestamp>>, "
    "files_changed array<struct<path:string,additions:long,deletions:long>>, first_commit_sha string, last_commit_sha string",
    "parsing": f"pr_number long, pair_count long, pairs array<struct<pr_number:long,file_path:string,declaration_name:string,declaration_kind:string,initial_proof:{BLOCK},final_proof:{BLOCK},initial_line_count:int,final_line_count:int,line_count_delta:int,signature_changed:boolean>>",
    "summarization": "pr_number long, pair_results array<struct<declaration_name:string,file_path:string,verdict:string,verdict_reasoning:string,summary:string,categories:array<string>,key_changes:array<string>,reviewer_quotes:array<string>,"
    "has_explicit_review_feedback:boolean,confidence:double,model:string,input_tokens:long,output_tokens:long>>",
    "context": "pr_number long, base_sha string, first_sha string, last_sha string, initial_files array<struct<path:string,content:string>>, final_files array<struct<path:string,content:string>>, lean_file_count long, fetch_errors array<string>",
    "verdicts": "verdicts array<struct<task_id:string,key_difference:string,verdict:string,reasoning:string,confidence:string>>",
}


@dataclass(frozen=True)
class Landing:
    """Where the phases' files lie below one folder, and what the dataset is called. from_conf takes them from the
    session's settings spark.pairquarry.root, .host, .owner, .repository and .version."""

    root: str
    host: str = ""
    owner: str = ""
    repository: str = ""
    version: str = "0.1"

    @classmethod
    def from_conf(cls, spark: SparkSession) -> Landing:
        given = {name: spark.conf.get(f"spark.pairquarry.{name}", None) for name in ("root", "host", "owner", "repository", "version")}
        if not given["root"]:
            raise ValueError("spark.pairquarry.root must name the folder of the landed files")
        return cls(**{k: v for k, v in given.items() if v is not None})

    @property
    def pull_url(self) -> str:
        return f"{self.host}/{self.owner}/{self.repository}/pull/"

    def of(self, phase: str) -> str:
        return f"{self.root.rstrip('/')}/{phase}"


def schema_of(kind: str) -> T.StructType:
    return T._parse_datatype_string(SCHEMAS[kind])


def lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Records of a JSON-lines file; lines that don't fit the schema, and blank ones, are left out."""
    whole = schema_of(kind).add("_corrupt_record", "string")
    read = spark.read.schema(whole).option("mode", "PERMISSIVE").json(path)
    # Taken together with its own columns, so that the reader really parses them.
    return read.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def strict_lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(schema_of(kind)).option("mode", "FAILFAST").json(path)


def record_files(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """One JSON document per file pr_N.json, with the number in its name and the name, by which later files override earlier."""
    read = spark.read.schema(schema_of(kind).add("_corrupt_record", "string")).option("multiLine", True).json(f"{folder}/pr_*.json")
    name = F.col("_metadata.file_name")
    return read.select("*", name.alias("file_name"), F.regexp_extract(name, r"pr_(\d+)\.json", 1).cast("long").alias("file_pr")).where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def strict_record_files(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Like record_files, but a document that doesn't fit the schema is an error."""
    read = spark.read.schema(schema_of(kind)).option("multiLine", True).option("mode", "FAILFAST").json(f"{folder}/pr_*.json")
    return read.withColumn("file_name", F.col("_metadata.file_name"))


def by_number(records: DataFrame, numbers: DataFrame, key: str) -> DataFrame:
    """The records whose key is asked for; numbers without a record give nothing."""
    return records.join(numbers.select(key).distinct(), key, "left_semi")


def held_out(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The requests and the (declaration, file) pairs of a reference set, whose records are flat or hold declarations."""
    one = "declaration_name string, file_path string"
    rows = spark.read.schema(f"pr_number long, {one}, declarations array<struct<{one.replace(' string', ':string')}>>").json(path)
    each = rows.select("pr_number", F.explode(F.coalesce("declarations", F.array(F.struct("declaration_name", "file_path")))).alias("d"))
    return rows.select("pr_number").distinct(), each.select("d.*").where("file_path IS NOT NULL").distinct()


def last_verdicts(read: DataFrame, order: list[str]) -> DataFrame:
    """verdicts exploded; of several for a task the last by order and position counts."""
    each = read.select(*order, F.posexplode("verdicts").alias("place", "v")).select(*order, "place", "v.*")
    rest = [c for c in each.columns if c not in ("task_id", "place", *order)]
    return each.groupBy("task_id").agg(F.max_by(F.struct(*rest), F.struct(*order, "place")).alias("v")).select("task_id", "v.*")


def verdict_files(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    read = spark.read.schema(schema_of("verdicts")).option("multiLine", True).json(f"{folder}/{prefix}_verdicts_*.json")
    return last_verdicts(read.select("verdicts", F.col("_metadata.file_name").alias("file_name")), ["file_name"])


def journal_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """Verdicts out of an event journal: the results' lines only; lines that aren't JSON are skipped."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    event = F.from_json("value", f"type string, result struct<{SCHEMAS['verdicts'].replace('verdicts array', 'verdicts:array')}>")
    return last_verdicts(raw.withColumn("e", event).where("e.type = 'result'").select("file_name", "block", "line", F.coalesce("e.result.verdicts", F.array()).alias("verdicts")), ["file_name", "block", "line"])
