"""Outside judges as injected functions: labels of pairs and verdicts on tasks. Failures become rows, never stop a run."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairquarry.functions.scan import json_object, lenient_json
from pairquarry.operators.reviews import coerced_categories, coerced_verdict
from pairquarry.operators.tables import written

LABEL = "verdict string, verdict_reasoning string, summary string, categories array<string>, key_changes array<string>, reviewer_quotes array<string>, has_explicit_review_feedback boolean, confidence double"

VERDICTS = "verdicts array<struct<task_id:string,verdict:string,reasoning:string,confidence:string>>"


def asked(prompts: DataFrame, key: str, prompt: str, ask: Callable[[str], str], tasks: int | None = None) -> DataFrame:
    """key, answer and error of each prompt. tasks bounds how many ask at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers, errors = [], []
            for p in frame[prompt]:
                try:
                    answers.append(ask(p))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  one prompt's failure is that row's
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:1000])
            yield pd.DataFrame({key: frame[key], "answer": answers, "error": errors})

    rows = prompts.select(key, prompt)
    return (rows.repartition(tasks) if tasks else rows).mapInPandas(run, f"{key} {prompts.schema[key].dataType.simpleString()}, answer string, error string")


def adjudicated(batches: DataFrame, ask: Callable[[str], str], tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The verdicts (batch, task_id, verdict, reasoning, confidence) that a judge gives on batches(batch, prompt), and the
    batches that failed with why: an error, or an answer without a list of verdicts that are A, B or comparable.

    Answers are written once, as asking again could give others.
    """
    answers = written(asked(batches, "batch", "prompt", ask, tasks), "answers")
    parsed = answers.select("batch", "error", F.from_json(lenient_json("answer"), VERDICTS).alias("v")).select("batch", "error", F.col("v.verdicts").alias("v"))
    fits = lambda v: v["task_id"].isNotNull() & F.coalesce(v["verdict"].isin("A", "B", "comparable"), F.lit(False))
    marked = written(parsed.withColumn("ok", F.col("error").isNull() & F.coalesce((F.size("v") > 0) & F.forall("v", fits), F.lit(False))), "adjudicated")
    failed = marked.where("NOT ok").select("batch", F.coalesce("error", F.lit("no valid verdicts")).alias("error"))
    return marked.where("ok").select("batch", F.inline("v")), failed


def labels(answers: DataFrame, key: str) -> DataFrame:
    """Typed labels out of answers; unknown verdicts count as LOW_VALUE, unknown categories as other, missing confidence as 0.5."""

    @F.pandas_udf("string")
    def found(values: pd.Series) -> pd.Series:
        def tidy(v):
            value = json.loads(json_object(v or "") or "{}")
            value = value if isinstance(value, dict) else {}
            value["has_explicit_review_feedback"] = bool(value.get("has_explicit_review_feedback", False))
            return json.dumps(value)

        return values.map(tidy)

    parsed = answers.where("error IS NULL").select(key, F.from_json(found("answer"), LABEL).alias("l")).select(key, "l.*")
    none = F.array().cast("array<string>")
    return parsed.select(
        key, coerced_verdict(F.coalesce("verdict", F.lit(""))).alias("verdict"), F.coalesce("summary", F.lit("")).alias("summary"), coerced_categories(F.coalesce("categories", none)).alias("categories"),
        F.coalesce("key_changes", none).alias("key_changes"), F.coalesce("reviewer_quotes", none).alias("reviewer_quotes"), F.col("has_explicit_review_feedback"), F.coalesce("confidence", F.lit(0.5)).alias("confidence"),
    )
