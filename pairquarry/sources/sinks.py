"""Sinks. Spark's job commit makes appends and overwrites whole or absent."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def replace_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """Overwrite; with partition columns, only the partitions that df has rows of."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def new_rows(df: DataFrame, known: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """Rows whose key isn't known yet, of each key the first by order (by all other columns, if none is given)."""
    from pairquarry.operators.mining import first_wins

    fresh = df.join(known.select(*keys).distinct(), keys, "left_anti")
    return first_wins(fresh, keys, order or [c for c in df.columns if c not in keys]).select(*df.columns)


def dataset_info(df: DataFrame, name: str, version: str, now: datetime | None = None, known: DataFrame | None = None, keys: list[str] | None = None) -> str:
    """The sidecar of a dataset: its name, version, number of rows and time. With known, the table of earlier runs, all
    different keys of both count."""
    total = df.count() if known is None else df.select(*keys).union(known.select(*keys)).distinct().count()
    return json.dumps({"name": name, "version": version, "total_rows": total, "generated_at": (now or datetime.now(UTC)).isoformat()})


def tally_report(tally: DataFrame, label: str, count: str, limit: int = 50) -> str:
    """A short table of counts, most frequent first."""
    rows = tally.orderBy(F.desc(count), label).limit(limit).collect()
    return "\n".join(f"{r[count]:>8}  {r[label]}" for r in rows)


def status_report(counts: DataFrame) -> str:
    """The one row of phase_counts() as a table."""
    row = counts.first().asDict()
    return "\n".join(f"{name:<20}{n:>8}" for name, n in row.items())


def verify_report(verdicts: DataFrame, tasks: DataFrame, preview: int = 12) -> tuple[str, int]:
    """How many tasks have a verdict and which have none, and the exit status: 1 if any is missing."""
    from pairquarry.operators.evaluation import missing_verdicts

    missing = missing_verdicts(verdicts, tasks)
    n, total = missing.count(), tasks.count()
    some = [r["task_id"] for r in missing.select("task_id").orderBy("task_id").limit(preview).collect()]
    lines = [f"verdicts: {total - n} of {total}", *([f"missing: {', '.join(some)}" + (f" and {n - len(some)} more" if n > len(some) else "")] if n else [])]
    return "\n".join(lines), int(n > 0)


def blind_files(tasks: DataFrame, dealt: DataFrame, folder: str) -> dict:
    """What readers get (tasks and batches) and, apart from it, the key: three tables in one commit, whose record is returned."""
    from pairquarry.operators.evaluation import reader_view
    from pairquarry.sources import bundle

    key = tasks.select("task_id", "pr", "declaration", "stratum", "rep", "accepted_is_a")
    batches = dealt.groupBy("batch").agg(F.sort_array(F.collect_list("task_id")).alias("task_ids"))
    return bundle.write({"tasks": reader_view(tasks), "key": key, "batches": batches}, folder, "blind", mode="overwrite")


def calibration(anchors: DataFrame, limit: int = 20) -> str:
    """Known cases as Markdown: anchors(declaration, initial, final, expected)."""
    rows = anchors.orderBy("declaration").limit(limit).collect()
    return "\n\n".join(f"### {r['declaration']}\n\nExpected: {r['expected']}\n\nBefore:\n\n    {r['initial']}\n\nAfter:\n\n    {r['final']}" for r in rows)
