"""The phase ledger as a fold over events: candidates, phases, errors, queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairquarry.functions.text import occurrences

# Phases in their order, the number of errors from which a record is left alone, and the longest message kept.
PHASES = ("enriched", "extracted", "parsed", "summarized", "assembled")
ALL_PHASES = (*PHASES, "contexts_extracted")
MAX_ERRORS, MAX_MESSAGE = 3, 1000
# What each queue waits for, and what it needs to be done before.
QUEUES = {"enrich": ("enriched", None), "extract": ("extracted", None), "parse": ("parsed", "extracted"), "summarize": ("summarized", "parsed"), "assemble": ("assembled", "summarized"), "contexts": ("contexts_extracted", "assembled")}


def folded_candidates(events: DataFrame) -> DataFrame:
    """events(pr, ts, source, query) as pr, source, source_query.

    A manual source stays, otherwise the last one holds. Queries are joined by commas in order, but a null on either
    side starts afresh, so only the queries after the last null count. Bounded by one record's own events.
    """
    rows = F.array_sort(F.collect_list(F.struct("ts", "source", "query")))
    gathered = events.groupBy("pr").agg(rows.alias("e"))
    last = F.element_at(F.col("e"), -1)
    nulls = F.filter(F.transform("e", lambda x, i: F.when(x["query"].isNull(), i + 1)), lambda i: i.isNotNull())
    suffix = F.slice(F.col("e.query"), F.coalesce(F.array_max(nulls), F.lit(0)) + 1, F.size("e"))
    return gathered.select(
        "pr",
        F.when(F.exists("e", lambda x: x["source"] == "manual"), "manual").otherwise(last["source"]).alias("source"),
        F.when(last["query"].isNotNull(), F.array_join(suffix, ",")).alias("source_query"),
    )


def phase_table(events: DataFrame) -> DataFrame:
    """events(pr, ts, phase) as pr and the last time of each phase; phases that aren't known raise nothing but are left out."""
    return events.where(F.col("phase").isin(*PHASES)).groupBy("pr").pivot("phase", [*PHASES]).agg(F.max("ts"))


def funnel(events: DataFrame) -> DataFrame:
    """Records discovered and records that reached each phase. An empty ledger gives zeros, where a plain SUM would give null."""
    per_pr = events.groupBy("pr").agg(*[F.max((F.col("phase") == p).cast("int")).alias(p) for p in PHASES], F.count_if(F.col("phase") == "error").alias("errors"))
    return per_pr.agg(F.count(F.lit(1)).alias("discovered"), *[F.count_if(F.col(p) == 1).alias(p) for p in PHASES], F.count_if(F.col("errors") > 0).alias("with_errors"))


def pending(events: DataFrame, phase: str, after: str | None = None) -> DataFrame:
    """Records without the phase (but with the one it needs), left alone after MAX_ERRORS errors."""
    sums = events.groupBy("pr").agg(F.max((F.col("phase") == phase).cast("int")).alias("done"), F.max((F.col("phase") == (after or phase)).cast("int")).alias("ready"), F.count_if(F.col("phase") == "error").alias("error_count"))
    return sums.where((F.col("done") == 0) & (F.col("error_count") < MAX_ERRORS) & ((F.col("ready") == 1) if after else F.lit(True))).select("pr", "error_count")


def checked_events(events: DataFrame) -> DataFrame:
    """events, unless a phase isn't known; then it raises. A null phase is a discovery."""
    odd = events.where(F.col("phase").isNotNull() & ~F.col("phase").isin(*ALL_PHASES, "error")).select("phase").first()
    if odd:
        raise ValueError(f"unknown phase: {odd['phase']}")
    return events


def status_table(events: DataFrame) -> DataFrame:
    """events(pr, ts, phase, qualifies, message) as one row per record: the last time of each phase, whether it qualifies
    (what the last enrichment said), its errors and the last one's message, cut at MAX_MESSAGE."""
    when = lambda p, value: F.when(F.col("phase") == p, value)
    return events.groupBy("pr").agg(
        *[F.max(when(p, F.col("ts"))).alias(f"{p}_at") for p in ALL_PHASES],
        F.coalesce(F.max_by(when("enriched", F.col("qualifies")), when("enriched", F.col("ts"))), F.lit(False)).alias("qualifies"),
        F.count_if(F.col("phase") == "error").alias("error_count"),
        F.max_by(F.substring("message", 1, MAX_MESSAGE), when("error", F.col("ts"))).alias("last_error"),
    )


def phase_counts(status: DataFrame) -> DataFrame:
    """Records discovered, qualified, failed, and those that reached each phase; zeros for an empty ledger."""
    reached = [F.count(f"{p}_at").alias(p) for p in ALL_PHASES]
    return status.agg(F.count(F.lit(1)).alias("discovered"), *reached, F.count_if("qualifies").alias("qualified"), F.count_if(F.col("error_count") >= MAX_ERRORS).alias("failed"))


def waiting(status: DataFrame, phase: str, after: str | None = None, qualified: bool = True, gated: bool = True) -> DataFrame:
    """Records without the phase: those that qualify, have the one it needs and fewer than MAX_ERRORS errors."""
    return status.where(_waits(phase, after, qualified, gated))


def _waits(phase: str, after: str | None, qualified: bool, gated: bool) -> Column:
    keep = F.col(f"{phase}_at").isNull()
    if qualified:
        keep = keep & F.col("qualifies")
    if after:
        keep = keep & F.col(f"{after}_at").isNotNull()
    if gated:
        keep = keep & (F.col("error_count") < MAX_ERRORS)
    return keep


def queue(status: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """The records that wait in a queue, in its order: by number, but extraction by priority (see by_priority)."""
    phase, after = QUEUES[name]
    found = waiting(status, phase, after, qualified=name != "enrich", gated=name != "enrich")
    ordered = by_priority(found) if name == "extract" else found.orderBy("pr")
    return ordered if limit is None else ordered.limit(limit)


def queue_heads(status: DataFrame, limit: int) -> DataFrame:
    """(queue, pr, place) of the first records of every queue, in one pass over the status: a record names the queues it waits in."""
    names = [F.when(_waits(phase, after, name != "enrich", name != "enrich"), F.lit(name)) for name, (phase, after) in QUEUES.items()]
    each = status.select("pr", "source", "source_query", F.explode(F.array_compact(F.array(*names))).alias("queue"))
    first = F.col("queue") == "extract"
    order = [F.when(first, _tier()), F.when(first, -keyword_hits(F.col("source_query"))), F.when(first, -F.col("pr")).otherwise(F.col("pr"))]
    # Tasks keep the first `limit` of each queue before they are dealt out.
    place = F.row_number().over(Window.partitionBy("queue").orderBy(*order))
    return each.withColumn("place", place).where(F.col("place") <= limit).select("queue", "pr", "place")


def scan_cursors(updates: DataFrame) -> DataFrame:
    """updates(scan_id, at, end_cursor, fetched, total) as each scan's last state; a total once known stays."""
    return updates.groupBy("scan_id").agg(
        F.max_by("end_cursor", "at").alias("end_cursor"), F.max_by("fetched", "at").alias("fetched"), F.max_by("total", F.when(F.col("total").isNotNull(), F.col("at"))).alias("total")
    )


def search_cursors(updates: DataFrame, queries: DataFrame) -> DataFrame:
    """queries(query_key) with the last page that was read: 0 if none was, -1 once the search is completed.

    updates: query_key, at, last_page, total_count, completed.
    """
    last = updates.groupBy("query_key").agg(F.max_by(F.struct("last_page", "completed"), "at").alias("u"))
    page = F.when(F.col("u.completed"), -1).otherwise(F.col("u.last_page"))
    return queries.join(last, "query_key", "left").select("query_key", F.coalesce(page, F.lit(0)).cast("long").alias("page"))


def widened(df: DataFrame, **columns: str) -> DataFrame:
    """df with the columns that it lacks, as nulls of the given types: rows of an older layout."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def keyword_hits(source_query: Column) -> Column:
    return F.coalesce(occurrences(source_query, ","), F.lit(0))


def _tier() -> Column:
    return F.when(F.col("source") == "keyword_search", 0).otherwise(1)


def by_priority(ledger: DataFrame) -> DataFrame:
    """Keyword finds first, those of many queries before others, then the newest."""
    return ledger.withColumn("tier", _tier()).withColumn("hits", keyword_hits(F.col("source_query"))).orderBy("tier", F.desc("hits"), F.desc("pr"))
