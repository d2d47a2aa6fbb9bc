"""The ledger's status kept up by batches of events: a state per record that merges, instead of a fold over all events again.

The state lies in buckets of records. A batch's events are summed to one row per record, merged with the rows of the buckets
that they fall into, and only these buckets are written, as one commit with the batch's number. Each bucket's newest
committed batch is its state. So a batch reads its own events and the buckets it touches, nothing else, and a batch
that is applied again, as a stream does after a failure, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairquarry.operators import ledger
from pairquarry.operators.phases import committed_folders, delete

BUCKETS = 64
ENTRY = "struct<ts:timestamp,source:string,query:string>"


def later(a: Column, b: Column) -> Column:
    """The greater of two values that may be null; structs compare by their first fields."""
    return F.when(a.isNull() | (b > a), b).otherwise(a)


def entries_since(entries: Column, fresh: Column) -> Column:
    """The queries that count: those not before the last find without a query."""
    at = lambda e: F.struct(e["ts"], e["source"])
    return F.array_sort(F.filter(entries, lambda e: fresh.isNull() | (at(e) >= fresh)))


def summed(events: DataFrame) -> DataFrame:
    """events(pr, ts, phase, qualifies, message, source, query) as one mergeable row per record."""
    when = lambda p, value: F.when(F.col("phase") == p, value)
    is_find = F.col("source").isNotNull()
    find = F.when(is_find, F.struct("ts", "source"))
    entry = F.struct("ts", "source", "query")
    raw = events.groupBy("pr").agg(
        *[F.max(when(p, F.col("ts"))).alias(f"{p}_at") for p in ledger.ALL_PHASES],
        F.max(when("enriched", F.struct("ts", "qualifies"))).alias("judged"),
        F.count_if(F.col("phase") == "error").alias("error_count"),
        F.max(when("error", F.struct("ts", F.substring("message", 1, ledger.MAX_MESSAGE).alias("message")))).alias("failed"),
        F.coalesce(F.max(F.col("source") == "manual"), F.lit(False)).alias("manual"),
        F.max(find).alias("last_find"),
        F.max(F.when(F.col("query").isNull(), find)).alias("fresh"),
        F.collect_list(F.when(is_find & F.col("query").isNotNull(), entry)).alias("entries"),
    )
    return raw.withColumn("entries", entries_since(F.col("entries"), F.col("fresh")))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two tables of summed() rows as one."""
    both = old.select("pr", F.struct(*[c for c in old.columns if c != "pr"]).alias("a")).join(new.select("pr", F.struct(*[c for c in new.columns if c != "pr"]).alias("b")), "pr", "full_outer")
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    none = F.array().cast(f"array<{ENTRY}>")
    fresh = later(a("fresh"), b("fresh"))
    return both.select(
        "pr",
        *[F.greatest(a(f"{p}_at"), b(f"{p}_at")).alias(f"{p}_at") for p in ledger.ALL_PHASES],
        later(a("judged"), b("judged")).alias("judged"),
        (F.coalesce(a("error_count"), F.lit(0)) + F.coalesce(b("error_count"), F.lit(0))).alias("error_count"),
        later(a("failed"), b("failed")).alias("failed"),
        (F.coalesce(a("manual"), F.lit(False)) | F.coalesce(b("manual"), F.lit(False))).alias("manual"),
        later(a("last_find"), b("last_find")).alias("last_find"),
        fresh.alias("fresh"),
        entries_since(F.concat(F.coalesce(a("entries"), none), F.coalesce(b("entries"), none)), fresh).alias("entries"),
    )


def status(state: DataFrame) -> DataFrame:
    """What ledger.status_table joined with ledger.folded_candidates gives of all events at once."""
    # If no entry is left, the last find had no query.
    return state.select(
        "pr", *[f"{p}_at" for p in ledger.ALL_PHASES], F.coalesce("judged.qualifies", F.lit(False)).alias("qualifies"), "error_count", F.col("failed.message").alias("last_error"),
        F.when(F.col("manual"), "manual").otherwise(F.col("last_find.source")).alias("source"), F.when(F.size("entries") > 0, F.array_join("entries.query", ",")).alias("source_query"),
    )


class LedgerState:
    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def newest(self) -> dict[int, str]:
        """For each bucket that has rows, the folder of its newest committed batch."""
        out: dict[int, str] = {}
        for batch in committed_folders(self.spark, self.folder)[0]:
            below = committed_folders(self.spark, f"{self.folder}/{batch}")[1]
            out |= {int(b.removeprefix("bucket=")): f"{self.folder}/{batch}/{b}" for b in below if b.startswith("bucket=")}
        return out

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        paths = [p for b, p in self.newest().items() if buckets is None or b in buckets]
        return self.spark.read.parquet(*paths) if paths else None

    def apply(self, events: DataFrame, batch: int) -> None:
        """Take in a batch of events; one whose number is committed already is passed over."""
        name = f"batch-{batch:09d}"
        done, cut_off = committed_folders(self.spark, self.folder)
        if done and name <= done[-1]:
            return
        in_use = {path.rsplit("/", 2)[1] for path in self.newest().values()}
        # What was cut off, and batches whose buckets have all been written anew since.
        for other in [*cut_off, *(d for d in done[:-1] if d not in in_use)]:
            delete(self.spark, f"{self.folder}/{other}")
        new = summed(events)
        bucket = F.pmod(F.xxhash64("pr"), F.lit(self.buckets)).cast("int")
        touched = [r["b"] for r in events.select(bucket.alias("b")).distinct().collect()]  # as many numbers as buckets at most
        old = self.read(touched)
        state = new if old is None else merged(old, new)
        state.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.folder}/{name}")

    def status(self) -> DataFrame | None:
        state = self.read()
        return None if state is None else status(state)
