"""A resumable run of phases. A phase's rows and its ledger events are one commit, so a run that dies is taken up where it stopped.

Each phase has a folder of runs. A run is one Spark write of rows (pr, at, error, qualifies, payload); it counts once the
job has committed it. The ledger's events are these very rows: a row without an error says that its record has reached the phase,
one with an error counts against the record. So no event can be there without its rows, or rows without their event.
A run that was cut off leaves a folder that isn't committed, which is never read and is deleted by the next run of the phase.

One process runs the phases of a folder at a time; Spark does the work of each.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairquarry.operators import ledger

COMMITTED = "_SUCCESS"
EVENT = "pr long, ts timestamp, phase string, qualifies boolean, message string, source string, query string"


def committed_folders(spark: SparkSession, folder: str) -> tuple[list[str], list[str]]:
    """Names of a folder's subfolders, in order: those that a job has committed, and the others."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return [], []
    names = sorted(x.getPath().getName() for x in fs.listStatus(path) if x.isDirectory())
    done = {n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/{COMMITTED}"))}
    return [n for n in names if n in done], [n for n in names if n not in done]


def delete(spark: SparkSession, folder: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)


@dataclass(frozen=True)
class Phase:
    """name: one of the ledger's phases, or "discovered". work(store, waiting) gives rows for waiting records: pr, error (null if
    all went well) and what else the phase makes; a record that it gives no row for stays waiting."""

    name: str
    work: Callable[[PhaseStore, DataFrame], DataFrame]
    after: str | None = None
    qualified: bool = True


class PhaseStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def runs(self, phase: str) -> list[str]:
        return committed_folders(self.spark, f"{self.folder}/{phase}")[0]

    def rows(self, phase: str) -> DataFrame | None:
        """All rows of a phase's committed runs, or None if there are none yet."""
        paths = [f"{self.folder}/{phase}/{run}" for run in self.runs(phase)]
        return self.spark.read.parquet(*paths) if paths else None

    def made(self, phase: str) -> DataFrame:
        """The rows of a phase without an error, as its consumers read them."""
        rows = self.rows(phase)
        if rows is None:
            raise ValueError(f"no run of {phase} is committed")
        return rows.where("error IS NULL").drop("error", "at")

    def events(self) -> DataFrame:
        """The ledger's events, as ledger.status_table and folded_candidates take them."""
        parts = []
        for phase in ("discovered", *ledger.ALL_PHASES):
            rows = self.rows(phase)
            if rows is not None:
                name = F.when(F.col("error").isNotNull(), "error").otherwise(F.lit(None if phase == "discovered" else phase))
                given = lambda c, t, rows=rows: (F.col(c) if c in rows.columns else F.lit(None).cast(t)).alias(c)
                parts.append(rows.select("pr", F.col("at").alias("ts"), name.alias("phase"), given("qualifies", "boolean"), F.col("error").alias("message"), given("source", "string"), given("query", "string")))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], EVENT)

    def status(self) -> DataFrame:
        return ledger.status_table(self.events())

    def waiting(self, phase: Phase, limit: int | None = None) -> DataFrame:
        """The records that a phase has to do."""
        if phase.name == "discovered":
            return self.spark.createDataFrame([], "pr long")
        found = ledger.waiting(self.status(), phase.name, phase.after, qualified=phase.qualified, gated=phase.qualified)
        return (found if limit is None else found.orderBy("pr").limit(limit)).select("pr")

    def run(self, phase: Phase, limit: int | None = None, now: datetime | None = None) -> None:
        """One run of a phase over what waits for it, committed as a whole."""
        folder = f"{self.folder}/{phase.name}"
        done, cut_off = committed_folders(self.spark, folder)
        for name in cut_off:
            delete(self.spark, f"{folder}/{name}")
        rows = phase.work(self, self.waiting(phase, limit)).withColumn("at", F.lit(now or datetime.now(UTC)).cast("timestamp"))
        rows.write.parquet(f"{folder}/run-{len(done):06d}")

    def discovered(self, found: DataFrame) -> DataFrame:
        """found(pr, source, query) that the ledger doesn't know yet, as rows of the phase "discovered"."""
        known = self.rows("discovered")
        new = found if known is None else found.join(known.select("pr").distinct(), "pr", "left_anti")
        return new.withColumn("error", F.lit(None).cast("string"))


def run_phases(store: PhaseStore, phases: list[Phase], limit: int | None = None, now: datetime | None = None) -> list[str]:
    """Runs each phase in turn over what waits for it; those that nothing waits for are passed over. Returns the names of those run.

    Called again, it does what is left: records that failed (fewer than ledger.MAX_ERRORS times) and what was cut off."""
    ran = []
    for phase in phases:
        if phase.name == "discovered" or not store.waiting(phase).isEmpty():
            store.run(phase, limit, now)
            ran.append(phase.name)
    return ran
