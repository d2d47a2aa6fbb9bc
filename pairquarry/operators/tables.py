"""Tables between the steps of iterative operators, in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: Paths of this process's tables, in order.
WRITTEN: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder of spark.checkpoint.dir; drop_written() deletes it like a table."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        folder = spark.sparkContext.getCheckpointDir()
    WRITTEN.append(f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return WRITTEN[-1]


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to the folder of spark.checkpoint.dir and read back: lineage ends here and outlives executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the tables that written() made since the `since`-th, but for the last `keep`: for callers whose result is
    stored elsewhere, as DataFrames that read these tables are of no use afterwards."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in WRITTEN[since : len(WRITTEN) - keep]:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    del WRITTEN[since : len(WRITTEN) - keep]


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at path, built and written there if there is none yet. What is there is never built again."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    build().write.parquet(path)
    return spark.read.parquet(path)
