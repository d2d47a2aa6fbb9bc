"""Several tables and their sidecar in one commit.

A bundle is a folder with a subfolder of JSON lines for each table and a record for each commit below `_commits`. Tasks
write files below `_staged`; the commit moves them to their tables' folders and then puts its record, which lists all
files that count, in its place by one rename. read() goes by the newest record, so that it sees all tables of a write or
none. What an aborted or killed write has left is removed by its abort or, where a task was still writing then, by the next
commit: one writer at a time. Counts come from what
the tasks say they wrote: nothing is counted a second time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

COMMITS, STAGED = "_commits", "_staged"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or a plain path, and the path in it."""
    return fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)


def entries(system: fs.FileSystem, folder: str) -> list[str]:
    return sorted(f.path for f in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)))


def last_commit(uri: str) -> dict | None:
    """The newest record: name, version, generated_at, number, rows and total_rows by table, files by table."""
    system, folder = opened(uri)
    found = [p for p in entries(system, f"{folder}/{COMMITS}") if p.endswith(".json")]
    if not found:
        return None
    with system.open_input_stream(found[-1]) as f:
        return json.loads(f.read())


@dataclass
class Wrote(WriterCommitMessage):
    """What one task wrote: by table its file's name and number of rows."""

    files: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


class BundleSource(DataSource):
    """Format "bundle", for writing rows of (part string, record string). Options: path, name, version, parts (comma-separated
    names of all tables, as one may have no rows) and generated_at."""

    @classmethod
    def name(cls) -> str:
        return "bundle"

    def schema(self) -> str:
        return "part string, record string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return BundleWriter(dict(self.options), overwrite)


class BundleWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.uri, self.overwrite, self.options, self.run = options["path"].rstrip("/"), overwrite, options, uuid.uuid4().hex
        self.parts = options["parts"].split(",")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        system, folder = opened(self.uri)
        staged, sinks, wrote = f"{folder}/{STAGED}/{self.run}", {}, Wrote()
        try:
            for batch in iterator:
                for part in batch.column(0).unique().to_pylist():
                    if part not in sinks:
                        system.create_dir(staged, recursive=True)
                        wrote.files[part], wrote.rows[part] = f"{part}-{uuid.uuid4().hex}.json", 0
                        sinks[part] = system.open_output_stream(f"{staged}/{wrote.files[part]}")
                    lines = batch.column(1).filter(pc.equal(batch.column(0), part))
                    wrote.rows[part] += len(lines)
                    sinks[part].write("".join(f"{line}\n" for line in lines.to_pylist()).encode())
        finally:
            for s in sinks.values():
                s.close()
        return wrote

    def commit(self, messages: list[Wrote | None]) -> None:
        system, folder = opened(self.uri)
        before = last_commit(self.uri)
        kept = before if before and not self.overwrite else {"files": {}, "total_rows": {}}
        files, rows, total = {p: list(kept["files"].get(p, [])) for p in self.parts}, dict.fromkeys(self.parts, 0), {p: kept["total_rows"].get(p, 0) for p in self.parts}
        # Tables of earlier commits that this write doesn't name stay.
        for p in set(kept["files"]) - set(self.parts):
            files[p], total[p] = kept["files"][p], kept["total_rows"][p]
        for m in filter(None, messages):
            for part, name in m.files.items():
                system.create_dir(f"{folder}/{part}", recursive=True)
                system.move(f"{folder}/{STAGED}/{self.run}/{name}", f"{folder}/{part}/{name}")
                files[part].append(name)
                rows[part] += m.rows[part]
                total[part] += m.rows[part]
        record = {
            "name": self.options.get("name", ""), "version": self.options.get("version", ""), "generated_at": self.options.get("generated_at") or datetime.now(UTC).isoformat(),
            "number": before["number"] + 1 if before else 0, "rows": rows, "total_rows": total, "files": files,
        }
        self._put(system, f"{folder}/{COMMITS}/{record['number']:08}.json", record)
        self._sweep(system, folder, files, f"{folder}/{STAGED}")

    def _put(self, system: fs.FileSystem, place: str, record: dict) -> None:
        if system.get_file_info(place).type != fs.FileType.NotFound:
            raise RuntimeError(f"another write has committed {place}")
        system.create_dir(place.rpartition("/")[0], recursive=True)
        with system.open_output_stream(f"{place}.{self.run}") as f:
            f.write(json.dumps(record, sort_keys=True).encode())
        system.move(f"{place}.{self.run}", place)

    def _sweep(self, system: fs.FileSystem, folder: str, files: dict[str, list[str]], staged: str) -> None:
        for part in files:
            for path in entries(system, f"{folder}/{part}"):
                if path.rpartition("/")[2] not in files[part]:
                    system.delete_file(path)
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)

    def abort(self, messages: list[Wrote | None]) -> None:
        system, folder = opened(self.uri)
        last = last_commit(self.uri)
        self._sweep(system, folder, {p: (last["files"].get(p, []) if last else []) for p in self.parts}, f"{folder}/{STAGED}/{self.run}")


def write(tables: dict[str, DataFrame], path: str, name: str = "", version: str = "", mode: str = "append", now: datetime | None = None) -> dict:
    """All tables in one commit, whose record is returned. append keeps the rows of earlier commits, overwrite replaces them."""
    spark = next(iter(tables.values())).sparkSession
    spark.dataSource.register(BundleSource)
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(part).alias("part"), F.to_json(F.struct("*")).alias("record")) for part, df in tables.items()])
    options = {"name": name, "version": version, "parts": ",".join(tables), "generated_at": now.isoformat() if now else ""}
    rows.write.format("bundle").mode(mode).options(**options).save(path)
    return last_commit(path)


def read(spark: SparkSession, path: str, part: str, schema) -> DataFrame:
    """The rows of one table as of the newest commit."""
    last = last_commit(path)
    files = last["files"].get(part, []) if last else []
    return spark.read.schema(schema).json([f"{path.rstrip('/')}/{part}/{f}" for f in files]) if files else spark.createDataFrame([], schema)


def info(path: str, part: str) -> str:
    """A table's sidecar as JSON: name, version, total_rows over all commits, generated_at."""
    last = last_commit(path)
    return json.dumps({"name": last["name"], "version": last["version"], "total_rows": last["total_rows"][part], "generated_at": last["generated_at"]})
