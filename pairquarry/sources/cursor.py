"""A stream over a chain of pages in which each page names the next: the stream's offset is the cursor.

Format "cursor", options: transport, "module:function" of (resource, cursor or None) to (records, next cursor or None, whether
more follow, total); resource; pages, read at most in a micro-batch (10); limit, records after which a run stops, at
the end of the page that reaches it. Rows: the cursor that the record's page was asked for by, its place in it, and the record as JSON.

A page can only be asked for when the one before has named it, so the chain is followed in one place. Where a host tells what
follows a page without its records, option following, "module:function" of (resource, cursor or None) to (number of records, next
cursor or None, whether more follow, total), the driver follows the cursors alone, up to `pages` (2,000) in a micro-batch, and tasks
ask for the records, `together` pages each (25). Without it all records come by way of the driver. The checkpoint keeps the last
cursor, and a run that starts with it goes on from there.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader

from pairquarry.sources.paged import Pace, with_retry


class CursorSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cursor"

    def schema(self) -> str:
        return "cursor string, place int, record string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        if "following" not in self.options:
            raise PySparkNotImplementedError(errorClass="NOT_IMPLEMENTED", messageParameters={"feature": "streamReader"})
        return FollowingReader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return CursorReader(self.options)


def _function(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _after(offset: dict, n: int, following: str | None, more: bool, total: int | None) -> dict:
    """The offset behind a page of n records."""
    # The cursor after the last page, if there is one, is kept: what comes later follows it.
    cursor = following if following is not None and n else offset["cursor"]
    return {"cursor": cursor, "fetched": offset["fetched"] + n, "ended": not n or not more or following is None, "total": total}


class Chain:
    """What both readers share: where a run begins, and how far one read goes."""

    #: Pages of a micro-batch.
    pages = 10

    def __init__(self, options):
        self.options = dict(options)
        self.fetch = _function(self.options["transport"])
        self.pace = Pace(float(self.options.get("interval", 0)))
        self.begun: int | None = None

    def initialOffset(self) -> dict:
        return {"cursor": None, "fetched": 0, "ended": False, "total": None}

    def read_on(self, start: dict, page) -> tuple[list, dict]:
        """What page(offset) gives of the pages from an offset on, and the offset behind them."""
        # A run's first read asks once more where the chain had ended.
        asks = self.begun is None
        self.begun = start["fetched"] if asks else self.begun
        limit, found, at = int(self.options.get("limit", 0)), [], start
        for _ in range(int(self.options.get("pages", self.pages))):
            if (at["ended"] and not asks) or (limit and at["fetched"] - self.begun >= limit):
                break
            asks = False
            more, at = page(at)
            found += more
        return found, at


class CursorReader(Chain, SimpleDataSourceStreamReader):
    def page(self, offset: dict) -> tuple[list[tuple], dict]:
        self.pace.wait()
        records, following, more, total = with_retry(lambda: self.fetch(self.options["resource"], offset["cursor"]))
        rows = [(offset["cursor"], n, json.dumps(r, sort_keys=True)) for n, r in enumerate(records)]
        return rows, _after(offset, len(records), following, more, total)

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, at = self.read_on(start, self.page)
        return iter(rows), at

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        at = start
        while (at["cursor"], at["ended"]) != (end["cursor"], end["ended"]):
            rows, at = self.page(at)
            yield from rows


@dataclass
class Pages(InputPartition):
    #: A page's cursor and the number of its records.
    asked: list[tuple[str | None, int]]


class FollowingReader(Chain, DataSourceStreamReader):
    """Follows the cursors where it is; tasks ask for the records."""

    pages = 2000

    def __init__(self, options):
        super().__init__(options)
        self.follow = _function(self.options["following"])
        self.at: dict | None = None
        self.known: dict[str, list] = {}

    def page(self, offset: dict) -> tuple[list[tuple], dict]:
        self.pace.wait()
        n, *rest = with_retry(lambda: self.follow(self.options["resource"], offset["cursor"]))
        return [(offset["cursor"], n)] if n else [], _after(offset, n, *rest)

    def latestOffset(self) -> dict:
        start = self.at or self.initialOffset()
        asked, self.at = self.read_on(start, self.page)
        if asked:
            self.known = {json.dumps([start, self.at]): asked}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        # A run that takes up a checkpoint is told its offset by an empty range.
        self.at = self.at or end
        asked = self.known.get(json.dumps([start, end]))
        if asked is None:
            asked, at = [], start
            while at["fetched"] < end["fetched"]:
                more, at = self.page(at)
                asked += more
        n = int(self.options.get("together", 25))
        return [Pages(asked[k : k + n]) for k in range(0, len(asked), n)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        for cursor, n in partition.asked:
            records = with_retry(lambda: self.fetch(self.options["resource"], cursor))[0]  # noqa: B023
            if len(records) < n:
                raise ValueError(f"page {cursor} has {len(records)} records, {n} were announced")
            # What a page has got since is not counted yet: the offset says how far a batch goes.
            yield from ((cursor, k, json.dumps(r, sort_keys=True)) for k, r in enumerate(records[:n]))


def scan(spark: SparkSession, path: str, checkpoint: str, **options: str) -> None:
    """Append what the chain holds from the last cursor on to a Parquet table, up to the limit, then stop."""
    spark.dataSource.register(CursorSource)
    stream: DataFrame = spark.readStream.format("cursor").options(**options).load()
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
