"""A Spark data source over a paged interface. The transport is injected, so tests and replays need no network."""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Statuses that are tried again, how often, and the waits between.
RETRIED, ATTEMPTS, FIRST_WAIT, LAST_WAIT = (429, 500, 502, 503), 5, 4.0, 120.0


class TransportError(Exception):
    def __init__(self, status: int, message: str = ""):
        super().__init__(f"{status}: {message}")
        self.status = status


class Pace:
    """At least `interval` seconds between calls; if few calls are left, waits until the server's reset."""

    def __init__(self, interval: float, spare: int = 50, clock=time.monotonic, sleep=time.sleep, wall=time.time):
        self.interval, self.spare, self.clock, self.sleep, self.wall = interval, spare, clock, sleep, wall
        self.last, self.left, self.reset = None, None, None

    def wait(self) -> None:
        if self.left is not None and self.left <= self.spare and self.reset:
            self.sleep(max(0.0, self.reset - self.wall()))
            self.left = None
        if self.last is not None:
            self.sleep(max(0.0, self.last + self.interval - self.clock()))
        self.last = self.clock()

    def heard(self, headers: dict) -> None:
        if "X-RateLimit-Remaining" in headers:
            self.left, self.reset = int(headers["X-RateLimit-Remaining"]), float(headers.get("X-RateLimit-Reset", 0))


def with_retry(call: Callable, sleep=time.sleep):
    """call(), again after growing waits while the server is busy."""
    for attempt in range(ATTEMPTS):
        try:
            return call()
        except TransportError as e:
            if e.status not in RETRIED or attempt == ATTEMPTS - 1:
                raise
            sleep(min(LAST_WAIT, FIRST_WAIT * 2**attempt))


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class PagedSource(DataSource):
    """Format "paged": options transport ("module:function" of (resource, page) to (list of records, whether more follow)),
    resource, pages (or limit and per_page, for as many pages as hold the limit, whole ones), first_page to go on from, and pages_per_partition. Rows: page and the record as JSON."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page int, record string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options)


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        first, step = int(self.options.get("first_page", 1)), int(self.options.get("pages_per_partition", 10))
        if "limit" in self.options:
            last = first - 1 - (-int(self.options["limit"]) // int(self.options["per_page"]))
        else:
            last = int(self.options["pages"])
        return [PageRange(a, min(a + step, last + 1)) for a in range(first, last + 1, step)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        module, _, function = self.options["transport"].partition(":")
        fetch = getattr(importlib.import_module(module), function)
        # Each partition gets its share of the rate.
        pace = Pace(float(self.options.get("interval", 0)) * max(1, len(self.partitions())))
        for page in range(partition.first, partition.last):
            pace.wait()
            records, more = with_retry(lambda page=page: fetch(self.options["resource"], page))
            for r in records:
                yield page, json.dumps(r, sort_keys=True)
            if not records or not more:
                return
