"""A judge's answers, each paid for once: a store that tasks write to as they are answered.

Prompts are dealt to asking tasks by the digest of their text, so that one task asks for each different prompt. It puts an
answer into the store before it asks for the next one: a task that is run again, or another run, finds there what was
answered and asks only for the rest. The store is a folder that driver and executors share, of one small JSON file an
answer, under 256 folders by digest. As a judge's pace is seconds a request, files are few for what they took to get.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairquarry.functions.scan import json_object
from pairquarry.operators.tables import written
from pairquarry.sources.paged import Pace

#: How often a prompt is tried, and the seconds between: twice as long each time, within bounds.
ATTEMPTS, FACTOR, FIRST_WAIT, LAST_WAIT = 3, 2.0, 10.0, 120.0
#: Seconds between two requests of all tasks together.
INTERVAL = 5.0

ASKED = "digest string, answer string, error string, attempts int, input_tokens long, output_tokens long"


class Reply(NamedTuple):
    text: str
    input_tokens: int = 0
    output_tokens: int = 0


class AnswerStore:
    """Replies by digest, in a folder of any file system that pyarrow opens by its URI."""

    def __init__(self, uri: str):
        self.uri = uri
        #: What a process opened, and the folders that it has made.
        self._opened: tuple[fs.FileSystem, str] | None = None
        self._made: set[str] = set()

    def __getstate__(self) -> dict:
        return {"uri": self.uri}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["uri"])

    def _place(self, digest: str) -> tuple[fs.FileSystem, str]:
        if self._opened is None:
            self._opened = fs.FileSystem.from_uri(self.uri) if "://" in self.uri or self.uri.startswith("file:") else (fs.LocalFileSystem(), self.uri)
        system, folder = self._opened
        return system, f"{folder}/{digest[:2]}/{digest}"

    def get(self, digest: str) -> Reply | None:
        system, path = self._place(digest)
        if system.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with system.open_input_stream(path) as f:
            return Reply(*json.loads(f.read()))

    def put(self, digest: str, reply: Reply) -> None:
        """Whole or not at all: written beside its place, then renamed."""
        system, path = self._place(digest)
        if (folder := path.rpartition("/")[0]) not in self._made:
            system.create_dir(folder, recursive=True)
            self._made.add(folder)
        beside = f"{path}.{uuid.uuid4().hex}.part"
        with system.open_output_stream(beside) as f:
            f.write(json.dumps(list(reply)).encode())
        system.move(beside, path)


def wait_before(attempt: int) -> float:
    """Seconds before the attempt-th try, counted from 0."""
    return min(LAST_WAIT, max(FIRST_WAIT, FACTOR * 2 ** (attempt - 1)))


def tried(ask: Callable[[str], Reply | str], prompt: str, retried: tuple, before: Callable[[], None], sleep: Callable[[float], None]) -> tuple[Reply | None, str | None, int]:
    """The reply or the error, and how many calls it took. Only errors of the kinds in retried are tried again."""
    for attempt in range(1, ATTEMPTS + 1):
        try:
            before()
            reply = ask(prompt)
            reply = reply if isinstance(reply, Reply) else Reply(reply)
            if json_object(reply.text) is None:
                raise ValueError(f"no JSON in the answer: {(reply.text or '')[:200]!r}")
            return reply, None, attempt
        except Exception as e:  # noqa: BLE001  one prompt's failure is that row's
            if not isinstance(e, retried) or attempt == ATTEMPTS:
                return None, f"{type(e).__name__}: {e}"[:1000], attempt
            sleep(wait_before(attempt))
    raise AssertionError("unreachable")


def asked_once(
    prompts: DataFrame, key: str, prompt: str, ask: Callable[[str], Reply | str], store: AnswerStore, tasks: int = 4, interval: float = INTERVAL, retried: tuple = (ConnectionError, TimeoutError), sleep: Callable[[float], None] = time.sleep
) -> DataFrame:
    """key, digest, answer, error, attempts, input_tokens and output_tokens of each prompt.

    Equal prompts share an answer and its tokens; what the store holds isn't asked for again and has 0 attempts. A failure,
    or an answer without a JSON object, is that row's error and isn't kept, so that a later run asks again. A null prompt is
    an error without a call. At most `tasks` ask at once, each at its share of the pace.
    """
    digests = prompts.select(key, F.col(prompt).alias("prompt"), F.sha2(F.encode(prompt, "UTF-8"), 256).alias("digest"))
    different = digests.where("digest IS NOT NULL").groupBy("digest").agg(F.min("prompt").alias("prompt"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        pace = Pace(interval * tasks, sleep=sleep)
        # Tasks start one after the other; one that is run again first waits its turn.
        lag = interval * (tasks if context.attemptNumber() else context.partitionId() % tasks)
        pace.last = time.monotonic() - interval * tasks + lag
        for frame in frames:
            rows = []
            for digest, text in zip(frame["digest"], frame["prompt"], strict=True):
                reply, error, attempts = store.get(digest), None, 0
                if reply is None:
                    reply, error, attempts = tried(ask, text, retried, pace.wait, sleep)
                    if reply is not None:
                        store.put(digest, reply)
                rows.append((digest, *((reply.text, None, attempts, reply.input_tokens, reply.output_tokens) if reply else (None, error, attempts, 0, 0))))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ASKED.split(", ")])

    answers = written(different.repartition(tasks, "digest").mapInPandas(run, ASKED), "answers")
    found = digests.drop("prompt").join(answers, "digest", "left")
    missing = F.col("digest").isNull()
    return found.select(
        key, "digest", "answer", F.when(missing, "no prompt").otherwise(F.col("error")).alias("error"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("attempts", "input_tokens", "output_tokens")],
    )


def usage(answers: DataFrame) -> DataFrame:
    """One row: prompts, different ones, those answered and failed, calls, and the tokens that all different answers cost."""
    each = answers.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), *[F.max(c).alias(c) for c in ("answer", "attempts", "input_tokens", "output_tokens")])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return each.agg(
        total("n").alias("prompts"), F.count("digest").alias("different"), F.count("answer").alias("answered"), F.count_if(F.col("answer").isNull()).alias("failed"), total("attempts").alias("calls"), total("input_tokens").alias("input_tokens"), total("output_tokens").alias("output_tokens"),
    )
