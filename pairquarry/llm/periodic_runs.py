"""Runs of periodic words by seeds and extension along diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least LEAST words and
PERIODS * q words long, that no neighbouring word extends. So words i and i + q agree over its length less q: at least
max(LEAST - q, (PERIODS - 1) * q), which is 16 or more for every q. The k-grams of these 16 words are indexed for the
periods up to 16; for periods above k / 2 and up to k the guaranteed overlap is k as well, for k = 32, 64 and so on, as
far as a third of the document.

Within a run, k-grams with k >= q are equal only at multiples of q from each other, as a primitive word equals none of
its rotations. So the next occurrence of a k-gram in its document is the one a period away, and of the pairs of equal
k-grams only those of neighbours are enumerated: at most one for each word and k, however often a gram occurs. Each
pair lies on the diagonal of its lag. It's extended to both sides, unless the table of the furthest word covered on each
lag says that an extension has been there. What is found has no smaller period, for the same reason.

Grams are told apart exactly: a rolling 64-bit hash only discards those that surely occur once; the others are compared
word by word, and longer ones as pairs of numbered shorter ones.

Every document is searched whole by one task, many short ones at once. Memory is that of a chunk of CHUNK_BYTES
of texts (in shared), or of one longer text.

Results for odd input: null and empty texts have no words and no runs; repeated rows are searched alike; a null id is
kept as it is; an empty table gives an empty result; other columns, whatever their names, are passed by or kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairquarry.llm.shared import WORD, byte_chunks, text_of

#: A run's least number of words, and of periods.
LEAST, PERIODS = 24, 3
#: The shortest overlap that every run guarantees.
SEED = min(max(LEAST - q, (PERIODS - 1) * q) for q in range(1, LEAST))
RUN = "struct<start:bigint,length:bigint,period:bigint>"


@dataclass
class Words:
    """The words of some documents one after the other: their numbers, and where each document begins and ends."""

    lists: list[list[bytes]]

    def __post_init__(self):
        number: dict[bytes, int] = {}
        self.flat = np.array([number.setdefault(w, len(number)) for words in self.lists for w in words], np.int64)
        self.begin = np.cumsum([0, *map(len, self.lists)])
        self.doc = np.repeat(np.arange(len(self.lists)), np.diff(self.begin))


def numbered(rows: np.ndarray) -> np.ndarray:
    """Equal rows get equal numbers, below the number of rows."""
    if not len(rows):
        return np.zeros(0, np.int64)
    order = np.lexsort(rows.T)
    moved = rows[order]
    new = np.append(False, (moved[1:] != moved[:-1]).any(axis=1))
    out = np.empty(len(rows), np.int64)
    out[order] = np.cumsum(new)
    return out


def repeated(ids: np.ndarray) -> np.ndarray:
    """Whether each number occurs more than once."""
    return np.bincount(ids)[ids] > 1 if len(ids) else np.zeros(0, bool)


def repeated_grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all k-grams that occur twice in their document, and perhaps of some others; numbers of the grams."""
    rng = np.random.default_rng(1)
    h = rng.integers(1, 2**63, max(int(words.flat.max(initial=0)) + 1, 1), np.uint64)[words.flat]
    size = 1
    while size < k:
        step = min(size, k - size)
        h = h[: len(h) - step] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + h[step:]
        size += step
    at = np.flatnonzero(words.doc[: len(h)] == words.doc[k - 1 :])
    h = h[at] + words.doc[at].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    _, first, ids, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    often = count[ids] > 1
    like, at, ids = at[first[ids[often]]], at[often], ids[often]
    if (words.doc[at] == words.doc[like]).all() and all((words.flat[at + n] == words.flat[like + n]).all() for n in range(k)):
        return at, ids
    return at, numbered(np.column_stack([words.doc[at], *(words.flat[at + n] for n in range(k))]))


def seeds(words: Words):
    """For each k: k, and the places and lags of neighbouring occurrences of equal k-grams of a document, lags in k's range."""
    k = SEED
    if len(words.flat) < k:
        return
    at, ids = repeated_grams(words, k)
    least = 1
    while len(at):
        keep = repeated(ids)
        at, ids = at[keep], ids[keep]
        order = np.argsort(ids, kind="stable")
        here, there = order[:-1], order[1:]
        lag = at[there] - at[here]
        fits = (ids[here] == ids[there]) & (lag >= least) & (lag <= k)
        found = np.sort(here[fits])
        after = np.zeros(len(at), np.int64)
        after[here] = lag
        yield k, at[found], after[found]
        # A gram of twice the size is the two grams of this size at its ends, both of which occur again.
        ahead = np.searchsorted(at, at + k)
        inside = ahead < len(at)
        inside[inside] = at[ahead[inside]] == at[inside] + k
        inside[inside] = words.doc[at[inside]] == words.doc[at[inside] + 2 * k - 1]
        first, second = np.flatnonzero(inside), ahead[inside]
        ids = numbered(np.column_stack([ids[first], ids[second]]))
        at, least, k = at[first], k + 1, 2 * k


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the first elements of a and b are equal."""
    at, step, size = 0, 32, min(len(a), len(b))
    while at < size:
        differ = np.flatnonzero(a[at : at + step] != b[at : at + step])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, 4 * step
    return size


def runs_of(lists: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """For the words of each document, its runs (start, length, period) by start, then period."""
    words = Words(lists)
    flat, out = words.flat, [[] for _ in lists]
    for k, places, lags in seeds(words):
        covered: dict[int, int] = {}  # of each lag, the end of the words that an extension has compared
        # Neighbouring places of one lag are on one diagonal: the first stands for all.
        first = np.ones(len(places), bool)
        first[1:] = (np.diff(places) != 1) | (np.diff(lags) != 0)
        for i, q in zip(places[first].tolist(), lags[first].tolist(), strict=True):
            if i < covered.get(q, -1):
                continue
            doc = int(words.doc[i])
            low, high = int(words.begin[doc]), int(words.begin[doc + 1])
            right = i + k + agreeing(flat[i + k : high - q], flat[i + k + q : high])
            left = i - agreeing(flat[low:i][::-1], flat[low + q : i + q][::-1])
            covered[q] = right
            length = right + q - left
            if length >= max(LEAST, PERIODS * q):
                out[doc].append((left - low, length, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """words without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    drop = np.cumsum(edge[:-1]) > 0
    return [w for w, gone in zip(words, drop.tolist(), strict=True) if not gone]


def find_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """A row for every row of docs: a struct `row` of the columns to keep (all, if none are named); runs, an array of
    (start, length, period) by start, then period; and collapsed, the text's words, joined by one space, without
    those after the first period of a run."""
    chosen = docs.select(F.struct(*(keep or docs.columns)).alias("row"), text_of(text_col).cast("binary").alias("words"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            runs, kept = [], []
            for texts in byte_chunks(batch.column(1)):
                # bytes.split() parts at ASCII white space alone.
                lists = [t.split() for t in texts]
                found = runs_of(lists)
                kept += [b" ".join(kept_words(w, r)) for w, r in zip(lists, found, strict=True)]
                runs += [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found]
            texts = pa.array(kept, pa.binary()).cast(pa.string(), safe=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, kind), texts], names=["row", "runs", "collapsed"])

    return chosen.mapInArrow(run, chosen.select("row", F.lit(None).cast(f"array<{RUN}>").alias("runs"), F.lit("").alias("collapsed")).schema)


def collapse_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the words after the first period of each run taken out of the texts that have runs; all columns stay."""
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col(f"row.`{text_col}`"))
    return find_runs(docs, text_col).select(*(text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones that with the smallest start, then period."""
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | more(r, best), r).otherwise(best))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs; every tenth text by the checksum of its id goes round in a part of its words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    part = docs.select("doc_id", text_of("text").alias("text"), h.alias("h"), F.floor(h / 10).alias("g"))
    # Only the texts in question are taken apart.
    part = part.withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"))))
    part = part.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    part = part.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    index = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    text = F.array_join(F.transform(index, lambda i: F.get("words", i.cast("int"))), " ")
    return part.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    found = find_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet")), keep=["doc_id"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select(F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), strongest(F.col("runs")).alias("best"), lines.alias("lines"), "collapsed").select(
        "doc_id",
        "n_runs",
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") > 0, F.concat("lines", F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
