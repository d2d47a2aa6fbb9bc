"""Substring dedup: words of passages that recur from a smaller document are removed.

A window is WINDOW consecutive words, a phrase PHRASE of them.

1. Each window has a least phrase, by hash. Equal windows have equal ones, so a window can recur only if its least phrase
   is one in a second document too. Such phrases are confirmed: their words are cut out of the smallest document that
   has them, their owner.
2. Confirmed phrases are sharded by their owner and their place in it, so that a passage's phrases are together, some
   SHARD_PHRASES in a shard. Every document with a confirmed phrase is sent to the shards of its phrases, in chunks of
   CHUNK_CHARS; all other documents have no recurring window. A task compiles its shard's phrases into Aho-Corasick
   automata over words, spelled in three letters each (some 2 kB a phrase), and streams the whole texts of its documents
   through them, which locates every occurrence.
3. A window belongs to the leftmost occurrence in it; neighbouring windows of one occurrence are a run, about one for
   every 18 words. Of runs with equal words around one phrase, all but the smallest document's are covered.
4. Where a phrase has several different runs, they may still share windows. These are spelled out, for each different
   run from its smallest document, and windows whose smallest document isn't their own are covered.
5. Covered words are removed from the documents that have any.

Words are compared by their 128-bit digests. Counting is by aggregates that combine before they shuffle, and joins are
between written tables, which Spark splits where a passage is in a large part of all documents. Nothing is gathered by
phrase, and no pairs of documents arise.

Results for odd input: null text counts as empty; fewer than WINDOW words are never removed; rows with a null id lose
nothing and cover nothing; rows repeating an id don't cover each other, whatever their texts; texts of any length are
read whole; an empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairquarry.llm.shared import materialize, same, text_of

WINDOW, PHRASE = 50, 16
#: Phrases of a shard, words of an owner whose phrases stay together, characters of a shard's texts in one chunk.
SHARD_PHRASES, SHARD_SPAN, CHUNK_CHARS = 20_000, 65_536, 12_000_000
#: Odd numbers: the base of phrase hashes, and what mixes them.
BASE = 0x9E3779B97F4A7C15
MIX = 0xD6E8FEB86659FD93
#: Words whose hashes are kept between the batches of a task, and words hashed together; memory only.
CACHE_WORDS, CHUNK_WORDS = 400_000, 500_000
#: An automaton's words are numbered in so many letters each; a new automaton begins when its numbers are used up.
LETTERS = 64


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


class Powers:
    """Powers of BASE and of its inverse, modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            power = lambda b: np.cumprod(np.append(np.ones(1, np.uint64), np.full(n - 1, b)), dtype=np.uint64)
            self.up, self.down = power(np.uint64(BASE)), power(np.uint64(pow(BASE, -1, 2**64)))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


class LeastPhrases:
    """The least phrase of each window of many texts."""

    def __init__(self, window: int = WINDOW, phrase: int = PHRASE):
        self.window, self.phrase = window, phrase
        self.hashes, self.powers = WordHashes(), Powers()

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, hash of the phrase, its first word), a row where the least phrase of the windows of a text changes."""
        if len(self.hashes) > CACHE_WORDS:
            self.hashes = WordHashes()
        lengths = np.array([len(t) for t in texts], np.int64)
        n = int(lengths.sum())
        if n < self.window:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = np.fromiter((x for t in texts for x in map(self.hashes.__getitem__, t)), np.uint64, n)
        text = np.repeat(np.arange(len(texts)), lengths)
        self.powers.grow(n + 1)
        upto = np.zeros(n + 1, np.uint64)
        np.cumsum(h * self.powers.up[:n], dtype=np.uint64, out=upto[1:])
        order = (upto[self.phrase :] - upto[: n + 1 - self.phrase]) * self.powers.down[: n + 1 - self.phrase]
        order ^= order >> np.uint64(32)
        order *= np.uint64(MIX)
        order ^= order >> np.uint64(32)
        # Minima over all phrases of each window, by doubling.
        width, span, least = self.window - self.phrase + 1, 1, order
        while 2 * span <= width:
            least = np.minimum(least[: len(least) - span], least[span:])
            span *= 2
        windows = n - self.window + 1
        least = np.minimum(least[:windows], least[width - span : width - span + windows])
        inside = text[:windows] == text[self.window - 1 :]
        fresh = np.append(True, (least[1:] != least[:-1]) | (text[1:windows] != text[: windows - 1]) | ~inside[:-1])
        start = np.flatnonzero(fresh & inside)
        place = start + order[start[:, None] + np.arange(width)].argmin(axis=1)
        return text[start], least[start].view(np.int64), place - (np.cumsum(lengths) - lengths)[text[start]]


def text_key():
    """Tells texts of rows with one id apart."""
    return F.xxhash64("text")


def document_phrases(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """docs(doc_id, text) as doc_id, tk, n_words, sha (of all words, joined by one space) and arrays: phrase, place."""

    def run(batches: Iterator[pa.RecordBatch]):
        finder = LeastPhrases(window, phrase)
        for batch in batches:
            begin = 0
            while begin < batch.num_rows:
                texts, sha, held, end = [], [], 0, begin
                while end < batch.num_rows and held < CHUNK_WORDS:
                    texts.append(words_of(batch.column(1)[end].as_py()))
                    sha.append(hashlib.sha256(b" ".join(texts[-1])).digest())
                    held, end = held + len(texts[-1]), end + 1
                text, found, place = finder.of(texts)
                ends = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (found, place.astype(np.int32))]
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([len(t) for t in texts], pa.int64()), pa.array(sha, pa.binary()), *lists], names=["doc_id", "tk", "n_words", "sha", "phrase", "place"])
                begin = end

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", text_key().alias("tk")).mapInArrow(run, f"doc_id {kind}, tk long, n_words long, sha binary, phrase array<long>, place array<int>")


class Automata:
    """Aho-Corasick automata of phrases of words."""

    def __init__(self):
        self.made: list[tuple] = []
        self.fresh()

    def fresh(self) -> None:
        self.code: dict[bytes, str] = {}
        self.phrases: list[int] = []
        self.building = ahocorasick.Automaton(ahocorasick.STORE_INTS)

    def add(self, words: list[bytes], phrase: int) -> None:
        if len(self.code) + len(words) > LETTERS**3:
            self.close()
        for w in words:
            if w not in self.code:
                n = len(self.code)
                # A letter's place in the word shows in itself, so that no match begins inside a word.
                self.code[w] = chr(1 + n // LETTERS**2) + chr(1 + LETTERS + n // LETTERS % LETTERS) + chr(1 + 2 * LETTERS + n % LETTERS)
        self.building.add_word("".join(map(self.code.__getitem__, words)), len(self.phrases))
        self.phrases.append(phrase)

    def close(self) -> None:
        if self.phrases:
            self.building.make_automaton()
            self.made.append((self.building, self.code, self.phrases))
            self.fresh()

    def occurrences(self, words: list[bytes], length: int) -> list[tuple[int, int]]:
        """(first word, phrase) of all occurrences, in order."""
        found = []
        for automaton, code, phrases in self.made:
            get = code.get
            spelled = "".join([get(w, "\0\0\0") for w in words])
            found += [((end + 1) // 3 - length, phrases[n]) for end, n in automaton.iter(spelled)]
        return sorted(found)


def edges_of(words: list[bytes]) -> np.ndarray:
    """Where each word begins in the words joined by spaces, and one past the end."""
    return np.append(0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1))


def confirmed_phrases(texts: DataFrame, phrase: int) -> DataFrame:
    """texts(text, own: array of (phrase, place, shard)) as shard, phrase, words."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for text, own in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = words_of(text.as_py())
                rows += [(o["shard"], o["phrase"], b" ".join(words[o["place"] : o["place"] + phrase]).decode("utf-8", "surrogatepass")) for o in own]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.string()))], names=["shard", "phrase", "words"])

    return texts.where(F.size("own") > 0).select("text", "own").mapInArrow(run, "shard int, phrase long, words string")


def located_runs(texts: DataFrame, phrases: DataFrame, window: int, phrase: int, chunk_chars: int) -> DataFrame:
    """texts(doc_id, tk, text, shards) as doc_id, tk, phrase, two halves of a digest, start, size: the runs around the
    occurrences of the phrases of each document's shards."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    sent = texts.select("doc_id", "tk", "text", F.explode("shards").alias("shard"))
    sizes = texts.select(F.length("text").alias("chars"), F.explode("shards").alias("shard")).groupBy("shard").agg(F.ceil(F.sum("chars") / chunk_chars).alias("chunks"))
    sizes = materialize(sizes.select("shard", F.greatest("chunks", F.lit(1)).cast("int").alias("chunks")), "shard-sizes")
    dealt = sent.join(sizes, "shard").select("shard", F.pmod(F.xxhash64("doc_id", "tk"), "chunks").cast("int").alias("chunk"), F.lit(1).alias("side"), "doc_id", "tk", "text", F.lit(0).cast("long").alias("phrase"))
    every = phrases.join(sizes, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("side"), F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("long").alias("tk"), F.col("words").alias("text"), "phrase"
    )
    # A chunk's phrases sort before its texts, so that its automata are complete when the first text comes.
    grouped = every.unionByName(dealt).repartition("shard", "chunk").sortWithinPartitions("shard", "chunk", "side")

    def run(batches: Iterator[pa.RecordBatch]):
        key, automata = None, Automata()
        for batch in batches:
            take, names, high, low, start, size = [], [], [], [], [], []
            shards, chunks, sides, phrases_of = (batch.column(i).to_numpy() for i in (0, 1, 2, 6))
            for row in range(batch.num_rows):
                if (shards[row], chunks[row]) != key:
                    key, automata = (shards[row], chunks[row]), Automata()
                words = words_of(batch.column(5)[row].as_py())
                if not sides[row]:
                    automata.add(words, int(phrases_of[row]))
                    continue
                automata.close()
                found = automata.occurrences(words, phrase)
                if not found:
                    continue
                at = np.array([p for p, _ in found], np.int64)
                # Windows after the occurrence before, up to the one that begins with this one.
                begin = np.maximum(np.append(0, at[:-1] + 1), np.maximum(at + phrase - window, 0))
                last = np.minimum(at, len(words) - window)
                joined, edge = b" ".join(words), edges_of(words)
                for i in np.flatnonzero(begin <= last).tolist():
                    a, b = int(begin[i]), int(last[i]) + window
                    digest = xxhash.xxh3_128_intdigest(joined[edge[a] : edge[b] - 1])
                    take.append(row)
                    names.append(found[i][1])
                    high.append(digest >> 64)
                    low.append(digest & (2**64 - 1))
                    start.append(a)
                    size.append(b - a)
            rows = pa.array(take, pa.int64())
            half = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(3).take(rows), batch.column(4).take(rows), pa.array(names, pa.int64()), half(high), half(low), pa.array(start, pa.int32()), pa.array(size, pa.int32())],
                names=["doc_id", "tk", "phrase", "high", "low", "start", "size"],
            )

    return grouped.mapInArrow(run, f"doc_id {kind}, tk long, phrase long, high long, low long, start int, size int")


def spelled_windows(texts: DataFrame, window: int) -> DataFrame:
    """texts(doc_id, tk, text, runs: array of (start, size)) as its windows: doc_id, tk, pos, and two halves of a digest."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows, pos, high, low = [], [], [], []
            for row, (text, runs) in enumerate(zip(batch.column(2), batch.column(3).to_pylist(), strict=True)):
                words = words_of(text.as_py())
                joined, edge = b" ".join(words), edges_of(words).tolist()
                # Runs found in several shards may overlap; each window is spelled once.
                for i in sorted({p for r in runs for p in range(r["start"], r["start"] + r["size"] - window + 1)}):
                    digest = xxhash.xxh3_128_intdigest(joined[edge[i] : edge[i + window] - 1])
                    rows.append(row)
                    pos.append(i)
                    high.append(digest >> 64)
                    low.append(digest & (2**64 - 1))
            take = pa.array(rows, pa.int64())
            half = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(pos, pa.int32()), half(high), half(low)], names=["doc_id", "tk", "pos", "high", "low"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "tk", "text", "runs").mapInArrow(run, f"doc_id {kind}, tk long, pos int, high long, low long")


def covered_ranges(docs: DataFrame, found: DataFrame, window: int, phrase: int, shard_phrases: int, chunk_chars: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, tk, start, size) of covered words, maybe overlapping, and (doc_id, tk, text) of the documents with confirmed phrases."""
    each = found.where("doc_id IS NOT NULL").select("doc_id", "tk", F.explode(F.arrays_zip("phrase", "place")).alias("r")).select("doc_id", "tk", "r.*")
    owners = each.groupBy("phrase").agg(F.min(F.struct("doc_id", "place")).alias("owner"), F.max("doc_id").alias("last_id")).where("owner.doc_id < last_id")
    owners = materialize(owners.select("phrase", F.col("owner.doc_id").alias("owner"), F.col("owner.place").alias("owner_place")), "phrases-owned")
    shards = max(1, -(-owners.count() // shard_phrases))
    placed = owners.withColumn("shard", F.pmod(F.xxhash64("owner", F.floor(F.col("owner_place") / SHARD_SPAN)), F.lit(shards)).cast("int"))
    is_own = (F.col("doc_id") == F.col("owner")) & (F.col("place") == F.col("owner_place"))
    listed = each.join(placed, "phrase").groupBy("doc_id", "tk").agg(F.collect_set("shard").alias("shards"), F.collect_list(F.when(is_own, F.struct("phrase", "place", "shard"))).alias("own"))
    # Documents with confirmed phrases, written once: the only texts that are read again.
    keyed = docs.where("doc_id IS NOT NULL").withColumn("tk", text_key())
    texts = materialize(keyed.join(materialize(listed, "phrases-listed"), ["doc_id", "tk"]).dropDuplicates(["doc_id", "tk"]), "texts-held")
    phrases = materialize(confirmed_phrases(texts, phrase), "phrases")
    runs = materialize(located_runs(texts, phrases, window, phrase, chunk_chars), "runs")
    run_key = ["phrase", "high", "low"]
    firsts = materialize(runs.groupBy(*run_key).agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")), "runs-first")
    several = materialize(firsts.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).select("phrase", (F.col("n") > 1).alias("several")), "phrases-open")
    open_or_copied = firsts.join(several, "phrase").where("several OR first_id < last_id").select(*run_key, "first_id", "several")
    decided = runs.join(materialize(open_or_copied, "runs-of-interest"), run_key).where("doc_id > first_id OR (several AND doc_id = first_id)")
    decided = materialize(decided.select("doc_id", "tk", "start", "size", (F.col("doc_id") > F.col("first_id")).alias("copied")), "runs-decided")
    cut = materialize(decided.where("NOT copied").groupBy("doc_id", "tk").agg(F.collect_list(F.struct("start", "size")).alias("runs")), "runs-open")
    windows = materialize(spelled_windows(texts.select("doc_id", "tk", "text").join(cut, ["doc_id", "tk"]), window), "windows")
    least = windows.groupBy("high", "low").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id").select("high", "low", "first_id")
    shared = windows.join(materialize(least, "windows-owned"), ["high", "low"]).where("doc_id > first_id")
    # A run's copies in larger documents are covered by rule 3, so only the texts that were spelled out take these.
    ranges = decided.where("copied").select("doc_id", "tk", "start", "size").unionByName(shared.select("doc_id", "tk", F.col("pos").alias("start"), F.lit(window).alias("size")))
    return ranges, texts.select("doc_id", "tk", "text")


def kept_words(texts: DataFrame) -> DataFrame:
    """texts(doc_id, tk, text, ranges: array of (start, size)) as doc_id, tk, n_removed, kept (text of the words left)."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            removed, kept = [], []
            for text, ranges in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                words = words_of(text.as_py())
                change = np.zeros(len(words) + 1, np.int64)
                for r in ranges:
                    change[r["start"]] += 1
                    change[r["start"] + r["size"]] -= 1
                gone = np.cumsum(change)[:-1] > 0
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "tk", "n_removed", "kept"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "tk", "text", "ranges").mapInArrow(run, f"doc_id {kind}, tk long, n_removed long, kept string")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE, shard_phrases: int = SHARD_PHRASES, chunk_chars: int = CHUNK_CHARS
) -> tuple[DataFrame, DataFrame]:
    """Per row of docs: doc_id, tk, n_words, sha (of all its words, joined by one space); and of the rows that lose
    words: doc_id, tk, n_removed, kept."""
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    found = materialize(document_phrases(base, window, phrase), "document-phrases")
    ranges, texts = covered_ranges(base, found, window, phrase, shard_phrases, chunk_chars)
    gathered = ranges.groupBy("doc_id", "tk").agg(F.collect_list(F.struct("start", "size")).alias("ranges"))
    changed = kept_words(texts.join(materialize(gathered, "ranges"), ["doc_id", "tk"]))
    return found.select("doc_id", "tk", "n_words", "sha"), changed


def op8_substring_dedup(spark, sf_dir):
    every, changed = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digests = materialize(changed.select("doc_id", "tk", "n_removed", F.sha2("kept", 256).alias("kept_sha")), "kept")
    return (
        every.join(digests, same(every, digests, "doc_id", "tk"), "left")
        .select(every.doc_id, "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha", F.lower(F.hex("sha"))).alias("kept_sha256"))
    )
