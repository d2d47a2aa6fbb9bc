"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

A batch's distinct words lie in one flat symbol array. Each round looks all adjacent pairs up by binary search over
the sorted pair keys, finds every word's lowest rank, and merges that pair throughout the word; words without a
mergeable pair leave the array. Rounds are as many as the longest chain of merges of a word, not as many as words.

Results for odd input: null text counts as empty and gives no ids; null ids decode to the empty text; ids that don't
form UTF-8 decode with U+FFFD as the tokenizers library does; strings of special tokens in a text become their ids;
texts of any length are encoded whole; repeated rows are encoded alike; other columns are passed by.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairquarry.llm.shared import text_of

#: Words kept with their ids between the batches of a task; memory only, results don't depend on it.
CACHE_WORDS = 150_000
#: Characters of text whose words are merged together.
CHUNK_CHARS = 4_000_000
NEVER = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in own)
    shifted = {b: 256 + i for i, b in enumerate(rest)}
    return [chr(shifted.get(b, b)) for b in range(256)]


def word_pattern(last_code: int = sys.maxunicode) -> re.Pattern:
    """The pre-token pattern of byte-level BPE with its Unicode classes spelled out up to last_code, so that `re` can run it."""

    def spelled(keep) -> str:
        runs, start, last = [], None, None
        for c in range(last_code + 2):
            if c <= last_code and keep(c):
                start, last = (c if start is None else start), c
            elif start is not None:
                runs.append((start, last))
                start = None
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)

    letters = spelled(lambda c: unicodedata.category(chr(c))[0] == "L")
    numbers = spelled(lambda c: unicodedata.category(chr(c))[0] == "N")
    space = r"\x09-\x0d\x20\x85\xa0  -     　"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+")


class Words(dict):
    """Numbers words in the order in which they are first seen."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start..start+length-1 of every entry, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        of_byte = byte_symbols()
        self.byte_id = np.array([vocab[c] for c in of_byte], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern, self.bmp_pattern = word_pattern(), word_pattern(0xFFFF)
        to_byte = {c: b for b, c in enumerate(of_byte)}
        tokens = [b""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            tokens[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        self.token_length = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.reset()

    def reset(self) -> None:
        self.words = Words()
        self.start, self.length, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def pair_ranks(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that start at the given places; NEVER where no merge exists or the word ends."""
        after = np.minimum(at + 1, len(symbol) - 1)
        key = symbol[at] * self.size + symbol[after]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[found] == key) & (word[at] == word[after]) & (after > at)
        return np.where(known, self.ranks[found], NEVER)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and the number of ids of each word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        symbol = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        done_symbol, done_word = [], []
        rank = self.pair_ranks(symbol, word, np.arange(len(symbol)))
        while len(symbol):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            best = np.repeat(lowest, np.diff(np.append(first, len(word))))
            over = best == NEVER
            if over.any():
                done_symbol.append(symbol[over])
                done_word.append(word[over])
                symbol, word, rank, best = symbol[~over], word[~over], rank[~over], best[~over]
            hit = rank == best
            # Of overlapping hits, as in a run of one symbol, every second is merged, from the left.
            if (hit[1:] & hit[:-1]).any():
                place = np.arange(len(hit))
                run = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, 0))
                hit &= (place - run) % 2 == 0
            symbol[hit] = self.merged[rank[hit]]
            keep = ~np.append(False, hit[:-1])[: len(hit)]
            symbol, word, rank, hit = symbol[keep], word[keep], rank[keep], hit[keep]
            changed = np.flatnonzero(hit | np.append(hit[1:], False)[: len(hit)])
            rank[changed] = self.pair_ranks(symbol, word, changed)
        if not done_word:
            return np.zeros(0, np.int32), np.zeros(len(raw), np.int64)
        word, symbol = np.concatenate(done_word), np.concatenate(done_symbol)
        order = np.argsort(word, kind="stable")
        return symbol[order].astype(np.int32), np.bincount(word, minlength=len(raw))

    def learn(self, new: list[str]) -> None:
        plain, lengths = self.merge([w for w in new if w not in self.special])
        ids, size, at, done = [], [], 0, 0
        if any(w in self.special for w in new):
            for w in new:
                if w in self.special:
                    ids.append(np.array([self.special[w]], np.int32))
                    size.append(1)
                else:
                    n = int(lengths[done])
                    ids.append(plain[at : at + n])
                    size.append(n)
                    at, done = at + n, done + 1
            plain, lengths = np.concatenate(ids), np.array(size, np.int64)
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.flat = np.concatenate([self.flat, plain])

    def numbered(self, text: str) -> array:
        """The text's words as numbers; strings of special tokens are words of their own."""
        # Classes without the higher planes are several times faster to test.
        pattern = self.bmp_pattern if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else self.pattern
        if self.split is None or not any(s in text for s in self.special):
            return array("q", map(self.words.__getitem__, pattern.findall(text)))
        out = array("q")
        for part in self.split.split(text):
            out.extend(map(self.words.__getitem__, [part] if part in self.special else pattern.findall(part)))
        return out

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        i = 0
        while i < len(texts):
            if len(self.words) > CACHE_WORDS:
                self.reset()
            chunk, chars = [], 0
            while i < len(texts) and (not chunk or chars + len(texts[i]) <= CHUNK_CHARS):
                chunk.append(np.frombuffer(self.numbered(texts[i]), np.int64))
                chars, i = chars + len(texts[i]), i + 1
            if len(self.words) > len(self.start):
                known = len(self.start)
                self.learn(list(islice(self.words, known, None)))
            for numbers in chunk:
                out.append(self.flat[gather(self.start[numbers], self.length[numbers])])
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.token_bytes[gather(self.token_start[ids], self.token_length[ids])].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=1)
def tokenizer(path: str) -> ByteBpe:
    """One per Python worker."""
    return ByteBpe(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", verify: bool = False) -> DataFrame:
    """id_col and ids (array of int) for every row of docs. path: the tokenizer's file, on every executor.

    With verify, each row's ids are decoded again, and ids that don't give the row's text are an error.
    """
    chosen = docs.select(F.col(id_col), text_of(text_col).alias("text"))

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = bpe.encode_batch(texts)
            for n, text in enumerate(texts if verify else ()):
                if bpe.decode(ids[n]) != text:
                    raise ValueError(f"the ids of {id_col} {batch.column(0)[n].as_py()} don't decode to its text")
            ends = np.cumsum([0, *map(len, ids)])
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=[id_col, "ids"])

    return chosen.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col, ids and decoded (string) for every row of encoded."""
    chosen = encoded.select(F.col(id_col), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            column = batch.column(1)
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            decoded = pa.array([bpe.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), column, decoded], names=[id_col, "ids", "decoded"])

    return chosen.mapInArrow(run, f"`{id_col}` {encoded.schema[id_col].dataType.simpleString()}, ids array<int>, decoded string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    path = path or default_path()
    both = decode_documents(encode_documents(docs, path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op10_bpe_encode_decode(spark, sf_dir):
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
