"""Token counts by trie-shared dynamic programming.

A text's pre-tokens are its words, each after the word mark. The distinct pre-tokens of a chunk of texts are sorted, and
their trie is grown level by level: a node is a prefix, made from its parent and one character, so each shared prefix
is scored once however many words begin with it. A node's unigram forward score is the best sum of piece scores over
all ways to cut its prefix into pieces; it keeps the unfinished pieces that end in it, as states of a trie of the
vocabulary, each with the score of the node where the piece began. All nodes of a level are made at once with numpy, or, where
few words are left, one by one along the sorted words, each word from the last node that it shares with the one before.
A pre-token's count is the number of pieces on the best way at its terminal node; a text's count sums its pre-tokens'.

No file of public_tokenizers holds unigram probabilities, so scores are this module's own: a piece's score is its
log-probability under Zipf's law by its rank in the file, as vocabularies are listed from frequent to rare. Characters
in no piece fall back to one token per UTF-8 byte. Of equally good ways the one with fewer tokens counts.

Results for odd input: null and empty texts have 0 tokens; texts and words of any length are counted whole; repeated
rows are counted each; an empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

import math
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairquarry.llm.shared import text_of

MARK = "▁"
#: Words kept with their terminal counts between the batches of a task, and characters of text that share a trie; memory only.
CACHE_WORDS = 400_000
CHUNK_CHARS = 8_000_000
#: Levels with fewer words than this are walked node by node, which is faster there; each shared prefix is scored once either way.
FEW_WORDS = 24
#: Zipf-Mandelbrot offset of the ranks, and what a byte costs below the rarest piece.
OFFSET, BYTE_COST = 2.7, 10.0
#: More than any code point, so that state * CODES + character is a key of its own.
CODES = 1 << 21


def piece_scores(path: str) -> dict[str, float]:
    """Log-probability of every ordinary piece of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = math.log(sum(1 / (r + OFFSET) for r in range(len(pieces))))
    return {p: -math.log(r + OFFSET) - total for r, p in enumerate(pieces)}


class PieceTrie:
    """The vocabulary as a trie: the step from a state by a character, and the score of the piece that ends in a state."""

    def __init__(self, scores: dict[str, float]):
        steps: dict[int, int] = {}
        ends: dict[int, float] = {}
        for piece, score in scores.items():
            state = 0
            for char in piece:
                state = steps.setdefault(state * CODES + ord(char), len(steps) + 1)
            ends[state] = score
        self.steps, self.ends = steps, ends
        self.keys = np.array(sorted(steps), np.int64)
        self.to = np.array([steps[k] for k in self.keys.tolist()], np.int64)
        self.score = np.full(len(steps) + 1, -np.inf)
        self.score[list(ends)] = list(ends.values())
        # Most keys are not there; a bit table rules them out before the search.
        self.bits = 21
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.slot(self.keys)] = True

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def step(self, states: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which entries have a step, and the states it leads to."""
        keys = states * CODES + chars
        maybe = np.flatnonzero(self.seen[self.slot(keys)])
        at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        there = self.keys[at] == keys[maybe]
        return maybe[there], self.to[at[there]]


def utf8_size(chars: np.ndarray) -> np.ndarray:
    return 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)


class TrieCounter:
    def __init__(self, scores: dict[str, float]):
        self.pieces = PieceTrie(scores)
        self.byte_score = min(scores.values()) - BYTE_COST
        self.known: dict[bytes, int] = {}

    def count_words(self, words: list[str]) -> np.ndarray:
        """Tokens of each word; words must be sorted and distinct, so that a prefix's words are neighbours."""
        lengths = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        first = np.cumsum(lengths) - lengths
        counts = np.zeros(len(words), np.int64)
        # The level's nodes: forward score and tokens. Its unfinished pieces: node, state, and the score and tokens they began at.
        score, tokens = np.zeros(1), np.zeros(1, np.int64)
        piece = (np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64))
        word, node = np.flatnonzero(lengths), np.zeros(int((lengths > 0).sum()), np.int64)
        depth = 0
        while len(word) >= FEW_WORDS:
            char = flat[first[word] + depth]
            fresh = np.append(True, (node[1:] != node[:-1]) | (char[1:] != char[:-1]))
            top = np.flatnonzero(fresh)
            score, tokens, piece = self.level(score, tokens, piece, node[top], char[top])
            node, depth = np.cumsum(fresh) - 1, depth + 1
            done = lengths[word] == depth
            counts[word[done]] = tokens[node[done]]
            word, node = word[~done], node[~done]
        edges = np.searchsorted(piece[0], np.arange(len(score) + 1))
        # The nodes on the way to the word before, from depth on: score, tokens, unfinished pieces. Words are sorted, so that
        # these are all of the nodes made so far that a word can go on from.
        trail: list[tuple[float, int, list]] = []
        before, at = "", -1
        for w, n in zip(word.tolist(), node.tolist(), strict=True):
            if n != at:
                own = slice(edges[n], edges[n + 1])
                trail, before, at = [(score[n], tokens[n], list(zip(*(x[own].tolist() for x in piece[1:]), strict=True)))], words[w][:depth], n
            shared = len(os.path.commonprefix([before, words[w]]))
            del trail[shared - depth + 1 :]
            for char in words[w][shared:]:
                trail.append(self.below(char, *trail[-1]))
            counts[w], before = trail[-1][1], words[w]
        return counts

    def level(self, score, tokens, piece, parent, char):
        """Nodes below `parent` by `char` (one entry each, in the order of parents), and their unfinished pieces."""
        edges = np.searchsorted(piece[0], np.arange(len(score) + 1))
        begin, size = edges[parent], edges[parent + 1] - edges[parent]
        node = np.repeat(np.arange(len(parent)), size)
        took = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(node))
        on, state = self.pieces.step(piece[1][took], char[node])
        node, took = node[on], took[on]
        base, base_tokens = piece[2][took], piece[3][took]
        bytes_ = utf8_size(char)
        new_score, new_tokens = score[parent] + bytes_ * self.byte_score, tokens[parent] + bytes_
        ends = np.flatnonzero(self.pieces.score[state] > -np.inf)
        if len(ends):
            at, way, way_tokens = node[ends], base[ends] + self.pieces.score[state[ends]], base_tokens[ends] + 1
            group = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            who = at[group]
            best = np.maximum(np.maximum.reduceat(way, group), new_score[who])
            full = np.repeat(best, np.diff(np.append(group, len(at))))
            fewest = np.minimum.reduceat(np.where(way == full, way_tokens, np.iinfo(np.int64).max), group)
            new_tokens[who] = np.minimum(fewest, np.where(new_score[who] == best, new_tokens[who], np.iinfo(np.int64).max))
            new_score[who] = best
        # Each node also begins new pieces, after those it goes on with.
        every = np.arange(len(parent))
        order = np.argsort(np.concatenate([node, every]), kind="stable")
        joined = lambda a, b: np.concatenate([a, b])[order]
        return new_score, new_tokens, (joined(node, every), joined(state, np.zeros(len(parent), np.int64)), joined(base, new_score), joined(base_tokens, new_tokens))

    def below(self, char: str, score: float, tokens: int, pieces: list[tuple[int, float, int]]) -> tuple[float, int, list]:
        """The node below a node by a character."""
        steps, ends, code = self.pieces.steps, self.pieces.ends, ord(char)
        size = int(utf8_size(np.array(code))) if code > 0x7F else 1
        best, fewest, going = score + size * self.byte_score, tokens + size, []
        for state, base, base_tokens in pieces:
            after = steps.get(state * CODES + code)
            if after is not None:
                going.append((after, base, base_tokens))
                own = ends.get(after)
                if own is not None and (base + own, -base_tokens - 1) > (best, -fewest):
                    best, fewest = base + own, base_tokens + 1
        going.append((0, best, fewest))
        return best, fewest, going

    def count_texts(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        i = 0
        while i < len(texts):
            if len(self.known) > CACHE_WORDS:
                self.known = {}
            split, new, chars = [], set(), 0
            while i < len(texts) and (not split or chars + len(texts[i]) <= CHUNK_CHARS):
                split.append(words_of(texts[i]))
                new.update(split[-1])
                chars, i = chars + len(texts[i]), i + 1
            new.difference_update(self.known)
            # Bytes of UTF-8 sort as their characters do.
            ordered = sorted(new)
            self.known.update(zip(ordered, self.count_words([MARK + w.decode("utf-8", "surrogatepass") for w in ordered]).tolist(), strict=True))
            out += [sum(map(self.known.__getitem__, words)) for words in split]
        return out


def words_of(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space, in UTF-8; a pre-token is such a word after the mark."""
    return text.encode("utf-8", "surrogatepass").split()


@lru_cache(maxsize=1)
def counter(path: str) -> TrieCounter:
    """One per Python worker."""
    return TrieCounter(piece_scores(path))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and n_tokens for every row of docs. path: the vocabulary file, on every executor."""
    chosen = docs.select(F.col(id_col), text_of(text_col).alias("text"))

    def run(batches):
        own = counter(path)
        for batch in batches:
            n = own.count_texts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=[id_col, "n_tokens"])

    return chosen.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long")


def op1_token_counts(spark, sf_dir):
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
