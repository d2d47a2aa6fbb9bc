"""Quality rules: boosted trees over document statistics, behind plain base rules.

Statistics are counted over whole texts, once, and kept as a row a document. A tree ensemble with logistic loss is fitted
to the quality labels of at most TRAIN_ROWS documents of each class, those with the smallest hashes of their ids; some
statistics may only lower the score as they grow (FALLING): a split that breaks this is not taken, and what lies below it
stays on its side of the split's middle. The trees are flattened into arrays of nodes (feature, threshold, left,
right, value), so that a batch of documents walks all trees at once, a level a step. Labels of the quarter of ids
that `held_out` names are never learned from.

A document is kept if no base rule fails it and the trees give it an even chance or better to be good.

Results for odd input: null and empty texts have no words and fail the base rules; a null id is scored like any; rows
that repeat an id are scored each, and train as one row, that with the least statistics; labels that are null or of
unknown documents aren't used; without labels of both classes the trees keep everything; an empty table gives an empty
result; other columns, whatever their names, are kept or passed by.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairquarry.llm.shared import byte_chunks, materialize, text_of

#: Most labelled documents of a class that the trees are fitted to.
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_LEAF, RIDGE = 60, 3, 0.2, 64, 8, 1.0
#: Base rules: fewest words, and the largest share of repeated words in percent.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the trees see, by name; those in FALLING may only lower the score.
FEATURES = ("words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "marks", "bare_words", "distinct", "commonest", "line_words", "digits")
FALLING = ("symbols", "dup_lines", "repeats", "capitals", "marks", "bare_words", "commonest")


def table_of(members) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


SPACE, SYMBOL, DIGIT = table_of(b" \t\n\r\x0b\x0c"), table_of(SYMBOLS), table_of(b"0123456789")
UPPER, LOWER, MARK, INNER = table_of(range(65, 91)), table_of(range(97, 123)), table_of(b"!?"), table_of(range(0x80, 0xC0))
LETTER = UPPER | LOWER | table_of(range(0x80, 0x100))


def counted(sums: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """How many of the flags are set in each stretch that begins at begin[i] and ends at begin[i + 1]."""
    total = np.append(0, np.cumsum(sums))
    return total[begin[1:]] - total[begin[:-1]]


def repeats_of(ids: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Words of each document inside of windows of three words that it holds twice or more."""
    out = np.zeros(docs, np.int64)
    if len(ids) < 3:
        return out
    size = int(ids.max()) + 1
    _, key = np.unique(doc[:-1] * size + ids[:-1], return_inverse=True)
    _, pair = np.unique(key * size + ids[1:], return_inverse=True)
    at = np.flatnonzero(doc[:-2] == doc[2:])
    _, inverse, count = np.unique(pair[at] * size + ids[at + 2], return_inverse=True, return_counts=True)
    inside = np.zeros(len(ids), bool)
    often = at[count[inverse] > 1]
    for n in range(3):
        inside[often + n] = True
    return np.bincount(doc[inside], minlength=docs)


def statistics_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For UTF-8 texts: COUNTS, and FEATURES, a row each."""
    flat = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum([0, *map(len, texts)])
    space = SPACE[flat]
    chars = counted(~space & ~INNER[flat], begin)
    symbols, digits, marks, letters, capitals = (counted(t[flat], begin) for t in (SYMBOL, DIGIT, MARK, LETTER & ~INNER, UPPER))
    lists = [t.split() for t in texts]
    n = np.array([len(w) for w in lists], np.int64)
    doc = np.repeat(np.arange(len(texts)), n)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for words in lists for w in words], np.int64)
    repeats = repeats_of(ids, doc, len(texts))
    kinds, count = np.unique(doc * max(len(number), 1) + ids, return_counts=True)
    kind_doc = kinds // max(len(number), 1)
    distinct = np.bincount(kind_doc, minlength=len(texts))
    commonest = np.zeros(len(texts), np.int64)
    np.maximum.at(commonest, kind_doc, count)
    bare = np.array([not LETTER[np.frombuffer(w, np.uint8)].any() for w in number], bool) if number else np.zeros(0, bool)
    bare_words = np.bincount(doc[bare[ids]], minlength=len(texts)) if len(ids) else np.zeros(len(texts), np.int64)
    lines, dup_lines = np.zeros((2, len(texts)), np.int64)
    for i, t in enumerate(texts):
        own = [x for x in t.split(b"\n") if x and not x.isspace()]
        lines[i], dup_lines[i] = len(own), len(own) - len(set(own))
    per_word, per_char, per_line = np.maximum(n, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    features = [np.log1p(n), chars / per_word, symbols / per_char, dup_lines / per_line, repeats / per_word, capitals / np.maximum(letters, 1), marks / per_word]
    features += [bare_words / per_word, distinct / per_word, commonest / per_word, n / per_line, digits / per_char]
    return np.column_stack([n, chars, symbols, dup_lines, repeats]), np.column_stack(features).astype(np.float64)


@dataclass
class Trees:
    """Nodes of all trees in arrays; a leaf is its own child. Scores are log odds."""

    start: float = 0.0
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    depth: int = 0

    def scores(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.start + self.value[at].sum(axis=1)


class Grower:
    """Fits trees to (x, y), y being 0 or 1, by second-order boosting on histograms."""

    def __init__(self, x: np.ndarray, y: np.ndarray, signs: np.ndarray):
        self.x, self.y, self.signs = x, y.astype(float), signs
        # Thresholds are values of the rows; x <= threshold goes left.
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) if len(x) else np.zeros(0) for c in x.T]
        self.bins = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T, strict=True)])
        self.nodes: list[list[float]] = []

    def best_split(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        """(gain, feature, bin, left value, right value) of the best split that keeps the signs, or None."""
        total_g, total_h, best = g[rows].sum(), h[rows].sum(), None
        whole = total_g**2 / (total_h + RIDGE)
        for f, edges in enumerate(self.edges):
            if not len(edges):
                continue
            b = self.bins[rows, f]
            gl, hl, nl = (np.cumsum(np.bincount(b, w, len(edges) + 1))[:-1] for w in (g[rows], h[rows], None))
            gr, hr = total_g - gl, total_h - hl
            vl, vr = np.clip(-gl / (hl + RIDGE), low, high), np.clip(-gr / (hr + RIDGE), low, high)
            gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - whole
            fits = (nl >= LEAST_LEAF) & (len(rows) - nl >= LEAST_LEAF) & (self.signs[f] * (vr - vl) >= 0) & (gain > 1e-6)
            if fits.any():
                at = int(np.argmax(np.where(fits, gain, -1)))
                if best is None or gain[at] > best[0]:
                    best = float(gain[at]), f, at, float(vl[at]), float(vr[at])
        return best

    def grow(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, low: float, high: float) -> int:
        me = len(self.nodes)
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + RIDGE), low, high))
        self.nodes.append([0, 0.0, me, me, RATE * value])
        found = self.best_split(rows, g, h, low, high) if depth else None
        if found:
            _, f, at, vl, vr = found
            middle = (vl + vr) / 2
            goes = self.bins[rows, f] <= at
            sides = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(int(self.signs[f]), ((low, high), (low, high)))
            left = self.grow(rows[goes], g, h, depth - 1, *sides[0])
            right = self.grow(rows[~goes], g, h, depth - 1, *sides[1])
            self.nodes[me] = [f, float(self.edges[f][at]), left, right, 0.0]
        return me

    def fit(self) -> Trees:
        share = np.clip(self.y.mean(), 1e-3, 1 - 1e-3)
        out, roots, score = Trees(float(np.log(share / (1 - share)))), [], np.full(len(self.y), np.log(share / (1 - share)))
        every = np.arange(len(self.y))
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            roots.append(self.grow(every, p - self.y, p * (1 - p), DEPTH, -np.inf, np.inf))
            score += flattened(out.start, self.nodes, roots[-1:]).scores(self.x) - out.start
        return flattened(out.start, self.nodes, roots)


def flattened(start: float, nodes: list[list[float]], roots: list[int]) -> Trees:
    columns = list(zip(*nodes, strict=True))
    kinds = (np.int32, np.float64, np.int32, np.int32, np.float64)
    return Trees(start, *(np.array(c, k) for c, k in zip(columns, kinds, strict=True)), np.array(roots, np.int32), DEPTH)


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Without rows of both classes the trees keep everything."""
    if len(set(y.tolist())) < 2:
        return Trees()
    return Grower(x, y, np.array([-1 if f in FALLING else 0 for f in FEATURES])).fit()


def held_out(id_col: str = "doc_id") -> Column:
    """The quarter of rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """A row for every row of docs: a struct `row` of the columns to keep (all, if none are named), COUNTS as longs, and
    features, an array."""
    chosen = docs.select(F.struct(*(keep or docs.columns)).alias("row"), text_of(text_col).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            found = [statistics_of(texts) for texts in byte_chunks(batch.column(1))]
            counts = np.concatenate([np.zeros((0, len(COUNTS)), np.int64), *(c for c, _ in found)])
            features = np.concatenate([np.zeros((0, len(FEATURES))), *(f for _, f in found)])
            wide = pa.ListArray.from_arrays(pa.array(np.arange(0, features.size + 1, len(FEATURES)), pa.int32()), pa.array(features.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts.T), wide], names=["row", *COUNTS, "features"])

    schema = chosen.select("row", *(F.lit(0).cast("long").alias(c) for c in COUNTS), F.lit(None).cast("array<double>").alias("features")).schema
    return chosen.mapInArrow(run, schema)


def learned(counted_docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Trees from rows of statistics (row.id_col, features) and labels; at most `rows` of each class reach the driver, as numbers."""
    wanted = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(~held_out("id") & F.col("y").isin(0, 1) & F.col("id").isNotNull()).distinct()
    found = counted_docs.select(F.col(f"row.`{id_col}`").alias("id"), "features").join(wanted, "id").groupBy("id", "y").agg(F.min("features").alias("features"))
    found = materialize(found, "quality-labelled")
    sample = [r for y in (0, 1) for r in found.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows).collect()]
    return fit_trees(np.array([r["features"] for r in sample]).reshape(-1, len(FEATURES)), np.array([r["y"] for r in sample]))


def base_failed() -> Column:
    """Too few words, or too many of them repeated."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judged(counted_docs: DataFrame, trees: Trees) -> DataFrame:
    """row, COUNTS, base_failed, score (the chance to be good, 0 to 1) and kept of each row of statistics."""

    def run(batches):
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            scores = 1 / (1 + np.exp(-trees.scores(x)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=["row", *COUNTS, "score"])

    scored = counted_docs.mapInArrow(run, counted_docs.select("row", *COUNTS, F.lit(0.0).alias("score")).schema)
    return scored.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= 0.5))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that a base rule or the trees reject; all columns stay."""
    counted_docs = materialize(statistics(docs, text_col), "quality-statistics")
    return judged(counted_docs, learned(counted_docs, labels, id_col)).where("kept").select("row.*")


def op11_quality_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted_docs = materialize(statistics(docs, keep=["doc_id"]), "quality-statistics")
    trees = learned(counted_docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(counted_docs, trees).select(F.col("row.doc_id").alias("doc_id"), *COUNTS, "base_failed", "kept")
