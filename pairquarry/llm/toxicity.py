"""Toxicity by a subsequence string-kernel support vector machine with Nystrom landmarks.

The kernel of two words sums over their common subsequences of four characters, gaps allowed, each weighted by
DECAY to the power of the characters it spans (at most SPAN), with marks for a word's start and end; it is scaled
by the words' lengths and raised to a power, which keeps near words apart from far ones. So a word with gaps or inserted
characters stays close to the word that it hides. The kernel of two sentences is the sum over their pairs of words;
with landmark words, whitened by the landmarks' own kernel matrix (Nystrom), a sentence's features are the sums of its
words' features.

The machine is trained on sentences. A clean document's sentences are all clean; in a toxic one only some are at fault, so
each of its sentences weighs by how far it stands out under the machine of the round before (ROUNDS rounds, from
equal weights). Landmarks with one inserted character are further toxic sentences of one word. A document's score is
a logistic function of its sentences' margins, fitted on margins of training rows by machines trained without them.

Training takes at most TRAIN_ROWS labelled documents of each class, those with the smallest hashes of their ids, of
these as many as together reach TRAIN_CHARS characters, very long ones last, and only rows the caller allows; scoring reads every
whole text.
Only the text is an input of a score.

Results for odd input: null text counts as empty; texts without words score as the fitted function says for no
sentences; without training rows of both classes every score is 0; labels that are null or of unknown documents are
not used; repeated rows are scored alike; an empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairquarry.llm.shared import text_of

#: Most labelled documents of a class that are used to train, and most characters of a class's documents.
TRAIN_ROWS, TRAIN_CHARS = 1200, 4_000_000
#: Texts longer than this part of TRAIN_CHARS train only where there are no others.
LONG_SHARE = 40
LANDMARKS, BACKGROUND = 96, 24
DECAY, SPAN = 0.7, 7
#: Places of a subsequence's characters after the first.
GAPS = [(a, b, c) for a in range(1, SPAN) for b in range(a + 1, SPAN) for c in range(b + 1, SPAN)]
#: Rounds in which sentences of toxic documents are weighed again.
ROUNDS = 3
#: Parts of the training rows whose margins the score is fitted on are left out of the machine that gives them.
PARTS = 3
#: Words kept with their margins between the batches of a task, characters scored together, words compared at once; memory only.
CACHE_WORDS, CHUNK_CHARS, BLOCK = 300_000, 4_000_000, 5_000
#: Up to this many character codes a table has a place for every key; with more, keys are searched.
DENSE = 61
THRESHOLD = 0.3
INSERTS = ".*-_x"
ENDS = (".", "!", "?")


@dataclass(frozen=True)
class Settings:
    """Chosen by log loss over inner folds of the training rows (toxicity_folds), never by the held-out ones: the kernel's
    power, how sharply sentences of toxic documents are weighed again, what a clean document weighs against a toxic one,
    and all disguised landmarks against all toxic documents."""

    power: int = 3
    sharpness: float = 1.0
    clean_weight: float = 1.5
    disguised_weight: float = 0.2


def bare(word: str) -> str:
    """The word without punctuation around it, within marks; long words are compared by all their characters."""
    return "^" + word.strip(".,;:!?\"'()[]{}<>*#$%&@~|/\\+=-_") + "$"


def words_and_sentences(text: str) -> tuple[list[str], list[int]]:
    """Lower-cased words, and where the lines among them end; sentences end there and after a word that ends in a full stop or the like."""
    words: list[str] = []
    ends = []
    for line in text.lower().split("\n"):
        words += line.split()
        ends.append(len(words))
    return words, ends


@dataclass
class Kernel:
    """Kernel values of many words to a fixed list of words."""

    words: list[str]
    power: int = 2

    def __post_init__(self):
        letters = sorted({c for w in self.words for c in w})
        self.code = {c: i + 1 for i, c in enumerate(letters)}
        self.base = len(letters) + 1
        self.kind = np.int32 if self.base <= DENSE else np.int64
        weights: dict[int, Counter] = {}
        for n, w in enumerate(self.words):
            for key, value in zip(*self.subsequences(w), strict=True):
                weights.setdefault(int(key), Counter())[n] += value / self.length(len(w))
        # For each key, in order, the own words that have it and how much it weighs in them.
        self.keys = np.array(sorted(weights), np.int64)
        rows = [weights[k] for k in self.keys.tolist()]
        self.begin = np.cumsum([0, *map(len, rows)])
        self.owner = np.array([n for r in rows for n in r], np.int64)
        self.value = np.array([v for r in rows for v in r.values()], np.float64)
        if self.base <= DENSE:
            self.place = np.full(self.base**4, -1, np.int16 if len(self.keys) < 2**15 else np.int32)
            self.place[self.keys] = np.arange(len(self.keys))

    def places(self, key: np.ndarray) -> np.ndarray:
        """The place of each number in keys, -1 where there is none."""
        if self.base <= DENSE:
            return self.place[key]
        if not len(self.keys):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    @staticmethod
    def length(n: int) -> float:
        """Scale of a word with n characters: the norm of its subsequences if all differ."""
        return max(sum(max(0, n - c) * DECAY ** (2 * (c + 1)) for _, _, c in GAPS), 1e-9) ** 0.5

    def subsequences(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        code = np.array([self.code.get(x, 0) for x in word], self.kind)
        keys, values = [], []
        for gap in GAPS:
            if len(code) > gap[2]:
                ok, key = self.combined(code, gap)
                keys.append(key[ok])
                values.append(np.full(ok.sum(), DECAY ** (gap[2] + 1)))
        return (np.concatenate(keys), np.concatenate(values)) if keys else (np.zeros(0, np.int64), np.zeros(0))

    def combined(self, code: np.ndarray, gap: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
        """For each place: whether all four characters are known, and their number."""
        n = len(code) - gap[2]
        key, ok = code[:n].copy(), code[:n] > 0
        for at in gap:
            key *= self.kind(self.base)
            key += code[at : at + n]
            ok &= code[at : at + n] > 0
        return ok, key

    def found(self, words: list[str]):
        """For every gap: the word and the place in keys of each of its subsequences that some own word has, and their weight."""
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.zeros(self.code_limit() + 1, self.kind)
        for ch, i in self.code.items():
            code[ord(ch)] = i
        c = code[np.minimum(flat, len(code) - 1)]
        owner = np.repeat(np.arange(len(words)), lengths)
        for gap in GAPS:
            n = len(c) - gap[2]
            if n > 0:
                ok, key = self.combined(c, gap)
                at = np.flatnonzero(ok & (owner[:n] == owner[gap[2] :]))
                place = self.places(key[at])
                yield owner[at[place >= 0]], place[place >= 0], DECAY ** (gap[2] + 1)

    def scale(self, words: list[str]) -> np.ndarray:
        by_length = np.array([self.length(n) for n in range(64)])
        return np.array([by_length[len(w)] if len(w) < 64 else self.length(len(w)) for w in words])

    def to(self, words: list[str]) -> np.ndarray:
        """Kernel values, a row per word."""
        size = len(self.words)
        out = np.zeros((len(words), size))
        for begin in range(0, len(words) if size else 0, BLOCK):
            part = words[begin : begin + BLOCK]
            for at, place, weight in self.found(part):
                n = self.begin[place + 1] - self.begin[place]
                each = np.repeat(self.begin[place] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                flat = np.bincount(np.repeat(at, n) * size + self.owner[each], self.value[each] * weight, len(part) * size)
                out[begin : begin + BLOCK] += flat.reshape(len(part), size)
        out /= self.scale(words)[:, None]
        out **= self.power
        return out

    def code_limit(self) -> int:
        return max(map(ord, self.code), default=0) + 1


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray  # of the kernel values to the landmarks, then the bias
    doc_weights: np.ndarray  # of document_features, then the bias
    constant: float | None = None  # the score of every text, where nothing could be learned
    power: int = 2


def document_features(margins: list[np.ndarray]) -> np.ndarray:
    """From the margins of each document's sentences: the largest, the sum and share of those near or beyond the plane, their number."""
    out = np.zeros((len(margins), 5))
    for row, m in zip(out, margins, strict=True):
        near = np.clip(m + 0.5, 0, 2).sum()
        row[:] = max(m.max(), -3) if len(m) else -3, np.log1p(near), min(near / max(len(m), 1), 1), np.log1p(len(m)) / 5, 1
    return out


def margins_of(blocks: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    return np.concatenate([x @ w for x in blocks])


def fit_hinge(blocks: list[np.ndarray], pos: np.ndarray, neg: np.ndarray, start: np.ndarray | None = None, ridge: float = 1e-6, rounds: int = 40) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps on the margin's inside, halved until the
    loss falls; each row counts pos for the one class and neg for the other. Rows come in blocks of single precision,
    so that no more than one is spelled out."""

    def loss(m, w):
        return pos @ np.maximum(1 - m, 0) ** 2 + neg @ np.maximum(1 + m, 0) ** 2 + ridge * w @ w

    width = blocks[0].shape[1]
    w = np.zeros(width) if start is None else start
    margin = margins_of(blocks, w)
    for _ in range(rounds):
        p, n = pos * (margin < 1), neg * (margin > -1)
        square, side, at = ridge * np.eye(width), np.zeros(width), 0
        for x in blocks:
            part, own = x.astype(np.float64), slice(at, at + len(x))
            square += part.T @ (part * (p + n)[own, None])
            side += part.T @ (p - n)[own]
            at += len(x)
        step = np.linalg.solve(square, side) - w
        moved, before, size = margins_of(blocks, step), loss(margin, w), 1.0
        while size > 1e-4 and loss(margin + size * moved, w + size * step) > before:
            size /= 2
        w, margin = w + size * step, margin + size * moved
        if np.abs(size * step).max() < 1e-7:
            break
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 100) -> np.ndarray:
    """Ridge logistic regression by Newton steps, halved until the loss falls."""

    def loss(w):
        z = x @ w
        return weight @ (np.logaddexp(0, z) - y * z) + ridge / 2 * w @ w

    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    return w


def disguised(word: str) -> list[str]:
    """The word with one character put in, at each inner place."""
    inner = word[1:-1]
    return [f"^{inner[:i]}{INSERTS[i % len(INSERTS)]}{inner[i:]}$" for i in range(1, len(inner))]


def landmarks_of(texts: list[str], labels: list[int], power: int = 2) -> tuple[list[str], list[tuple[str, float]]]:
    """Landmark words, and of the words that set toxic documents apart the first LANDMARKS with how much they do.

    A word's lift is the share of toxic documents that have it, less an error of the count, less four times the share of
    clean ones. Words are taken by falling lift unless near to one already taken; the most usual words of clean
    documents follow.
    """
    toxic, seen = sum(labels), (Counter(), Counter())
    for text, label in zip(texts, labels, strict=True):
        seen[label].update({bare(w) for w in words_and_sentences(text)[0]})
    lift = {w: (n - 0.5 * n**0.5) / toxic - 4 * seen[0][w] / (len(labels) - toxic) for w, n in seen[1].items() if len(w) > 4}
    ranked = sorted((w for w in lift if lift[w] > 0), key=lambda w: (-lift[w], w))[: 8 * LANDMARKS]
    near = Kernel(ranked, power).to(ranked)
    taken: list[int] = []
    for n in range(len(ranked)):
        if len(taken) < LANDMARKS and all(near[n, t] < 0.6**power * (near[n, n] * near[t, t]) ** 0.5 for t in taken):
            taken.append(n)
    chosen = [ranked[n] for n in taken]
    usual = [w for w, _ in sorted(seen[0].items(), key=lambda x: (-x[1], x[0])) if len(w) > 4 and w not in chosen]
    return chosen + usual[:BACKGROUND], [(w, lift[w]) for w in ranked[:LANDMARKS]]


def whitening(kernel: Kernel) -> np.ndarray:
    own = kernel.to(kernel.words)
    value, vector = np.linalg.eigh((own + own.T) / 2)
    return vector / np.sqrt(np.maximum(value, 1e-3 * max(value.max(initial=0), 1e-9)))


def sentence_starts(words: list[str], line_ends: list[int]) -> np.ndarray:
    stops = np.array([w.endswith(ENDS) for w in words], bool)
    return starts_of(stops, line_ends)


def starts_of(stops: np.ndarray, line_ends: list[int]) -> np.ndarray:
    """First word of each sentence; stops: whether a sentence ends after the word."""
    if not len(stops):
        return np.zeros(0, np.int64)
    edge = np.append(True, stops)
    edge[line_ends] = True
    return np.flatnonzero(edge[:-1])


def sentence_features(texts: list[str], kernel: Kernel, white: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Blocks of a row for each sentence of the texts (features, then 1), and the text it is of."""
    rows, of = [], []
    block, at = [], 0
    for n, text in enumerate(texts):
        block.append((n, *words_and_sentences(text)))
        at += len(block[-1][1])
        if at < 4 * BLOCK and n < len(texts) - 1:
            continue
        number: dict[str, int] = {}
        flat = np.array([number.setdefault(bare(w), len(number)) for _, words, _ in block for w in words], np.int64)
        starts, base = [], 0
        for m, words, ends in block:
            starts.append(base + sentence_starts(words, ends))
            of.append(np.full(len(starts[-1]), m))
            base += len(words)
        starts = np.concatenate(starts)
        features = (kernel.to([*number]) @ white).astype(np.float32)
        rows.append(np.ones((len(starts), white.shape[1] + 1), np.float32))
        # Few sentences at a time: their words' features are spelled out before they are summed.
        for a in range(0, len(starts), 500):
            end = starts[a + 500] if a + 500 < len(starts) else len(flat)
            rows[-1][a : a + 500, :-1] = np.add.reduceat(features[flat[starts[a] : end]], starts[a : a + 500] - starts[a], axis=0)
        block, at = [], 0
    return rows, np.concatenate([np.zeros(0, np.int64), *of])


def trained_machine(texts: list[str], y: np.ndarray, settings: Settings) -> Model:
    """Landmarks and weights; documents are not scored yet."""
    toxic, clean = int((y == 1).sum()), int((y == 0).sum())
    landmarks, insults = landmarks_of(texts, y.tolist(), settings.power)
    kernel = Kernel(landmarks, settings.power)
    white = whitening(kernel)
    x, of = sentence_features(texts, kernel, white)
    hidden = [(v, lift) for w, lift in insults for v in disguised(w)]
    own = np.hstack([kernel.to([v for v, _ in hidden]) @ white, np.ones((len(hidden), 1))]).astype(np.float32)
    weight = np.array([n for _, n in hidden])
    weight = settings.disguised_weight * weight / max(weight.sum(), 1e-12)
    # A document's sentences share its weight, and a class's documents the class's.
    share = 1 / np.maximum(np.bincount(of, minlength=len(y)), 1)[of]
    neg = np.append(np.where(y[of] == 0, settings.clean_weight * share / clean, 0), np.zeros(len(hidden)))
    every = [*x, own]
    w = None
    for _ in range(ROUNDS + 1):
        if w is not None:
            margin = margins_of(x, w)
            top = np.full(len(y), -np.inf)
            np.maximum.at(top, of, margin)
            share = np.exp(settings.sharpness * (margin - top[of]))
            share /= np.bincount(of, share, len(y))[of]
        pos = np.append(np.where(y[of] == 1, share / toxic, 0), weight)
        w = fit_hinge(every, pos, neg, w)
    return Model(landmarks, np.append(white @ w[:-1], w[-1]), np.zeros(5), power=settings.power)


def parts_of(y: np.ndarray, parts: int) -> np.ndarray:
    """A part for each row, the classes dealt out in turn."""
    out = np.zeros(len(y), np.int64)
    for label in (0, 1):
        out[y == label] = np.arange((y == label).sum()) % parts
    return out


def train(texts: list[str], labels: list[int], totals: tuple[int, int] | None = None, settings: Settings | None = None) -> Model:
    """totals: labelled documents of class 0 and 1 in all, of which texts are a sample.

    The function that makes scores of margins is fitted on margins by machines that haven't seen the document: margins of a
    machine's own rows lie too far from its plane."""
    settings, y = settings or Settings(), np.array(labels)
    count = np.array([(y == 0).sum(), (y == 1).sum()])
    if not count.all():
        return Model([], np.zeros(1), np.zeros(5), 0.0)
    part = parts_of(y, PARTS) if count.min() >= 2 * PARTS else np.zeros(len(y), np.int64)
    features = np.zeros((len(y), 5))
    machine = trained_machine(texts, y, settings)
    for n in range(part.max() + 1):
        unseen, seen = np.flatnonzero(part == n), np.flatnonzero(part != n)
        other = trained_machine([texts[i] for i in seen], y[seen], settings) if len(seen) else machine
        features[unseen] = document_features(Scorer(other).margins([texts[i] for i in unseen]))
    # The sample may hold the classes in other shares than the labels do.
    of_class = np.array(totals or count) / count
    weights = of_class[y] * len(y) / of_class[y].sum()
    machine.doc_weights = fit_logistic(features, y.astype(float), weights)
    return machine


class Scorer:
    def __init__(self, model: Model):
        self.model, self.kernel = model, Kernel(model.landmarks, model.power)
        self.reset()

    def reset(self) -> None:
        self.number: dict[str, int] = {}
        self.margin, self.stops = np.zeros(0), np.zeros(0, bool)

    def learn(self) -> None:
        """Margins of the words numbered since the last time."""
        new = list(self.number)[len(self.margin) :]
        for at in range(0, len(new), 4 * BLOCK):
            part = new[at : at + 4 * BLOCK]
            self.margin = np.append(self.margin, self.kernel.to([bare(w) for w in part]) @ self.model.weights[:-1])
            self.stops = np.append(self.stops, np.array([w.endswith(ENDS) for w in part], bool))

    def margins(self, texts: list[str]) -> list[np.ndarray]:
        """The margins of each text's sentences."""
        out: list[np.ndarray] = []
        i = 0
        while i < len(texts):
            if len(self.number) > CACHE_WORDS:
                self.reset()
            chunk, chars, number = [], 0, self.number
            while i < len(texts) and (not chunk or chars + len(texts[i]) <= CHUNK_CHARS):
                words, ends = words_and_sentences(texts[i])
                chunk.append((np.array([number.setdefault(w, len(number)) for w in words], np.int64), ends))
                chars, i = chars + len(texts[i]), i + 1
            self.learn()
            for ids, ends in chunk:
                starts = starts_of(self.stops[ids], ends)
                out.append(np.add.reduceat(self.margin[ids], starts) + self.model.weights[-1] if len(starts) else np.zeros(0))
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.model.constant is not None or not texts:
            return np.full(len(texts), self.model.constant or 0.0)
        z = document_features(self.margins(texts)) @ self.model.doc_weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def training_sample(
    docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str, text_col: str, label_col: str, rows: int, chars: int
) -> tuple[list[str], list[int], tuple[int, int]]:
    """At most `rows` labelled texts of each class, those with the smallest hashes of their ids, and of these as many as
    reach `chars` characters together; and the labels of each class.

    Texts longer than a LONG_SHARE-th of chars come last, so that one of them can't stand for all others; a class that
    has any text keeps one at least. Of rows that repeat an id the least text trains."""
    wanted = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y")).where(allowed & F.col("y").isin(0, 1) & F.col("doc_id").isNotNull()).distinct()
    counts = {r["y"]: r["count"] for r in wanted.groupBy("y").count().collect()}
    by_hash = lambda y: wanted.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most 2 * rows ids of a few bytes: small enough to broadcast by its own bound.
    chosen = F.broadcast(by_hash(0).unionByName(by_hash(1)))
    found = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).join(chosen, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    order = [F.length("text") > chars // LONG_SHARE, F.xxhash64("doc_id"), "doc_id"]
    before = F.coalesce(F.sum(F.length("text")).over(Window.partitionBy("y").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sample = found.withColumn("before", before).where(F.col("before") < chars).orderBy(F.xxhash64("doc_id"), "doc_id", "y").select("text", "y").collect()
    return [r["text"] for r in sample], [r["y"] for r in sample], (counts.get(0, 0), counts.get(1, 0))


def held_out(id_col: str = "doc_id") -> Column:
    """The quarter of rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """id_col and score of every row; with keep, all columns of docs in a struct `row`, and score."""
    own = F.struct("*").alias("row") if keep else F.col(id_col)
    chosen = docs.select(own, text_of(text_col).alias("text"))

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            scores = scorer.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[batch.schema.names[0], "score"])

    return chosen.mapInArrow(run, chosen.drop("text").withColumn("score", F.lit(0.0)).schema)


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model:
    return train(*training_sample(docs, labels, ~held_out("doc_id"), id_col, text_col, label_col, rows, chars))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows whose score reaches the threshold; all columns stay."""
    return score_documents(docs, model, keep=True).where(F.col("score") < threshold).select("row.*")


def op3_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
