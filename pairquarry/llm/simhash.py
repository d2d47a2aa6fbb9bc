"""SimHash near-dedup with pivot distance tables.

Fingerprints are made in one pass over the texts. Equal fingerprints become one node, so copies never meet as pairs.
Two fingerprints at `radius` bits or fewer agree on some choice of `blocks - radius` of `blocks` bit blocks; nodes are
grouped by each such choice. Within a group every node has its Hamming distances to the pivots (reference
fingerprints); since distances obey the triangle inequality, a pair whose coordinates differ by more than the radius
anywhere is discarded, and the survivors are verified bit by bit. A group gives the links of a spanning forest, not
all its pairs. Nodes of groups over `group_rows` are grouped again by finer blocks; at 16 blocks a group differs in 8 bits
only, so that it has at most 256 nodes however many share a block. Every link comes from a pivot table.

Results for odd input: null text counts as empty; texts without words get fingerprint 0 and are linked like any
other; a null id never represents a group unless all its ids are null; repeated rows give repeated result rows; an
empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairquarry.llm.components import connected_components
from pairquarry.llm.shared import materialize, text_of

BITS = 64
SEED = 42
PIVOTS = 48
#: Nodes of a group that are compared in one go, and into how many blocks of bits fingerprints are cut, and cut again.
GROUP_ROWS, BLOCKS = 512, (4, 16)
#: Bins of a min-hash sketch, and bands of rows among them that are keys.
BINS, BANDS, ROWS = 256, 24, 4
#: Bits by which fingerprints of similar texts may differ; documents of a family in one chunk, and shingles of one.
SIMILAR_RADIUS, CHUNK, CHUNK_SHINGLES = 24, 2048, 1_000_000
#: Rows of an Arrow batch that carries texts or shingles.
SLICE = 1000
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of every run of `size` lower-cased words (repeats included); of all words if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    last = ends[min(size, len(words)) - 1 :][:n]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; 0 without hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a signed long."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(shingle_hashes(t.as_py(), shingle)) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return chosen.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp long")


def pivot_fingerprints(count: int = PIVOTS, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, count, dtype=np.uint64)


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def forest(n: int, pairs) -> list[tuple[int, int]]:
    """The pairs that join two trees, in order."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def verified_pairs(fps: np.ndarray, table: np.ndarray, radius: int) -> np.ndarray:
    """All pairs (i, j), i < j, within the radius: survivors of the pivot table, verified by their bits."""
    left, right = np.triu_indices(len(fps), 1)
    for p in range(table.shape[1]):  # coordinate by coordinate, so that most pairs go after a few
        near = np.abs(table[left, p] - table[right, p]) <= radius
        left, right = left[near], right[near]
    true = np.bitwise_count(fps[left] ^ fps[right]) <= radius
    return np.stack([left[true], right[true]], axis=1)


def whole_groups(batches, keys: list[str]):
    """Frames that hold whole groups of rows with equal keys, from batches sorted by them."""
    held = None
    for batch in batches:
        frame = batch.to_pandas()
        held = frame if held is None or not len(held) else pd.concat([held, frame], ignore_index=True)
        if len(held):
            last = (held[keys] == held[keys].iloc[-1]).all(axis=1).to_numpy()
            if not last.all():
                yield held[~last]
            held = held[last]
    if held is not None and len(held):
        yield held


def group_edges(frame: pd.DataFrame, keys: list[str]):
    """(first, end) of each group of a sorted frame."""
    values = frame[keys].to_numpy()
    edge = np.flatnonzero(np.append(True, (values[1:] != values[:-1]).any(axis=1))).tolist()
    return zip(edge, [*edge[1:], len(frame)], strict=True)


def block_keys(radius: int, blocks: int) -> list:
    """A column for each choice of blocks - radius blocks: the choice's number and the bits of those blocks."""
    width = BITS // blocks
    edge = [width * i for i in range(blocks)] + [BITS]
    keys = []
    for i, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edge[b + 1] - edge[b])) - 1) << edge[b] for b in chosen)
        mask -= (1 << BITS) * (mask >> (BITS - 1))  # as a signed long
        keys.append(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits")))
    return keys


def near_links(nodes: DataFrame, radius: int = 2, levels: tuple[int, ...] = BLOCKS, pivots: int = PIVOTS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links that connect all nodes(node, fp) within the radius of each other. fp must be unique.

    levels: into how many blocks fingerprints are cut; groups that are too large at one level are cut finer at the next,
    and at the last level all groups are compared, as they have at most 2**(radius * 64 / levels[-1]) nodes.
    """
    kind = nodes.schema["node"].dataType.simpleString()

    def compare(batches):
        reference = pivot_fingerprints(pivots)
        for frame in whole_groups(batches, ["choice", "bits"]):
            fps, ids, a, b = frame["fp"].to_numpy().view(np.uint64), frame["node"].to_numpy(), [], []
            table = pivot_table(fps, reference)
            for x, y in group_edges(frame, ["choice", "bits"]):
                for i, j in forest(y - x, verified_pairs(fps[x:y], table[x:y], radius)):
                    a.append(ids[x + i])
                    b.append(ids[x + j])
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"a": pd.Series(a, dtype=frame["node"].dtype), "b": pd.Series(b, dtype=frame["node"].dtype)}), preserve_index=False)

    links, left = [], nodes.select("node", "fp")
    for blocks in levels:
        keyed = left.select("node", "fp", F.explode(F.array(*block_keys(radius, blocks))).alias("key"))
        sizes = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-sizes")
        shared = materialize(keyed.join(sizes, "key"), "simhash-shared")
        crowded = F.lit(False) if blocks == levels[-1] else F.col("n") > group_rows
        dealt = shared.where(~crowded).select("key.choice", "key.bits", "node", "fp").repartition("choice", "bits").sortWithinPartitions("choice", "bits")
        links.append(materialize(dealt.mapInArrow(compare, f"a {kind}, b {kind}"), "simhash-links"))
        left = shared.where(crowded).select("node", "fp").distinct()
        if blocks == levels[-1] or left.isEmpty():
            break
    return reduce(DataFrame.unionByName, links).distinct()


def sketch(ordered: np.ndarray) -> np.ndarray:
    """One-permutation min-hash of different hashes in order: of those that start with byte i the least; 0 where there is none."""
    out = np.zeros(BINS, np.uint64)
    bins = (ordered >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1])) if len(ordered) else np.zeros(0, np.int64)
    out[bins[first]] = ordered[first] | np.uint64(1)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key for each band of ROWS bins; an empty bin takes the next one that isn't."""
    filled = np.flatnonzero(least)
    if not len(filled):
        return np.zeros(0, np.uint64)
    dense = least[filled[np.searchsorted(filled, np.arange(BANDS * ROWS)) % len(filled)]].reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            keys = (keys ^ (dense[:, i] >> np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
    return keys


def similarity_sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, text, fp, keys): the fingerprint of the different shingles; the keys of their min-hash bands, and one of all minima."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            fps, keys = [], []
            for text in batch.column(1):
                # Each shingle once, as the Jaccard index counts it: a line repeated often must not outvote the others.
                hashes = np.unique(shingle_hashes(text.as_py(), shingle))
                least = sketch(hashes)
                fps.append(fingerprint(hashes))
                own = band_keys(least)
                keys.append(np.append(own, np.uint64(xxhash.xxh64_intdigest(least.tobytes(), SEED))).view(np.int64) if len(own) else own.view(np.int64))
            ends = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
            flat = pa.array(np.concatenate([np.zeros(0, np.int64), *keys]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "text", "fp", "keys"])

    return chosen.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, text string, fp long, keys array<long>")


def byte_bins(ordered: np.ndarray) -> bytes:
    """How many of the different hashes in order start with each byte (255: as many or more), then a byte of the least of each."""
    bins = (ordered >> np.uint64(56)).astype(np.int64)
    least = (sketch(ordered) >> np.uint64(1)).astype(np.uint8)
    return np.minimum(np.bincount(bins, minlength=BINS), 255).astype(np.uint8).tobytes() + least.tobytes()


def sure_differences(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """A number of hashes that the set of bins `one` and each of the others certainly don't share: in each bin the
    difference of the counts; where these are equal but the least hashes aren't, one on each side."""
    count, least = one[:BINS].astype(np.int16), one[BINS:]
    apart = np.abs(others[:, :BINS] - count)
    swapped = (apart == 0) & (others[:, BINS:] != least)
    return apart.sum(axis=1, dtype=np.int64) + swapped @ np.where(count < 255, 2, 1)


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """docs(doc_id, text, fp) with the sorted hashes of the different shingles, and their byte_bins, instead of the text."""

    def run(batches):
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            sets = [np.unique(shingle_hashes(t.as_py(), shingle)) for t in batch.column(1)]
            ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            flat = pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))
            bins = pa.array([byte_bins(x) for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.ListArray.from_arrays(ends, flat), bins], names=["doc_id", "fp", "shingles", "bins"])

    return docs.select("doc_id", "text", "fp").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long, shingles array<long>, bins binary")


def exact_links(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose different shingles have a Jaccard index of at least the similarity. Many pairs may have the same a."""
    kind = sets.schema["doc_id"].dataType.simpleString()
    one = materialize(pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b"), "exact-one")
    both = one.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a").select("a", "b", "x", "y")

    def run(batches):
        for batch in batches:
            (xs, xe), (ys, ye) = ((c.values.to_numpy(), c.offsets.to_numpy()) for c in (batch.column(2), batch.column(3)))
            good = []
            for n in range(batch.num_rows):
                x, y = xs[xe[n] : xe[n + 1]], ys[ye[n] : ye[n + 1]]
                if min(len(x), len(y)) >= similarity * max(len(x), len(y)) - 1:
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if shared / max(1, len(x) + len(y) - shared) >= similarity:
                        good.append(n)
            take = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], names=["a", "b"])

    return materialize(both.mapInArrow(run, f"a {kind}, b {kind}").distinct(), "exact-links")


class Postings:
    """Shingles of many documents: which documents have each."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets])
        flat = np.concatenate([np.zeros(0, np.int64), *sets])
        order = np.argsort(flat, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        flat = flat[order]
        self.start = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, np.int64)
        self.known, self.length = flat[self.start], np.diff(np.append(self.start, len(flat)))

    def jaccard(self, own: np.ndarray) -> np.ndarray:
        """The exact Jaccard index of a set of shingles with each document's."""
        if not len(self.known):
            return np.zeros(len(self.sizes))
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        at = at[self.known[at] == own]
        n = self.length[at]
        each = np.repeat(self.start[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(self.owner[each], minlength=len(self.sizes))
        return shared / np.maximum(len(own) + self.sizes - shared, 1)


def joining_links(fps: np.ndarray, sets: list[np.ndarray], component: np.ndarray, side: np.ndarray, similarity: float, radius: int):
    """Pairs (i, j), i of side 0 and j of side 1, that are similar and join two components not joined before."""
    table = pivot_table(fps, pivot_fingerprints(PIVOTS))
    other = np.flatnonzero(side == 1)
    postings = Postings([sets[j] for j in other])
    names, number = np.unique(component, return_inverse=True)
    root = np.arange(len(names))
    for i in np.flatnonzero(side == 0).tolist():
        while (root != root[root]).any():  # few steps: roots are kept flat
            root = root[root]
        j = np.flatnonzero(root[number[other]] != root[number[i]])
        for p in range(0, table.shape[1], 8):  # the pivot table, a few coordinates at a time
            j = j[(np.abs(table[other[j], p : p + 8] - table[i, p : p + 8]) <= radius).all(axis=1)]
        j = j[np.bitwise_count(fps[other[j]] ^ fps[i]) <= radius]
        if len(j):
            j = j[postings.jaccard(sets[i])[j] >= similarity]
            for k in other[j].tolist():
                a, b = root[number[i]], root[number[k]]
                if a != b:
                    root[root == max(a, b)] = min(a, b)
                    yield i, k


def possible_links(fps: np.ndarray, sizes: np.ndarray, bins: np.ndarray, component: np.ndarray, similarity: float, radius: int):
    """Pairs (i, j) of rows in order of size that neither their sizes, nor the pivot table, nor their bins rule out, and that
    join two components not joined before."""
    table = pivot_table(fps, pivot_fingerprints(PIVOTS))
    names, number = np.unique(component, return_inverse=True)
    root = np.arange(len(names))
    # Sets of sizes m and n with the similarity differ by (m + n) * share at most.
    share, end = (1 - similarity) / (1 + similarity), np.searchsorted(sizes, sizes / similarity + 1e-6, "right")
    for i in range(len(sizes) - 1):
        while (root != root[root]).any():
            root = root[root]
        j = np.arange(i + 1, end[i])
        j = j[root[number[j]] != root[number[i]]]
        for p in range(0, table.shape[1], 8):
            if not len(j):
                break
            j = j[(np.abs(table[j, p : p + 8] - table[i, p : p + 8]) <= radius).all(axis=1)]
        j = j[np.bitwise_count(fps[j] ^ fps[i]) <= radius]
        if len(j):
            j = j[sure_differences(bins[i], bins[j]) <= (sizes[i] + sizes[j]) * share + 1e-6]
            for k in j.tolist():
                a, b = root[number[i]], root[number[k]]
                if a != b:
                    root[root == max(a, b)] = min(a, b)
                    yield i, k


def families(opened: DataFrame, held: DataFrame, similarity: float, radius: int, chunk: int) -> DataFrame:
    """(component, family): components with documents that share a key and may be similar. Sharing a key by chance makes no
    family, so that families don't grow with the corpus.

    A row is a document's fingerprint, size and bins, never its shingles. Keys of over `chunk` documents are cut by size,
    each document meeting those of its own step and the next, and what is still larger a chunk by a chunk.
    """
    kind = held.schema["doc_id"].dataType.simpleString()
    step = math.log(1 / similarity) * (1 + 1e-9)  # sizes of similar documents are at most a step apart
    many = materialize(opened.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "similar-crowds")
    small = held.select("doc_id", "fp", F.size("shingles").alias("size"), "bins")
    rows = materialize(opened.select("key", "doc_id", "component").join(many, "key").withColumn("crowded", F.col("n") > chunk).drop("n"), "similar-asked").join(small, "doc_id")
    own = F.floor(F.log("size") / step).cast("int")
    sized = rows.withColumn("step", F.explode(F.when(F.col("crowded"), F.array(own, own + 1)).otherwise(F.array(F.lit(0)))))
    asked = opened.select("key", "doc_id").join(held.select("doc_id", F.size("shingles").alias("size")), "doc_id").join(many.where(F.col("n") > chunk).select("key"), "key", "left_semi")
    steps = asked.select("key", F.explode(F.array(own, own + 1)).alias("step")).groupBy("key", "step").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("parts"))
    cut = sized.join(materialize(steps, "similar-steps"), ["key", "step"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    blocks = cut.withColumn("own", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    keys = ["key", "step", "i", "j"]
    grouped = blocks.select(*keys, "size", "component", "fp", "bins").repartition(*keys).sortWithinPartitions(*keys, "size")

    def run(batches):
        for frame in whole_groups(batches, keys):
            fps, sizes, component, a, b = frame["fp"].to_numpy().view(np.uint64), frame["size"].to_numpy(), frame["component"].to_numpy(), [], []
            bins = np.frombuffer(b"".join(frame["bins"]), np.uint8).reshape(-1, 2 * BINS)
            for x, y in group_edges(frame, keys):
                for m, n in possible_links(fps[x:y], sizes[x:y], bins[x:y], component[x:y], similarity, radius):
                    a.append(component[x + m])
                    b.append(component[x + n])
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"a": pd.Series(a, dtype=component.dtype), "b": pd.Series(b, dtype=component.dtype)}), preserve_index=False)

    found = materialize(grouped.mapInArrow(run, f"a {kind}, b {kind}"), "possible-links")
    return connected_components(found).select(F.col("node").alias("component"), F.col("component").alias("family"))


def family_links(shared: DataFrame, held: DataFrame, components: DataFrame, similarity: float, radius: int, chunk: int) -> DataFrame:
    """(a, b): links that join the components of all similar documents that share a key.

    Keys whose documents are one component are done. Components connected by possibly similar documents of the other
    keys are a family; its documents outside of its largest component are compared with all of it, a chunk of these and a chunk of those at a time, by
    their pivot tables and then their whole shingle sets. A task gives links that join two components, of which there
    are fewer than components, and never all similar pairs.
    """
    kind = held.schema["doc_id"].dataType.simpleString()
    placed = shared.select("doc_id", "key").join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    placed = materialize(placed.withColumn("component", F.coalesce("component", "doc_id")), "similar-placed")
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    opened = materialize(placed.join(materialize(several, "similar-open"), "key"), "similar-opened")
    members = opened.select("doc_id", "component").distinct().join(families(opened, held, similarity, radius, chunk), "component")
    rows = materialize(held.drop("bins").join(members, "doc_id").withColumn("size", F.size("shingles")), "similar-members")
    counts = rows.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    largest = counts.groupBy("family").agg(F.max(F.struct("n", "component", "shingles")).alias("top"), F.sum("n").alias("n"), F.sum("shingles").alias("shingles"))
    parts = lambda n, m: F.greatest(F.ceil(n / chunk), F.ceil(m / CHUNK_SHINGLES), F.lit(1)).cast("int")
    sizes = largest.select(
        "family", F.col("top.component").alias("base"), parts(F.col("n"), F.col("shingles")).alias("all_parts"),
        parts(F.col("n") - F.col("top.n"), F.col("shingles") - F.col("top.shingles")).alias("rest_parts"),
    )
    dealt = rows.join(materialize(sizes, "similar-families"), "family")
    own = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["family", "i", "j", "side", "doc_id", "component", "fp", "shingles"]
    rest = dealt.where("component <> base").withColumn("i", own("rest_parts")).withColumn("j", spread("all_parts")).withColumn("side", F.lit(0))
    every = dealt.withColumn("j", own("all_parts")).withColumn("i", spread("rest_parts")).withColumn("side", F.lit(1))
    keys = ["family", "i", "j"]
    grouped = rest.select(columns).unionByName(every.select(columns)).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        for frame in whole_groups(batches, keys):
            fps, ids, a, b = frame["fp"].to_numpy().view(np.uint64), frame["doc_id"].to_numpy(), [], []
            sets, component, side = frame["shingles"].tolist(), frame["component"].to_numpy(), frame["side"].to_numpy()
            for x, y in group_edges(frame, keys):
                for m, n in joining_links(fps[x:y], sets[x:y], component[x:y], side[x:y], similarity, radius):
                    a.append(ids[x + m])
                    b.append(ids[x + n])
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"a": pd.Series(a, dtype=ids.dtype), "b": pd.Series(b, dtype=ids.dtype)}), preserve_index=False)

    return materialize(grouped.mapInArrow(run, f"a {kind}, b {kind}"), "family-links")


def similar_links(sketches: DataFrame, similarity: float, radius: int, chunk: int = CHUNK, shingle: int = 5) -> DataFrame:
    """(a, b) links that connect all documents that share a key and have a Jaccard index of at least the similarity.

    First each key's documents are compared with its least one, then those that are still apart by families. Keys and
    fingerprints only choose pairs: each link is a pair whose whole shingle sets were compared.
    """
    keyed = sketches.select("doc_id", F.explode(F.array_distinct("keys")).alias("key"))
    sizes = keyed.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least < last").drop("last")
    shared = materialize(keyed.join(materialize(sizes, "similar-sizes"), "key"), "similar-shared")
    ids = materialize(shared.select("doc_id").distinct(), "similar-ids")
    held = materialize(shingle_sets(sketches.join(ids, "doc_id", "left_semi"), shingle), "shingle-sets")
    stars = materialize(shared.where("doc_id <> least").select(F.col("least").alias("a"), F.col("doc_id").alias("b")).distinct(), "similar-stars")
    fps = held.select("doc_id", "fp")
    marked = materialize(stars.join(fps.withColumnsRenamed({"doc_id": "b", "fp": "fb"}), "b"), "similar-marked")
    marked = marked.join(fps.withColumnsRenamed({"doc_id": "a", "fp": "fa"}), "a").where(F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= radius)
    links = exact_links(materialize(marked.select("a", "b").distinct(), "similar-near"), held, similarity)
    return links.unionByName(family_links(shared, held, connected_components(links), similarity, radius, chunk)).distinct()


def similar_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = SIMILAR_RADIUS) -> DataFrame:
    """(doc_id, component_id) of every document that is linked to another of at least the similarity, by the Jaccard
    index of their shingles.

    At 0.8 fingerprints of the different shingles differ by about 10 of 64 bits, more than bit blocks can key; so groups
    come from bands of min-hashes of the same shingles, the pivot table discards pairs of a group beyond the radius, and
    the survivors' whole shingle sets are compared. Documents without words are similar to none.
    """
    sketches = materialize(similarity_sketches(docs.where(F.col(id_col).isNotNull()), id_col, text_col, shingle), "sketches")
    return connected_components(similar_links(sketches, similarity, radius, shingle=shingle)).select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one document, that with the smallest id, of each group of near copies; all columns stay."""
    found = similar_duplicates(docs, id_col, text_col, shingle, similarity)
    extra = materialize(found.where("doc_id <> component_id").select("doc_id"), "near-extra")
    return docs.join(extra, docs[id_col] == extra["doc_id"], "left_anti")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs; a component's id is the smallest doc_id in it."""
    marked = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    components = connected_components(near_links(nodes.where("node IS NOT NULL"), radius))
    named = nodes.join(components, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    named = materialize(named, "simhash-components")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def op4_simhash_near_dedup(spark, sf_dir):
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
