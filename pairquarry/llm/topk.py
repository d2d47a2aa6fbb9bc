"""Exact top-k inner products: a ball tree per shard, branch and bound with a shared k-th score.

Vectors are dealt to shards by a hash of their id, each vector to one. A shard's task builds its tree once and streams the
queries that were sent to it, a batch at a time, so that its memory is bounded by the shard. A query goes through the
shards in three rounds: one shard, as many as the square root of their number, the rest. The k-th best score of the
rounds before bounds its search in a shard, which visits nodes in order of their inner-product upper bound q.c + |q| r and
stops at the first that can't reach the current k-th place.
Only queries are copied, one to a shard: with 100 million vectors, 2 % of them queries, and 65,536 vectors a shard, 3
billion small rows. Scores are exact; bounds carry a slack for rounding. Equal vectors of a shard are one point with its
smallest ids, so a vector with many copies costs one visit.

Results for odd input: vectors that are null, hold null or non-finite components, or have a null id take no part;
vectors are compared with those of the same length only; ties go to the smaller id; rows repeating an id and its
vector count once; fewer candidates than k give fewer rows; scores beyond the range of a long, of huge components, count
as its ends; an empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

import heapq
import math
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairquarry.llm.shared import materialize

#: Most vectors of a shard, and queries that are searched together; a shard of 64 components is some 100 MB.
SHARD_ROWS = 65_536
BLOCK_ROWS = 2048
LEAF_ROWS = 128
SLACK = 1e-9
LONG = 2**63 - 1


class BallTree:
    """Nodes in arrays; a leaf holds the points order[start:end]."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(points))
        self.center, self.radius, self.span, self.children = [], [], [], []
        self.split(points.astype(np.float64), leaf_rows)
        self.center, self.radius = np.array(self.center), np.array(self.radius)

    def split(self, points: np.ndarray, leaf_rows: int) -> None:
        todo = [(0, len(points), -1)]
        while todo:
            start, end, parent = todo.pop()
            own = points[self.order[start:end]]
            center = own.mean(axis=0)
            away = np.sqrt(((own - center) ** 2).sum(axis=1))
            node = len(self.span)
            self.center.append(center)
            self.radius.append(away.max())
            self.span.append((start, end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if end - start > leaf_rows and away.max() > 0:
                a = own[away.argmax()]
                b = own[((own - a) ** 2).sum(axis=1).argmax()]
                along = np.argsort(own @ (b - a), kind="stable")
                self.order[start:end] = self.order[start:end][along]
                middle = (start + end) // 2
                todo += [(start, middle, node), (middle, end, node)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product of every query with every node's points."""
        length = np.sqrt((queries**2).sum(axis=1))[:, None]
        reach = np.sqrt((self.center**2).sum(axis=1)) + self.radius
        return queries @ self.center.T + length * self.radius + SLACK * length * reach + SLACK


class Shard:
    """The vectors of a shard, in double precision as long as their components are whole numbers below 2**53."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        points, which = np.unique(vectors, axis=0, return_inverse=True)
        by_id = np.lexsort((ids, which.ravel()))
        edges = np.searchsorted(which.ravel()[by_id], np.arange(len(points) + 1))
        self.points, self.sorted_ids, self.edges = points, ids[by_id], edges
        self.largest = np.abs(points).max(initial=0)
        self.tree = BallTree(points)

    def ids(self, point: int, n: int) -> list[int]:
        return self.sorted_ids[self.edges[point] : min(self.edges[point + 1], self.edges[point] + n)].tolist()

    def products(self, inside: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return self.points[inside] @ query
        # Products of numbers that doubles can't hold, in whole numbers of any size.
        whole = [sum(int(a) * int(b) for a, b in zip(p, query, strict=True)) for p in self.points[inside].tolist()]
        return np.array([max(-LONG - 1, min(LONG, x)) for x in whole], object)

    def search(self, queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query's place, id, score) of the best k of this shard that can still be among the best k of all."""
        tree, out = self.tree, []
        limits = np.nan_to_num(tree.bounds(queries), nan=np.inf, posinf=np.inf)
        for i, (query, own, floor) in enumerate(zip(queries, query_ids.tolist(), floors.tolist(), strict=True)):
            exact = self.largest * np.abs(query).max(initial=0) * len(query) < 2.0**53
            best: list[tuple[int, int]] = []  # (score, -id), the worst first
            heap = [(-limits[i, 0], 0)]
            while heap:
                limit, node = heapq.heappop(heap)
                worst = max(floor, best[0][0]) if len(best) == k else floor
                if -limit < worst:
                    break
                if tree.children[node]:
                    for child in tree.children[node]:
                        heapq.heappush(heap, (-limits[i, child], child))
                    continue
                start, end = tree.span[node]
                inside = tree.order[start:end]
                scores = self.products(inside, query, exact)
                for j in np.flatnonzero(scores >= worst).tolist():
                    # One more than k of a point's ids, as the query's own may be among them.
                    for c in self.ids(inside[j], k + 1):
                        if c != own:
                            entry = (int(scores[j]), -c)
                            if len(best) < k:
                                heapq.heappush(best, entry)
                            elif entry > best[0]:
                                heapq.heapreplace(best, entry)
            out += [(i, -c, s) for s, c in best]
        return out


def searched(points: DataFrame, asks: DataFrame, k: int, name: str) -> DataFrame:
    """points: id, v, dim, shard; asks: id, v, dim, shard, floor. A shard's vectors sort before its queries, so its tree
    is complete when the first query comes; a query without vectors in its shard gives nothing."""
    vectors = points.select("dim", "shard", F.lit(0).alias("side"), "id", "v", F.lit(0).cast("long").alias("floor"))
    wanted = asks.select("dim", "shard", F.lit(1).alias("side"), "id", "v", "floor")
    dealt = vectors.unionByName(wanted).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "side")

    def run(batches):
        key, ids, rows, shard = None, [], [], None
        for batch in batches:
            dims, shards, sides = (batch.column(i).to_numpy() for i in range(3))
            edge = np.flatnonzero(np.append(True, (dims[1:] != dims[:-1]) | (shards[1:] != shards[:-1]) | (sides[1:] != sides[:-1])))
            for a, b in zip(edge.tolist(), [*edge[1:].tolist(), batch.num_rows], strict=True):
                if (dims[a], shards[a]) != key:
                    key, ids, rows, shard = (dims[a], shards[a]), [], [], None
                part = batch.slice(a, b - a)
                own, values = part.column(3).to_numpy(), part.column(4).flatten().to_numpy().reshape(b - a, dims[a])
                if sides[a] == 0:
                    ids.append(own)
                    rows.append(values)
                    continue
                if shard is None and ids:
                    shard = Shard(np.concatenate(rows), np.concatenate(ids))
                    ids, rows = [], []
                for at in range(0, b - a if shard else 0, BLOCK_ROWS):
                    some = slice(at, at + BLOCK_ROWS)
                    found = shard.search(values[some], own[some], part.column(5).to_numpy()[some], k)
                    if found:
                        where, c, score = zip(*found, strict=True)
                        take = pa.array([at + w for w in where], pa.int64())
                        yield pa.RecordBatch.from_arrays([part.column(3).take(take), part.column(4).take(take), pa.array(c, pa.int64()), pa.array(score, pa.int64())], names=["query_id", "q", "vec_id", "score"])

    return materialize(dealt.mapInArrow(run, "query_id long, q array<double>, vec_id long, score long"), name)


def rounds(shards: int) -> list[int]:
    """Where the rounds over a query's shards begin and end."""
    return sorted({0, 1, 1 + math.isqrt(shards - 1), shards})


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query among what was found, with their ranks."""
    place = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", "q", "vec_id", "score").withColumn("rank", place).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "vector", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows of vectors with the highest inner product.

    vectors, queries: id_col (long) and vector_col (array of whole numbers). A query's own id is no candidate for it.
    """
    tidy = lambda df: df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).distinct().withColumn("dim", F.size("v"))
    points, asks = materialize(tidy(vectors), "topk-vectors"), materialize(tidy(queries), "topk-queries")
    # As many shards as their size asks for, and no fewer than there are cores to search them.
    count = points.count()
    shards = max(1, -(-count // shard_rows), min(points.sparkSession.sparkContext.defaultParallelism, count // BLOCK_ROWS))
    place = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(shards)).cast("int")
    points = points.withColumn("shard", place(0))
    lowest = F.lit(-(2**63)).cast("long")
    bounded, found = asks.withColumn("floor", lowest), None
    for n, (start, end) in enumerate(pairwise(rounds(shards))):
        # Each query begins at a shard of its own, so that no shard gets all queries of a round.
        sent = bounded.withColumn("turn", F.explode(F.sequence(F.lit(start), F.lit(end - 1)))).withColumn("shard", F.pmod(place(1) + F.col("turn"), F.lit(shards)))
        part = searched(points, sent, k, f"topk-round-{n}")
        found = best(part if found is None else part.unionByName(found.drop("rank")), k)
        kth = found.groupBy("query_id", "q").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).drop("n")
        bounded = asks.join(kth, (F.col("id") == F.col("query_id")) & (F.col("v") == F.col("q")), "left").select("id", "v", "dim", F.coalesce("kth", lowest).alias("floor"))
    return found.select("query_id", "rank", "vec_id", "score")


def quantized(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector): floor(256 x) of each component, a whole number as a double; only vectors whose components are all finite."""
    x = F.transform("embedding", lambda v: v.cast("double") * 256)
    # not < infinity holds for NaN too, which Spark orders above all numbers; null is tested by itself
    finite = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v.cast("double") * 256) < float("inf")))
    # From 2**52 on a double is a whole number as it is; F.floor would cut it at the range of a long.
    whole = lambda v: F.when(F.abs(v) < 2.0**52, F.floor(v).cast("double")).otherwise(v)
    return embeddings.where(F.col("embedding").isNotNull() & finite).select("vec_id", F.transform(x, whole).alias("vector"))


def op9_exact_topk(spark, sf_dir):
    vectors = quantized(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
