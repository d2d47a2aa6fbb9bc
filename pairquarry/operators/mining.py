"""Before/after pairs: token bags, thresholds, name matching, last and first wins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairquarry.functions import text

# A pair counts from so many changed tokens, and from this share of the shorter side's tokens.
MIN_CHANGED, MIN_SHARE = 3, 0.05


#: Pairs whose tokens are counted at once; memory only.
SLICE = 256


def balances(one: pa.ListArray, other: pa.ListArray) -> list[np.ndarray]:
    """n_initial, n_final, added and removed of each pair of token lists: equal tokens of a pair are one number, and the
    sorted numbers are counted by their runs."""
    n = len(one)
    sizes = [pc.list_value_length(side).to_numpy(zero_copy_only=False).astype(np.int64) for side in (one, other)]
    codes = pa.concat_arrays([one.flatten(), other.flatten()]).dictionary_encode()
    row = np.concatenate([np.repeat(np.arange(n), s) for s in sizes])
    keys = row * max(1, len(codes.dictionary)) + codes.indices.to_numpy(zero_copy_only=False)
    # The side is the lowest bit, so that a run's sum tells how its tokens are shared.
    keys = np.sort(2 * keys + (np.arange(len(keys)) >= sizes[0].sum()))
    token, sign = keys >> 1, 2 * (keys & 1) - 1
    start = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(keys) else np.zeros(0, np.int64)
    net = np.add.reduceat(sign, start) if len(keys) else sign
    owner = token[start] // max(1, len(codes.dictionary))
    total = lambda x: np.bincount(owner, weights=x, minlength=n).astype(np.int64)
    return [*sizes, total(np.maximum(net, 0)), total(np.maximum(-net, 0))]


def bag_diff(pairs: DataFrame, key: str, initial: str, final: str, *carried: str) -> DataFrame:
    """key, carried columns, n_initial, n_final, added, removed: tokens that one side has more often, as multisets, order apart.

    Tokens are numbered and their balance is summed for many pairs at once, without a shuffle. A null side has no tokens.
    """
    none = F.array().cast("array<string>")
    split = pairs.select(key, *carried, F.coalesce(text.tokens(F.col(initial)), none).alias("one"), F.coalesce(text.tokens(F.col(final)), none).alias("other"))
    kept, counts = [key, *carried], ["n_initial", "n_final", "added", "removed"]

    def run(batches):
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            found = balances(batch.column(len(kept)), batch.column(len(kept) + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *map(pa.array, found)], names=[*kept, *counts])

    schema = T.StructType([*split.select(*kept).schema.fields, *(T.StructField(c, T.LongType()) for c in counts)])
    return split.mapInArrow(run, schema)


def migration_only(initial: Column, final: Column) -> Column:
    """Whether the sides differ at most by the refine' migration and its placeholders."""
    plain = lambda c: text.strip(F.replace(F.replace(c, F.lit("refine'"), F.lit("refine")), F.lit(" _"), F.lit(" ?_")))
    return plain(initial) == plain(final)


def meaningful(added: Column, removed: Column, n_initial: Column, n_final: Column, migrated: Column) -> Column:
    changed, shorter = added + removed, F.least(n_initial, n_final)
    return ~migrated & (changed >= MIN_CHANGED) & ~((shorter > 0) & (changed / shorter < MIN_SHARE))


def last_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key by order; a maximum, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def matched_blocks(initial: DataFrame, final: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Both sides' last block of each name, joined; unnamed blocks never match. Columns get a side's prefix."""
    named = lambda df: last_wins(df.where(F.col(keys[-1]).isNotNull()), keys, order)
    prefixed = lambda df, p: df.select(*keys, *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c not in keys])
    return prefixed(named(initial), "initial").join(prefixed(named(final), "final"), keys)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join in which null keys equal each other; left's keys stay."""
    r = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [left[k].eqNullSafe(r[f"__{k}"]) for k in keys]
    return left.join(r, on, how).drop(*[f"__{k}" for k in keys])


def multiset_minus(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.exceptAll(right)


def two_key_decisions(rows: DataFrame, order: str, first_key: str, second_key: str, written, rounds: int = 3, small: int = 10_000) -> DataFrame:
    """Ordered greedy dedup on two keys: rows by descending order, each kept unless a kept one before it shares a key with it.

    order, and why a row goes: first_key or second_key, whichever of the two, in this order, a kept row before it holds;
    null for those that stay. order must be unique; null keys equal each other.

    A row with no larger undecided row on either key stays, and rows sharing a key with one that stays go: `rounds` times, with maxima
    per key. Where keys repeat at random that decides nearly all. What is left falls apart into components of
    rows that share keys, found in rounds that grow with the logarithm of a chain's length; those of up to `small` rows are gone through row by row, each by
    one task, and only larger ones take further rounds of the first kind.
    written(df, name) stores a table between rounds.
    """
    keys = rows.select(F.col(order).alias("row"), F.col(first_key).alias("a"), F.col(second_key).alias("b"))
    undecided, kept = written(keys, "undecided"), keys.limit(0)
    for _ in range(rounds):
        if undecided.isEmpty():
            break
        kept, undecided = one_round(undecided, kept, written)
    if not undecided.isEmpty():
        labelled = written(undecided.join(key_components(undecided, written), "row"), "components")
        sizes = labelled.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
        few = labelled.join(sizes.where(F.col("size") <= small), "component", "left_semi")
        kept = written(kept.unionByName(few.groupBy("component").applyInPandas(kept_in_turn, keys.schema)), "kept")
        undecided = written(labelled.join(sizes.where(F.col("size") > small), "component", "left_semi").select("row", "a", "b"), "undecided")
        while not undecided.isEmpty():
            kept, undecided = one_round(undecided, kept, written)
    # A key is held by one kept row at most.
    by_first = kept.select(F.col("row").alias("first_row"), F.col("a").alias("held_a"))
    marked = keys.join(by_first, keys["a"].eqNullSafe(F.col("held_a")), "left").join(kept.select("row", F.lit(True).alias("stays")), "row", "left")
    why = F.when(F.col("stays"), None).when(F.col("first_row") > F.col("row"), first_key).otherwise(second_key)
    return marked.select(F.col("row").alias(order), why.alias("reason"))


def one_round(undecided: DataFrame, kept: DataFrame, written) -> tuple[DataFrame, DataFrame]:
    """The rows that are the largest of both their keys join the kept ones; what shares a key with them is decided too."""
    top = lambda k: written(undecided.groupBy(k).agg(F.max("row").alias(f"top_{k}")).withColumnRenamed(k, f"of_{k}"), f"top-{k}")
    a, b = top("a"), top("b")
    marked = undecided.join(a, undecided["a"].eqNullSafe(a["of_a"])).join(b, undecided["b"].eqNullSafe(b["of_b"]))
    best = written(marked.where("row = top_a AND row = top_b").select("row", "a", "b"), "best")
    gone = lambda df, k: df.join(best.select(F.col(k).alias("k")).distinct(), df[k].eqNullSafe(F.col("k")), "left_anti")
    return written(kept.unionByName(best), "kept"), written(gone(gone(undecided, "a"), "b"), "undecided")


def key_components(rows: DataFrame, written) -> DataFrame:
    """(row, component): rows(row, a, b) that are linked by shared keys have the least row of them all.

    Rows of a key are linked to its least row. Links are then turned towards ever lesser rows: those of a row's greater
    neighbours, then of its lesser ones (large and small stars), until every row is linked to its component's least alone."""
    star = lambda k: rows.join(rows.groupBy(k).agg(F.min("row").alias("least")).withColumnRenamed(k, "k"), rows[k].eqNullSafe(F.col("k"))).where("row > least").select(F.col("row").alias("u"), F.col("least").alias("v"))
    links = written(star("a").unionByName(star("b")).distinct(), "links")

    def turned(links: DataFrame, large: bool) -> DataFrame:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        met = both.join(least, "u")
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return out.where("u > v").distinct()

    while True:
        following = written(turned(written(turned(links, True), "links"), False), "links")
        if following.exceptAll(links).isEmpty() and links.exceptAll(following).isEmpty():
            break
        links = following
    return rows.select("row").join(links.groupBy(F.col("u").alias("row")).agg(F.min("v").alias("component")), "row", "left").select("row", F.coalesce("component", "row").alias("component"))


def kept_in_turn(pdf):
    """The rows of a component that stay, gone through one by one."""
    held_a, held_b, stays = set(), set(), []
    pdf = pdf.sort_values("row", ascending=False)
    for a, b in zip(pdf["a"], pdf["b"], strict=True):
        stays.append(a not in held_a and b not in held_b)
        if stays[-1]:
            held_a.add(a)
            held_b.add(b)
    return pdf.loc[stays, ["row", "a", "b"]]


def newest_of_two_keys(rows: DataFrame, order: str, first_key: str, second_key: str, written) -> DataFrame:
    """The rows that two_key_decisions lets stay."""
    stays = two_key_decisions(rows, order, first_key, second_key, written).where("reason IS NULL")
    return rows.join(stays.select(order), order, "left_semi")


def by_priority_within_budget(comments: Column, budget: int) -> Column:
    """The texts of comments (array of struct(priority, position, text), sorted) that fit the budget.

    A group's texts are taken up to the first that is longer than what is left; each costs its length and one. The
    next group is still looked at, unless nothing is left at the end of a group.
    """
    start = F.struct(F.lit(budget).cast("long").alias("left"), F.lit(-1).cast("int").alias("group"), F.lit(False).alias("stopped"), F.lit(False).alias("over"), F.array().cast("array<string>").alias("taken"))

    def step(s, c):
        fresh = c["priority"] != s["group"]
        over = s["over"] | (fresh & (s["group"] >= 0) & (s["left"] <= 0))
        stopped = F.when(fresh, F.lit(False)).otherwise(s["stopped"]) | (F.length(c["text"]) > s["left"])
        takes = ~over & ~stopped
        return F.struct(
            F.when(takes, s["left"] - F.length(c["text"]) - 1).otherwise(s["left"]).cast("long").alias("left"),
            c["priority"].cast("int").alias("group"),
            stopped.alias("stopped"),
            over.alias("over"),
            F.when(takes, F.concat(s["taken"], F.array(c["text"]))).otherwise(s["taken"]).alias("taken"),
        )

    return F.aggregate(comments, start, step, lambda s: s["taken"])
