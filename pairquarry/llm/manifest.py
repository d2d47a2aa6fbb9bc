"""Merkle manifest of a table: a digest for each row, a tree for each group, a tree over the groups, proofs for all rows.

A leaf is the digest of a row's columns. In each group the leaves ascend by id; every FAN consecutive nodes become the
digest of their digests, level by level, until one is left, the group's subroot; the subroots, ordered by group, likewise
give the root. A row's proof holds, for each level, the digests to the left and to the right of it in its run of FAN.

Where a leaf stands in its group isn't found by sorting the leaves, but by rank queries on a bitmap of the group's ids:

* A group's bitmap is stored as its words of 64 bits that aren't zero, keyed by (group, id >> 6). Tasks make words of their
  own rows, and words of equal keys are merged by OR.
* Directories of popcounts lie above: each level has, for 2^10 or 2^16 consecutive keys of the level below, how many rows
  come before each of them. So a window holds 65,536 entries of a few numbers at most, whatever a group holds.
* A leaf's rank is its word's count of rows before it and the popcount of the word's bits below its own: one join by the
  word's key, which at most 64 ids share.

Coordinates give keys: position div FAN^LEVELS names a block, the rest is a slot of the block's array. A block of slots is
reduced LEVELS levels at once, and its rows' parts of the proof are read off the same arrays; then blocks are the leaves
of the next round. A billion rows take four rounds, each a FAN^LEVELS-th of the one before.

Rows that repeat an id within a group are ordered by their leaves. Such ids, and the null id, are numbered apart, by a sort
over all tasks with counts for each task's range; the words know how many rows their ids stand for.

Results for odd input: a null column counts as `-` in the leaf, others as their UTF-8 bytes' count, a colon and the value, so
that no two different rows have one encoding; null ids come first in their group, the null group comes first; equal rows have
equal leaves, a place and a proof each; a lone leaf is its group's subroot, a lone subroot is the root; an empty table
gives an empty manifest; other columns, whatever their names, are kept in a struct or passed by.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairquarry.llm.shared import materialize

#: Children of a node, and levels that a block is reduced by at once.
FAN, LEVELS = 3, 6
#: Bits of an id below each level of the bitmap: words of 64, then directories of 2^10 and of 2^16 entries.
SHIFTS = (6, 16, 32, 48)
STEP = "struct<left:string,right:string>"


def h(*parts: Column | str) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(column: Column) -> Column:
    """A value as a leaf has it."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(columns: list[Column]) -> Column:
    return h(*map(field, columns))


def joined(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """a and b's further columns, by keys that may be null."""
    more = [c for c in b.columns if c not in keys]
    right = b.select(*(F.col(k).alias(f"right_{k}") for k in keys), *more)
    return a.join(right, reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"right_{k}")) for k in keys))).select(*a.columns, *more)


def numbered(rows: DataFrame, keys: list[str], name: str, size: str | None = None) -> DataFrame:
    """rows with `before`: how many rows (or how much of the column size) come before each in the order of keys, nulls first.

    Spark sorts ranges of keys; a range's total is a row, and only these totals are summed in one place."""
    size_of = F.col(size) if size else F.lit(1)
    sorted_rows = materialize(rows.orderBy(*keys).withColumns({"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), name)
    totals = sorted_rows.groupBy("range").agg(F.sum(size_of).cast("long").alias("total"))
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("range", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("offset"))
    within = F.coalesce(F.sum(size_of).over(Window.partitionBy("range").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sorted_rows.withColumn("within", within).join(offsets, "range").withColumn("before", (F.col("offset") + F.col("within")).cast("long")).drop("range", "at", "offset", "within")


def bitmap_words(ids: DataFrame) -> DataFrame:
    """(grp, k0, mask, rows): the words of each group's bitmap that aren't zero, from rows of (grp, id)."""
    word = F.shiftright(F.col("id"), SHIFTS[0])
    bit = F.expr(f"shiftleft(1L, cast(id & {2 ** SHIFTS[0] - 1} as int))")
    return ids.select("grp", word.alias("k0"), bit.alias("bit")).groupBy("grp", "k0").agg(F.bit_or("bit").alias("mask"), F.count(F.lit(1)).alias("rows"))


def with_directories(words: DataFrame) -> DataFrame:
    """words with `before`, the rows of the group in words before, and n, those of the whole group."""
    levels = [words]
    for i in range(1, len(SHIFTS)):
        up = F.shiftright(F.col(f"k{i - 1}"), SHIFTS[i] - SHIFTS[i - 1]).alias(f"k{i}")
        levels.append(levels[-1].select("grp", up, "rows").groupBy("grp", f"k{i}").agg(F.sum("rows").alias("rows")))
    # From the top down: each entry's rows before it below its parent, then the parent's own are added.
    top = len(SHIFTS) - 1
    whole = Window.partitionBy("grp")
    ahead = whole.orderBy(f"k{top}").rowsBetween(Window.unboundedPreceding, -1)
    out = levels[top].select("grp", f"k{top}", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("base"), F.sum("rows").over(whole).alias("n"))
    for i in range(top - 1, -1, -1):
        own = levels[i].withColumn(f"k{i + 1}", F.shiftright(F.col(f"k{i}"), SHIFTS[i + 1] - SHIFTS[i]))
        ahead = Window.partitionBy("grp", f"k{i + 1}").orderBy(f"k{i}").rowsBetween(Window.unboundedPreceding, -1)
        own = joined(own.withColumn("inside", F.coalesce(F.sum("rows").over(ahead), F.lit(0))), out, "grp", f"k{i + 1}")
        out = own.withColumn("base", F.col("base") + F.col("inside")).drop("inside", f"k{i + 1}", *(["rows"] if i else []))
    return out.withColumnRenamed("base", "before")


def placed(leaves: DataFrame) -> DataFrame:
    """leaves (grp, id, leaf, ...) with pos, the place of each in its group from 0, and n, the group's number of leaves."""
    words = materialize(with_directories(materialize(bitmap_words(leaves.select("grp", "id")), "bitmap-words")), "bitmap-directories")
    below = F.expr(f"mask & ~shiftleft(-1L, cast(id & {2 ** SHIFTS[0] - 1} as int))")
    keyed = leaves.withColumn("k0", F.shiftright(F.col("id"), SHIFTS[0]))
    plain = words.where("mask IS NOT NULL AND rows = bit_count(mask)")
    found = joined(keyed, plain, "grp", "k0").withColumn("pos", F.col("before") + F.bit_count(below)).select(*leaves.columns, "pos", "n")
    odd = words.where("mask IS NULL OR rows <> bit_count(mask)")
    if odd.isEmpty():
        return found
    # Words with repeated ids, and the null id: equal rows are counted, the rest numbered in one order over all groups.
    rows = joined(keyed, odd.select("grp", "k0", F.col("before").alias("first"), "n"), "grp", "k0")
    rest = [c for c in leaves.columns if c not in ("grp", "id", "leaf")]
    counted = rows.groupBy("grp", "k0", "id", "leaf", *rest, "first", "n").agg(F.count(F.lit(1)).alias("copies"))
    order = materialize(numbered(counted, ["grp", "id", "leaf", *rest], "manifest-repeats", size="copies"), "manifest-order")
    start = order.groupBy("grp", "k0").agg(F.min("before").alias("start"))
    copy = joined(order, start, "grp", "k0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return found.unionByName(copy.withColumn("pos", F.col("first") + F.col("before") - F.col("start") + F.col("copy")).select(*leaves.columns, "pos", "n"))


def levels_of(n: Column) -> Column:
    """How many levels a tree of n leaves has above them."""
    powers = F.array(*(F.lit(FAN**i).cast("long") for i in range(40)))
    return F.size(F.filter(powers, lambda p: p < n))


def parents(nodes: Column) -> Column:
    """The level above an array of digests."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int")), lambda i: F.sha2(F.array_join(F.slice(nodes, i * FAN + 1, F.lit(FAN)), ""), 256))


def step_of(nodes: Column, i: Column) -> Column:
    """What stands left and right of the i-th digest in its run."""
    first = i - i % FAN
    left = F.array_join(F.slice(nodes, first + 1, i - first), "")
    right = F.array_join(F.slice(nodes, i + 2, first + FAN - 1 - i), "")
    return F.struct(left.alias("left"), right.alias("right"))


def block_round(nodes: DataFrame, done: int, name: str) -> tuple[DataFrame, DataFrame]:
    """nodes (grp, pos, n, digest, item), as arrays of FAN^LEVELS slots, reduced by LEVELS levels or as many as are left.

    Gives (grp, block, pos, n, item, steps), and the nodes of the next round, without items."""
    size = FAN**LEVELS
    slot = F.struct((F.col("pos") % size).alias("slot"), "digest", "item")
    block = F.floor(F.col("pos") / size).alias("block")
    # Places are dense, so that the slots in order are the array.
    arrays = nodes.groupBy("grp", "n", block).agg(F.array_sort(F.collect_list(slot)).alias("slots"))
    arrays = arrays.withColumn("left", F.least(F.lit(LEVELS), F.greatest(F.lit(0), levels_of(F.col("n")) - done))).withColumn("l0", F.col("slots.digest"))
    for i in range(1, LEVELS + 1):
        arrays = arrays.withColumn(f"l{i}", F.when(F.col("left") >= i, parents(F.col(f"l{i - 1}"))))
    every = F.array(*(F.col(f"l{i}") for i in range(LEVELS + 1)))
    arrays = arrays.select("grp", "n", "block", "slots", "left", F.slice(every, F.lit(1), F.col("left")).alias("below"), F.get(F.get(every, F.col("left")), F.lit(0)).alias("top"))

    def steps(slot: Column) -> Column:
        at = F.transform(F.col("below"), lambda nodes, i: step_of(nodes, F.floor(slot / F.pow(F.lit(FAN), i)).cast("int")))
        return at

    items = F.transform("slots", lambda s: F.struct((F.col("block") * size + s["slot"]).alias("pos"), s["item"].alias("item"), steps(s["slot"]).alias("steps")))
    written = materialize(arrays.select("grp", "n", "block", "top", items.alias("items")), name)
    return written.select("grp", "block", F.inline("items")), written.select("grp", F.col("block").alias("pos"), "n", F.col("top").alias("digest"))


def proven(nodes: DataFrame, name: str, above: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """nodes (grp, pos, n, digest, item) with their steps up to the group's top, and (grp, digest) of the tops.

    The number of rounds follows from the largest group alone."""
    largest = nodes.agg(F.max("n")).first()[0] or 1
    rounds, done, parts = 0, 0, []
    while rounds == 0 or FAN**done < largest:
        members, tops = block_round(nodes, done, f"{name}-{rounds}")
        parts.append(members)
        nodes = tops.withColumn("item", F.lit(0))
        rounds, done = rounds + 1, done + LEVELS
    return parts, nodes.select("grp", "digest")


def descend(parts: list[DataFrame], paths: DataFrame) -> DataFrame:
    """(grp, item, steps, and what paths has) of the lowest nodes, from paths (grp, steps, ...) of the tops."""
    more = [c for c in paths.columns if c not in ("grp", "steps")]
    upper = paths.withColumn("pos", F.lit(0).cast("long"))
    for members in reversed(parts):
        up = upper.select("grp", F.col("pos").alias("block"), F.col("steps").alias("up_steps"), *more)
        upper = joined(members, up, "grp", "block").select("grp", "pos", "item", F.concat("steps", "up_steps").alias("steps"), *more)
    return upper.drop("pos")


def manifest(rows: DataFrame, group_col: str, id_col: str, leaf: Column, items: list[Column]) -> DataFrame:
    """The items of every row, its leaf, steps (the proof, from the leaf up), subroot and root.

    items are kept with a row through the rounds; they should be small."""
    leaves = materialize(rows.select(F.col(group_col).alias("grp"), F.col(id_col).cast("long").alias("id"), leaf.alias("leaf"), F.struct(*items).alias("extra")), "manifest-leaves")
    at = placed(leaves).select("grp", "pos", "n", F.col("leaf").alias("digest"), F.struct("id", "leaf", "extra").alias("item"))
    parts, subroots = proven(at, "manifest-blocks")
    ordered = materialize(numbered(subroots, ["grp"], "manifest-groups"), "manifest-subroots")
    count = ordered.count()
    upper = ordered.select(F.lit(0).alias("grp"), F.col("before").alias("pos"), F.lit(count).cast("long").alias("n"), "digest", F.struct(F.col("grp").alias("own"), F.col("digest").alias("subroot")).alias("item"))
    upper_parts, root = proven(upper, "manifest-top")
    tops = descend(upper_parts, root.select("grp", F.array().cast(f"array<{STEP}>").alias("steps"), F.col("digest").alias("root")))
    paths = tops.select(F.col("item.own").alias("grp"), "steps", F.col("item.subroot").alias("subroot"), "root")
    return descend(parts, paths).select("item.id", "item.leaf", "item.extra", "steps", "subroot", "root")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(steps, leaf, lambda acc, s: h(s["left"], acc, s["right"]))


def proof_digest(steps: Column) -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def op12_merkle_manifest(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(tampered & F.contains("text", F.lit("\n")), leaf_of([*columns[:-1], F.replace("text", F.lit("\n"), F.lit(""))]))
    found = manifest(docs, "source", "doc_id", leaf_of(columns), [changed.alias("changed")])
    folds = folded(F.coalesce("extra.changed", "leaf"), F.col("steps"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), folds.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: SQL has no CRC-32: it is folded here over bytes and bits. Trees are grown level by level.
ORACLE = """
WITH RECURSIVE crc AS (
    SELECT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) AS c
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), rows AS (
    SELECT row_number() OVER () AS rid, d.*, coalesce(c % 2 = 0, false) AS hit,
           CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END AS tampered
    FROM documents d LEFT JOIN crc USING (doc_id)
), leaves AS (
    SELECT rid, doc_id, source,
           sha256(concat({head}, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
           sha256(concat({head}, coalesce(strlen(tampered) || ':' || tampered, '-'))) AS other
    FROM rows
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves
), nodes AS (
    SELECT source, 0 AS lvl, pos, n AS width, leaf AS digest FROM placed
    UNION ALL
    SELECT source, lvl + 1, pos // 3, CAST(ceil(any_value(width) / 3) AS BIGINT), sha256(string_agg(digest, '' ORDER BY pos))
    FROM nodes WHERE width > 1 GROUP BY source, lvl, pos // 3
), subroots AS (
    SELECT source, digest, lvl AS height, row_number() OVER (ORDER BY CAST(encode(source) AS BLOB) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM nodes WHERE width = 1
), tops AS (
    SELECT 0 AS lvl, pos, n AS width, digest FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 3, CAST(ceil(any_value(width) / 3) AS BIGINT), sha256(string_agg(digest, '' ORDER BY pos))
    FROM tops WHERE width > 1 GROUP BY lvl, pos // 3
), every AS (
    SELECT source, lvl, pos, digest FROM nodes WHERE width > 1
    UNION ALL
    SELECT s.source, s.height + t.lvl, t.pos, t.digest FROM tops t CROSS JOIN subroots s WHERE t.width > 1
), climb AS (
    SELECT p.rid, p.source, 0 AS lvl, p.pos AS pos, p.other AS acc, '' AS proof FROM placed p
    UNION ALL
    SELECT c.rid, c.source, c.lvl + 1, CASE WHEN c.lvl + 1 = any_value(s.height) THEN any_value(s.pos) ELSE c.pos // 3 END,
           sha256(string_agg(CASE WHEN e.pos = c.pos THEN c.acc ELSE e.digest END, '' ORDER BY e.pos)),
           c.proof || coalesce(string_agg(CASE WHEN e.pos <> c.pos THEN e.digest END, '' ORDER BY e.pos), '')
    FROM climb c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source
    JOIN every e ON e.source IS NOT DISTINCT FROM c.source AND e.lvl = c.lvl
        AND e.pos // 3 = CASE WHEN c.lvl = s.height THEN s.pos ELSE c.pos END // 3
    GROUP BY c.rid, c.source, c.lvl, c.pos, c.acc, c.proof
), last AS (SELECT rid, max_by(acc, lvl) AS acc, max_by(proof, lvl) AS proof FROM climb GROUP BY rid)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(last.proof) AS proof_sha256, last.acc AS folded_root, last.acc = r.digest AS verified
FROM placed p JOIN last USING (rid) JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN (SELECT digest FROM tops WHERE width = 1) r
""".replace("{head}", ", ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars")))
