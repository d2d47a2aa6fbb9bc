"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A source's target in words is its weight's share of all words, never over `cap` times its own size; what a capped
source can't take is shared again by weight. Within a source longer documents are expected more often: a document whose
size has b binary digits has the weight LEAN + b, and its expected number of copies is its weight times the source's level,
never over `cap`; the level is such that the expected words are the target. The whole part of it are certain copies,
the fraction is the document's inclusion probability p.

Each document gets the Pareto rank q = (u / (1 - u)) / (p / (1 - p)), u being uniform and fixed by seed and id, and the
source's documents with the smallest q are taken until the words that certain copies leave of its target are used up. The
size of the sample is fixed in words: it stops at the rank that comes closest to them.

Sizes of one number of digits are a class; a source has at most 64 classes, so levels and probabilities come from a
table of sources and classes. The stopping rank is found without sorting a source: ranks, as q / (1 + q), fall in bins, bins
are summed (map-side combined), a window over the bins of a source gives the bin in which the remainder ends, and
only that bin's documents are ranked one by one. So no task sees all documents of a hot source. The decision is
then local to each row. Only the table of sources, a row each, is ordered by one task: ten million sources are some
hundred megabytes.

Results for odd input: null text has size 0; a null source is a source of its own, the last; sources of size 0 get
target 0 and their documents are taken 0 times more than certain; rows repeating an id and a size are taken or left
together; an empty table gives an empty result; the row's other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairquarry.llm.shared import materialize, text_of, word_count

SEED = "mix-1"
CAP = 3
CYCLE = 3
#: Weight of a document besides the number of its size's binary digits; the larger, the more alike documents are taken.
LEAN = 8
#: Bins of ranks in one level; the second level splits the bin in which a source's remainder ends.
BINS = 4096
#: Random bits of u.
BITS = 44


def uniform_bits(id_col: Column, seed: str = SEED) -> Column:
    """BITS random bits fixed by seed and id."""
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("null"))), 256)
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, cap: int = CAP, cycle: int = CYCLE) -> DataFrame:
    """sizes(source, source_size) with weight and target. One row per source, so a single task orders them."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % cycle + 1).cast("long"))
    # Sources in the order in which they reach their cap as the level of words per weight rises.
    rising = Window.orderBy(cap * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = rising.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    levels = weighed.select(
        "*",
        ((F.sum("source_size").over(everything) - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))).alias("__level"),
    )
    # The level at which this source would fit if all before it are capped; the first that fits sets the level of all the rest.
    fits = levels.withColumn("__fits", F.when(F.col("__level") * F.col("weight") <= cap * F.col("source_size"), F.col("__level")))
    level = F.first("__fits", ignorenulls=True).over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return fits.select("source", "source_size", "weight", F.least((cap * F.col("source_size")).cast("double"), level * F.col("weight")).alias("target"))


def digits(size: Column) -> Column:
    """Number of binary digits: the class of a size."""
    return F.length(F.bin(size))


def class_plan(classes: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """classes(source, digits, words), sources(source, target, ...) as source, digits, whole copies and p of each class."""
    named = classes.alias("c").join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select("c.*", "s.target")
    weighed = named.withColumn("weight", (LEAN + F.col("digits")).cast("double"))
    # Classes in the order in which they reach the cap as the level rises: the heaviest first.
    whole = Window.partitionBy("source")
    rising = whole.orderBy(F.desc("digits"))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    spent = cap * F.coalesce(F.sum("words").over(before), F.lit(0))
    load = F.sum(F.col("words") * (LEAN + F.col("digits"))).over(rising.rowsBetween(0, Window.unboundedFollowing))
    levels = weighed.withColumn("level", F.when(load > 0, (F.col("target") - spent) / load))
    # The level at which all before a class are capped; the first at which the class itself isn't holds for all the rest.
    fits = levels.withColumn("fits", F.when(F.col("level") * F.col("weight") <= cap, F.col("level")))
    level = F.first("fits", ignorenulls=True).over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    expected = F.least(F.lit(float(cap)), F.greatest(F.coalesce(level, F.lit(float(cap))), F.lit(0.0)) * F.col("weight"))
    planned = fits.withColumn("expected", F.when(F.col("target") > 0, expected).otherwise(F.lit(0.0)))
    return planned.select("source", "digits", "words", F.floor("expected").alias("whole"), (F.col("expected") - F.floor("expected")).alias("p"))


def pareto_rank(bits: Column, p: Column) -> Column:
    """q / (1 + q) of a document: from 0 to 1, in the order of q; null where p is 0."""
    u = (bits + 0.5) / float(2**BITS)
    q = u / (1 - u) / (p / (1 - p))
    return F.when(p > 0, q / (1 + q))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: int = CAP, seed: str = SEED, bins: int = BINS) -> DataFrame:
    """One row per source and class: source_size, target, whole copies, p, and the last (rank, id) of the source that is still taken."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_of(text_col)).alias("size"), uniform_bits(F.col(id_col), seed).alias("bits"))
    base = materialize(base.withColumn("digits", digits(F.col("size"))), "mix-sizes")
    classes = materialize(base.groupBy("source", "digits").agg(F.sum("size").alias("words")), "mix-classes")
    sources = materialize(targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), cap), "mix-sources")
    plan = materialize(class_plan(classes, sources, cap), "mix-plan")
    certain = plan.groupBy("source").agg(F.sum(F.col("whole") * F.col("words")).alias("certain"), F.max("p").alias("most"))
    rest = sources.alias("s").join(certain.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source"))).select("s.source", "s.source_size", "s.target", (F.col("target") - F.col("certain")).alias("rest"), "c.most")
    rest = materialize(rest, "mix-rest")
    ranked = base.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.digits") == F.col("p.digits"))).select("d.doc_id", "d.source", "d.size", pareto_rank(F.col("bits"), F.col("p.p")).alias("rank")).where("rank IS NOT NULL")
    upto = lambda key: F.sum("words").over(Window.partitionBy("source").orderBy(*key).rowsBetween(Window.unboundedPreceding, 0))

    def ending_bin(rows: DataFrame, bounds: DataFrame, count: int, name: str) -> DataFrame:
        """The bin of each source in which its remainder ends, and what is left of it at that bin's start."""
        sums = rows.withColumn(name, F.floor(F.col("rank") * float(count))).groupBy("source", name).agg(F.sum("size").alias("words"))
        with_rest = sums.alias("s").join(bounds.alias("b"), F.col("s.source").eqNullSafe(F.col("b.source"))).select("s.*", "b.rest")
        run = with_rest.withColumn("upto", upto([name]))
        ends = run.where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")))
        return ends.select("source", name, (F.col("rest") - (F.col("upto") - F.col("words"))).alias("rest"))

    def inside(rows: DataFrame, ends: DataFrame, count: int, name: str) -> DataFrame:
        numbered = rows.withColumn("bin", F.floor(F.col("rank") * float(count)))
        return numbered.alias("d").join(ends.alias("f"), F.col("d.source").eqNullSafe(F.col("f.source")) & (F.col("bin") == F.col(f"f.{name}"))).select("d.doc_id", "d.source", "d.size", "d.rank", "f.rest")

    first = ending_bin(ranked, rest.where("rest > 0").select("source", "rest"), bins, "bin1")
    narrowed = materialize(inside(ranked, first, bins, "bin1"), "mix-narrowed")
    second = materialize(ending_bin(narrowed.drop("rest"), narrowed.select("source", "rest").distinct(), bins * bins, "bin2"), "mix-second")
    last = inside(narrowed.drop("rest"), second, bins * bins, "bin2").withColumn("words", F.col("size"))
    run = last.withColumn("upto", upto(["rank", F.col("doc_id").asc_nulls_first()]))
    # The document that crosses the remainder is taken if that comes closer than stopping before it.
    took = (F.col("upto") <= F.col("rest")) | (F.col("upto") - F.col("rest") <= F.col("rest") - (F.col("upto") - F.col("size")))
    stop = run.where(took & (F.col("upto") - F.col("size") < F.col("rest"))).groupBy("source").agg(F.max(F.struct("rank", "doc_id")).alias("stop"))
    found = (
        plan.alias("p")
        .join(rest.alias("r"), F.col("p.source").eqNullSafe(F.col("r.source")))
        .join(second.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")), "left")
        .join(stop.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
        .select(
            "p.source", "p.digits", "p.whole", "p.p", "r.source_size", "r.target", "r.rest", F.col("t.bin2").alias("from_bin"),
            F.col("e.stop.rank").alias("stop_rank"), F.col("e.stop.doc_id").alias("stop_id"),
        )
    )
    return materialize(found, "mix-stops")


def copies(plan: str, id_col: Column, bits: Column, bins: int = BINS) -> Column:
    """Times a document is taken, from its class's row of mix_plan under the alias plan."""
    c = lambda name: F.col(f"{plan}.{name}")
    rank = pareto_rank(bits, c("p"))
    # Without a stop in its last bin a source takes what lies before that bin; without a bin, all or nothing.
    before_bin = F.floor(rank * float(bins * bins)) < c("from_bin")
    to_stop = (rank < c("stop_rank")) | ((rank == c("stop_rank")) & (id_col.isNull() | F.coalesce(id_col <= c("stop_id"), F.lit(False))))
    taken = F.when(c("stop_rank").isNotNull(), to_stop).when(c("from_bin").isNotNull(), before_bin).otherwise(F.lit(True))
    return c("whole") + F.when((c("p") > 0) & (c("rest") > 0) & taken, 1).otherwise(0)


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: int = CAP, seed: str = SEED) -> DataFrame:
    """row (all columns of docs in a struct), size, source_size, target and copies (0 to cap) of each row; nothing is shuffled but small tables."""
    plan = mix_plan(docs, id_col, text_col, source_col, cap, seed)
    sized = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_of(text_col)).alias("size"))
    # Random bits below the join, where they are drawn once a row, however often the rank is looked at.
    numbered = sized.withColumn("digits", digits(F.col("size"))).withColumn("bits", uniform_bits(F.col("id"), seed))
    joined = numbered.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.digits") == F.col("p.digits")), "left")
    return joined.select("row", "size", "p.source_size", "p.target", copies("p", F.col("d.id"), F.col("d.bits")).alias("copies"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken."""
    counted = mix_counts(docs, id_col, text_col, source_col, cap, seed).where("copies > 0")
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long")))).select("row.*")


def op5_mix_sources(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted = mix_counts(docs.select("doc_id", "text", "source"))
    return counted.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, {BITS // 4}))::BIGINT AS bits FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {CYCLE} + 1 AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum({CAP} * source_size) OVER b, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
      FROM w WINDOW b AS (ORDER BY ({CAP} * source_size)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT (SELECT level FROM l WHERE level * weight <= {CAP} * source_size ORDER BY ({CAP} * source_size)::DOUBLE / weight, source NULLS LAST LIMIT 1) AS level),
t AS (SELECT source, source_size, least(({CAP} * source_size)::DOUBLE, f.level * weight) AS target FROM w, f),
k AS (SELECT d.source, length(bin(size))::BIGINT AS digits, sum(size)::BIGINT AS words, any_value(t.target) AS target
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
h AS (SELECT *, (target - ({CAP} * coalesce(sum(words) OVER b, 0))::DOUBLE) / nullif((sum(words * ({LEAN} + digits)) OVER a)::DOUBLE, 0) AS level FROM k
      WINDOW b AS (PARTITION BY source ORDER BY digits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             a AS (PARTITION BY source ORDER BY digits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
x AS (SELECT *, first(CASE WHEN level * ({LEAN} + digits)::DOUBLE <= {CAP} THEN level END IGNORE NULLS)
                OVER (PARTITION BY source ORDER BY digits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fit FROM h),
e AS (SELECT *, CASE WHEN target > 0 THEN least({CAP}::DOUBLE, greatest(coalesce(fit, {CAP}::DOUBLE), 0::DOUBLE) * ({LEAN} + digits)::DOUBLE) ELSE 0::DOUBLE END AS expected FROM x),
p AS (SELECT *, floor(expected)::BIGINT AS whole, expected - floor(expected) AS p FROM e),
o AS (SELECT source, any_value(target) - sum(whole * words)::DOUBLE AS rest FROM p GROUP BY source),
j AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, p.whole, p.p, o.rest, (bits + 0.5::DOUBLE) / {2**BITS}::DOUBLE AS u
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND length(bin(d.size)) = p.digits
      JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN o ON d.source IS NOT DISTINCT FROM o.source),
q AS (SELECT *, CASE WHEN p > 0 THEN u / (1::DOUBLE - u) / (p / (1::DOUBLE - p)) END AS q FROM j),
c AS (SELECT *, CASE WHEN p > 0 THEN sum(CASE WHEN p > 0 THEN size ELSE 0 END)
                OVER (PARTITION BY source ORDER BY q / (1::DOUBLE + q) NULLS LAST, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS upto FROM q)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN p > 0 AND rest > 0 AND upto - size < rest AND (upto <= rest OR upto - rest <= rest - (upto - size)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
