"""What a judge gets to read of a pair's review: comments on its declaration, on its file, then other remarks, within a budget.

Nothing here joins each comment with each pair of its file. Hunks are found by the names that they hold through an index of
grams, and a pair is given its file's comments only as far as its budget can reach.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairquarry.operators import mining
from pairquarry.operators.tables import written

#: Names are looked up by so many of their first characters, or by all, if they have fewer.
HEAD = 8
# The budget in characters, and what a pair without comments gets.
BUDGET, NOTHING = 12_000, "(no reviewer comments found)"


def no_texts() -> Column:
    return F.array().cast("array<string>")


def hunk_key(hunk: Column) -> Column:
    return F.sha2(hunk, 256)


def named_hunks(hunks: DataFrame, names: DataFrame) -> DataFrame:
    """(pr, path, declaration, hunk_key): which of hunks(pr, path, diff_hunk) hold which of names(pr, path, declaration), each once.

    A name may stand within a longer one. Null or empty names and null hunks give nothing. Equal hunks (a thread's comments
    share theirs) are read once. A hunk is taken apart into its different grams of the lengths that its file's names are
    looked up by, and only those whose first two characters begin such a name; what meets a name is compared in full.
    """
    names = names.where("declaration <> ''").select("pr", "path", "declaration").distinct().withColumn("gram", F.left("declaration", F.lit(HEAD)))
    start = lambda c: F.left(c, F.lit(2))
    wanted = names.groupBy("pr", "path").agg(F.collect_set(F.length("gram")).alias("lengths"), F.collect_set(start(F.col("gram"))).alias("starts"))
    different = hunks.where("diff_hunk IS NOT NULL").select("pr", "path", "diff_hunk").distinct().withColumn("hunk_key", hunk_key(F.col("diff_hunk")))
    # An empty look-ahead finds a gram at each character.
    of_length = lambda n: F.when(F.array_contains("lengths", n), F.regexp_extract_all("diff_hunk", F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1))).otherwise(no_texts())
    grams = F.filter(F.array_distinct(F.concat(*[of_length(n) for n in range(1, HEAD + 1)])), lambda g: F.array_contains("starts", start(g)))
    index = different.join(wanted, ["pr", "path"]).select("pr", "path", "hunk_key", F.explode(grams).alias("gram"))
    met = index.join(names, ["pr", "path", "gram"]).select("pr", "path", "hunk_key", "declaration")
    return met.join(different, ["pr", "path", "hunk_key"]).where(F.contains("diff_hunk", "declaration")).select("pr", "path", "declaration", "hunk_key")


def reachable_comments(pairs: DataFrame, comments: DataFrame, remarks: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(pair, priority, position, text): all comments that could enter a pair's context, for pairs(pair, pr, path, declaration),
    comments(pr, path, position, text, diff_hunk) and remarks(pr, position, text).

    Priority 1 are comments on the pair's file whose hunk names its declaration, 2 its file's other comments, 3 the remarks. A
    group is read in order up to the first text that doesn't fit, and each text costs its length and one. So a pair can't
    reach a comment of its file that more than the budget, and the cost of those that name it, comes before. Files are cut
    into stretches of one budget's cost, and a pair meets only the stretches that it can reach. pair must be unique. Texts beyond the budget are cut
    behind it, as they only end a group. Null texts count as empty; null requests and paths have no comments.
    """
    shown = F.left(F.coalesce("text", F.lit("")), F.lit(budget + 1)).alias("text")
    cost, within = (F.length("text") + 1).cast("long"), F.lit(budget + 1)
    spent = lambda *keys: F.coalesce(F.sum(cost).over(Window.partitionBy(*keys).orderBy("position", "text").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pairs = pairs.select("pair", "pr", "path", "declaration")
    on_file = comments.select("pr", "path", "position", shown, hunk_key(F.col("diff_hunk")).alias("hunk_key")).withColumn("spent", spent("pr", "path"))
    # Read three times below.
    hits = written(named_hunks(comments, pairs), "named-hunks")
    of_pair = pairs.join(hits, ["pr", "path", "declaration"])
    named = of_pair.join(on_file.drop("spent"), ["pr", "path", "hunk_key"]).select("pair", "position", "text")
    costs = named.groupBy("pair").agg(F.sum(cost).alias("named_cost"))

    first = named.withColumn("spent", spent("pair")).where(F.col("spent") <= within).select("pair", F.lit(1).alias("priority"), "position", "text")
    reaching = pairs.join(costs, "pair", "left").withColumn("reach", within + F.coalesce("named_cost", F.lit(0)))
    stretch = lambda c: F.floor(c / within)
    meets = reaching.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), stretch(F.col("reach"))))).drop("named_cost")
    near = meets.join(on_file.withColumn("stretch", stretch(F.col("spent"))), ["pr", "path", "stretch"]).where("spent <= reach")
    unnamed = near.join(of_pair.select("pair", "hunk_key"), ["pair", "hunk_key"], "left_anti")
    second = unnamed.select("pair", F.lit(2).alias("priority"), "position", "text")
    said = remarks.select("pr", "position", shown).withColumn("spent", spent("pr")).where(F.col("spent") <= within)
    third = pairs.select("pair", "pr").join(said, "pr").select("pair", F.lit(3).alias("priority"), "position", "text")
    return first.unionByName(second).unionByName(third)


def review_contexts(pairs: DataFrame, comments: DataFrame, remarks: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(pair, n_taken, context) for each pair; see reachable_comments for what is read and how."""
    rows = F.array_sort(F.collect_list(F.struct("priority", "position", "text")))
    gathered = reachable_comments(pairs, comments, remarks, budget).groupBy("pair").agg(mining.by_priority_within_budget(rows, budget).alias("taken"))
    taken = F.coalesce("taken", no_texts())
    context = F.when(F.size(taken) > 0, F.array_join(taken, "\n\n")).otherwise(NOTHING)
    return pairs.select("pair").join(gathered, "pair", "left").select("pair", F.size(taken).cast("long").alias("n_taken"), context.alias("context"))
