"""Hunks are cut by expressions over whole diffs; no function is called for each line."""

from pairquarry.functions import blocks

DIFF = "--- a\n@@ -3,2 +4 @@ lemma no\n-old\n+new\n\n theorem\tx.y' z\n lemma\n b\n@@ -x @@\n@@ -7 +8,0 @@\r\n-def d\n+instance e"


def test_hunks_of_odd_diffs(spark):
    rows = [(1, DIFF), (2, DIFF[6:]), (3, ""), (4, "no hunk\n@@ -1 +1"), (5, None), (6, "@@ -1 +1 @@")]
    found = blocks.hunks_of(spark.createDataFrame(rows, "k int, diff string"), "diff", "k")
    first = (1, 3, 2, 4, 1, ["old", "theorem\tx.y' z", "lemma", "b"], ["new", "theorem\tx.y' z", "lemma", "b"], ["theorem\tx.y' z", "lemma", "b"], "x.y'")
    second = (2, 7, 1, 8, 0, ["def d"], ["instance e"], [], "d")
    bare = (1, 1, 1, 1, 1, [], [], [], None)
    assert sorted(tuple(r) for r in found.collect()) == [(1, *first), (1, *second), (2, *first), (2, *second), (6, *bare)]
    assert "lambda" not in found._jdf.queryExecution().executedPlan().toString()
