"""Token bags are counted for many pairs at once, not by a function called for each token."""

import re
from collections import Counter

from pairquarry.operators import mining

ROWS = [(1, "a b b c", "b a a d"), (2, None, "x"), (3, "", ""), (4, "x' y.z (", None), (5, "same\n", "same"), (6, "é eé _1", "eé é é"), (None, "q q", "q")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bags_of_odd_texts(spark, monkeypatch):
    token = re.compile(r"[a-zA-Z_][\w'.]*|\S")
    want = set()
    for k, a, b in ROWS:
        one, other = (Counter(token.findall(x or "")) for x in (a, b))
        want.add((k, f"c{k}", one.total(), other.total(), (other - one).total(), (one - other).total()))
    df = spark.createDataFrame([(k, f"c{k}", a, b) for k, a, b in ROWS], "k long, c string, a string, b string").coalesce(1)
    found = mining.bag_diff(df, "k", "a", "b", "c")
    assert {tuple(r) for r in found.collect()} == want
    assert mining.bag_diff(df.limit(0), "k", "a", "b").count() == 0
    monkeypatch.setattr(mining, "SLICE", 2)
    assert {tuple(r) for r in mining.bag_diff(df, "k", "a", "b", "c").collect()} == want


def test_no_function_is_called_for_each_token_and_counts_are_made_once(spark):
    df = spark.createDataFrame([r for r in ROWS if r[0]], "k long, a string, b string")
    kept = mining.bag_diff(df, "k", "a", "b").where("added + removed >= 3 AND added > 0 AND removed > 0")
    assert "aggregate(" not in plan(kept) and "lambda" not in plan(kept) and plan(kept).count("regexp_extract_all(") == 2
