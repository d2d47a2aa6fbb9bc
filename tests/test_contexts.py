import random

import pytest

from pairquarry.operators import contexts

PAIRS, COMMENTS, REMARKS = "pair long, pr long, path string, declaration string", "pr long, path string, position long, text string, diff_hunk string", "pr long, position long, text string"


def by_hand(pairs, comments, remarks, budget):
    found = {}
    for pair, pr, path, declaration in pairs:
        groups = [[], [], []]
        for of, where, position, text, hunk in comments:
            if pr is not None and of == pr and path is not None and where == path:
                groups[0 if declaration and declaration in (hunk or "") else 1].append((position, text or ""))
        groups[2] = [(position, text or "") for of, position, text in remarks if of == pr and pr is not None]
        left, taken = budget, []
        for group in groups:
            for _, text in sorted(group):
                if len(text) > left:
                    break
                taken.append(text)
                left -= len(text) + 1
            if left <= 0:
                break
        found[pair] = (len(taken), "\n\n".join(taken) if taken else contexts.NOTHING)
    return found


def by_spark(spark, pairs, comments, remarks, budget):
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((pairs, PAIRS), (comments, COMMENTS), (remarks, REMARKS))]
    return {r["pair"]: (r["n_taken"], r["context"]) for r in contexts.review_contexts(*frames, budget).collect()}


@pytest.mark.parametrize("budget", [25, 90])
def test_contexts_equal_those_made_by_hand(spark, budget):
    rng = random.Random(budget)
    names = ["a", "add", "add_comm", "add_comm_monoid", "Nat.succ_le", "ℕ𝔸_lift.x", "x\ny", "", None]
    hunk = lambda: rng.choice([None, "", "@@ " + " ".join(rng.choice([n or "zz" for n in names]) + rng.choice(["", "'", "s"]) for _ in range(rng.randint(1, 3)))])
    text = lambda: rng.choice([None, "", "t" * rng.randint(1, 12), "u" * rng.randint(20, 120)])
    path = lambda: rng.choice(["A", "B", None])
    comments = [(rng.randint(1, 3), path(), i // 2, text(), hunk()) for i in range(160)]
    remarks = [(rng.randint(1, 4), i // 2, text()) for i in range(30)]
    pairs = [(i, rng.choice([1, 2, 3, 4, 5, None]), path(), rng.choice(names)) for i in range(80)]
    assert by_spark(spark, pairs, comments, remarks, budget) == by_hand(pairs, comments, remarks, budget)


def test_a_hot_file_gives_each_pair_only_what_it_can_reach(spark):
    """300 comments by 300 pairs of one file; one declaration is named by all comments but ten."""
    comments = [(1, "A", i, f"text {i:03}", "@@ popular" if i >= 10 else "@@ other") for i in range(300)]
    pairs = [(i, 1, "A", "popular" if i == 7 else f"lonely_{i}") for i in range(300)]
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((pairs, PAIRS), (comments, COMMENTS))]
    none = spark.createDataFrame([], REMARKS)
    rows = contexts.reachable_comments(*frames, none, 40).groupBy("pair", "priority").count().collect()
    assert max(r["count"] for r in rows) <= 10 and len(rows) == 301
    assert by_spark(spark, pairs, comments, [], 40) == by_hand(pairs, comments, [], 40)
    assert contexts.named_hunks(frames[1], frames[0]).count() == 1


def test_no_pairs_and_no_comments(spark):
    assert by_spark(spark, [], [(1, "A", 1, "t", "h")], [], 40) == {}
    assert by_spark(spark, [(1, 1, "A", "h")], [], [], 40) == {1: (0, contexts.NOTHING)}
