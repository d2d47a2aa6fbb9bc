import random

import pytest
from pyspark.sql import functions as F

from pairquarry.llm import chat, mixing


def test_escapes_are_undone(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(["\\", "<|", "|", "<", "n", "\n", "im_end|>", "<|im_end|>", "$1"], k=rng.randint(0, 8))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"), chat.escape_role(F.col("t")).alias("er"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("ur")).collect():
        assert r.u == r.t == r.ur and "<|" not in r.e and "\n" not in r.er and "<|" not in r.er


def test_paths_and_ranks_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for tree in range(6):
        for m in range(rng.randint(1, 30)):
            rows.append((tree, m, rng.randrange(m) if m and rng.random() < 0.95 else None, rng.choice([None, 0.0, 1.0, 2.0])))
    df = spark.createDataFrame(rows, "tree int, msg int, parent int, score double")
    node = {(t, m): (p, s or 0.0) for t, m, p, s in rows}
    want = set()
    for tree in range(6):
        mine = {m for t, m in node if t == tree}
        leaves = mine - {node[tree, m][0] for m in mine}
        paths = []
        for leaf in leaves:
            path, m = [], leaf
            while m is not None:
                path.append(m)
                m = node[tree, m][0]
            paths.append((-sum(node[tree, x][1] for x in path), leaf, path[::-1]))
        for branch, (_, leaf, path) in enumerate(sorted(paths), 1):
            want |= {(tree, leaf, branch, d, m) for d, m in enumerate(path)}
    assert {tuple(r) for r in chat.reply_paths(df, branches=None).select("tree", "leaf", "branch", "depth", "msg").collect()} == want
    assert {tuple(r) for r in chat.reply_paths(df, branches=2).select("tree", "leaf", "branch", "depth", "msg").collect()} == {w for w in want if w[2] <= 2}


def test_odd_conversations(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 2, "assistant", "b"), (None, 1, None, "x"), (3, None, "assistant", ""), (3, 1, "a\nb\\", "<|im_end|>\n<|im_start|>user\n"), (4, 1, "assistant", "z" * 100_000)]
    done = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = {r.conv_id: r for r in done.select("conv_id", chat.parsed_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    turns = {k: [tuple(t) for t in r.turns] for k, r in found.items()}
    assert turns == {1: [("user", ""), ("assistant", "b"), ("assistant", "b")], None: [("", "x")], 3: [("assistant", ""), ("a\nb\\", "<|im_end|>\n<|im_start|>user\n")], 4: [("assistant", "z" * 100_000)]}
    assert {k: r.loss for k, r in found.items()} == {1: "bb", None: "", 3: "", 4: "z" * 100_000}


def test_empty_conversations(spark):
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def brute_targets(sizes, cap=3):
    """Reshare by weight until no source is over its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, open_, out = sum(sizes.values()), set(order), {}
    while open_:
        level = total / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: cap * sizes[s] for s in over}
        total -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return out


@pytest.fixture(scope="module")
def mixed_docs(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 60))), rng.choice(["a"] * 40 + ["b"] * 3 + ["c", None, "É"]), "x") for i in range(3000)]
    return spark.createDataFrame([*rows, (3000, None, "d", "x"), (3001, " \t\x0b", "a", "x"), (None, "w w", "a", "x")], "doc_id long, text string, source string, size string")


def test_mix_meets_its_targets(mixed_docs):
    rows = mixing.mix_counts(mixed_docs).select(F.col("row.source").alias("source"), F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "copies").collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = brute_targets(sizes)
    largest = max(r.size for r in rows)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert mine[0].source_size == sizes[s] and abs(mine[0].target - want[s]) < 1e-6
        assert abs(sum(r.size * r.copies for r in mine) - want[s]) <= largest / 2 + 1
    assert all(0 <= r.copies <= 3 for r in rows)
    again = mixing.mix_counts(mixed_docs.repartition(7)).select("row.doc_id", "copies").collect()
    assert sorted(map(repr, again)) == sorted(repr(type(again[0])(doc_id=r.doc_id, copies=r.copies)) for r in rows)


def test_mix_takes_whole_rows(mixed_docs):
    taken = mixing.mix_documents(mixed_docs)
    assert taken.columns == mixed_docs.columns
    counts = {r.doc_id: r.copies for r in mixing.mix_counts(mixed_docs).select("row.doc_id", "copies").collect()}
    got = {r.doc_id: r["count"] for r in taken.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in counts.items() if n}


def test_mix_of_nothing(mixed_docs):
    assert mixing.mix_counts(mixed_docs.limit(0)).count() == 0
    assert {r.target for r in mixing.mix_counts(mixed_docs.where("doc_id = 3000")).collect()} == {0.0}


def test_longer_documents_are_taken_more_often(spark):
    # Half of the words of one source, so that no copy is certain; short and long documents compete by their odds.
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.choice([3, 3000])), "a") for i in range(1200)] + [(5000 + i, " ".join(["w"] * 1500), "b") for i in range(600)] + [(9000 + i, " ".join(["w"] * 1500), "c") for i in range(600)]
    found = mixing.mix_counts(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("row.source", "size", "copies").where("source = 'a'").collect()
    share = lambda size: sum(r.copies for r in found if r.size == size) / sum(r.size == size for r in found)
    # 8 + 12 digits against 8 + 2.
    assert {r.copies for r in found} == {0, 1} and abs(share(3000) / share(3) - 2) < 0.35


def test_ranks_are_random_odds_by_inclusion_odds(spark):
    got = spark.range(1).select(*[mixing.pareto_rank(F.lit(b), F.lit(p)).alias(f"r{n}") for n, (b, p) in enumerate([(2**42, 0.8), (2**42, 0.2), (2**43, 0.2), (2**42, 0.0)])]).first()
    odds = lambda b, p: (b + 0.5) / (2**44 - b - 0.5) / (p / (1 - p))
    want = [q / (1 + q) for q in (odds(2**42, 0.8), odds(2**42, 0.2), odds(2**43, 0.2))]
    assert got[3] is None and all(abs(g - w) < 1e-12 for g, w in zip(got[:3], want, strict=True)) and want == sorted(want)
