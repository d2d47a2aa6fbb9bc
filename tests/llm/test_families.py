"""Families of the near-dedup: texts that share a key by chance make none, and no similar pair is ruled out."""

import random

import numpy as np

from pairquarry.llm import simhash


def test_keys_shared_by_chance_make_no_family(spark, monkeypatch):
    # Half of each text is common to all: a Jaccard index of about a third, enough for many common keys.
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    common = [word() for _ in range(150)]
    texts = [(n, " ".join(common + [word() for _ in range(150)])) for n in range(40)]
    texts.append((90, texts[3][1] + " and more"))
    rows, write = {}, simhash.materialize

    def counted(df, name):
        out = write(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(simhash, "materialize", counted)
    sketches = simhash.similarity_sketches(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text", 5)
    found = {tuple(sorted(r)) for r in simhash.similar_links(sketches, 0.8, simhash.SIMILAR_RADIUS, 8).collect()}
    assert found == {(3, 90)}
    assert rows["similar-opened"] > 40 and rows["similar-members"] <= 2


def test_differences_that_are_sure_are_never_too_many():
    rng = np.random.default_rng(2)
    for size in (3, 200, 5000, 90_000):
        pool = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        for keep in (0.5, 0.9, 1.0):
            one, other = (pool[rng.random(len(pool)) < keep] for _ in range(2))
            a, b = (np.frombuffer(simhash.byte_bins(x), np.uint8) for x in (one, other))
            assert 0 <= simhash.sure_differences(a, b[None])[0] <= len(np.setxor1d(one, other))
