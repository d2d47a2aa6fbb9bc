import hashlib
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
from comparing import duck_rows, spark_rows
from conftest import SF

from pairquarry.llm import bpe, queries, token_counts

ODD = ["", None, "a", " ", "\n\n \t", "idi0t's don't  \x1c x", "naïve 漢字 🙂🙂 ½ \x85 ", "<|endoftext|> a<|endoftext|><|endo", "aaaa" * 50, "x" * 40_000, "the the the"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    assert spark_rows(queries.QUERIES[name](spark, SF)) == duck_rows(duck.sql(queries.ORACLE_SQL[name]))


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(2, "a", "again"), (None, "b", "")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_bpe_equals_the_library(spark, odd_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    got = {(r.doc_id, tuple(r.ids), r.decoded) for r in bpe.decode_documents(bpe.encode_documents(odd_docs, bpe.default_path()), bpe.default_path()).collect()}
    texts = {(r.doc_id, r.text or "") for r in odd_docs.collect()}
    want = set()
    for i, t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        want.add((i, tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == want


def test_bpe_on_random_strings():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(bpe.default_path()), bpe.ByteBpe(bpe.default_path())
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "a", "ab", "'s", "'re", "<|endoftext|>", "é", "　", "\x1c", "1", "½", "漢", "🙂", "!", "aaaa", "\xa0"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(500)]
    assert [x.tolist() for x in own.encode_batch(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    ids = [[rng.randrange(own.size) for _ in range(20)] for _ in range(300)]
    assert [own.decode(np.array(x)) for x in ids] == [library.decode(x, skip_special_tokens=False) for x in ids]


def test_bpe_query_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op10_bpe_encode_decode(spark, SF).collect()} == want


def test_bpe_of_an_empty_table(odd_docs):
    assert bpe.token_digests(odd_docs.limit(0)).count() == 0


def brute_count(text, scores, byte_score, longest):
    """Tokens of each word's best way, without a trie."""
    total = 0
    for w in (text or "").encode().split():
        word = token_counts.MARK + w.decode()
        best = [(0.0, 0)] + [None] * len(word)
        for end in range(1, len(word) + 1):
            n = len(word[end - 1].encode())
            ways = [(best[end - 1][0] + n * byte_score, best[end - 1][1] - n)]
            ways += [(best[s][0] + scores[word[s:end]], best[s][1] - 1) for s in range(max(0, end - longest), end) if word[s:end] in scores]
            best[end] = max(ways)
        total -= best[-1][1]
    return total


def test_token_counts_equal_brute_force(spark, odd_docs):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    scores = token_counts.piece_scores(path)
    own = token_counts.TrieCounter(scores)
    docs = odd_docs.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 4 = 0").select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    want = sorted((r.doc_id or -1, brute_count(r.text, scores, own.byte_score, max(map(len, scores)))) for r in docs.collect())
    assert sorted((r.doc_id or -1, r.n_tokens) for r in token_counts.count_tokens(docs, path).collect()) == want
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("n", [3, 23, 24, 60])
def test_a_shared_prefix_is_scored_once_however_few_words_share_it(monkeypatch, n):
    import public_tokenizers

    own = token_counts.TrieCounter(token_counts.piece_scores(public_tokenizers.path("piece_bpe_32k.model")))
    made = []
    below, level = token_counts.TrieCounter.below, token_counts.TrieCounter.level
    monkeypatch.setattr(token_counts.TrieCounter, "below", lambda self, *a: made.append(1) or below(self, *a))
    monkeypatch.setattr(token_counts.TrieCounter, "level", lambda self, *a: made.extend(a[-1]) or level(self, *a))
    words = sorted({"inter" * 40 + format(i, "b") for i in range(n)})
    counts = own.count_words(words)
    assert len(made) == len({w[:k] for w in words for k in range(1, len(w) + 1)})
    assert counts.tolist() == [token_counts.TrieCounter.count_words(own, [w])[0] for w in words]
