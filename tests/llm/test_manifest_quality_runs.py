import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
from conftest import SF

from pairquarry.llm import manifest, periodic_runs, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# Manifest


def encoded(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def grown(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def climbed(levels, pos, acc, siblings):
    for level in levels[:-1]:
        first = pos - pos % 3
        siblings += level[first:pos] + level[pos + 1 : first + 3]
        acc = digest(*level[first:pos], acc, *level[pos + 1 : first + 3])
        pos //= 3
    return acc


def plain_manifest(rows):
    """Expected rows of the query, by lists."""
    leaf = lambda r, text: digest(encoded([r[0], r[3], r[2], r[4], text]))
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: grown([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    top = grown([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for pos, (_, _, own, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            start = leaf(r, r[1].replace("\n", "")) if hit and r[1] is not None else own
            siblings = []
            found = climbed(top, at, climbed(trees[s], pos, start, siblings), siblings)
            out.append((r[0], own, trees[s][-1][0], top[-1][0], digest(*siblings), found, found == top[-1][0]))
    return sorted(out, key=str)


def queried(query, spark, tmp_path, tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return query(spark, str(tmp_path))


def doc(i, text, source="a", lang="en"):
    return i, text, lang, source, None if text is None else len(text)


def test_manifest_equals_trees_grown_by_hand(spark, tmp_path):
    """Ids of all ranges, null and repeated ones, equal rows, null groups and a group of over one block."""
    rnd = random.Random(3)
    rows = [doc(rnd.randint(-(2**62), 2**62), f"line {i}\nend{'é' * (i % 3)}", rnd.choice(["a", "b", None, "ä", ""])) for i in range(200)]
    rows += [doc(i, f"x\n{i}", "a") for i in range(100, 230)] + [doc(5000, None, "lone"), doc(63, "", "a"), doc(2**63 - 1, "max\n", "a"), doc(-(2**63), "min\n", "a")]
    rows += [doc(i % 5, f"v\n{i % 7}", rnd.choice(["a", "b"])) for i in range(60)] + [doc(None, "null id\n"), doc(None, "null id\n"), doc(None, None, None)]
    rows += [doc(i, f"t\n{i}" if i % 5 else "no break", "hot") for i in range(0, 4600, 2)]
    found = [tuple(r) for r in queried(manifest.op12_merkle_manifest, spark, tmp_path, {"documents": (rows, DOCS)}).collect()]
    assert sorted(found, key=str) == plain_manifest(rows)
    assert {r[-1] for r in found} == {True, False}


def test_lone_and_no_rows(spark, tmp_path):
    one = [doc(7, "only\nme", None)]
    for rows in (one, []):
        assert [tuple(r) for r in queried(manifest.op12_merkle_manifest, spark, tmp_path, {"documents": (rows, DOCS)}).collect()] == (plain_manifest(rows) if rows else [])


def test_manifest_keeps_columns_with_clashing_names(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i, i % 2, f"t{i}") for i in range(9)], "pos long, grp int, leaf string")
    found = manifest.manifest(rows, "grp", "pos", manifest.leaf_of([F.col("leaf")]), [F.col("leaf").alias("steps"), F.col("grp").alias("n")])
    assert {(r.id, r.extra.steps, r.extra.n, r.leaf) for r in found.collect()} == {(i, f"t{i}", i % 2, digest(encoded([f"t{i}"]))) for i in range(9)}
    assert found.where(manifest.folded(F.col("leaf"), F.col("steps")) != F.col("root")).count() == 0


# Quality


def base_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


ODD_TEXTS = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x\nx\n \nx\n\ny", "été # été # été #\n|<>\r\n&&", "a a a a a", " b c d", "w " * 70, "word" * 5000, "\n".join(f"l{i} m n" for i in range(60))]


def test_base_counts_of_odd_texts(spark, tmp_path):
    rows = [doc(i, t) for i, t in enumerate(ODD_TEXTS)]
    found = queried(quality.op11_quality_rules, spark, tmp_path, {"documents": (rows, DOCS), "labels": ([], "doc_id long, quality int, toxic int")})
    for r in found.collect():
        n, *rest = base_counts(ODD_TEXTS[r.doc_id])
        failed = n < 50 or 100 * rest[-1] > 50 * n
        # Without labels the trees keep everything.
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == (n, *rest, failed, not failed), ODD_TEXTS[r.doc_id]


def test_base_counts_and_verdicts_of_the_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = quality.op11_quality_rules(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(texts[r.doc_id])
    judged = [(r.kept, labels[r.doc_id]) for r in rows if r.doc_id in labels and not r.base_failed]
    assert np.mean([kept == bool(label) for kept, label in judged]) > 0.9


def test_trees_learn_keep_their_signs_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality.FEATURES)))
    symbols, words = quality.FEATURES.index("symbols"), quality.FEATURES.index("words")
    # The label rises with symbols in one part: the constraint must not follow it there.
    y = ((x[:, symbols] < 0.4) | (x[:, symbols] > 0.8)) & (x[:, words] > 0.3)
    trees = quality.fit_trees(x, y.astype(int))
    probe = np.repeat(rng.random((50, x.shape[1])), 40, axis=0)
    probe[:, symbols] = np.tile(np.linspace(0, 1, 40), 50)
    steps = np.diff(trees.scores(probe).reshape(50, 40), axis=1)
    assert (steps <= 1e-12).all() and (steps < 0).any()
    free = quality.Grower(x, y.astype(int), np.zeros(x.shape[1])).fit()
    assert (np.diff(free.scores(probe).reshape(50, 40), axis=1) > 0.1).any()
    assert ((free.scores(x) > 0) == y).mean() > 0.97

    def walked(row):
        total = trees.start
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
            total += trees.value[at]
        return total

    assert np.allclose(trees.scores(x[:50]), [walked(r) for r in x[:50]])


def test_held_out_labels_do_not_matter(spark, tmp_path):
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    stats = quality.statistics(docs, keep=["doc_id"])
    a, b = quality.learned(stats, labels), quality.learned(stats, turned)
    assert a.start == b.start and all((getattr(a, k) == getattr(b, k)).all() for k in ("feature", "threshold", "value"))


def test_keep_good_keeps_all_columns(spark):
    good = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, good, "x", 3, None), (1, good, "x", 3, None), (None, good, "y", 4, 2), (2, "short", "z", 5, 1)], "doc_id long, text string, row string, n_words int, features int")
    kept = quality.keep_good(docs, spark.createDataFrame([(None, 1), (77, 0), (1, None)], "doc_id long, quality int"))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, good, "x", 3, None)] * 2 + [(None, good, "y", 4, 2)], key=str)


# Periodic runs


def plain_runs(words):
    n, out = len(words), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                j = i
                while j + q < n and words[j] == words[j + q]:
                    j += 1
                size = j + q - i
                own = words[i : i + size]
                if size >= max(24, 3 * q) and not any(all(own[x] == own[x + p] for x in range(size - p)) for p in range(1, q)):
                    out.add((i, size, q))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rnd):
    words = []
    for _ in range(rnd.randint(0, 6)):
        base = [b"%d" % rnd.randint(0, rnd.choice([1, 2, 5, 1000])) for _ in range(rnd.choice([1, 2, 3, 7, 8, 9, 16, 17, 20, 33, 40]))]
        words += (base * rnd.randint(1, 6))[: rnd.randint(1, 300)]
    return words


def test_runs_equal_all_lags_compared():
    rnd = random.Random(5)
    for _ in range(150):
        lists = [random_words(rnd) for _ in range(rnd.randint(1, 5))]
        assert periodic_runs.runs_of(lists) == [plain_runs(w) for w in lists]


def test_a_period_whose_parts_repeat_inside_it():
    # Every pair of blocks occurs twice in the period, so that shorter grams than the period meet at other lags first.
    blocks = {c: [f"{c}{i}".encode() for i in range(20)] for c in "ABC"}
    period = [w for c in "ABACBCABCACB" for w in blocks[c]]
    words = period * 4
    assert periodic_runs.runs_of([words]) == [plain_runs(words)]


def test_colliding_hashes_are_told_apart(monkeypatch):
    class Same:
        def integers(self, low, high, size, kind):
            return np.ones(size, kind)

    monkeypatch.setattr(np.random, "default_rng", lambda seed: Same())
    rnd = random.Random(6)
    lists = [random_words(rnd) for _ in range(8)]
    assert periodic_runs.runs_of(lists) == [plain_runs(w) for w in lists]


def test_a_hot_gram_gives_one_pair_a_word():
    words = periodic_runs.Words([[b"a"] * 20_000])
    assert sum(len(places) for _, places, _ in periodic_runs.seeds(words)) < 3 * 20_000
    assert periodic_runs.runs_of([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]


def expected_runs(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *head, digest("".join(f"{s},{size},{q}\n" for s, size, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in drop))


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    tens = [i for i in range(10**6, 10**6 + 400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rnd = random.Random(7)
    rows += [(i, " ".join(f"w{rnd.randint(0, 40)}" for _ in range(rnd.randint(1, 400)))) for i in tens]
    rows += [(tens[0], None), (tens[1], ""), (None, "z " * 30), (1, None), (1, "z\n" * 30), (1, "z\n" * 30), (2, " ".join("ab" * 12)), (3, " ".join("abé" * 8) + " ")]
    found = queried(periodic_runs.op13_periodic_runs, spark, tmp_path, {"documents": ([(i, t) for i, t in rows], "doc_id long, text string")})
    assert sorted(map(tuple, found.collect()), key=str) == sorted((expected_runs(i, t) for i, t in rows if len(WORD.findall(t or "")) < 5000), key=str)


def test_collapse_keeps_columns_and_plain_texts(spark):
    docs = spark.createDataFrame([(1, "keep  as\tit is", "r"), (2, "x " * 40 + "end", "q"), (3, None, None)], "runs long, text string, collapsed string")
    found = periodic_runs.collapse_runs(docs)
    assert found.columns == docs.columns
    assert sorted(map(tuple, found.collect())) == [(1, "keep  as\tit is", "r"), (2, "x end", "q"), (3, None, None)]
