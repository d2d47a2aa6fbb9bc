import hashlib
import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from pairquarry.llm import components, exact_dedup, simhash, substrings, topk
from pairquarry.operators import tables

ROWS = [(5, "a", "s"), (7, "a", "s"), (7, "a", "s"), (2, None, "s"), (9, "", "t"), (None, "b", "t"), (None, "b", "t"), (1, "c", "u"), (4, "long " * 5000, "u"), (3, "d", "v"), (6, "e", "v")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, s, s) for i, t, s in ROWS], "doc_id long, text string, digest string, keep_id string, salt string").repartition(3)


def expected_exact():
    groups = {}
    for i, t, _ in ROWS:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        keep, left = max(ids, key=lambda x: (x is not None, x or 0)), True
        for i in ids:
            out.append((i, keep, len(ids), left and i == keep, hashlib.sha256(t.encode()).hexdigest()))
            left = left and i != keep
    return sorted(map(repr, out))


@pytest.mark.parametrize("bits", [256, 2, 0])
def test_exact_groups_even_where_digests_collide(docs, bits):
    digest = exact_dedup.sha256 if bits == 256 else lambda t: F.unhex(F.lpad(F.hex(F.length(t) % (1 << bits)), 2, "0"))
    got = exact_dedup.exact_groups(docs, digest=digest, salts=2)
    assert sorted(repr(tuple(r)) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == expected_exact()


def test_exact_copies_are_dropped_once(docs):
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(7, "a"), (9, ""), (0, "b"), (1, "c"), (4, "long " * 5000), (3, "d"), (6, "e")])
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_the_row_that_stays_is_fixed_and_names_may_clash(spark):
    rows = [(7, "a", 3, "x"), (7, "a", 1, "y"), (7, "a", 2, "x"), (5, "a", 0, "z"), (1, "b", 9, "z")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, row int, sha string").withColumn("id", F.lit(1)).withColumn("kept_sha", F.lit("k")).withColumn("__sha", F.lit("s"))
    for n in (1, 3, 5):
        kept = exact_dedup.drop_exact_copies(odd.repartition(n))
        assert kept.columns == odd.columns and sorted((r.doc_id, r.row, r.sha, r.id, r["__sha"]) for r in kept.collect()) == [(1, 9, "z", 1, "s"), (7, 1, "y", 1, "s")]


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(40)]
    want = union(links, {x for p in links if p[0] != p[1] for x in p})
    got = components.connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text, size=3):
    import re

    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = union([(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2], fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op4_simhash_near_dedup(spark, SF).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


@pytest.mark.parametrize("group_rows", [512, 4])
def test_links_connect_all_within_the_radius(spark, group_rows):
    rng = random.Random(8)
    centers = [rng.getrandbits(64) for _ in range(6)]
    fps = set(centers)
    for c in centers:
        for _ in range(40):
            fps.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    fps = sorted(fps)
    want = union([(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2], range(len(fps)))
    nodes = spark.createDataFrame([(i, f - (1 << 64) * (f >> 63)) for i, f in enumerate(fps)], "node long, fp long")
    links = [tuple(r) for r in simhash.near_links(nodes, group_rows=group_rows).collect()]
    assert all((fps[a] ^ fps[b]).bit_count() <= 2 for a, b in links)
    assert union(links, range(len(fps))) == want


def test_a_crowded_group_is_compared_by_finer_blocks(spark):
    # 2,000 nodes with 32 bits in common, in small families: far beyond what one group may hold.
    rng = random.Random(5)
    fps = set()
    while len(fps) < 2000:
        c = 0xABCD1234 << 32 | rng.getrandbits(32)
        fps |= {c, *(c ^ (1 << rng.randrange(32)) for _ in range(rng.randrange(3)))}
    fps = sorted(fps)
    want = union([(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2], range(len(fps)))
    nodes = spark.createDataFrame([(i, f - (1 << 64) * (f >> 63)) for i, f in enumerate(fps)], "node long, fp long")
    links = [tuple(r) for r in simhash.near_links(nodes).collect()]
    assert len(links) > 800 and union(links, range(len(fps))) == want


def test_simhash_of_odd_rows(docs):
    got = sorted(((r.doc_id or 0), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert [g for g in got if g[0] in (2, 9)] == [(2, 2), (9, 2)] and [g for g in got if g[0] in (5, 7)] == [(5, 5), (7, 5), (7, 5)] and len(got) == len(ROWS)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [1024, 3])
def test_similar_documents(spark, chunk):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base = [[word() for _ in range(300)] for _ in range(8)]
    rows, want = [], {}
    for n, b in enumerate(base):
        rows.append((10 * n, " ".join(b), "clash"))
        for k in range(1, 5):
            copy = list(b)
            for _ in range(3):
                copy[rng.randrange(300)] = word()
            rows.append((10 * n + k, " ".join(copy), "clash"))
            want[10 * n + k] = 10 * n
        rows.append((10 * n + 9, " ".join(b[:150] + [word() for _ in range(150)]), "clash"))
    df = spark.createDataFrame([*rows, (990, None, ""), (991, "", ""), (992, "one two", ""), (None, "x", "")], "doc_id long, text string, fp string")
    sketches = simhash.similarity_sketches(df.where("doc_id IS NOT NULL"), "doc_id", "text", 5)
    found = components.connected_components(simhash.similar_links(sketches, 0.8, simhash.SIMILAR_RADIUS, chunk))
    assert {r.node: r.component for r in found.where("node <> component").collect()} == want
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - set(want) | {990, 991, 992, None}


def brute_shingles(text, size=5):
    words = text.lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


@pytest.mark.parametrize("chunk", [1024, 5])
def test_similar_documents_are_decided_by_their_exact_similarity(spark, chunk):
    # Changing words at the end of 404 gives pairs from just above to just below 0.8, apart from all others.
    texts = {}
    for n in range(60):
        own = [f"w{n}x{i}" for i in range(404)]
        cut = 44 if n % 2 else 45  # 356 or 355 of 400 shingles stay: 356/444 = 0.8018, 355/445 = 0.7978
        texts[2 * n], texts[2 * n + 1] = " ".join(own), " ".join([*own[:-cut], *(f"v{n}x{i}" for i in range(cut))])
    sets = {i: brute_shingles(t) for i, t in texts.items()}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert want == {(2 * n, 2 * n + 1) for n in range(1, 60, 2)}
    sketches = simhash.similarity_sketches(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id", "text", 5)
    assert {tuple(sorted(r)) for r in simhash.similar_links(sketches, 0.8, simhash.SIMILAR_RADIUS, chunk).collect()} == want


@pytest.mark.parametrize("chunk", [1024, 7])
def test_a_family_of_half_similar_texts_gives_few_links(spark, monkeypatch, chunk):
    # Short texts with two words changed each: most pairs are well below 0.8, some above, and all share keys.
    rng = random.Random(11)
    own, texts = [f"w{i}" for i in range(60)], {0: " ".join(f"w{i}" for i in range(60))}
    for n in range(1, 150):
        words = list(own)
        for at in rng.sample(range(60), 2):
            words[at] = rng.choice(["x", "y"]) + str(at)
        texts[n] = " ".join(words)
    sets = {i: brute_shingles(t) for i, t in texts.items()}
    want = union([(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8], sets)
    rows, write = {}, simhash.materialize

    def counted(df, name):
        out = write(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(simhash, "materialize", counted)
    monkeypatch.setattr(simhash, "BANDS", 64)  # so that all similar pairs share a key
    sketches = simhash.similarity_sketches(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id", "text", 5)
    found = components.connected_components(simhash.similar_links(sketches, 0.8, simhash.SIMILAR_RADIUS, chunk))
    assert {i: c for i, c in want.items() if c != i} == {r.node: r.component for r in found.where("node <> component").collect()}
    assert len(set(want.values())) > 5 and rows["family-links"] < len(texts) * (2 if chunk > 150 else -(-150 // chunk))


def test_a_line_repeated_often_hides_no_copy(spark):
    texts = {}
    for n in range(12):
        own = [f"w{n}x{i}" for i in range(304)]
        texts[2 * n], texts[2 * n + 1] = " ".join(own), " ".join([*own, *([f"v{n}x{i}" for i in range(15)] * 100)])
    found = simhash.similar_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: i - i % 2 for i in texts}


def test_a_family_of_one_component_is_not_dealt_out(spark, monkeypatch):
    own = [f"w{i}" for i in range(100)]
    texts = [(i, "  ".join(w.upper() if k % 7 == i % 7 else w for k, w in enumerate(own))) for i in range(40)]
    sketches = simhash.similarity_sketches(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text", 5)
    written, write = [], simhash.materialize

    def counted(df, name):
        out = write(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(simhash, "materialize", counted)
    links = {tuple(r) for r in simhash.similar_links(sketches, 0.8, simhash.SIMILAR_RADIUS, 4).collect()}
    assert links == {(0, i) for i in range(1, 40)}
    assert [n for name, n in written if name == "similar-opened"] == [0]


def brute_repeats(texts, window):
    seen, out = {}, {}
    for i in sorted(texts):
        words, gone = (texts[i] or "").encode().split(), set()
        for p in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[p : p + window]), i) < i:
                gone |= set(range(p, p + window))
        out[i] = (len(words), len(gone), b" ".join(w for p, w in enumerate(words) if p not in gone).decode())
    return out


@pytest.mark.parametrize(
    ("letters", "window", "phrase", "shard", "chunk", "code"), [("ab", 6, 2, 40_000, 10**7, 64), ("abcdefghij", 6, 3, 5, 300, 64), ("abcdefghijklmnopqrstuvwxyz", 8, 4, 7, 10**7, 2)]
)
def test_substrings_equal_brute_force(spark, monkeypatch, letters, window, phrase, shard, chunk, code):
    monkeypatch.setattr(substrings, "LETTERS", code)
    rng = random.Random(6)
    shared = [[rng.choice(letters) for _ in range(rng.randint(4, 25))] for _ in range(6)]
    texts = {}
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice(letters) for _ in range(rng.randint(0, 9))] + (rng.choice(shared) if rng.random() < 0.6 else [])
        texts[i] = " ".join(words)
    texts[60], texts[61], texts[62] = None, "", texts[0]
    every, changed = substrings.remove_repeats(spark.createDataFrame([*[(i, t, "x") for i, t in texts.items()], (None, texts[0], "x")], "doc_id long, text string, runs string"), window=window, phrase=phrase, shard_phrases=shard, chunk_chars=chunk)
    lost = {r.doc_id: (r.n_removed, r.kept) for r in changed.collect()}
    for i, (n, removed, kept) in brute_repeats(texts, window).items():
        assert lost.get(i, (0, " ".join((texts[i] or "").split()))) == (removed, kept), i
    assert None not in lost and every.count() == len(texts) + 1


def test_substring_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, (n, gone, kept) in brute_repeats(texts, 50).items()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.op8_substring_dedup(spark, SF).collect()} == want


def test_automata_locate_all_occurrences():
    rng = random.Random(2)
    words = [rng.choice("abc").encode() for _ in range(400)]
    phrases = [[rng.choice("abc").encode() for _ in range(3)] for _ in range(8)]
    automata = substrings.Automata()
    for n, p in enumerate(phrases):
        automata.add(p, n)
    automata.close()
    last = {tuple(p): n for n, p in enumerate(phrases)}
    assert automata.occurrences(words, 3) == [(i, last[tuple(words[i : i + 3])]) for i in range(398) if tuple(words[i : i + 3]) in last]


def test_runs_come_from_the_automata(spark):
    # Without the phrases in the shards nothing is located, whatever the documents hold.
    twice = " ".join(f"w{i}" for i in range(80))
    texts = spark.createDataFrame([(1, 1, twice, [0]), (2, 2, twice, [0])], "doc_id long, tk long, text string, shards array<int>")
    phrases = spark.createDataFrame([(0, 7, " ".join(f"w{i}" for i in range(20, 36)))], "shard int, phrase long, words string")
    assert substrings.located_runs(texts, phrases.limit(0), 50, 16, 1000).count() == 0
    assert sorted((r.doc_id, r.phrase, r.start, r.size) for r in substrings.located_runs(texts, phrases, 50, 16, 1000).collect()) == [(1, 7, 0, 70), (2, 7, 0, 70)]


def test_top_k_equals_brute_force(spark):
    rng = random.Random(9)
    vectors = {i: [rng.randint(-20, 20) for _ in range(8)] for i in range(300)}
    vectors |= {i: [20] * 8 for i in range(300, 360)} | {400: [2**20] * 8}
    rows = [(i, v, 0) for i, v in vectors.items()] + [(None, [1] * 8, 0), (500, [1, 2], 0), (0, vectors[0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>, rank int")
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 25 = 0"), 5, shard_rows=60).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in [i for i in vectors if i % 25 == 0]:
        best = sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q)[:5]
        assert sorted(got[q]) == [(n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert 500 not in got


def test_rounds():
    assert [topk.rounds(n) for n in (1, 2, 3, 5, 100)] == [[0, 1], [0, 1, 2], [0, 1, 2, 3], [0, 1, 3, 5], [0, 1, 10, 100]]


def test_later_rounds_give_only_what_can_be_among_the_best(spark):
    rng = random.Random(3)
    vectors = {i: [rng.randint(-20, 20) for _ in range(4)] for i in range(400)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, vector array<long>")
    first = len(tables.WRITTEN)
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 50 = 0"), 5, shard_rows=16).collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    for q in range(0, 400, 50):
        assert sorted(got[q]) == sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q)[:5]
    # 25 shards: one, then four more, then the last twenty, each of which could give five rows a query without a floor.
    held = [spark.read.parquet(p).count() for p in tables.WRITTEN[first:] if "topk-round" in p]
    assert len(held) == 3 and held[0] == 8 * 5 and held[1] <= 8 * 4 * 5 and held[2] < 8 * 20 * 5 / 4


def test_huge_components_have_exact_or_saturated_scores(spark):
    rows = [(0, [1.0, 2.0**52]), (1, [3.0, 2.0**52]), (2, [-1.0, 2.0**53 + 2]), (3, [3e36, 1.0]), (4, [-3e36, 1.0]), (50, [1.0, 2.0**4])]
    got = {}
    vectors = topk.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    for r in topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r.score, -r.vec_id))
    whole = {i: [int(256 * x) for x in v] for i, v in rows}
    cut = lambda x: max(-(2**63), min(2**63 - 1, x))
    for q in (0, 50):
        want = sorted(((cut(sum(a * b for a, b in zip(whole[q], v, strict=True))), -i) for i, v in whole.items() if i != q), reverse=True)
        assert sorted(got[q], reverse=True) == want


def test_vectors_that_take_no_part(spark):
    df = spark.createDataFrame([(1, [1.0, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("-inf"), 1.0]), (6, [-0.001, 0.0])], "vec_id long, embedding array<float>")
    assert {r.vec_id: r.vector for r in topk.quantized(df).collect()} == {1: [256, 128], 6: [-1, 0]}
    assert topk.top_k(topk.quantized(df).limit(0), topk.quantized(df).limit(0)).count() == 0
