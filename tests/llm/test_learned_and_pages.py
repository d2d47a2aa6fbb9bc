import json
import random
import time
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from pairquarry.llm import toxicity, wrappers

BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    return toxicity.learned(docs, labels)


def test_held_out_accuracy(spark, model):
    docs, labels = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    tested = toxicity.score_documents(docs.join(labels.where(toxicity.held_out()), "doc_id"), model, keep=True).select("row.*", "score").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in tested)
    score, y = np.array([r.score for r in tested]), np.array([r.toxic for r in tested])
    rank = np.argsort(np.argsort(score, kind="stable")) + 1
    area = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (y == 0).sum())
    caught = score >= toxicity.THRESHOLD
    assert area > 0.95 and y[caught].mean() > 0.85 and caught[y == 1].mean() > 0.9


def test_disguised_insults_are_found(model):
    s = toxicity.Scorer(model)
    plain, hidden, clean = s.scores(["you idiot", "you id.iot and mo-ron", "the and of in"])
    assert plain > 0.3 and hidden > 0.3 and clean < 0.3


def test_odd_texts_get_a_score(spark, model):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "x" * 200_000, 0.5), (None, "idiot", 0.5), (1, None, 0.5)], "doc_id long, text string, score double")
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    assert toxicity.drop_toxic(docs, model).columns == docs.columns


def test_without_both_classes_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score_documents(docs, toxicity.learned(docs, labels)).collect()] == [0.0]


def test_few_labels_are_enough_for_a_score(spark):
    docs = spark.createDataFrame([(1, "you utter blockhead. fine day"), (2, "fine day. good news"), (3, "what a block-head"), (4, "good day")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, toxicity.learned(docs, labels)).collect()}
    assert got[3] > got[4] and got[1] > got[2]


def test_training_takes_no_more_than_its_bounds(spark):
    docs = spark.createDataFrame([(i, "word " * 20) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    texts, y, totals = toxicity.training_sample(docs, labels, F.lit(True), "doc_id", "text", "toxic", 8, 550)
    # The text that crosses the bound is the last.
    assert (len(texts), sum(y), totals) == (12, 6, (20, 20))


def test_a_very_long_text_does_not_stand_for_all_others(spark):
    docs = spark.createDataFrame([(i, f"word {i} " * 20) for i in range(40)] + [(i, "long " * 1000) for i in range(100, 108)] + [(200, "much " * 2000), (3, "word 3 other")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in [*range(40), *range(100, 108)]] + [(200, 1)], "doc_id long, toxic int")
    texts, y, _ = toxicity.training_sample(docs, labels, F.lit(True), "doc_id", "text", "toxic", 48, 20_000)
    # Short ones first, an id once, long ones as far as there is room; a class of long texts alone keeps one.
    assert y.count(1) == 1 and sum(t.startswith("word") for t in texts) == 40 and sum(t.startswith("long") for t in texts) == 3


def test_inner_folds_score_each_training_row_once(spark):
    from pairquarry.llm import toxicity_folds

    texts = [f"you idiot {i}. fine" if i % 3 == 0 else f"a fine day {i}" for i in range(24)]
    settings = toxicity_folds.candidates(toxicity.Settings())[:2]
    scored = toxicity_folds.fold_scores(spark, texts, [int(i % 3 == 0) for i in range(24)], settings)
    assert scored.groupby("setting").size().tolist() == [24, 24] and scored[scored["setting"] == 1]["label"].sum() == 8
    assert all(0 <= x for x in toxicity_folds.figures(scored))


def brute_kernel(a, b):
    """Common subsequences of four characters, each weighted by the characters that it spans."""

    def weights(word):
        out = Counter()
        for places in combinations(range(len(word)), 4):
            span = places[-1] - places[0] + 1
            if span <= toxicity.SPAN:
                out["".join(word[p] for p in places)] += toxicity.DECAY**span
        return out

    x, y = weights(a), weights(b)
    norm = lambda w: sum(toxicity.DECAY ** (2 * (p[-1] - p[0] + 1)) for p in combinations(range(len(w)), 4) if p[-1] - p[0] < toxicity.SPAN) ** 0.5
    return (sum(v * y[k] for k, v in x.items()) / norm(a) / norm(b)) ** 2


def test_kernel_equals_brute_force():
    known = ["^idiot$", "^банан$", "^aaaaaaa$", "^漢字漢字$", "^worthless$"]
    words = ["^idiot$", "^id.iot$", "^iiddiioott$", "^aaaa$", "^банан-банан$", "^字漢字漢$", "^less-worth$", "^table$"]
    assert np.allclose(toxicity.Kernel(known).to(words), [[brute_kernel(w, k) for k in known] for w in words])


def test_kernel_is_symmetric_and_tolerates_gaps():
    k = toxicity.Kernel(["^idiot$", "^table$"])
    own = k.to(["^idiot$", "^table$"])
    assert np.allclose(own, own.T) and own[0, 1] < 0.0025
    near = k.to(["^id-iot$", "^idiott$", "^tablet$"])
    assert near[0, 0] > 0.25**2 * own[0, 0] and near[1, 0] > 0.5**2 * own[0, 0] and near[2, 0] < 0.0025


def test_kernel_keeps_all_characters_of_its_words():
    words = ["^abcdefghijklmnopqrstuvwxyz$", "^0123456789$", "^абвгдежзийклмнопрстуфхцчш$", "^щъыьэюя$", "^" + "".join(map(chr, range(0x4E00, 0x4F00))) + "$"]
    for known in (words[:4], words):
        k = toxicity.Kernel(known)
        assert np.allclose(np.diag(k.to(known)), [toxicity.Kernel([w]).to([w])[0, 0] for w in known]) and k.to(known).max(axis=1).min() > 0.1


def test_sentences_end_at_stops_and_lines():
    words, ends = toxicity.words_and_sentences("One two. Three\n\nfour! 5\n")
    assert words == ["one", "two.", "three", "four!", "5"] and toxicity.sentence_starts(words, ends).tolist() == [0, 2, 3, 4]
    assert toxicity.sentence_starts(*toxicity.words_and_sentences("\n")).tolist() == []


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a = "<p>no</p>";</script></head><body><nav><ul>{menu}</ul></nav><div class="cookie-notice">We use cookies</div>
<main><article id=a><h1>Head&amp;line</h1>{body}<aside>see also</aside><form>mail <input></form><div class="ad-box">Buy</div></article></main>
<section class="comments"><p>reader: nice</p></section><div id="sidebar">side</div><footer>foot &copy;</footer></body></html>"""


def page(n):
    return PAGE.format(menu="".join(f"<li><a href=/{i}>m{i}</a></li>" for i in range(n + 1)), body="".join(f"<p>One&nbsp;two\n  <b>th</b>ree<br>four {i}</p>" for i in range(n)))


def want(n):
    return " ".join(["Head&line", *(f"One two three four {i}" for i in range(n))])


def test_pages(spark):
    rows = [(n, "https://a.example/x", page(n % 4)) for n in range(12)]
    cut = page(2)[: page(2).index("four 1") + 4]
    rows += [(20, "https://a.example/c", cut), (21, None, page(1)), (22, "https://a.example/", None), (23, "x", "plain <b>text</b> only"), (0, "https://a.example/x", page(0)), (24, "https://b.example", "<p>a</p><p>b" + " c" * 50_000)]
    got = wrappers.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    assert {n: text[n] for n in range(12)} == {n: want(n % 4) for n in range(12)}
    assert text[20] == "Head&line One two three four 0 One two three four" and text[21] == want(1) and text[22] == "" and text[23] == "plain text only" and text[24] == "a b" + " c" * 50_000
    assert wrappers.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_without_an_article_on_a_host_where_others_have_one(spark):
    plain, mixed = "<body><div><p>t</p></div></body>", "<body><div><p>t</p></div><article><p>u</p></article></body>"
    rows = [(1, "https://a.example/1", plain), (2, "https://a.example/2", mixed), (3, "https://b.example/1", plain)]
    got = wrappers.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {1: "t", 2: "u", 3: "t"}


def test_wrappers_hold_optional_and_repeated_groups():
    streams = [wrappers.fold(s.split()) for s in ("ul li # /li li # /li /ul p # /p", "ul li # /li /ul p # /p p # /p", "ul li # /li li # /li li # /li /ul h2 # /h2 p # /p")]
    made = wrappers.wrapper_of(streams)
    assert made == ["ul", (False, True, ("li", "#", "/li")), "/ul", (True, False, ("h2", "#", "/h2")), (False, True, ("p", "#", "/p"))]
    for s in ("ul li # /li /ul p # /p", "ul li # /li li # /li /ul h2 # /h2 p # /p p # /p"):
        assert len(wrappers.Automaton(wrappers.numbered(made)).follow(s.split())) == len(s.split())


def texts_of(spark, pages):
    df = spark.createDataFrame([(n, "https://a.example/x", h) for n, h in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in wrappers.extract_main_text(df).collect()}


def test_the_wrapper_overrules_names_that_mislead(spark):
    # The text stands in a "sidebar", the same notice on all pages in a "content" block next to it.
    one = '<body><div class="content">Always the same words of welcome to all of our readers</div><div class="sidebar"><div>{}</div></div></body>'
    texts = [f"A story of its own, number {n}, with {n * 7} sheep and {n * n} goats" for n in range(9)]
    assert texts_of(spark, [one.format(t) for t in texts]) == dict(enumerate(texts))


def test_nothing_of_an_article_is_dropped_however_many_pages_share_it(spark):
    one = "<body><article><p>{}</p><div><p>Share this with your friends</p></div></article></body>"
    texts = [f"Text {n} of the series about the {n * n} lives of cats" for n in range(8)]
    for some in (texts, texts[:2], texts[:1], texts[:1] * 8):
        assert texts_of(spark, [one.format(t) for t in some]) == {n: f"{t} Share this with your friends" for n, t in enumerate(some)}


def test_without_an_article_what_different_pages_share_is_template(spark):
    one = "<body><div><b>Best of cats</b></div><p>{}</p><p>{}</p></body>"
    texts = [(f"Text {n} of the series", f"about the {n * n} lives of cats") for n in range(5)]
    assert texts_of(spark, [one.format(*t) for t in texts]) == {n: " ".join(t) for n, t in enumerate(texts)}
    # Copies of one page don't tell what is template.
    assert texts_of(spark, [one.format(*texts[0]) for _ in texts]) == dict.fromkeys(range(5), "Best of cats " + " ".join(texts[0]))


def spread(streams):
    return wrappers.numbered(wrappers.wrapper_of([wrappers.fold(s) for s in streams]))


def test_the_wrapper_alone_reads_pages():
    """Another host's wrapper, or none, with the same plan gives no text."""
    streams = [[s for s, _ in wrappers.tokens(page(n))] for n in range(3)]
    own = json.dumps(spread(streams))
    units = [(slot, path) for n in range(3) for _, slot, path in wrappers.slots_of([*wrappers.tokens(page(n))], wrappers.Automaton(spread(streams))) if "article.a" in path and not wrappers.set_apart(path) and "div.ad-box" not in path]
    plan = json.dumps({"article": units})
    assert wrappers.Reader(own, plan).text(page(2)) == want(2)
    for other in ("[]", json.dumps(spread([["p", "#", "/p"]]))):
        assert wrappers.Reader(other, plan).text(page(2)) == ""


def body(rnd, depth=0):
    """Balanced markup at random."""
    parts = []
    for _ in range(rnd.randint(0, 3)):
        kind = rnd.choice(["h2", "p", "div", "ul"] if depth < 4 else ["h2", "p"])
        if kind == "div":
            parts.append(f"<div>{body(rnd, depth + 1)}</div>")
        elif kind == "ul":
            parts.append("<ul>" + "<li>x</li>" * rnd.randint(0, 3) + "</ul>")
        else:
            parts.append(f"<{kind}>t{rnd.randint(0, 99)}</{kind}>")
    return "".join(parts)


def test_every_page_follows_the_wrapper_made_of_it():
    rnd = random.Random(11)
    for _ in range(2000):
        streams = [[s for s, _ in wrappers.tokens(f"<body><article>{body(rnd)}</article></body>")] for _ in range(rnd.randint(1, 12))]
        automaton = wrappers.Automaton(spread(streams))
        for s in streams:
            slots = automaton.follow(s)
            assert len(slots) == len(s) and [n >= 0 for n in slots] == [x == wrappers.SLOT for x in s]


HANGING = ["", "<h2>h</h2><ul><li>x</li></ul><ul></ul>", "<div></div>", "<h2>h</h2>", "<div></div><p>t81</p>", "<h2>h</h2><div><p>t76</p></div>", "<p>t94</p><div><h2>h</h2><p>t88</p><div><p>t74</p><div><p>t21</p><p>t41</p></div><h2>h</h2></div></div><p>t35</p>", "<div><h2>h</h2></div>", "<div><p>t9</p><div><p>t36</p><div></div></div><ul><li>x</li><li>x</li><li>x</li></ul></div><div><p>t5</p><p>t23</p></div>"]


def test_groups_of_optional_parts_end():
    began = time.time()
    streams = [[s for s, _ in wrappers.tokens(f"<body><article>{b}")] for b in HANGING]
    automaton = wrappers.Automaton(spread(streams))
    assert [len(automaton.follow(s)) for s in streams] == [len(s) for s in streams]
    odd = wrappers.Automaton([(False, True, ((True, False, ("a", "b")), (True, False, ("c", "d"))))])
    assert odd.follow(["a", "x"]) == [-1] and odd.follow(["a", "b", "c", "d", "c", "d"]) == [-1] * 6
    assert time.time() - began < 5


def test_a_long_page_against_another_takes_no_square_of_time():
    rnd = random.Random(4)
    a, b = ([f"{rnd.choice('abcdefgh')}{rnd.randint(0, 300)}" for _ in range(6000)] for _ in range(2))
    began = time.time()
    automaton = wrappers.Automaton(spread([a, b]))
    assert time.time() - began < 20
    assert len(automaton.follow(a)) == len(a) and len(automaton.follow(b)) == len(b)


@pytest.mark.parametrize("group", [2, 64])
def test_many_streams_of_a_host_are_merged_in_rounds(spark, group):
    pages = [f"<body><nav>m</nav>{'<h2>a</h2>' * (n % 3)}<ul>{'<li>x</li>' * (n % 5)}</ul><article>{'<p>t</p><pre>c</pre>' * (n % 7)}</article></body>" for n in range(105)]
    df = spark.createDataFrame([("https://a.example/", p) for p in [*pages, pages[0]]] + [("https://b.example/", pages[1])], "url string, html string")
    made = {r.host: r.wrapper for r in wrappers.infer_wrappers(df, group=group).collect()}
    assert set(made) == {"a.example", "b.example"}
    wrapper = wrappers.Automaton([wrappers.to_nodes(x) for x in json.loads(made["a.example"])])
    for p in pages:
        symbols = [s for s, _ in wrappers.tokens(p)]
        assert len(wrapper.follow(symbols)) == len(symbols)


@pytest.mark.parametrize("folder", [SF, SF.replace("sf0.001", "sf0.01")])
def test_page_query_reads_articles(spark, folder):
    import html
    import re

    for r in wrappers.op7_html_extraction(spark, folder).join(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        inside = re.sub(r"</?b>", "", re.sub(r"<[a-zA-Z/][^>]*\Z", "", inside))
        assert r.text == " ".join(filter(None, (" ".join(html.unescape(x).split()) for x in re.split("<[^>]*>", inside)))) and r.n_chars == len(r.text)
