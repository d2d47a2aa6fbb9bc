"""Main text of web pages by union-free regular-expression wrappers, inferred per host.

A page is a stream of tags and text slots. Adjacent repeats in it are folded into repeated groups, and the folded
streams of a host are aligned one after the other: what both have stays, where they differ the difference becomes an
optional group, and groups that start alike are aligned inside. The result is the host's wrapper: tags, numbered text
slots, optional and repeated groups, and no alternatives.

A wrapper is compiled into an automaton that holds all its states at once while a page is read, so that every page that
took part in the inference is followed to its end, however alike the beginnings of optional groups are, and in time that grows with its
tokens. Of several ways to read a page the one that enters groups first is taken.

Every page is read through its host's wrapper, and the texts in each slot, below each stack of open elements, are counted: how many
different ones, how long. From these counts alone a host learns which slots hold its content:

* The texts of a slot weigh by the characters of the different ones. So what all pages share weighs as one text, what varies
  weighs on every page, and copies of a page weigh nothing more.
* Content lies below the host's article or main elements, if these hold a fair part of this weight, else below the element that it
  leads down to: from the root on, the one that holds most of it. In the latter case a slot with the same text on different pages is template.
* An element below it whose class or id speaks of menus, notices, adverts, comments and the like is left out, unless it
  holds half of the weight itself: then its name misleads.

Elements that HTML itself sets apart (nav, footer, aside, form, script and so on) are never content. Hosts on which only
some pages have an article learn both kinds of pages apart. A page's text is what its wrapper puts into the content slots: without the
wrapper, or with that of another host, there is none.

Every page takes part in the inference: pages give their folded streams, equal ones of a host are counted first, and the
different ones are aligned in groups of some GROUP, then the groups' wrappers, round by round, until a host has one. So
no task gathers a host, however many different streams it has.

Results for odd input: null html counts as empty and gives an empty text, as does a page without content; a null url is
a host of its own; pages of any length are read whole; repeated rows are read alike; an empty table gives an empty
result; other columns are passed by.
"""

from __future__ import annotations

import bisect
import functools
import html as entities
import itertools
import json
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairquarry.llm.shared import materialize, text_of

#: Streams of a host that are aligned in one go.
GROUP = 64
#: Shares of the weight of texts: that of articles to be the content, that of an element for the way to lead into it, and that at which a name misleads.
ARTICLE, LEADS, MISLEADS = 0.2, 0.6, 0.5
#: Elements that hold a line of text; the way ends above them.
LINES = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd tr td th tbody thead blockquote pre figure figcaption br hr address".split())
#: Most bytes of wrappers that are sent to every task; more are joined by host. Most states that an automaton keeps; memory only.
BROADCAST_BYTES, KEPT_STATES = 8_000_000, 1_000_000
#: Longest group of tokens that is recognised as repeated.
PERIOD = 12
SLOT = "#"
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp")
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that HTML sets apart, and class or id words that speak of something else than an article.
OUTSIDE = frozenset("head nav footer aside form script style noscript template button select option iframe svg dialog menu textarea title".split())
OUTSIDE_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|banner|cookies?|consent|notice|alert|popup|modal|sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|comments?|reply|replies|respond|share|sharing|social|related|recommended|login|signup|subscribe|newsletter|search|pagination|toolbar|widget|copyright)(?:[^a-z]|$)"
)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
CLOSE = {name: re.compile(rf"</{name}\b", re.I) for name in RAW}


def tokens(html: str):
    """(symbol, text): a tag's symbol is its name, with class and id words, and a slash if it closes; a slot has a text."""
    at, size = 0, len(html)
    while at < size:
        tag = TOKEN.search(html, at)
        end = tag.start() if tag else size
        if end > at and not html[at:end].isspace():
            yield SLOT, html[at:end]
        if not tag:
            return
        at = tag.end()
        if tag[2] and tag[4]:
            name = tag[2].lower()
            if tag[1]:
                yield "/" + name, ""
                continue
            marks = " ".join(x.strip("\"'").lower() for x in MARKS.findall(tag[3])) if "=" in tag[3] else ""
            yield (f"{name}.{marks}" if marks else name), ""
            if name in CLOSE:
                shut = CLOSE[name].search(html, at)
                at = shut.start() if shut else size


class Place:
    """Open elements while a stream is read."""

    def __init__(self):
        self.open: list[str] = []

    def feed(self, symbol: str) -> None:
        name = symbol.partition(".")[0]
        if name[0] == "/":
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at].partition(".")[0] == name[1:]:
                    del self.open[at:]
                    return
            return
        if name in VOID or name in INLINE:
            return
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and self.open and self.open[-1].partition(".")[0] == name:
            self.open.pop()
        self.open.append(symbol)


def is_article(symbol: str) -> bool:
    name, _, marks = symbol.partition(".")
    return name in ("article", "main") or marks == "main"


def set_apart(path: tuple[str, ...]) -> bool:
    """Whether HTML itself sets an open element apart from the text; headers inside an article are its own."""
    names = [p.partition(".")[0] for p in path]
    return not OUTSIDE.isdisjoint(names) or ("header" in names and not any(map(is_article, path[: names.index("header")])))


def speaks_of_other(symbol: str) -> bool:
    name, _, marks = symbol.partition(".")
    return bool(marks) and name not in ("html", "body", "article", "main") and OUTSIDE_WORDS.search(marks) is not None


# A node is a symbol, or (optional, repeated, nodes).
def first(node) -> str:
    while not isinstance(node, str):
        node = node[2][0]
    return node


def fold(nodes: list) -> list:
    """nodes with each run of equal neighbours, of up to PERIOD nodes each, as one repeated group; shortest periods first."""
    for period in range(1, PERIOD + 1):
        out, i = [], 0
        while i < len(nodes):
            body = nodes[i : i + period]
            n = 1
            while len(body) == period and nodes[i + n * period : i + (n + 1) * period] == body:
                n += 1
            if n > 1:
                same = period == 1 and not isinstance(body[0], str)
                out.append((body[0][0], True, body[0][2]) if same else (False, True, tuple(body)))
                i += n * period
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def optional(nodes: list) -> list:
    if not nodes:
        return []
    if len(nodes) == 1 and not isinstance(nodes[0], str):
        return [(True, nodes[0][1], nodes[0][2])]
    return [(True, False, tuple(nodes))]


def align(a: list, b: list) -> list:
    """The wrapper of all that the wrappers a and b describe."""
    out, i, j = [], 0, 0
    where: dict[str, list[int]] = {}
    for n, y in enumerate(b):
        where.setdefault(first(y), []).append(n)
    while i < len(a) and j < len(b):
        x, y = a[i], b[j]
        if x == y:
            out.append(x)
            i, j = i + 1, j + 1
            continue
        if first(x) == first(y) and not (isinstance(x, str) and isinstance(y, str)):
            if isinstance(x, str) or isinstance(y, str):
                # A group meets its content spelled out: as many times as it follows itself.
                group, plain, at = (y, a, i) if isinstance(x, str) else (x, b, j)
                size, n = len(group[2]), 0
                while tuple(plain[at + n * size : at + (n + 1) * size]) == group[2]:
                    n += 1
                if n:
                    out.append((group[0], group[1] or n > 1, group[2]))
                    i, j = (i + n * size, j + 1) if isinstance(x, str) else (i + 1, j + n * size)
                    continue
            else:
                out.append((x[0] or y[0], x[1] or y[1], tuple(align(list(x[2]), list(y[2])))))
                i, j = i + 1, j + 1
                continue
        # The nearest places at which both go on alike; what lies before is optional.
        best, k = None, i
        while k < len(a) and (best is None or k - i < best[0]):
            places = where.get(first(a[k]), ())
            n = bisect.bisect_left(places, j + (k == i))
            if n < len(places):
                best = min(x for x in (best, (k - i + places[n] - j, k, places[n])) if x)
            k += 1
        if best is None:
            break
        out += optional(a[i : best[1]]) + optional(b[j : best[2]])
        i, j = best[1], best[2]
    return fold(out + optional(a[i:]) + optional(b[j:]))


def wrapper_of(streams: list[list]) -> list:
    """Streams aligned one after the other."""
    made = streams[0]
    for s in streams[1:]:
        made = align(made, s)
    return made


def to_nodes(value):
    return value if isinstance(value, str) else (value[0], value[1], tuple(map(to_nodes, value[2])))


def numbered(nodes: list, count=None) -> list:
    """nodes with their slots as "#0", "#1" and so on."""
    count = itertools.count() if count is None else count
    return [(f"{SLOT}{next(count)}" if n == SLOT else n) if isinstance(n, str) else (n[0], n[1], tuple(numbered(n[2], count))) for n in nodes]


class Automaton:
    """A wrapper's nodes as places to read a symbol at, and the places that may come next, those inside of groups first."""

    def __init__(self, wrapper: list):
        self.symbol: list[str | None] = []  # None: nothing is read here
        self.slot: list[int] = []
        self.after: list[list[int]] = []  # of places where nothing is read, where they lead
        self.build(wrapper)
        self.end = self.put(None, -1)
        self.near: dict[int, tuple[int, ...]] = {}
        self.forget()

    def put(self, symbol: str | None, slot: int) -> int:
        self.symbol.append(symbol)
        self.slot.append(slot)
        self.after.append([])
        return len(self.symbol) - 1

    def build(self, nodes) -> None:
        for n in nodes:
            if isinstance(n, str):
                self.put(*(SLOT, int(n[1:])) if n[0] == SLOT else (n, -1))
                continue
            fork = self.put(None, -1) if n[0] else None
            begin = len(self.symbol)
            self.build(n[2])
            if n[1]:
                again = self.put(None, -1)
                self.after[again] = [begin, again + 1]
            if fork is not None:
                self.after[fork] = [fork + 1, len(self.symbol)]

    def forget(self) -> None:
        self.lists: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.moves: dict[tuple[int, str], tuple[int, tuple[int, ...]]] = {}
        self.size = 0
        self.numbered(self.reading(0))

    def numbered(self, states: tuple[int, ...]) -> int:
        if states not in self.number:
            self.number[states] = len(self.lists)
            self.lists.append(states)
            self.size += len(states)
        return self.number[states]

    def reading(self, place: int) -> tuple[int, ...]:
        """The places that read, or the end, that are reached from a place without reading, in order."""
        if place not in self.near:
            found, seen, todo = [], set(), [place]
            while todo:
                at = todo.pop()
                if at in seen:
                    continue
                seen.add(at)
                if self.symbol[at] is not None or at == self.end:
                    found.append(at)
                else:
                    todo += reversed(self.after[at])
            self.near[place] = tuple(found)
        return self.near[place]

    def moved(self, states: int, symbol: str) -> tuple[int, tuple[int, ...]]:
        """The states after a symbol, and which state each of them came from."""
        to: dict[int, int] = {}
        for n, place in enumerate(self.lists[states]):
            if self.symbol[place] == symbol:
                for x in self.reading(place + 1):
                    to.setdefault(x, n)
        self.moves[states, symbol] = self.numbered(tuple(to)), tuple(to.values())
        self.size += len(to)
        return self.moves[states, symbol]

    def follow(self, symbols: list[str]) -> list[int]:
        """For each symbol that follows the wrapper, from the first on, the number of its slot, or -1 if it is a tag."""
        if self.size > KEPT_STATES:
            self.forget()
        now, trail = 0, []
        for symbol in symbols:
            to, came = self.moves.get((now, symbol)) or self.moved(now, symbol)
            if not came:
                break
            trail.append((now, came))
            now = to
        last = self.lists[now]
        at = last.index(self.end) if self.end in last and len(trail) == len(symbols) else 0
        out = []
        for states, came in reversed(trail):
            at = came[at]
            out.append(self.slot[self.lists[states][at]])
        return out[::-1]


def slots_of(stream: list[tuple[str, str]], wrapper: Automaton):
    """(place in the stream, slot number or -1 where the wrapper isn't followed any more, open elements) of each text."""
    followed = wrapper.follow([s for s, _ in stream])
    place = Place()
    for n, (symbol, _) in enumerate(stream):
        if symbol == SLOT:
            yield n, followed[n] if n < len(followed) else -1, tuple(place.open)
        else:
            place.feed(symbol)


def kind_of(stream: list[tuple[str, str]]) -> str:
    """Pages with an article or main element, and others."""
    return "article" if any(is_article(s) for s, _ in stream) else "plain"


def learned(units: list[tuple[int, tuple[str, ...], int, bool]]) -> list[tuple[int, tuple[str, ...]]]:
    """Which units are content, of one kind of pages, from (slot, open elements, characters of different texts, whether
    different pages have the same text there)."""
    units = [u for u in units if u[0] >= 0 and not set_apart(u[1])]
    mass: Counter = Counter()
    for _, path, weight, _ in units:
        for n in range(len(path) + 1):
            mass[path[:n]] += weight
    roots = [p for p in mass if p and is_article(p[-1]) and not any(map(is_article, p[:-1]))]
    by_name = bool(roots) and sum(mass[p] for p in roots) >= ARTICLE * mass[()]
    if not by_name:
        at: tuple[str, ...] = ()
        below = sorted(mass, key=lambda p: (-mass[p], p))
        while True:
            on = next((p for p in below if len(p) == len(at) + 1 and p[:-1] == at and mass[p] >= LEADS * mass[at]), None)
            if on is None or on[-1].partition(".")[0] in LINES:
                break
            at = on
        roots = [at]
    tops = set(roots)
    inside = lambda path: next((n for n in range(len(path) + 1) if path[:n] in tops), None)
    cut = {p for p in mass if p and speaks_of_other(p[-1]) and mass[p] < MISLEADS * mass[()] and inside(p[:-1]) is not None}
    return [(slot, path) for slot, path, _, same in units if inside(path) is not None and not any(path[:n] in cut for n in range(len(path) + 1)) and (by_name or not same)]


class Reader:
    """Reads the pages of a host by its wrapper and what was learned of it."""

    def __init__(self, wrapper: str, plan: str):
        self.wrapper = Automaton([to_nodes(x) for x in json.loads(wrapper)])
        self.plans = {kind: {(slot, tuple(path)) for slot, path in units} for kind, units in json.loads(plan).items()}

    def text(self, html: str) -> str:
        """Blocks of the content slots, white space squeezed, joined by one space."""
        stream = [*tokens(html)]
        plan = self.plans.get(kind_of(stream))
        if not plan:
            return ""
        content = {n for n, slot, path in slots_of(stream, self.wrapper) if (slot, path) in plan}
        blocks: list[list[str]] = [[]]
        for n, (symbol, text) in enumerate(stream):
            if symbol == SLOT:
                if n in content:
                    blocks[-1].append(entities.unescape(text))
                continue
            name = symbol.lstrip("/").partition(".")[0]
            if name == "br":
                blocks[-1].append(" ")
            elif name not in INLINE:
                blocks.append([])
        return " ".join(filter(None, (" ".join("".join(b).split()) for b in blocks)))


def host(url_col: str):
    return F.coalesce(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", group: int = GROUP) -> DataFrame:
    """(host, wrapper): one row per host; the wrapper as JSON, its slots numbered."""
    chosen = pages.select(host(url_col).alias("host"), text_of(html_col).alias("html"))

    def streams(batches):
        for batch in batches:
            seen = Counter()
            for h, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[h, json.dumps(fold([s for s, _ in tokens(page)]))] += 1
            yield pa.RecordBatch.from_pydict({"host": [h for h, _ in seen], "stream": [s for _, s in seen], "n": [*seen.values()]}, schema=pa.schema([("host", pa.string()), ("stream", pa.string()), ("n", pa.int64())]))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["n", "stream"], ascending=[False, True])
        made = wrapper_of([[to_nodes(x) for x in json.loads(s)] for s in rows["stream"]])
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "stream": [json.dumps(made)], "n": [rows["n"].sum()]})

    schema = "host string, stream string, n long"
    parts = materialize(chosen.mapInArrow(streams, schema).groupBy("host", "stream").agg(F.sum("n").alias("n")), "page-streams")
    while True:
        sizes = parts.groupBy("host").agg(F.count(F.lit(1)).alias("streams"))
        if (sizes.agg(F.max("streams")).first()[0] or 0) <= 1:
            break
        salted = parts.join(sizes, "host").withColumn("salt", F.pmod(F.xxhash64("stream"), F.ceil(F.col("streams") / group)))
        parts = materialize(salted.select("host", "salt", "stream", "n").groupBy("host", "salt").applyInPandas(merge, schema), "wrapper-parts")

    number = F.udf(lambda s: json.dumps(numbered([to_nodes(x) for x in json.loads(s)])), "string")  # one call a host
    return materialize(parts.select("host", number("stream").alias("wrapper")), "wrappers")


def with_hosts(pages: DataFrame, hosts: DataFrame, columns: list[str]) -> DataFrame:
    """pages with the columns of their host: sent to every task where they are small all together, else joined."""
    size = hosts.agg(F.sum(sum(F.length(c) for c in columns))).first()[0] or 0
    return pages.join(F.broadcast(hosts) if size <= BROADCAST_BYTES else hosts, "host", "left")


def per_host(make):
    """make(key, ...), remembered for the last 1,000 hosts."""
    return functools.lru_cache(1000)(make)


def signed_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


def learn_hosts(pages: DataFrame, wrappers: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper, plan): the content slots of each host, as JSON by kind of page, from the texts in its wrapper's slots."""
    chosen = with_hosts(pages.select(host(url_col).alias("host"), text_of(html_col).alias("html")), wrappers, ["wrapper"]).select("host", "html", "wrapper")
    names = ["host", "kind", "slot", "path", "text", "chars", "least", "most"]
    types = [pa.string(), pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 4]

    def counts(batches):
        automaton = per_host(lambda wrapper: Automaton([to_nodes(x) for x in json.loads(wrapper)]))
        for batch in batches:
            seen: dict = {}
            for h, page, w in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                stream = [*tokens(page)]
                kind, own = kind_of(stream), signed_hash(page)
                for n, slot, path in slots_of(stream, automaton(w)):
                    text = stream[n][1]
                    one = seen.setdefault((h, kind, slot, path, signed_hash(text)), [len(text), own, own])
                    one[1:] = min(one[1], own), max(one[2], own)
            rows = [(h, kind, slot, json.dumps(path), text, *v) for (h, kind, slot, path, text), v in seen.items()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    # least and most are hashes of pages: they differ where different pages have the text.
    each = chosen.mapInArrow(counts, "host string, kind string, slot int, path string, text long, chars long, least long, most long")
    unit = ["host", "kind", "slot", "path"]
    texts = each.groupBy(*unit, "text").agg(F.max("chars").alias("chars"), F.min("least").alias("least"), F.max("most").alias("most"))
    units = texts.groupBy(*unit).agg(F.sum("chars").alias("mass"), ((F.count(F.lit(1)) == 1) & (F.min("least") < F.max("most"))).alias("same"))

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        plan = {}
        for kind, own in pdf.groupby("kind"):
            plan[kind] = learned([(int(r.slot), tuple(json.loads(r.path)), int(r.mass), bool(r.same)) for r in own.sort_values(["slot", "path"]).itertuples()])
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "plan": [json.dumps(plan)]})

    plans = units.groupBy("host").applyInPandas(decide, "host string, plan string")
    return materialize(wrappers.join(plans, "host"), "host-plans")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id_col, url_col and text of every row of pages."""
    plans = learn_hosts(pages, infer_wrappers(pages, url_col, html_col), url_col, html_col)
    chosen = pages.select(F.col(id_col), F.col(url_col), host(url_col).alias("host"), text_of(html_col).alias("html"))
    joined = with_hosts(chosen, plans, ["wrapper", "plan"]).select(id_col, url_col, "html", "wrapper", "plan")

    def run(batches):
        reader = per_host(Reader)
        for batch in batches:
            texts = [reader(w or "[]", plan or "{}").text(page) for page, w, plan in zip(*(batch.column(i).to_pylist() for i in range(2, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=[id_col, url_col, "text"])

    return joined.mapInArrow(run, joined.select(id_col, url_col, F.lit("").alias("text")).schema)


def op7_html_extraction(spark, sf_dir):
    found = extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
