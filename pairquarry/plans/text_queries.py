"""Queries over texts: documents and benchmark stand for sources, two documents with following ids for the two sides of a pair."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairquarry.functions import blocks, code, scan, text
from pairquarry.operators import evaluation, mining, reviews
from pairquarry.operators.tables import written
from pairquarry.session import dealt, table

TOKEN_SQL = r"[a-zA-Z_][\p{L}\p{N}_''.]*|[^\s\x0B\x1c-\x1f\x85\p{Z}]"
PAIRS_SQL = "pairs AS (SELECT a.doc_id, a.text AS initial, b.text AS final FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)"
DIFF_SQL = f"""
WITH {PAIRS_SQL},
tok AS (SELECT doc_id, unnest(regexp_extract_all(initial, '{TOKEN_SQL}')) AS token, -1 AS sign FROM pairs
        UNION ALL SELECT doc_id, unnest(regexp_extract_all(final, '{TOKEN_SQL}')), 1 FROM pairs),
net AS (SELECT doc_id, token, sum(sign) AS net, count(*) FILTER (sign < 0) AS b, count(*) FILTER (sign > 0) AS a FROM tok GROUP BY ALL),
diff AS (SELECT p.doc_id, coalesce(sum(b), 0)::BIGINT AS n_initial, coalesce(sum(a), 0)::BIGINT AS n_final, coalesce(sum(greatest(net, 0)), 0)::BIGINT AS added,
                coalesce(sum(greatest(-net, 0)), 0)::BIGINT AS removed FROM pairs p LEFT JOIN net USING (doc_id) GROUP BY p.doc_id)
"""


def document_pairs(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    after = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("final"))
    # Texts are never broadcast, however few there are.
    return d.select("doc_id", F.col("text").alias("initial")).join(after.hint("shuffle_hash"), "doc_id")


def bag_token_diff(spark, sf_dir):
    return mining.bag_diff(document_pairs(spark, sf_dir), "doc_id", "initial", "final")


def meaningful_pairs(spark, sf_dir):
    pairs = document_pairs(spark, sf_dir)
    marked = pairs.withColumn("migrated", mining.migration_only(F.col("initial"), F.col("final")))
    joined = mining.bag_diff(marked, "doc_id", "initial", "final", "migrated")
    keep = mining.meaningful(F.col("added"), F.col("removed"), F.col("n_initial"), F.col("n_final"), F.col("migrated"))
    return joined.where(keep).select("doc_id", (F.col("added") + F.col("removed")).alias("changed"), F.least("n_initial", "n_final").alias("shorter"))


MEANINGFUL_SQL = DIFF_SQL + r"""
SELECT doc_id, added + removed AS changed, least(n_initial, n_final) AS shorter FROM diff JOIN pairs USING (doc_id)
WHERE replace(replace(initial, 'refine''', 'refine'), ' _', ' ?_') <> replace(replace(final, 'refine''', 'refine'), ' _', ' ?_')
  AND added + removed >= 3 AND NOT (least(n_initial, n_final) > 0 AND (added + removed) / least(n_initial, n_final)::DOUBLE < 0.05)
"""


def multiset_except(spark, sf_dir):
    """Tokens that documents with even ids have more often than those with odd ids, by language."""
    t = table(spark, sf_dir, "documents").select("doc_id", "lang", F.explode(text.tokens(F.col("text"))).alias("token"))
    side = lambda n: t.where(F.col("doc_id") % 2 == n).select("lang", "token")
    return mining.multiset_minus(side(0), side(1)).groupBy("lang", "token").agg(F.count(F.lit(1)).alias("surplus"))


MULTISET_SQL = f"""
WITH t AS (SELECT doc_id, lang, unnest(regexp_extract_all(text, '{TOKEN_SQL}')) AS token FROM documents)
SELECT lang, token, count(*) AS surplus
FROM (SELECT lang, token FROM t WHERE doc_id % 2 = 0 EXCEPT ALL SELECT lang, token FROM t WHERE doc_id % 2 = 1) GROUP BY ALL
"""


def duplicate_members(spark, sf_dir):
    """The members of each group of equal texts, a row each in order: no group is gathered, however large."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    groups = d.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")
    return d.join(groups, "text_sha256").select("text_sha256", "doc_id", "n", "first_id")


MEMBERS_SQL = "SELECT sha256(text) AS text_sha256, doc_id, count(*) OVER g AS n, min(doc_id) OVER g AS first_id FROM documents WINDOW g AS (PARTITION BY text) QUALIFY count(*) OVER g > 1"


def duplicate_groups(spark, sf_dir):
    """Texts that several documents share: how many, the first and the last of them."""
    d = table(spark, sf_dir, "documents")
    groups = d.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("n > 1")
    return groups.select(F.sha2("text", 256).alias("text_sha256"), "n", "first_id", "last_id")


DUPLICATES_SQL = "SELECT sha256(text) AS text_sha256, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY text HAVING count(*) > 1"


def line_counts(spark, sf_dir):
    """Lines of both sides, their difference, and whether the recorded size is off by more than one."""
    p = document_pairs(spark, sf_dir).select("doc_id", text.line_count(F.col("initial")).alias("initial_lines"), text.line_count(F.col("final")).alias("final_lines"), (F.col("initial") != F.col("final")).alias("signature_changed"))
    return p.withColumn("line_delta", F.col("final_lines") - F.col("initial_lines")).withColumn("mismatch", F.abs("line_delta") > 1)


LINES_SQL = f"""
WITH {PAIRS_SQL},
n AS (SELECT doc_id, length(initial) - length(replace(initial, chr(10), '')) + 1 AS initial_lines, length(final) - length(replace(final, chr(10), '')) + 1 AS final_lines,
             initial <> final AS signature_changed FROM pairs)
SELECT *, final_lines - initial_lines AS line_delta, abs(final_lines - initial_lines) > 1 AS mismatch FROM n
"""


def bracket_balance(spark, sf_dir):
    """For round brackets: how many, the depth at the end, the lowest depth, and whether they balance."""
    signs = F.transform(F.regexp_extract_all(F.col("text"), F.lit(r"[()]"), F.lit(0)), lambda b: F.when(b == "(", 1).otherwise(-1))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("low"))
    step = lambda s, x: F.struct((s["depth"] + x).alias("depth"), F.least(s["low"], s["depth"] + x).alias("low"))
    d = table(spark, sf_dir, "documents").select("doc_id", signs.alias("signs"))
    run = d.select("doc_id", F.size("signs").cast("long").alias("n_brackets"), F.aggregate("signs", zero, step).alias("r"))
    return run.select("doc_id", "n_brackets", F.col("r.depth").cast("long").alias("depth"), F.col("r.low").cast("long").alias("lowest"), ((F.col("r.depth") == 0) & (F.col("r.low") == 0)).alias("balanced"))


BRACKETS_SQL = r"""
WITH b AS (SELECT doc_id, regexp_extract_all(text, '[()]') AS l FROM documents),
e AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM b),
r AS (SELECT doc_id, i, sum(CASE x WHEN '(' THEN 1 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY i) AS depth FROM e),
s AS (SELECT doc_id, arg_max(depth, i) AS depth, min(depth) AS low FROM r GROUP BY doc_id)
SELECT b.doc_id, len(l)::BIGINT AS n_brackets, coalesce(depth, 0)::BIGINT AS depth, least(coalesce(low, 0), 0)::BIGINT AS lowest,
       coalesce(depth, 0) = 0 AND coalesce(low, 0) >= 0 AS balanced FROM b LEFT JOIN s USING (doc_id)
"""


def part_sources(spark, sf_dir):
    """Two declarations for each part, with comments, a nested comment and a string that holds comment marks."""
    source = F.concat(
        F.lit("/-- A part. -/\ntheorem part"), F.col("p_partkey"), F.lit(".name (n : Nat) : Size n := by -- "), F.col("p_name"), F.lit("\n  exact /- "), F.col("p_brand"), F.lit(" /- inner -/ -/ size "),
        F.col("p_size"), F.lit(' "a -- b"\n\n@[simp] private lemma other'), F.col("p_partkey"), F.lit(" : True where\n  trivial\n\nend Part\n"),
    )
    return dealt(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", source.alias("source"))


def strip_comments_synth(spark, sf_dir):
    s = part_sources(spark, sf_dir)
    return s.select("p_partkey", code.code_only("source").alias("code"), code.signature("source").alias("signature"), code.body("source").alias("body"), code.is_balanced("source").alias("balanced"))


STRIP_SQL = """
WITH s AS (SELECT p_partkey, 'theorem part' || p_partkey || '.name (n : Nat) : Size n' AS signature,
                  'by exact size ' || p_size || ' "a -- b" @[simp] private lemma other' || p_partkey || ' : True where trivial end Part' AS body FROM part)
SELECT p_partkey, signature || ' := ' || body AS code, signature, body, true AS balanced FROM s
"""


def block_parse_synth(spark, sf_dir):
    found = blocks.blocks_of(part_sources(spark, sf_dir), "source", "p_partkey")
    return found.select("p_partkey", "kind", "name", "signature", "start_line", "end_line", F.length("body").cast("long").alias("body_chars"))


BLOCKS_SQL = """
SELECT p_partkey, 'theorem' AS kind, 'part' || p_partkey || '.name' AS name, 'theorem part' || p_partkey || '.name (n : Nat) : Size n' AS signature,
       2 AS start_line, 3 AS end_line, length('by -- ' || p_name || '   exact /- ' || p_brand || ' /- inner -/ -/ size ' || p_size || ' "a -- b"')::BIGINT AS body_chars FROM part
UNION ALL
SELECT p_partkey, 'lemma', 'other' || p_partkey, '@[simp] private lemma other' || p_partkey || ' : True', 5, 6, 15 FROM part
"""


def diff_hunks_synth(spark, sf_dir):
    """A diff for each order line: a hunk named by its context, and one without."""
    line = lambda *c: F.concat(*c, F.lit("\n"))
    k = F.concat(F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"))
    q = F.col("l_quantity").cast("int").cast("string")
    diff = F.concat(line(F.lit("--- a"),), line(F.lit("@@ -"), q, F.lit(",2 +"), q, F.lit(",3 @@")), line(F.lit(" theorem t"), k, F.lit(" : T")), line(F.lit("-old")), line(F.lit("+new")), line(F.lit("+lemma other")), F.lit("@@ -7 +8 @@\n-x\n+y"))
    each = table(spark, sf_dir, "lineitem").select(F.concat_ws("/", k, "l_partkey", "l_suppkey").alias("line"), diff.alias("diff"))
    h = blocks.hunks_of(each, "diff", "line")
    return h.select("line", "hunk", "old_start", "old_count", "new_start", "new_count", F.array_join("old_lines", "|").alias("old"), F.array_join("new_lines", "|").alias("new"), "declaration")


HUNKS_SQL = """
WITH l AS (SELECT l_orderkey || '_' || l_linenumber AS k, l_orderkey || '_' || l_linenumber || '/' || l_partkey || '/' || l_suppkey AS line, l_quantity::INT AS q FROM lineitem)
SELECT line, 1 AS hunk, q AS old_start, 2 AS old_count, q AS new_start, 3 AS new_count, 'theorem t' || k || ' : T|old' AS old, 'theorem t' || k || ' : T|new|lemma other' AS new, 't' || k AS declaration FROM l
UNION ALL SELECT line, 2, 7, 1, 8, 1, 'x', 'y', NULL FROM l
"""


def diff_declarations(spark, sf_dir):
    """The different declarations that a diff names, in the order in which its hunks do."""
    line = lambda *c: F.concat(*c, F.lit("\n"))
    named = lambda k: line(F.lit(" theorem t"), k, F.lit(" : T"))
    p = F.col("p_partkey").cast("string")
    head = F.lit("@@ -1,2 +1,2 @@\n")
    diff = F.concat(head, named(F.lit("b")), head, named(F.concat(F.lit("a"), p)), head, named(F.lit("b")), head, F.lit("-x\n+y"))
    return blocks.declarations_of(table(spark, sf_dir, "part").select("p_partkey", diff.alias("diff")), "diff", "p_partkey").select("p_partkey", F.array_join("declarations", ",").alias("declarations"))


DECLARATIONS_SQL = "SELECT p_partkey, 'tb,ta' || p_partkey AS declarations FROM part"


def tactic_blocks(spark, sf_dir):
    """Declarations whose proof is by tactics."""
    found = blocks.tactics_only(blocks.blocks_of(part_sources(spark, sf_dir), "source", "p_partkey"))
    return found.select("p_partkey", "name")


TACTICS_SQL = "SELECT p_partkey, 'part' || p_partkey || '.name' AS name FROM part"


def json_lenient(spark, sf_dir):
    """Properties read back from a fenced answer amid prose."""
    answer = F.concat(F.lit("```json\nHere it is: "), F.col("props"), F.lit(" - done {}\n```"))
    e = table(spark, sf_dir, "events").select("event_id", scan.lenient_json(answer).alias("found"))
    return e.select("event_id", F.get_json_object("found", "$.k").cast("long").alias("k"))


JSON_SQL = "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events"


def body_similarity(spark, sf_dir):
    """Similarity of a part's name and type as two bodies of one theorem."""
    side = lambda c: F.concat(F.lit("theorem t : T := "), F.col(c))
    return table(spark, sf_dir, "part").select("p_partkey", scan.similarity(side("p_name"), side("p_type")).alias("similarity"))


# Longest common runs of what is left before and behind the last ones, until nothing matches.
SIMILARITY_SQL = """
WITH RECURSIVE p AS (SELECT p_partkey AS k, trim(p_name) AS a, trim(p_type) AS b FROM part),
starts AS (SELECT k, a, b, unnest(range(1, length(a) + 1)) AS i FROM p),
pos AS (SELECT k, a, b, i, unnest(range(1, length(b) + 1)) AS j FROM starts),
ext AS (SELECT k, i, j, len(list_filter(range(1, least(length(a) - i, length(b) - j) + 2), lambda n: substr(a, i, n) = substr(b, j, n))) AS n FROM pos WHERE substr(a, i, 1) = substr(b, j, 1)),
seg AS (
  SELECT k, 1::BIGINT AS al, length(a) + 1 AS ah, 1::BIGINT AS bl, length(b) + 1 AS bh, 0::BIGINT AS matched FROM p
  UNION ALL
  SELECT k, CASE WHEN side = 0 THEN al ELSE m.n - m.i END, CASE WHEN side = 0 THEN -m.i ELSE ah END, CASE WHEN side = 0 THEN bl ELSE m.n - m.j END, CASE WHEN side = 0 THEN -m.j ELSE bh END, CASE WHEN side = 0 THEN m.n ELSE 0 END
  FROM (SELECT k, al, ah, bl, bh, max(struct_pack(n := least(n, ah - i, bh - j), i := -i, j := -j)) AS m
        FROM seg JOIN ext USING (k) WHERE i >= al AND i < ah AND j >= bl AND j < bh GROUP BY ALL), (VALUES (0), (1)) AS sides(side))
SELECT k AS p_partkey, 2.0::DOUBLE * sum(matched) / any_value(length(a) + length(b)) AS similarity FROM seg JOIN p USING (k) GROUP BY k
"""


def name_suffix_present(spark, sf_dir):
    """Whether the last part of a dotted name occurs in a text."""
    p = table(spark, sf_dir, "part").withColumn("name", F.replace(F.col("p_name"), F.lit(" "), F.lit(".")))
    last = text.last_component(F.col("name"))
    return p.select("p_partkey", last.alias("suffix"), F.contains(F.lower("p_type"), F.lower(last)).alias("present"))


SUFFIX_SQL = "SELECT p_partkey, split_part(replace(p_name, ' ', '.'), '.', -1) AS suffix, contains(lower(p_type), lower(split_part(replace(p_name, ' ', '.'), '.', -1))) AS present FROM part"

# Words searched for.
KEYWORDS = ("the", "und", "que", "les", "license", "para", "sch")


def keyword_union(spark, sf_dir):
    """Documents found by keyword searches and by the scan of one source, as one set with the searches that found each."""
    d = table(spark, sf_dir, "documents")
    hits = F.filter(F.array(*[F.when(F.contains("text", F.lit(w)), F.lit(w)) for w in KEYWORDS]), lambda w: w.isNotNull())
    found = d.select("doc_id", F.explode(hits).alias("query")).unionByName(d.where("source = 'src1'").select("doc_id", F.lit("scan").alias("query")))
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_queries"), F.array_join(F.array_sort(F.collect_set("query")), ",").alias("queries"))


KEYWORD_SQL = " WITH f AS (" + " UNION ALL ".join(f"SELECT doc_id, '{w}' AS query FROM documents WHERE contains(text, '{w}')" for w in KEYWORDS) + """
UNION ALL SELECT doc_id, 'scan' FROM documents WHERE source = 'src1')
SELECT doc_id, count(*) AS n_queries, string_agg(query, ',' ORDER BY query) AS queries FROM f GROUP BY doc_id
"""


def base64_content(spark, sf_dir):
    """Contents after a round trip through base64; empty and differently encoded ones become null."""
    from pairquarry.operators.reviews import decoded_content

    e = table(spark, sf_dir, "documents").select("doc_id", F.base64(F.encode("text", "UTF-8")).alias("content"), F.when(F.col("doc_id") % 7 == 0, "none").otherwise("base64").alias("encoding"))
    back = decoded_content(F.col("content"), F.col("encoding"))
    return e.select("doc_id", F.length(back).cast("long").alias("n_chars"), F.sha2(back, 256).alias("text_sha256"))


BASE64_SQL = """
WITH b AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 AND text <> '' THEN decode(from_base64(to_base64(encode(text)))) END AS t FROM documents)
SELECT doc_id, length(t) AS n_chars, sha256(t) AS text_sha256 FROM b
"""


def snapshot_align(spark, sf_dir):
    """Initial and final snapshots side by side; a missing side stays null."""
    # Every eleventh file came back empty, which counts as missing.
    content = F.when(F.col("doc_id") % 11 != 0, F.col("text")).otherwise("")
    d = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 2).alias("path"), F.length(reviews.present(content)).cast("long").alias("n_chars"))
    one = d.where((F.col("doc_id") % 2 == 0) & (F.col("doc_id") % 10 != 0)).select("path", F.col("n_chars").alias("initial_chars"))
    two = d.where((F.col("doc_id") % 2 == 1) & (F.col("doc_id") % 7 != 0)).select("path", F.col("n_chars").alias("final_chars"))
    both = one.join(two, "path", "full").where("initial_chars IS NOT NULL OR final_chars IS NOT NULL")
    return both.withColumn("fetch_failed", F.col("initial_chars").isNull() | F.col("final_chars").isNull())


SNAPSHOT_SQL = """
WITH d AS (SELECT doc_id, doc_id // 2 AS path, CASE WHEN doc_id % 11 <> 0 AND text <> '' THEN length(text) END AS n FROM documents)
SELECT coalesce(a.path, b.path) AS path, a.n AS initial_chars, b.n AS final_chars, a.n IS NULL OR b.n IS NULL AS fetch_failed
FROM (SELECT * FROM d WHERE doc_id % 2 = 0 AND doc_id % 10 <> 0) a FULL JOIN (SELECT * FROM d WHERE doc_id % 2 = 1 AND doc_id % 7 <> 0) b ON a.path = b.path WHERE a.n IS NOT NULL OR b.n IS NOT NULL
"""


def stored_line_counts(spark, sf_dir):
    """The recorded number of lines, or where it is 0 or missing that of the text."""
    recorded = F.when(F.col("doc_id") % 3 == 1, 0).when(F.col("doc_id") % 3 == 2, F.col("n_chars"))
    return table(spark, sf_dir, "documents").select("doc_id", text.stored_or_counted(recorded, F.col("text")).alias("lines"))


STORED_SQL = "SELECT doc_id, CASE WHEN doc_id % 3 = 2 AND n_chars <> 0 THEN n_chars WHEN text = '' THEN 0 ELSE length(text) - length(replace(text, chr(10), '')) + CASE WHEN ends_with(text, chr(10)) THEN 0 ELSE 1 END END::BIGINT AS lines FROM documents"


def anchor_lookup(spark, sf_dir):
    """Known cases looked up by their key, with what they are expected to be."""
    anchors = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.when(F.col("item_id") % 4 == 0, "comparable").otherwise("accepted").alias("expected"))
    return table(spark, sf_dir, "documents").join(anchors, "doc_id").select("doc_id", "lang", "expected")


ANCHOR_SQL = "SELECT doc_id, lang, CASE WHEN item_id % 4 = 0 THEN 'comparable' ELSE 'accepted' END AS expected FROM documents JOIN benchmark ON item_id = doc_id"


def greedy_pool_dedup(spark, sf_dir):
    """Documents, newest first, without a text or a (source, size) seen before."""
    return mining.newest_of_two_keys(pool_of_documents(spark, sf_dir), "doc_id", "text_key", "size_key", written)


def pool_of_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text_key"), F.concat_ws("/", "source", "n_chars").alias("size_key"))


def pool_rejections(spark, sf_dir):
    """How many documents of the pool go, by why: metadata rules first, then the dedup of what they let through, in one tally."""
    pool = pool_of_documents(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    rules = evaluation.first_failure([("language", F.col("lang") != "en"), ("short", F.col("n_chars") < 500)])
    judged = written(pool.withColumn("reason", rules), "pool-judged")
    passed = judged.where("reason IS NULL").drop("reason")
    dropped = mining.two_key_decisions(passed, "doc_id", "size_key", "text_key", written).where("reason IS NOT NULL")
    return evaluation.tally(judged).unionByName(evaluation.tally(dropped))


TURN_SQL = """
r AS (SELECT *, row_number() OVER (ORDER BY doc_id DESC) AS n FROM pool),
t AS (SELECT 0::BIGINT AS n, NULL::BIGINT AS doc_id, NULL::VARCHAR AS reason, [NULL::VARCHAR] AS a, [NULL::VARCHAR] AS b
      UNION ALL SELECT r.n, r.doc_id, CASE WHEN list_contains(t.a, r.first_key) THEN '{first}' WHEN list_contains(t.b, r.second_key) THEN '{second}' END AS why,
        CASE WHEN why IS NULL THEN list_append(t.a, r.first_key) ELSE t.a END, CASE WHEN why IS NULL THEN list_append(t.b, r.second_key) ELSE t.b END FROM t JOIN r ON r.n = t.n + 1)
"""
POOL_SQL = (
    "WITH RECURSIVE pool AS (SELECT doc_id, md5(text) AS first_key, source || '/' || n_chars AS second_key FROM documents),"
    + TURN_SQL.format(first="text_key", second="size_key")
    + "SELECT doc_id, sha256(d.text) AS text_key, source || '/' || n_chars AS size_key FROM t JOIN documents d USING (doc_id) WHERE reason IS NULL"
)
REJECTIONS_SQL = (
    "WITH RECURSIVE judged AS (SELECT *, CASE WHEN lang <> 'en' THEN 'language' WHEN n_chars < 500 THEN 'short' END AS reason FROM documents),"
    "pool AS (SELECT doc_id, source || '/' || n_chars AS first_key, md5(text) AS second_key FROM judged WHERE reason IS NULL),"
    + TURN_SQL.format(first="size_key", second="text_key")
    + "SELECT reason, count(*) AS n FROM (SELECT reason FROM judged UNION ALL SELECT reason FROM t) WHERE reason IS NOT NULL GROUP BY reason"
)


def hygiene_summary(spark, sf_dir):
    """Findings per check over all document pairs, with the first 12 of each."""
    p = document_pairs(spark, sf_dir)
    squeezed = lambda c: text.strip(F.regexp_replace(c, r"\s+", " "))
    checks = {
        "identical": squeezed(F.col("initial")) == squeezed(F.col("final")),
        "empty": F.length(squeezed(F.col("final"))) == 0,
        "line_count": F.abs(text.line_count(F.col("initial")) - text.line_count(F.col("final"))) > 1,
        "unbalanced": text.occurrences(F.col("final"), "(") != text.occurrences(F.col("final"), ")"),
    }
    hit = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]), lambda n: n.isNotNull())
    found = p.select("doc_id", F.explode(hit).alias("finding"))
    counts = found.groupBy("finding").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    first = found.withColumn("k", F.row_number().over(Window.partitionBy("finding").orderBy("doc_id"))).where("k <= 12")
    preview = first.groupBy("finding").agg(F.array_join(F.sort_array(F.collect_list("doc_id")).cast("array<string>"), ",").alias("preview"))
    return counts.join(preview, "finding")


HYGIENE_SQL = f"""
WITH {PAIRS_SQL},
s AS (SELECT doc_id, trim(regexp_replace(initial, '\\s+', ' ', 'g')) AS i, trim(regexp_replace(final, '\\s+', ' ', 'g')) AS f, initial, final FROM pairs),
h AS (SELECT doc_id, 'identical' AS finding FROM s WHERE i = f UNION ALL SELECT doc_id, 'empty' FROM s WHERE f = ''
      UNION ALL SELECT doc_id, 'line_count' FROM s WHERE abs(length(replace(initial, chr(10), chr(10) || ' ')) - length(initial) - length(replace(final, chr(10), chr(10) || ' ')) + length(final)) > 1
      UNION ALL SELECT doc_id, 'unbalanced' FROM s WHERE length(replace(final, '(', '')) <> length(replace(final, ')', ''))),
r AS (SELECT *, row_number() OVER (PARTITION BY finding ORDER BY doc_id) AS k FROM h)
SELECT finding, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FILTER (k <= 12) AS preview FROM r GROUP BY finding
"""



def audited_parts(spark, sf_dir):
    """A pair for each part, of twelve kinds that break different checks."""
    p, k = dealt(table(spark, sf_dir, "part"), "p_partkey"), F.col("p_partkey") % 12
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    name = F.when(k == 7, "dup").otherwise(F.concat(F.lit("part"), key))
    stated = F.concat(F.lit("theorem "), name, F.lit(" : Size "), size)
    initial = F.concat(stated, F.lit(" := by\n  norm_num\n  exact h"), key)
    final = (
        F.when(k == 0, F.concat(initial, F.lit(" -- same"))).when(k == 1, F.concat(stated, F.lit(" := by simp ("))).when(k == 2, F.concat(F.lit("theorem other : Size "), size, F.lit(" := by simp")))
        .when(k == 4, F.concat(F.lit("theorem "), name, F.lit(" : Other := by simp"))).when(k == 5, "-- gone").when(k == 7, "theorem dup : Size := by simp").when(k == 8, F.concat(stated, F.lit(" := do let x : MetaM Expr := y")))
        .otherwise(F.concat(stated, F.lit(" := by simp"), key))
    )
    return p.select(
        "p_partkey", F.concat(F.lit("Root."), name).alias("declaration"), F.when(k == 9, "scripts/x.lean").otherwise("Mathlib/A.lean").alias("file_path"), initial.alias("initial"), final.alias("final"),
        F.lit(3).alias("initial_lines"), F.when(k == 0, 3).when(k == 6, 9).otherwise(1).alias("final_lines"),
    )


def hygiene_audit(spark, sf_dir):
    from pairquarry.operators.hygiene import audit

    return audit(audited_parts(spark, sf_dir), "p_partkey")


AUDIT_SQL = """
WITH p AS (SELECT p_partkey, p_partkey % 12 AS k, CASE WHEN p_partkey % 12 = 7 THEN 'dup' ELSE 'part' || p_partkey END AS name, p_size FROM part),
s AS (SELECT *, 'theorem ' || name || ' : Size ' || p_size AS sig_i FROM p),
c AS (SELECT *, sig_i || ' := by norm_num exact h' || p_partkey AS code_i,
  CASE k WHEN 2 THEN 'theorem other : Size ' || p_size WHEN 4 THEN 'theorem ' || name || ' : Other' WHEN 5 THEN '' WHEN 7 THEN 'theorem dup : Size' ELSE sig_i END AS sig_f FROM s),
f AS (SELECT *, CASE k WHEN 0 THEN code_i WHEN 1 THEN sig_f || ' := by simp (' WHEN 5 THEN '' WHEN 8 THEN sig_f || ' := do let x : MetaM Expr := y' WHEN 2 THEN sig_f || ' := by simp' WHEN 4 THEN sig_f || ' := by simp'
  WHEN 7 THEN sig_f || ' := by simp' ELSE sig_f || ' := by simp' || p_partkey END AS code_f FROM c)
SELECT 'identical_after_comment_strip' AS finding, p_partkey, '' AS side FROM f WHERE code_i = code_f
UNION ALL SELECT 'unbalanced_brackets', p_partkey, 'final' FROM f WHERE k = 1
UNION ALL SELECT 'declaration_name_absent', p_partkey, 'final' FROM f WHERE k IN (2, 5)
UNION ALL SELECT 'signature_actually_differs', p_partkey, '' FROM f WHERE sig_i <> sig_f
UNION ALL SELECT 'empty_proof_body', p_partkey, '' FROM f WHERE code_f = ''
UNION ALL SELECT 'line_count_mismatch', p_partkey, '' FROM f WHERE k = 6
UNION ALL SELECT 'non_mathematical_path', p_partkey, '' FROM f WHERE k = 9
UNION ALL SELECT 'metaprogram_code', p_partkey, '' FROM f WHERE k = 8
UNION ALL SELECT 'duplicate_final_proof', min(p_partkey), count(*) || ' rows' FROM f GROUP BY code_f HAVING count(*) > 1
UNION ALL SELECT 'duplicate_initial_proof', min(p_partkey), count(*) || ' rows' FROM f GROUP BY code_i HAVING count(*) > 1
"""

QUERIES = {
    "bag_token_diff": bag_token_diff, "meaningful_pairs": meaningful_pairs, "multiset_except": multiset_except, "duplicate_groups": duplicate_groups, "duplicate_members": duplicate_members, "stored_line_counts": stored_line_counts, "diff_declarations": diff_declarations, "tactic_blocks": tactic_blocks, "line_counts": line_counts,
    "bracket_balance": bracket_balance, "strip_comments_synth": strip_comments_synth, "block_parse_synth": block_parse_synth, "diff_hunks_synth": diff_hunks_synth, "json_lenient": json_lenient,
    "body_similarity": body_similarity, "name_suffix_present": name_suffix_present, "keyword_union": keyword_union, "base64_content": base64_content, "snapshot_align": snapshot_align,
    "anchor_lookup": anchor_lookup, "greedy_pool_dedup": greedy_pool_dedup, "pool_rejections": pool_rejections, "hygiene_summary": hygiene_summary, "hygiene_audit": hygiene_audit,
}
ORACLE_SQL = {
    "bag_token_diff": DIFF_SQL + "SELECT * FROM diff", "meaningful_pairs": MEANINGFUL_SQL, "multiset_except": MULTISET_SQL, "duplicate_groups": DUPLICATES_SQL, "duplicate_members": MEMBERS_SQL, "stored_line_counts": STORED_SQL, "diff_declarations": DECLARATIONS_SQL, "tactic_blocks": TACTICS_SQL, "line_counts": LINES_SQL,
    "bracket_balance": BRACKETS_SQL, "strip_comments_synth": STRIP_SQL, "block_parse_synth": BLOCKS_SQL, "diff_hunks_synth": HUNKS_SQL, "json_lenient": JSON_SQL, "body_similarity": SIMILARITY_SQL, "name_suffix_present": SUFFIX_SQL,
    "keyword_union": KEYWORD_SQL, "base64_content": BASE64_SQL, "snapshot_align": SNAPSHOT_SQL, "anchor_lookup": ANCHOR_SQL, "greedy_pool_dedup": POOL_SQL, "pool_rejections": REJECTIONS_SQL, "hygiene_summary": HYGIENE_SQL, "hygiene_audit": AUDIT_SQL,
}
