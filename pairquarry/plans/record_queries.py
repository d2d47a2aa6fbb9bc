"""Queries over review records. Orders stand for merge requests, order lines for pairs and candidates, conversation
turns for comments (system turns for bots), events for the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairquarry.functions import text
from pairquarry.operators import ledger, mining, reviews
from pairquarry.session import table

# ---- ledger -------------------------------------------------------------------------------------------------

EVENTS_SQL = """
ev AS (SELECT user_id * 100 + event_id % 100 AS pr, ts, event_id, value, event_type,
  CASE WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'manual' WHEN event_type IN ('click', 'purchase') THEN 'keyword_search' ELSE 'full_scan' END AS source,
  CASE WHEN event_type IN ('click', 'purchase') THEN event_type END AS query,
  CASE event_type WHEN 'view' THEN 'enriched' WHEN 'click' THEN 'extracted' WHEN 'purchase' THEN 'parsed' WHEN 'signup' THEN CASE WHEN event_id % 3 = 0 THEN 'assembled' ELSE 'summarized' END ELSE 'error' END AS phase
  FROM events)
"""


def ledger_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind, n = F.col("event_type"), F.col("event_id")
    keyword = kind.isin("click", "purchase")
    return e.select(
        (F.col("user_id") * 100 + n % 100).alias("pr"), "ts", "event_id", "value", "event_type",
        F.when((kind == "signup") & (n % 5 == 0), "manual").when(keyword, "keyword_search").otherwise("full_scan").alias("source"),
        F.when(keyword, kind).alias("query"),
        F.when(kind == "view", "enriched").when(kind == "click", "extracted").when(kind == "purchase", "parsed").when(kind == "signup", F.when(n % 3 == 0, "assembled").otherwise("summarized")).otherwise("error").alias("phase"),
    )


def ledger_fold(spark, sf_dir):
    return ledger.folded_candidates(ledger_events(spark, sf_dir))


FOLD = f"""{EVENTS_SQL},
li AS (SELECT pr, max(ts) AS last_ts, max(ts) FILTER (query IS NULL) AS null_ts, bool_or(source = 'manual') AS manual, arg_max(source, ts) AS last_source FROM ev GROUP BY pr),
fold AS (SELECT pr, CASE WHEN manual THEN 'manual' ELSE last_source END AS source,
  (SELECT string_agg(query, ',' ORDER BY ts) FROM ev WHERE ev.pr = li.pr AND (null_ts IS NULL OR ts > null_ts)) AS source_query FROM li)
"""


def phase_funnel(spark, sf_dir):
    return ledger.funnel(ledger_events(spark, sf_dir))


FUNNEL_SQL = f"""WITH {EVENTS_SQL},
p AS (SELECT pr, bool_or(phase = 'enriched') AS a, bool_or(phase = 'extracted') AS b, bool_or(phase = 'parsed') AS c, bool_or(phase = 'summarized') AS d, bool_or(phase = 'assembled') AS e, bool_or(phase = 'error') AS x FROM ev GROUP BY pr)
SELECT count(*) AS discovered, count(*) FILTER (a) AS enriched, count(*) FILTER (b) AS extracted, count(*) FILTER (c) AS parsed, count(*) FILTER (d) AS summarized, count(*) FILTER (e) AS assembled, count(*) FILTER (x) AS with_errors FROM p
"""


def phase_times(spark, sf_dir):
    return ledger.phase_table(ledger_events(spark, sf_dir))


PHASES_SQL = f"WITH {EVENTS_SQL} SELECT pr, " + ", ".join(f"max(ts) FILTER (phase = '{p}') AS {p}" for p in ledger.PHASES) + " FROM ev GROUP BY pr HAVING count(*) FILTER (phase <> 'error') > 0"


def error_gate(spark, sf_dir):
    return ledger.pending(ledger_events(spark, sf_dir), "parsed", after="extracted")


GATE_SQL = f"""WITH {EVENTS_SQL}
SELECT pr, count(*) FILTER (phase = 'error') AS error_count FROM ev GROUP BY pr
HAVING count(*) FILTER (phase = 'parsed') = 0 AND count(*) FILTER (phase = 'extracted') > 0 AND count(*) FILTER (phase = 'error') < 3
"""


def extraction_priority(spark, sf_dir):
    done = ledger.by_priority(ledger_fold(spark, sf_dir))
    return done.select("pr", "source", "tier", F.col("hits").cast("long").alias("hits"))


PRIORITY_SQL = f"""WITH {FOLD}
SELECT pr, source, CASE WHEN source = 'keyword_search' THEN 0 ELSE 1 END AS tier, coalesce(length(source_query) - length(replace(source_query, ',', '')), 0)::BIGINT AS hits FROM fold
"""


def last_wins_metadata(spark, sf_dir):
    return mining.last_wins(ledger_events(spark, sf_dir).select("pr", "ts", "event_id", "event_type", "value"), ["pr"], ["ts"])


LAST_SQL = f"WITH {EVENTS_SQL} SELECT pr, ts, event_id, event_type, value FROM ev QUALIFY row_number() OVER (PARTITION BY pr ORDER BY ts DESC) = 1"


def enrich_update(spark, sf_dir):
    """The ledger with what orders know about each record; records without an order stay as they are."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pr"), F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("title"))
    folded = ledger_fold(spark, sf_dir).select("pr", "source")
    return folded.join(o, "pr", "left").select("pr", "source", F.coalesce("state", F.lit("?")).alias("state"), "title", F.col("state").isNotNull().alias("is_enriched"))


ENRICH_SQL = f"WITH {FOLD} SELECT pr, source, coalesce(o_orderstatus, '?') AS state, o_orderpriority AS title, o_orderkey IS NOT NULL AS is_enriched FROM fold LEFT JOIN orders ON o_orderkey = pr"

# ---- merge requests -----------------------------------------------------------------------------------------

REQUESTS_SQL = """
req AS (SELECT o_orderkey AS pr, CASE WHEN o_orderkey % 3 = 0 THEN '[Merged by Bors] - ' ELSE '' END || o_orderpriority AS title, CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'CLOSED' END AS state,
  o_orderkey % 11 = 0 AS merged, CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS author_key, o_orderdate AS created FROM orders)
"""


def requests(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("pr"), F.concat(F.when(F.col("o_orderkey") % 3 == 0, reviews.MERGED_PREFIX).otherwise(""), "o_orderpriority").alias("title"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("CLOSED").alias("state"), (F.col("o_orderkey") % 11 == 0).alias("merged"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("author_key"), F.col("o_orderdate").alias("created"),
    )


def merge_status(spark, sf_dir):
    return requests(spark, sf_dir).select("pr", reviews.merge_status(F.col("title"), F.col("state"), F.col("merged")).alias("status"), reviews.plain_title(F.col("title")).alias("plain_title"))


STATUS_SQL = f"""WITH {REQUESTS_SQL}
SELECT pr, CASE WHEN merged THEN 'github_merged' WHEN upper(state) = 'OPEN' THEN 'open' WHEN starts_with(title, '[Merged by Bors] - ') THEN 'merged_by_bors' ELSE 'closed_not_merged' END AS status,
       CASE WHEN starts_with(title, '[Merged by Bors] - ') THEN substr(title, 20) ELSE title END AS plain_title FROM req
"""
PATH_SQL = """CASE WHEN l_partkey % 7 = 0 THEN 'scripts/' WHEN l_partkey % 7 = 1 THEN 'Mathlib/Tactic/' WHEN l_partkey % 7 = 2 THEN 'Archive/' WHEN l_partkey % 7 = 3 THEN 'Mathlib/Data/Linter/' ELSE 'Mathlib/Algebra/' END
  || l_partkey || CASE WHEN l_suppkey % 4 = 0 THEN '.md' ELSE '.lean' END"""


def line_path():
    m = F.col("l_partkey") % 7
    folder = F.when(m == 0, "scripts/").when(m == 1, "Mathlib/Tactic/").when(m == 2, "Archive/").when(m == 3, "Mathlib/Data/Linter/").otherwise("Mathlib/Algebra/")
    return F.concat(folder, F.col("l_partkey").cast("string"), F.when(F.col("l_suppkey") % 4 == 0, ".md").otherwise(".lean"))


def qualify_prs(spark, sf_dir):
    """Requests that are merged, touch proofs, were reviewed, and add at least 3."""
    files = table(spark, sf_dir, "lineitem").withColumn("path", line_path())
    touched = files.groupBy(F.col("l_orderkey").alias("pr")).agg(
        F.bool_or(reviews.is_source(F.col("path")) & ~reviews.is_infrastructure(F.col("path"))).alias("touches_proofs"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_reviews"), F.count_if(F.col("l_linestatus") == "O").alias("n_threads"), F.sum(F.col("l_quantity").cast("long")).alias("additions"),
    )
    r = requests(spark, sf_dir).withColumn("status", reviews.merge_status(F.col("title"), F.col("state"), F.col("merged")))
    return r.join(touched, "pr").where(F.col("status").isin("github_merged", "merged_by_bors") & F.col("touches_proofs") & reviews.has_review_activity(F.col("n_reviews"), F.col("n_threads")) & (F.col("additions") >= 3)).select("pr", "status", "n_reviews", "n_threads", "additions")


QUALIFY_SQL = f"""WITH {REQUESTS_SQL},
f AS (SELECT *, {PATH_SQL} AS path FROM lineitem),
t AS (SELECT l_orderkey AS pr, bool_or(ends_with(path, '.lean') AND NOT regexp_matches(path, '^(scripts/|Mathlib/Tactic/)')) AS touches, count(*) FILTER (l_returnflag = 'R') AS n_reviews, count(*) FILTER (l_linestatus = 'O') AS n_threads, sum(l_quantity::BIGINT)::BIGINT AS additions FROM f GROUP BY ALL),
s AS (SELECT *, CASE WHEN merged THEN 'github_merged' WHEN upper(state) = 'OPEN' THEN 'open' WHEN starts_with(title, '[Merged') THEN 'merged_by_bors' ELSE 'closed_not_merged' END AS status FROM req)
SELECT pr, status, n_reviews, n_threads, additions FROM s JOIN t USING (pr) WHERE status IN ('github_merged', 'merged_by_bors') AND touches AND (n_reviews >= 1 OR n_threads >= 1) AND additions >= 3
"""


def flatten_defaults(spark, sf_dir):
    """Requests with their author's login, or ghost; empty lists and defaults instead of nulls."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("author_key"), F.col("c_name").alias("login"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("label"))
    j = requests(spark, sf_dir).join(c, "author_key", "left")
    labels = F.filter(F.array("label"), lambda x: x.isNotNull())
    return j.select("pr", reviews.login_or_ghost(F.col("login")).alias("author"), F.array_join(labels, ",").alias("labels"), F.size(labels).alias("n_labels"), F.coalesce(F.nullif("title", F.lit("2-HIGH")), F.lit("master")).alias("base_ref"))


FLATTEN_SQL = f"""WITH {REQUESTS_SQL}
SELECT pr, coalesce(c_name, 'ghost') AS author, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS labels, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS n_labels, coalesce(nullif(title, '2-HIGH'), 'master') AS base_ref
FROM req LEFT JOIN customer ON c_custkey = author_key
"""


def file_level_filter(spark, sf_dir):
    """Per request: files, sources, and sources outside the infrastructure; the two filters differ on purpose."""
    f = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr"), line_path().alias("path"))
    src, infra = reviews.is_source(F.col("path")), reviews.is_infrastructure(F.col("path"))
    return f.groupBy("pr").agg(F.count(F.lit(1)).alias("n_files"), F.count_if(src).alias("n_sources"), F.count_if(src & ~infra).alias("n_proof_files"))


FILES_SQL = f"""WITH f AS (SELECT l_orderkey AS pr, {PATH_SQL} AS path FROM lineitem)
SELECT pr, count(*) AS n_files, count(*) FILTER (ends_with(path, '.lean')) AS n_sources, count(*) FILTER (ends_with(path, '.lean') AND NOT regexp_matches(path, '^(scripts/|Mathlib/Tactic/)')) AS n_proof_files FROM f GROUP BY pr
"""
LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def first_last_commit(spark, sf_dir):
    """First and last line of each order by date; a request with one commit has no pair."""
    li = table(spark, sf_dir, "lineitem")
    order = F.struct(*LINE_ORDER)
    return li.groupBy(F.col("l_orderkey").alias("pr")).agg(F.min_by("l_partkey", order).alias("first_sha"), F.max_by("l_partkey", order).alias("last_sha"), F.count(F.lit(1)).alias("n_commits")).withColumn("has_pair", F.col("n_commits") > 1)


COMMITS_SQL = f"""WITH o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
SELECT l_orderkey AS pr, max(l_partkey) FILTER (i = 1) AS first_sha, max(l_partkey) FILTER (i = n) AS last_sha, any_value(n) AS n_commits, any_value(n) > 1 AS has_pair FROM o GROUP BY l_orderkey
"""


def first_wins_dedup(spark, sf_dir):
    """New rows against those already in the dataset and against earlier rows of the same run, by request and name."""
    li = table(spark, sf_dir, "lineitem").withColumn("declaration", F.col("l_partkey") % 5)
    rows = li.select(F.col("l_orderkey").alias("pr"), "declaration", *LINE_ORDER)
    before = rows.where("pr % 9 = 0 AND declaration = 1").select("pr", "declaration").distinct()
    first = mining.first_wins(rows, ["pr", "declaration"], LINE_ORDER)
    return first.join(before, ["pr", "declaration"], "left_anti").select("pr", "declaration", "l_partkey", "l_linenumber")


FIRST_SQL = f"""SELECT l_orderkey AS pr, l_partkey % 5 AS declaration, l_partkey, l_linenumber FROM lineitem WHERE NOT (l_orderkey % 9 = 0 AND l_partkey % 5 = 1)
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey % 5 ORDER BY {', '.join(LINE_ORDER)}) = 1"""


def pair_label_join(spark, sf_dir):
    """Labelled pairs with their request, its author, and optional context; misses of the inner joins go."""
    li = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(s, "l_suppkey", "left")
    return j.groupBy(F.col("l_orderkey").alias("pr")).agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.col("s_name").isNull()).alias("n_without_context"), F.max("c_name").alias("author"), F.min(F.coalesce("s_name", F.lit(""))).alias("first_context"))


PAIRS_SQL = """SELECT l_orderkey AS pr, count(*) AS n_pairs, count(*) FILTER (s_name IS NULL) AS n_without_context, max(c_name) AS author, min(coalesce(s_name, '')) AS first_context
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = l_suppkey WHERE l_returnflag = 'R' GROUP BY l_orderkey"""


def universe_nullsafe(spark, sf_dir):
    """Pairs with their label by request, name (null equals null) and file; the label is the last one of its key."""
    key = [F.col("l_orderkey").alias("pr"), F.when(F.col("l_partkey") % 4 != 0, F.col("l_partkey") % 4).alias("declaration"), (F.col("l_suppkey") % 3).alias("file")]
    li = table(spark, sf_dir, "lineitem")
    pairs = li.where("l_linestatus = 'O'").groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(F.col("l_quantity").cast("long")).alias("initial_lines"), F.max(F.col("l_quantity").cast("long")).alias("final_lines"))
    labels = mining.last_wins(li.where("l_linestatus = 'F'").select(*key, "l_returnflag", *LINE_ORDER), ["pr", "declaration", "file"], [*LINE_ORDER, "l_returnflag"]).select("pr", "declaration", "file", F.col("l_returnflag").alias("verdict"))
    j = mining.null_safe_join(pairs, labels, ["pr", "declaration", "file"])
    return j.select("pr", "declaration", "file", "n", "verdict", (F.col("final_lines") / F.greatest("initial_lines", F.lit(1))).alias("ratio"))


UNIVERSE_SQL = f"""WITH k AS (SELECT *, l_orderkey AS pr, CASE WHEN l_partkey % 4 <> 0 THEN l_partkey % 4 END AS declaration, l_suppkey % 3 AS file FROM lineitem),
p AS (SELECT pr, declaration, file, count(*) AS n, min(l_quantity::BIGINT) AS a, max(l_quantity::BIGINT) AS b FROM k WHERE l_linestatus = 'O' GROUP BY ALL),
l AS (SELECT * FROM k WHERE l_linestatus = 'F' QUALIFY row_number() OVER (PARTITION BY pr, declaration, file ORDER BY {', '.join(c + ' DESC' for c in [*LINE_ORDER, 'l_returnflag'])}) = 1)
SELECT p.pr, p.declaration, p.file, n, l.l_returnflag AS verdict, b::DOUBLE / greatest(a, 1) AS ratio
FROM p LEFT JOIN l ON p.pr = l.pr AND p.declaration IS NOT DISTINCT FROM l.declaration AND p.file = l.file
"""


def pr_verdict_counts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    v = F.col("l_returnflag")
    return li.groupBy(F.col("l_orderkey").alias("pr")).agg(F.count_if(v == "R").alias("high"), F.count_if(v == "N").alias("low"), F.count_if(v == "A").alias("contextual"), F.sum(F.col("l_quantity").cast("long")).alias("tokens"))


VERDICTS_SQL = "SELECT l_orderkey AS pr, count(*) FILTER (l_returnflag = 'R') AS high, count(*) FILTER (l_returnflag = 'N') AS low, count(*) FILTER (l_returnflag = 'A') AS contextual, sum(l_quantity::BIGINT)::BIGINT AS tokens FROM lineitem GROUP BY l_orderkey"


def name_match_pairs(spark, sf_dir):
    """Initial (F) and final (O) lines of an order matched by line number; the last of a name counts."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr"), F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("name"), "l_linestatus", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    side = lambda s: li.where(F.col("l_linestatus") == s).drop("l_linestatus")
    m = mining.matched_blocks(side("F"), side("O"), ["pr", "name"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return m.select("pr", "name", "initial_l_partkey", "final_l_partkey", (F.col("initial_l_partkey") != F.col("final_l_partkey")).alias("changed"))


MATCH_SQL = """WITH s AS (SELECT l_orderkey AS pr, l_linenumber AS name, l_linestatus, l_partkey FROM lineitem WHERE l_linenumber <> 7
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_linestatus ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1)
SELECT a.pr, a.name, a.l_partkey AS initial_l_partkey, b.l_partkey AS final_l_partkey, a.l_partkey <> b.l_partkey AS changed FROM s a JOIN s b ON a.pr = b.pr AND a.name = b.name AND a.l_linestatus = 'F' AND b.l_linestatus = 'O'"""


def text_lookup_joins(spark, sf_dir):
    """Candidates with their text and summary; a missing text is a reason to reject, a missing summary is empty."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pr"))
    j = o.join(d.select(F.col("doc_id").alias("pr"), "n_chars"), "pr", "left").join(d.where("doc_id % 3 = 0").select(F.col("doc_id").alias("pr"), "lang"), "pr", "left")
    return j.select("pr", F.when(F.col("n_chars").isNull(), "no parsing record").alias("reason"), F.coalesce("lang", F.lit("{}")).alias("summary"), F.coalesce("n_chars", F.lit(0)).alias("n_chars"))


LOOKUP_SQL = "SELECT o_orderkey AS pr, CASE WHEN d.doc_id IS NULL THEN 'no parsing record' END AS reason, coalesce(CASE WHEN d.doc_id % 3 = 0 THEN lang END, '{}') AS summary, coalesce(n_chars, 0) AS n_chars FROM orders LEFT JOIN documents d ON doc_id = o_orderkey"


def pr_rollup(spark, sf_dir):
    """One row per request: distinct files, its declarations, merged categories, summed sizes."""
    li = table(spark, sf_dir, "lineitem")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return li.groupBy(F.col("l_orderkey").alias("pr")).agg(joined(F.col("l_suppkey").cast("string")).alias("files"), F.count(F.lit(1)).alias("n_declarations"), joined("l_returnflag").alias("categories"), F.sum(F.col("l_quantity").cast("long")).alias("lines"))


ROLLUP_SQL = """SELECT l_orderkey AS pr, array_to_string(list_sort(list(DISTINCT l_suppkey::VARCHAR)), ',') AS files, count(*) AS n_declarations, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS categories,
sum(l_quantity::BIGINT)::BIGINT AS lines FROM lineitem GROUP BY l_orderkey"""


def corpus_stats(spark, sf_dir):
    """Per verdict: rows, share of all, how many shrank, stayed and grew, sum and median of the size change, distinct requests."""
    li = table(spark, sf_dir, "lineitem").withColumn("delta", F.col("l_quantity").cast("long") - F.col("l_linenumber") * 6)
    s = li.groupBy(F.col("l_returnflag").alias("verdict")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("delta") < 0).alias("shrank"), F.count_if(F.col("delta") == 0).alias("same_size"), F.count_if(F.col("delta") > 0).alias("grew"),
        F.sum("delta").alias("delta_sum"), F.percentile("delta", F.lit(0.5)).alias("delta_median"), F.count_distinct("l_orderkey").alias("n_prs"),
    )
    total = li.agg(F.count(F.lit(1)).alias("total"))
    return s.join(F.broadcast(total)).withColumn("share", F.col("n") / F.col("total")).drop("total")


STATS_SQL = """WITH l AS (SELECT *, l_quantity::BIGINT - l_linenumber * 6 AS delta FROM lineitem)
SELECT l_returnflag AS verdict, count(*) AS n, count(*) FILTER (delta < 0) AS shrank, count(*) FILTER (delta = 0) AS same_size, count(*) FILTER (delta > 0) AS grew, sum(delta)::BIGINT AS delta_sum,
       quantile_cont(delta, 0.5)::DOUBLE AS delta_median, count(DISTINCT l_orderkey) AS n_prs, count(*)::DOUBLE / (SELECT count(*) FROM l) AS share FROM l GROUP BY l_returnflag"""


def review_duration(spark, sf_dir):
    """Days from an order to its last line, unrounded; 0 for open ones."""
    last = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("pr")).agg(F.max("l_shipdate").alias("closed"))
    r = requests(spark, sf_dir).join(last, "pr", "left")
    closed = F.when(F.col("state") != "open", F.col("closed"))
    return r.select("pr", reviews.days_between(F.col("created"), closed).alias("days"), F.substring(F.col("created").cast("string"), 1, 4).alias("year"))


DURATION_SQL = f"""WITH {REQUESTS_SQL}, c AS (SELECT l_orderkey AS pr, max(l_shipdate) AS closed FROM lineitem GROUP BY ALL)
SELECT pr, coalesce(CASE WHEN state <> 'open' THEN (epoch_us(closed::TIMESTAMP) - epoch_us(created::TIMESTAMP)) / 86400000000.0::DOUBLE END, 0.0)::DOUBLE AS days, substr(created::VARCHAR, 1, 4) AS year FROM req LEFT JOIN c USING (pr)"""


def pr_context_join(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pr"), "source", "n_chars")
    return pr_rollup(spark, sf_dir).join(d, "pr").select("pr", "n_declarations", "source", "n_chars")


CONTEXT_SQL = "SELECT l_orderkey AS pr, count(*) AS n_declarations, any_value(source) AS source, any_value(n_chars) AS n_chars FROM lineitem JOIN documents ON doc_id = l_orderkey GROUP BY l_orderkey"

# ---- comments -----------------------------------------------------------------------------------------------

LOGIN_SQL = "CASE role WHEN 'system' THEN 'github-actions[bot]' ELSE role || (turn % 3) END"


def comments(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("pr"), "turn", F.when(F.col("role") == "system", "github-actions[bot]").otherwise(F.concat("role", (F.col("turn") % 3).cast("string"))).alias("author"), F.col("text").alias("body"))


def human_comment_counts(spark, sf_dir):
    """Comments by people, their authors in order, and whether changes were requested."""
    c = comments(spark, sf_dir)
    human = ~reviews.is_bot(F.col("author"))
    spoken = human & (F.length(text.strip(F.col("body"))) > 0)
    return c.groupBy("pr").agg(F.count_if(spoken).alias("n_human"), F.array_join(F.array_sort(F.collect_set(F.when(human, F.col("author")))), ",").alias("reviewers"), F.coalesce(F.bool_or(human & (F.col("turn") % 4 == 3)), F.lit(False)).alias("changes_requested"))


HUMAN_SQL = f"""WITH c AS (SELECT conv_id AS pr, turn, {LOGIN_SQL} AS author, text AS body FROM conversations)
SELECT pr, count(*) FILTER (NOT ends_with(author, '[bot]') AND regexp_replace(body, '\\s', '', 'g') <> '') AS n_human, coalesce(array_to_string(list_sort(list(DISTINCT author) FILTER (NOT ends_with(author, '[bot]'))), ','), '') AS reviewers,
       bool_or(NOT ends_with(author, '[bot]') AND turn % 4 = 3) AS changes_requested FROM c GROUP BY pr"""


def ranked_comments(spark, sf_dir):
    """Comments of each record by priority: on the declaration, on its file, other remarks; noise and bots go."""
    c = comments(spark, sf_dir).where(~reviews.is_bot(F.col("author")))
    on_file, on_declaration = F.col("turn") % 2 == 1, F.contains("body", F.lit("the"))
    priority = F.when(on_file & on_declaration, 1).when(on_file, 2).when(~reviews.noise(F.col("body")), 3)
    return c.withColumn("priority", priority).where("priority IS NOT NULL").withColumn("formatted", reviews.inline_text(F.col("author"), F.lit("f.lean"), F.when(F.col("turn") % 5 != 0, F.col("turn")), F.col("body")))


RANKED_SQL = rf"""
c AS (SELECT conv_id AS pr, turn, {LOGIN_SQL} AS author, regexp_replace(text, '^[\s\x0B\x1c-\x1f\x85\p{{Z}}]+|[\s\x0B\x1c-\x1f\x85\p{{Z}}]+$', '', 'g') AS b, text AS body FROM conversations WHERE role <> 'system'),
q AS (SELECT *, CASE WHEN turn % 2 = 1 AND contains(body, 'the') THEN 1 WHEN turn % 2 = 1 THEN 2 WHEN NOT (starts_with(b, 'bors') OR length(b) < 20) THEN 3 END AS priority,
        '[Inline comment by @' || author || ' on f.lean' || CASE WHEN turn % 5 <> 0 THEN ':' || turn ELSE '' END || '] ' || b AS formatted FROM c)
"""


def comment_context_rank(spark, sf_dir):
    r = ranked_comments(spark, sf_dir)
    return r.select("pr", "turn", "priority", F.length("formatted").cast("long").alias("n_chars"), F.sha2("formatted", 256).alias("sha"))


RANK_SQL = f"WITH {RANKED_SQL} SELECT pr, turn, priority, length(formatted) AS n_chars, sha256(formatted) AS sha FROM q WHERE priority IS NOT NULL"
BUDGET = 1500


def comment_budget_prefix(spark, sf_dir):
    """The comments of each record that fit the budget, by priority and turn."""
    rows = F.array_sort(F.collect_list(F.struct("priority", F.col("turn").alias("position"), F.col("formatted").alias("text"))))
    g = ranked_comments(spark, sf_dir).groupBy("pr").agg(rows.alias("c"))
    taken = mining.by_priority_within_budget(F.col("c"), BUDGET)
    return g.select("pr", F.size("c").cast("long").alias("n_comments"), taken.alias("t")).select("pr", "n_comments", F.size("t").cast("long").alias("n_taken"), F.sha2(F.array_join("t", "\n\n"), 256).alias("context_sha"))


BUDGET_SQL = f"""WITH RECURSIVE {RANKED_SQL},
o AS (SELECT pr, priority, formatted, row_number() OVER (PARTITION BY pr ORDER BY priority, turn, formatted) AS i FROM q WHERE priority IS NOT NULL),
w AS (SELECT pr, 0::BIGINT AS i, {BUDGET}::BIGINT AS budget, -1 AS grp, false AS stopped, false AS over, NULL::VARCHAR AS ctx, 0::BIGINT AS n_taken FROM (SELECT DISTINCT pr FROM o)
      UNION ALL
      SELECT pr, i, CASE WHEN takes THEN budget - length(formatted) - 1 ELSE budget END, priority, stopped, over, CASE WHEN takes THEN coalesce(ctx || chr(10) || chr(10), '') || formatted ELSE ctx END, n_taken + takes::INT
      FROM (SELECT *, NOT stopped AND NOT over AS takes FROM (SELECT w.pr, o.i, o.priority, o.formatted, w.budget, w.ctx, w.n_taken, (o.priority = w.grp AND w.stopped) OR length(o.formatted) > w.budget AS stopped,
              w.over OR (o.priority <> w.grp AND w.grp >= 0 AND w.budget <= 0) AS over FROM w JOIN o ON o.pr = w.pr AND o.i = w.i + 1)))
SELECT pr, max(i) AS n_comments, arg_max(n_taken, i) AS n_taken, sha256(coalesce(max_by(ctx, i), '')) AS context_sha FROM (SELECT *, coalesce(ctx, '') AS c FROM w) GROUP BY pr
"""


def extraction_gather(spark, sf_dir):
    """What comments, events and lines know of each record, side by side; missing parts count as empty."""
    c = comments(spark, sf_dir).groupBy("pr").agg(F.count(F.lit(1)).alias("n_comments"), F.collect_set("author").alias("a"))
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("pr")).agg(F.count(F.lit(1)).alias("n_events"), F.collect_set("event_type").alias("b"))
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("pr")).agg(F.count(F.lit(1)).alias("n_lines"))
    none = F.array().cast("array<string>")
    zero = lambda x: F.coalesce(x, F.lit(0)).alias(x)
    j = c.join(e, "pr", "full").join(li, "pr", "full")
    return j.select("pr", zero("n_comments"), zero("n_events"), zero("n_lines"), F.array_join(F.array_sort(F.array_union(F.coalesce("a", none), F.coalesce("b", none))), ",").alias("names"))


GATHER_SQL = f"""WITH c AS (SELECT conv_id AS pr, count(*) AS n, list(DISTINCT {LOGIN_SQL}) AS a FROM conversations GROUP BY ALL),
e AS (SELECT user_id AS pr, count(*) AS n, list(DISTINCT event_type) AS b FROM events GROUP BY ALL), l AS (SELECT l_orderkey AS pr, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT pr, coalesce(c.n, 0) AS n_comments, coalesce(e.n, 0) AS n_events, coalesce(l.n, 0) AS n_lines, array_to_string(list_sort(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))), ',') AS names
FROM c FULL JOIN e USING (pr) FULL JOIN l USING (pr)"""


def array_predicates(spark, sf_dir):
    """List functions over a record's lines: any, all, membership, slice, extremes."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("pr")).agg(F.array_sort(F.collect_list(F.col("l_quantity").cast("long"))).alias("q"))
    return li.select("pr", F.size("q").cast("long").alias("n"), F.exists("q", lambda x: x >= 45).alias("any_large"), F.forall("q", lambda x: x >= 5).alias("all_some"), F.array_contains("q", F.lit(7).cast("long")).alias("has_seven"), F.array_join(F.slice("q", 1, 3).cast("array<string>"), ",").alias("least"), F.size(F.filter("q", lambda x: x % 2 == 0)).cast("long").alias("n_even"))


ARRAY_SQL = """WITH l AS (SELECT l_orderkey AS pr, list_sort(list(l_quantity::BIGINT)) AS q FROM lineitem GROUP BY ALL)
SELECT pr, len(q)::BIGINT AS n, list_max(q) >= 45 AS any_large, list_min(q) >= 5 AS all_some, list_contains(q, 7) AS has_seven, array_to_string(q[1:3], ',') AS least, len(list_filter(q, lambda x: x % 2 = 0))::BIGINT AS n_even FROM l"""

QUERIES = {
    "ledger_fold": ledger_fold, "phase_funnel": phase_funnel, "phase_times": phase_times, "error_gate": error_gate, "extraction_priority": extraction_priority, "last_wins_metadata": last_wins_metadata, "enrich_update": enrich_update,
    "merge_status": merge_status, "qualify_prs": qualify_prs, "flatten_defaults": flatten_defaults, "file_level_filter": file_level_filter, "first_last_commit": first_last_commit, "first_wins_dedup": first_wins_dedup,
    "pair_label_join": pair_label_join, "universe_nullsafe": universe_nullsafe, "pr_verdict_counts": pr_verdict_counts, "name_match_pairs": name_match_pairs, "text_lookup_joins": text_lookup_joins, "pr_rollup": pr_rollup,
    "corpus_stats": corpus_stats, "review_duration": review_duration, "pr_context_join": pr_context_join, "human_comment_counts": human_comment_counts, "comment_context_rank": comment_context_rank,
    "comment_budget_prefix": comment_budget_prefix, "extraction_gather": extraction_gather, "array_predicates": array_predicates,
}
ORACLE_SQL = {
    "ledger_fold": f"WITH {FOLD} SELECT * FROM fold", "phase_funnel": FUNNEL_SQL, "phase_times": PHASES_SQL, "error_gate": GATE_SQL, "extraction_priority": PRIORITY_SQL, "last_wins_metadata": LAST_SQL, "enrich_update": ENRICH_SQL,
    "merge_status": STATUS_SQL, "qualify_prs": QUALIFY_SQL, "flatten_defaults": FLATTEN_SQL, "file_level_filter": FILES_SQL, "first_last_commit": COMMITS_SQL, "first_wins_dedup": FIRST_SQL, "pair_label_join": PAIRS_SQL,
    "universe_nullsafe": UNIVERSE_SQL, "pr_verdict_counts": VERDICTS_SQL, "name_match_pairs": MATCH_SQL, "text_lookup_joins": LOOKUP_SQL, "pr_rollup": ROLLUP_SQL, "corpus_stats": STATS_SQL, "review_duration": DURATION_SQL,
    "pr_context_join": CONTEXT_SQL, "human_comment_counts": HUMAN_SQL, "comment_context_rank": RANK_SQL, "comment_budget_prefix": BUDGET_SQL, "extraction_gather": GATHER_SQL, "array_predicates": ARRAY_SQL,
}
