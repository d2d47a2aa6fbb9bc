"""Queries over the ledger's status table, queues and cursors, and over raw records of a code host. Events stand for the
ledger's log; conversation turns and order lines, written as JSON, for a host's answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairquarry.functions import text
from pairquarry.operators import assembly, contexts, evaluation, ledger, reviews
from pairquarry.operators.tables import new_path
from pairquarry.plans.record_queries import LINE_ORDER, PATH_SQL, line_path
from pairquarry.session import dealt, table
from pairquarry.sources import normalize, records, sinks

STATUS_SQL = """
ev AS (SELECT user_id * 7 + event_id % 7 AS pr, ts, [NULL, 'enriched', 'extracted', 'parsed', 'summarized', 'assembled', 'contexts_extracted', 'error', 'enriched'][event_id % 9 + 1] AS phase, value >= 50 AS qualifies,
  repeat('x', (event_id % 1500)::INT) || event_id AS message, CASE WHEN event_id % 5 = 0 THEN 'keyword_search' ELSE 'full_scan' END AS source, CASE WHEN event_id % 4 <> 0 THEN 'q' || event_id % 3 END AS query FROM events),
li AS (SELECT pr, max(ts) FILTER (query IS NULL) AS null_ts, arg_max(source, ts) AS source FROM ev GROUP BY pr),
fold AS (SELECT pr, source, (SELECT string_agg(query, ',' ORDER BY ts) FROM ev WHERE ev.pr = li.pr AND (null_ts IS NULL OR ts > null_ts)) AS source_query FROM li),
st AS (SELECT pr, max(ts) FILTER (phase = 'enriched') AS enriched_at, max(ts) FILTER (phase = 'extracted') AS extracted_at, max(ts) FILTER (phase = 'parsed') AS parsed_at, max(ts) FILTER (phase = 'summarized') AS summarized_at,
  max(ts) FILTER (phase = 'assembled') AS assembled_at, max(ts) FILTER (phase = 'contexts_extracted') AS contexts_extracted_at, coalesce(arg_max(qualifies, ts) FILTER (phase = 'enriched'), false) AS qualifies,
  count(*) FILTER (phase = 'error') AS error_count, substr(arg_max(message, ts) FILTER (phase = 'error'), 1, 1000) AS last_error FROM ev GROUP BY pr),
status AS (SELECT * FROM st JOIN fold USING (pr))
"""


def status_events(spark, sf_dir):
    e, n = table(spark, sf_dir, "events"), F.col("event_id")
    phases = F.array(F.lit(None).cast("string"), *map(F.lit, ("enriched", "extracted", "parsed", "summarized", "assembled", "contexts_extracted", "error", "enriched")))
    return ledger.checked_events(e.select(
        (F.col("user_id") * 7 + n % 7).alias("pr"), "ts", F.get(phases, (n % 9).cast("int")).alias("phase"), (F.col("value") >= 50).alias("qualifies"),
        F.concat(F.repeat(F.lit("x"), (n % 1500).cast("int")), n.cast("string")).alias("message"), F.when(n % 5 == 0, "keyword_search").otherwise("full_scan").alias("source"),
        F.when(n % 4 != 0, F.concat(F.lit("q"), (n % 3).cast("string"))).alias("query"),
    ))


def ledger_status(spark, sf_dir):
    events = status_events(spark, sf_dir)
    return ledger.status_table(events).join(ledger.folded_candidates(events), "pr")


def status_funnel(spark, sf_dir):
    return ledger.phase_counts(ledger.status_table(status_events(spark, sf_dir)))


FUNNEL_SQL = "SELECT count(*) AS discovered, " + ", ".join(f"count({p}_at) AS {p}" for p in ledger.ALL_PHASES) + ", count(*) FILTER (qualifies) AS qualified, count(*) FILTER (error_count >= 3) AS failed FROM st"
QUEUE_ROWS = 40


def pending_queues(spark, sf_dir):
    """The head of each queue, in its order."""
    return ledger.queue_heads(ledger_status(spark, sf_dir), QUEUE_ROWS)


def _queue_sql(name: str) -> str:
    phase, after = ledger.QUEUES[name]
    keep = [f"{phase}_at IS NULL", *([] if name == "enrich" else ["qualifies", "error_count < 3"]), *([f"{after}_at IS NOT NULL"] if after else [])]
    order = "CASE WHEN source = 'keyword_search' THEN 0 ELSE 1 END, length(coalesce(source_query, '')) - length(replace(coalesce(source_query, ''), ',', '')) DESC, pr DESC" if name == "extract" else "pr"
    return f"SELECT '{name}' AS queue, pr, row_number() OVER (ORDER BY {order})::INT AS place FROM status WHERE {' AND '.join(keep)} QUALIFY place <= {QUEUE_ROWS}"


def generic_queue(spark, sf_dir):
    """Records without a phase, whatever came before it, qualified or not."""
    status = ledger.status_table(status_events(spark, sf_dir))
    return ledger.waiting(status, "summarized", qualified=False).select("pr", "error_count")


def scan_cursors(spark, sf_dir):
    n = F.col("event_id")
    updates = table(spark, sf_dir, "events").select(F.col("event_type").alias("scan_id"), F.col("ts").alias("at"), F.when(n % 5 != 0, F.concat(F.lit("c"), n.cast("string"))).alias("end_cursor"), n.alias("fetched"), F.when(n % 3 == 0, F.col("user_id")).alias("total"))
    return ledger.scan_cursors(updates)


SCANS_SQL = """SELECT event_type AS scan_id, max_by(struct_pack(c := CASE WHEN event_id % 5 <> 0 THEN 'c' || event_id END), ts).c AS end_cursor, arg_max(event_id, ts) AS fetched,
arg_max(user_id, ts) FILTER (event_id % 3 = 0) AS total FROM events GROUP BY event_type"""


def search_cursors(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    updates = e.select(F.col("event_type").alias("query_key"), F.col("ts").alias("at"), F.col("user_id").alias("last_page"), F.lit(0).alias("total_count"), (F.col("event_id") % 4 == 0).alias("completed"))
    asked = e.select(F.explode(F.array("event_type", F.concat("event_type", F.lit("?")))).alias("query_key")).distinct()
    return ledger.search_cursors(updates, asked)


SEARCHES_SQL = "SELECT event_type AS query_key, CASE WHEN arg_max(event_id, ts) % 4 = 0 THEN -1 ELSE arg_max(user_id, ts) END::BIGINT AS page FROM events GROUP BY event_type UNION ALL SELECT DISTINCT event_type || '?', 0 FROM events"


def widened_ledger(spark, sf_dir):
    """Orders without a title's column and orders with it, as one table."""
    o = table(spark, sf_dir, "orders")
    old = o.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("pr"))
    new = o.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("pr"), F.col("o_orderpriority").alias("title"))
    return ledger.widened(old, title="string").unionByName(new)


WIDENED_SQL = "SELECT o_orderkey AS pr, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS title FROM orders"


def point_lookup(spark, sf_dir):
    """Records by number; numbers that aren't there give nothing."""
    wanted = table(spark, sf_dir, "benchmark").select((F.col("item_id") * 3).alias("pr"))
    found = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pr"), F.col("o_orderstatus").alias("state"))
    return records.by_number(found, wanted, "pr")


LOOKUP_SQL = "SELECT o_orderkey AS pr, o_orderstatus AS state FROM orders WHERE o_orderkey IN (SELECT item_id * 3 FROM benchmark)"


def request_titles(spark, sf_dir):
    """Requests with pairs and their last title; those without one get a default."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 4 <> 0")
    titles = o.select(F.col("o_orderkey").alias("pr"), F.explode(F.array(F.struct(F.lit(1).alias("version"), F.lit("draft").alias("title")), F.struct(F.lit(2).alias("version"), F.col("o_orderpriority").alias("title")))).alias("t")).select("pr", "t.*")
    asked = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("pr")).agg(F.count(F.lit(1)).alias("n_pairs"))
    return reviews.titled(asked, titles, "pr", ["version"])


TITLES_SQL = "SELECT l_orderkey AS pr, count(*) AS n_pairs, coalesce(max(o_orderpriority), 'PR #' || l_orderkey) AS title FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 4 <> 0) ON o_orderkey = l_orderkey GROUP BY l_orderkey"


def comment_pair_join(spark, sf_dir):
    """Inline comments on the files of pairs, by whether their hunk names the pair's declaration."""
    c = table(spark, sf_dir, "conversations")
    comments = c.select(F.col("conv_id").alias("pr"), F.concat(F.lit("f"), (F.col("turn") % 3).cast("string")).alias("path"), "turn", F.col("text").alias("diff_hunk"))
    pairs = c.where("turn < 2").select(F.col("conv_id").alias("pr"), F.concat(F.lit("f"), (F.col("conv_id") % 3).cast("string")).alias("path"), F.lower(F.split_part("text", F.lit(" "), F.lit(2))).alias("declaration"))
    return reviews.comments_on_pairs(comments, pairs).select("pr", "declaration", "turn", "priority")


COMMENTS_SQL = """SELECT c.conv_id AS pr, lower(split_part(p.text, ' ', 2)) AS declaration, c.turn, CASE WHEN split_part(p.text, ' ', 2) <> '' AND contains(c.text, lower(split_part(p.text, ' ', 2))) THEN 1 ELSE 2 END AS priority
FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn < 2 AND c.turn % 3 = p.conv_id % 3"""


CONTEXT_BUDGET = 1500


def discussed_pairs(spark, sf_dir):
    """Conversation turns as pairs, comments and remarks of a request: a turn's hunk is its text, and a pair is named like a word of its turn."""
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pr"), F.concat(F.lit("f"), (F.col("turn") % 3).cast("string")).alias("path"), "turn", "role", "text")
    position = F.col("turn").cast("long").alias("position")
    pairs = c.select(F.struct("pr", "turn").alias("pair"), "pr", "path", F.split_part("text", F.lit(" "), F.lit(3)).alias("declaration"))
    comments = c.select("pr", "path", position, reviews.inline_text(F.col("role"), F.col("path"), F.col("turn"), F.col("text")).alias("text"), F.col("text").alias("diff_hunk"))
    return pairs.distinct(), comments, c.where(~reviews.noise(F.col("text"))).select("pr", position, text.strip(F.col("text")).alias("text"))


def review_contexts(spark, sf_dir):
    """What a judge gets to read of each pair's review within the budget."""
    made = contexts.review_contexts(*discussed_pairs(spark, sf_dir), CONTEXT_BUDGET)
    return made.select("pair.pr", "pair.turn", "n_taken", F.length("context").cast("long").alias("n_chars"), F.sha2("context", 256).alias("context_sha"))


CONTEXTS_SQL = rf"""WITH RECURSIVE c AS (SELECT conv_id AS pr, 'f' || turn % 3 AS path, turn, role, text, regexp_replace(text, '^[\s\x0B\x1c-\x1f\x85\p{{Z}}]+|[\s\x0B\x1c-\x1f\x85\p{{Z}}]+$', '', 'g') AS b FROM conversations),
p AS (SELECT DISTINCT pr, turn, path, split_part(text, ' ', 3) AS declaration FROM c),
q AS (SELECT p.pr, p.turn, CASE WHEN declaration <> '' AND contains(c.text, declaration) THEN 1 ELSE 2 END AS priority, c.turn AS place, '[Inline comment by @' || role || ' on ' || path || ':' || c.turn || '] ' || b AS t FROM p JOIN c USING (pr, path)
      UNION ALL SELECT p.pr, p.turn, 3, c.turn, b FROM p JOIN c USING (pr) WHERE NOT (starts_with(b, 'bors') OR length(b) < 20)),
o AS (SELECT *, row_number() OVER (PARTITION BY pr, turn ORDER BY priority, place, t) AS i FROM q),
w AS (SELECT pr, turn, 0::BIGINT AS i, {CONTEXT_BUDGET}::BIGINT AS budget, -1 AS grp, false AS stopped, false AS over, NULL::VARCHAR AS ctx, 0::BIGINT AS n_taken FROM p
      UNION ALL
      SELECT pr, turn, i, CASE WHEN takes THEN budget - length(t) - 1 ELSE budget END, priority, stopped, over, CASE WHEN takes THEN coalesce(ctx || chr(10) || chr(10), '') || t ELSE ctx END, n_taken + takes::INT
      FROM (SELECT *, NOT stopped AND NOT over AS takes FROM (SELECT w.pr, w.turn, o.i, o.priority, o.t, w.budget, w.ctx, w.n_taken, (o.priority = w.grp AND w.stopped) OR length(o.t) > w.budget AS stopped,
              w.over OR (o.priority <> w.grp AND w.grp >= 0 AND w.budget <= 0) AS over FROM w JOIN o ON o.pr = w.pr AND o.turn = w.turn AND o.i = w.i + 1))),
e AS (SELECT pr, turn, max(n_taken) AS n_taken, coalesce(max_by(ctx, i), '{contexts.NOTHING}') AS context FROM w GROUP BY pr, turn)
SELECT pr, turn, n_taken, length(context) AS n_chars, sha256(context) AS context_sha FROM e"""


def rollup_nested(spark, sf_dir):
    """One row per request with its declarations nested in order."""
    li = table(spark, sf_dir, "lineitem")
    one = F.struct(F.col("l_linenumber").cast("long").alias("line"), F.col("l_partkey").cast("long").alias("part"), F.col("l_suppkey").cast("long").alias("file"), F.col("l_quantity").cast("long").alias("lines"))
    return li.groupBy(F.col("l_orderkey").alias("pr")).agg(F.to_json(F.array_sort(F.collect_list(one))).alias("declarations"))


NESTED_SQL = """SELECT l_orderkey AS pr, '[' || string_agg(format('{{"line":{},"part":{},"file":{},"lines":{}}}', l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT), ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) || ']' AS declarations
FROM lineitem GROUP BY l_orderkey"""

# ---- raw records ----------------------------------------------------------------------------------------------


def raw_turns(spark, sf_dir, **fields):
    """Conversation turns as a host's JSON answers: system turns have lost their author, every fourth path is missing."""
    user = F.when(F.col("role") != "system", F.struct(F.concat("role", (F.col("turn") % 3).cast("string")).alias("login"))).alias("user")
    day = F.concat(F.lit("2024-01-0"), (F.col("turn") % 9 + 1).cast("string"), F.lit("T03:04:05Z"))
    own = [F.col("conv_id").cast("long").alias("id"), user, F.when(F.col("turn") % 5 != 0, F.col("text")).alias("body"), *[f.alias(n) for n, f in fields.items()]]
    record = F.struct(*own, *[day.alias(n) for n in ("created_at", "submitted_at")])
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pr"), "turn", F.to_json(record).alias("record"))


def shown_day(column):
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss").alias(column)


def normalized_review_comments(spark, sf_dir):
    raw = raw_turns(
        spark, sf_dir, path=F.when(F.col("turn") % 4 != 0, F.concat(F.lit("f"), F.col("turn").cast("string"))), position=F.when(F.col("turn") % 3 != 0, F.col("turn")), original_position=F.col("turn"), diff_hunk=F.when(F.col("turn") % 2 == 0, F.lit("@@")),
        in_reply_to_id=F.when(F.col("turn") > 0, F.col("turn") - 1), pull_request_review_id=F.col("conv_id") * 10,
    )
    found = normalize.review_comments(raw, "pr")
    return found.withColumn("created_at", shown_day("created_at"))


AUTHOR_SQL = "CASE WHEN role = 'system' THEN 'ghost' ELSE role || turn % 3 END"
BODY_SQL = "CASE WHEN turn % 5 <> 0 AND text IS NOT NULL THEN text ELSE '' END"
DAY_SQL = "'2024-01-0' || turn % 9 + 1 || 'T03:04:05'"
REVIEW_COMMENTS_SQL = f"""SELECT conv_id AS pr, conv_id::BIGINT AS id, {AUTHOR_SQL} AS author, CASE WHEN turn % 4 <> 0 THEN 'f' || turn ELSE '' END AS path, CASE WHEN turn % 3 <> 0 THEN turn END::BIGINT AS position, turn::BIGINT AS original_position,
{BODY_SQL} AS body, {DAY_SQL} AS created_at, CASE WHEN turn > 0 THEN turn - 1 END::BIGINT AS in_reply_to_id, (conv_id * 10)::BIGINT AS review_id, CASE WHEN turn % 2 = 0 THEN '@@' ELSE '' END AS diff_hunk, false AS is_bot FROM conversations"""


def normalized_issue_comments(spark, sf_dir):
    return normalize.issue_comments(raw_turns(spark, sf_dir), "pr").withColumn("created_at", shown_day("created_at"))


def normalized_reviews(spark, sf_dir):
    return normalize.reviews(raw_turns(spark, sf_dir, state=F.upper("role")), "pr").withColumn("submitted_at", shown_day("submitted_at"))


def normalized_commits(spark, sf_dir):
    """Order lines as commits: with a login, with a name only, or with neither."""
    k = F.col("l_orderkey") % 3
    author = F.when(k == 0, F.struct(F.concat(F.lit("u"), "l_suppkey").alias("login"))).alias("author")
    inner = F.struct(F.struct(F.when(k == 1, F.concat(F.lit("Name "), "l_suppkey")).alias("name"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date")).alias("author"), F.lit("m").alias("message")).alias("commit")
    parents = F.array(F.struct(F.col("l_suppkey").cast("string").alias("sha"))).alias("parents")
    raw = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr"), F.to_json(F.struct(F.col("l_partkey").cast("string").alias("sha"), author, inner, parents)).alias("record"))
    return normalize.commits(raw, "pr").select("pr", "sha", "message", "author", shown_day("date"), F.array_join("parents", ",").alias("parents"))


COMMITS_SQL = """SELECT l_orderkey AS pr, l_partkey::VARCHAR AS sha, 'm' AS message, CASE l_orderkey % 3 WHEN 0 THEN 'u' || l_suppkey WHEN 1 THEN 'Name ' || l_suppkey ELSE 'ghost' END AS author,
strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS date, l_suppkey::VARCHAR AS parents FROM lineitem"""


def normalized_files(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr"), F.to_json(F.struct(line_path().alias("filename"), F.col("l_quantity").cast("long").alias("additions"), F.col("l_linenumber").cast("long").alias("deletions"))).alias("record"))
    return normalize.files(raw, "pr")


FILES_SQL = f"SELECT l_orderkey AS pr, {PATH_SQL} AS path, l_quantity::BIGINT AS additions, l_linenumber::BIGINT AS deletions FROM lineitem"

def landed_metadata(spark, sf_dir):
    """Requests written as JSON lines, with lines that don't fit among them, and scanned back by their schema."""
    o = table(spark, sf_dir, "orders")
    path = new_path(spark, "landed-metadata")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    sinks.append_lines(o.select(F.col("o_orderkey").alias("number"), F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("state"), stamp.alias("created_at"), F.array("o_orderpriority").alias("labels")), path)
    o.where("o_orderkey % 10 = 0").select(F.concat(F.lit("not json "), "o_orderkey").alias("value")).write.mode("append").text(path)
    found = records.lines(spark, path, "metadata")
    return found.select("number", "title", "state", F.date_format("created_at", "yyyy-MM-dd").alias("created"), F.size("labels").cast("long").alias("n_labels"), F.col("author").isNull().alias("no_author"))


LANDED_SQL = "SELECT o_orderkey AS number, o_orderpriority AS title, o_orderstatus AS state, strftime(o_orderdate, '%Y-%m-%d') AS created, 1::BIGINT AS n_labels, true AS no_author FROM orders"


def journal_of_verdicts(spark, sf_dir):
    """Verdicts out of a journal: results amid other events and lines that aren't JSON. A task has one verdict here."""
    e, n = table(spark, sf_dir, "events"), F.col("event_id")
    verdict = F.struct(F.concat(F.lit("t"), n.cast("string")).alias("task_id"), F.when(n % 3 == 0, "A").when(n % 3 == 1, "B").otherwise("comparable").alias("verdict"), F.col("event_type").alias("reasoning"))
    line = F.when(n % 5 == 0, F.lit("noise")).otherwise(F.to_json(F.struct(F.when(n % 5 == 1, "start").otherwise("result").alias("type"), F.struct(F.array(verdict).alias("verdicts")).alias("result"))))
    path = new_path(spark, "journal")
    e.select(line.alias("value")).write.text(path)
    return records.journal_verdicts(spark, path).select("task_id", "verdict", "reasoning")


JOURNAL_SQL = "SELECT 't' || event_id AS task_id, CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'comparable' END AS verdict, event_type AS reasoning FROM events WHERE event_id % 5 > 1"


def held_out_reader(spark, sf_dir):
    """A reference set of flat records (even requests) and records that hold declarations (odd ones), read as requests and pairs."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr_number"), F.concat(F.lit("d"), "l_linenumber").alias("declaration_name"), F.when(F.col("l_linenumber") != 3, line_path()).alias("file_path"))
    path, even = new_path(spark, "held-out"), F.col("pr_number") % 2 == 0
    sinks.append_lines(li.where(even), path)
    sinks.append_lines(li.where(~even).groupBy("pr_number").agg(F.collect_list(F.struct("declaration_name", "file_path")).alias("declarations")), path)
    requests, pairs = records.held_out(spark, path)
    none = F.lit(None).cast("string")
    return requests.select("pr_number", none.alias("declaration"), none.alias("file_path")).unionByName(pairs.select(F.lit(None).cast("long").alias("pr_number"), F.col("declaration_name").alias("declaration"), "file_path"))


HELD_OUT_SQL = f"""WITH l AS (SELECT l_orderkey, 'd' || l_linenumber AS declaration, {PATH_SQL} AS file_path, l_linenumber FROM lineitem)
SELECT DISTINCT l_orderkey AS pr_number, NULL::VARCHAR AS declaration, NULL::VARCHAR AS file_path FROM l UNION ALL SELECT DISTINCT NULL::BIGINT, declaration, file_path FROM l WHERE l_linenumber <> 3"""


def strict_records(spark, sf_dir):
    """Landed requests, read so that a line which doesn't fit is an error, by the numbers of the benchmark."""
    path = new_path(spark, "strict-records")
    o = table(spark, sf_dir, "orders")
    sinks.append_lines(o.select(F.col("o_orderkey").alias("number"), F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("state")), path)
    numbers = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("number"))
    return records.by_number(records.strict_lines(spark, path, "metadata"), numbers, "number").select("number", "title", "state")


STRICT_SQL = "SELECT o_orderkey AS number, o_orderpriority AS title, o_orderstatus AS state FROM orders WHERE o_orderkey IN (SELECT item_id FROM benchmark)"


def metadata_errors(spark, sf_dir):
    """Pending requests without metadata, as errors of theirs."""
    lines = table(spark, sf_dir, "lineitem")
    # Keys take few bytes, so that tasks by bytes would grow with the input; these are by what is read.
    tasks = 4 * lines.rdd.getNumPartitions()
    pending = dealt(lines.select(F.col("l_orderkey").alias("pr")), "pr", tasks=tasks).distinct()
    metadata = table(spark, sf_dir, "orders").where("o_orderkey % 6 <> 0").select(F.col("o_orderkey").alias("pr"), F.col("o_orderpriority").alias("title"))
    ready, errors = assembly.pending_metadata(pending, dealt(metadata, "pr", tasks=tasks))
    return ready.select("pr", "title", F.lit(None).cast("string").alias("error")).unionByName(errors.select("pr", F.lit(None).cast("string").alias("title"), "error"))


ERRORS_SQL = "SELECT l_orderkey AS pr, max(CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END) AS title, CASE WHEN l_orderkey % 6 = 0 THEN 'no metadata' END AS error FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey"


def anchor_choice(spark, sf_dir):
    """Known cases by name, the last of each, and by request and name, the first."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr"), F.concat(F.lit("d"), "l_partkey").alias("declaration"), *LINE_ORDER)
    b = table(spark, sf_dir, "benchmark")
    names = b.select(F.concat(F.lit("d"), "item_id").alias("declaration"), F.lit("accepted").alias("expected"))
    asked = table(spark, sf_dir, "lineitem").where("l_partkey % 50 = 1").select(F.col("l_orderkey").alias("pr"), F.concat(F.lit("d"), "l_partkey").alias("declaration"), F.lit("comparable").alias("expected")).distinct()
    return evaluation.anchors(li, names, asked, LINE_ORDER).select("pr", "declaration", "expected", "l_linenumber", "l_suppkey")


ORDER_SQL = ", ".join(LINE_ORDER)
ANCHORS_SQL = f"""(SELECT l_orderkey AS pr, 'd' || l_partkey AS declaration, 'accepted' AS expected, l_linenumber, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT item_id FROM benchmark)
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) = 1)
UNION ALL (SELECT l_orderkey, 'd' || l_partkey, 'comparable', l_linenumber, l_suppkey FROM lineitem WHERE l_partkey % 50 = 1 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY {ORDER_SQL}) = 1)"""

QUERIES = {
    "ledger_status": ledger_status, "status_funnel": status_funnel, "pending_queues": pending_queues, "generic_queue": generic_queue, "scan_cursors": scan_cursors, "search_cursors": search_cursors, "widened_ledger": widened_ledger,
    "point_lookup": point_lookup, "request_titles": request_titles, "comment_pair_join": comment_pair_join, "review_contexts": review_contexts, "rollup_nested": rollup_nested, "normalized_review_comments": normalized_review_comments,
    "normalized_issue_comments": normalized_issue_comments, "normalized_reviews": normalized_reviews, "normalized_commits": normalized_commits, "normalized_files": normalized_files,
    "landed_metadata": landed_metadata, "journal_of_verdicts": journal_of_verdicts, "metadata_errors": metadata_errors, "anchor_choice": anchor_choice, "held_out_reader": held_out_reader, "strict_records": strict_records,
}
ORACLE_SQL = {
    "ledger_status": f"WITH {STATUS_SQL} SELECT * FROM status", "status_funnel": f"WITH {STATUS_SQL} {FUNNEL_SQL}", "pending_queues": f"WITH {STATUS_SQL} " + " UNION ALL ".join(f"SELECT * FROM ({_queue_sql(q)})" for q in ledger.QUEUES),
    "generic_queue": f"WITH {STATUS_SQL} SELECT pr, error_count FROM st WHERE summarized_at IS NULL AND error_count < 3", "scan_cursors": SCANS_SQL, "search_cursors": SEARCHES_SQL, "widened_ledger": WIDENED_SQL, "point_lookup": LOOKUP_SQL,
    "request_titles": TITLES_SQL, "comment_pair_join": COMMENTS_SQL, "review_contexts": CONTEXTS_SQL, "rollup_nested": NESTED_SQL, "normalized_review_comments": REVIEW_COMMENTS_SQL,
    "normalized_issue_comments": f"SELECT conv_id AS pr, conv_id::BIGINT AS id, {AUTHOR_SQL} AS author, {BODY_SQL} AS body, {DAY_SQL} AS created_at, false AS is_bot FROM conversations",
    "normalized_reviews": f"SELECT conv_id AS pr, conv_id::BIGINT AS id, {AUTHOR_SQL} AS author, upper(role) AS state, {BODY_SQL} AS body, {DAY_SQL} AS submitted_at, false AS is_bot FROM conversations",
    "normalized_commits": COMMITS_SQL, "normalized_files": FILES_SQL,
    "landed_metadata": LANDED_SQL, "journal_of_verdicts": JOURNAL_SQL, "metadata_errors": ERRORS_SQL, "anchor_choice": ANCHORS_SQL, "held_out_reader": HELD_OUT_SQL, "strict_records": STRICT_SQL,
}
