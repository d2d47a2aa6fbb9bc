"""The mined flow from landed JSON to a dataset, the ledger by batches, and a cursor scan. Conversations stand for requests: each
turn is a proof, the next turn its final form."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairquarry.functions import blocks
from pairquarry.operators import assembly, evaluation, external, hygiene, mining, reviews
from pairquarry.operators.answers import AnswerStore, Reply, asked_once, usage
from pairquarry.operators.ledger_state import LedgerState
from pairquarry.operators.phases import Phase, PhaseStore, run_phases
from pairquarry.operators.tables import new_path, written
from pairquarry.plans.status_queries import STATUS_SQL, status_events
from pairquarry.plans.text_queries import TOKEN_SQL
from pairquarry.session import dealt, table
from pairquarry.sources import bundle, cursor, records, sinks

TARGET, HIGH_CHANGE, FILE = 50, 6, "Mathlib/A.lean"
#: Rows of a page of the replayed scan.
PAGE = 500


def land(spark, sf_dir, root: str) -> None:
    """Metadata and contexts of conversations as JSON lines, as a host's answers are landed. Every eleventh has no context."""
    day = F.make_date(2019 + F.col("pr") % 5, 1 + F.col("pr") % 12, F.lit(1))
    stamp = lambda d: F.date_format(d.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    c = dealt(table(spark, sf_dir, "conversations"), "conv_id", "turn").select(F.col("conv_id").alias("pr"), "turn", "role", F.lower(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]+", " "))).alias("words"))
    meta = c.groupBy("pr").agg(F.count(F.lit(1)).alias("comment_count"), F.count_if(F.col("role") == "user").alias("review_count"))
    sinks.append_lines(
        meta.select(F.col("pr").alias("number"), F.concat(F.lit("[Merged by Bors] - Request "), "pr").alias("title"), F.lit("CLOSED").alias("state"), stamp(day).alias("created_at"), stamp(F.date_add(day, (F.col("pr") % 9).cast("int"))).alias("closed_at"), "comment_count", "review_count"),
        f"{root}/metadata",
    )
    proof = lambda words: F.concat(F.lit("theorem d"), F.col("turn").cast("string"), F.lit(" : T := by\n  "), words)
    after = c.select("pr", (F.col("turn") - 1).alias("turn"), F.col("words").alias("later"))
    each = c.where("pr % 11 <> 0").join(after, ["pr", "turn"]).select("pr", F.struct("turn", proof(F.col("words")).alias("initial"), proof(F.col("later")).alias("final")).alias("p"))
    sides = each.groupBy("pr").agg(F.array_sort(F.collect_list("p")).alias("p"))
    content = lambda side: F.array(F.struct(F.lit(FILE).alias("path"), F.array_join(f"p.{side}", "\n\n").alias("content")))
    sinks.append_lines(sides.select(F.col("pr").alias("pr_number"), F.concat(F.lit("sha"), "pr").alias("base_sha"), content("initial").alias("initial_files"), content("final").alias("final_files")), f"{root}/context")


def judge(prompt: str) -> str:
    """Stands in for a model: much changed is of high value."""
    changed = int(re.search(r"Changed: (\d+)", prompt)[1])
    return json.dumps({"verdict": "HIGH_VALUE" if changed >= HIGH_CHANGE else "LOW_VALUE", "summary": f"changed {changed}", "categories": ["readability"]})


def phases_of(landing: records.Landing) -> list[Phase]:
    """The flow's phases over a landing; each reads what the phases before have made."""

    def metadata(store):
        return records.lines(store.spark, landing.of("metadata"), "metadata").withColumnRenamed("number", "pr")

    fine = F.lit(None).cast("string").alias("error")

    def discover(store, _):
        return store.discovered(metadata(store).select("pr", F.lit("full_scan").alias("source"), F.lit(None).cast("string").alias("query")))

    def enrich(store, waiting):
        merged = reviews.merge_status(F.col("title"), F.col("state"), F.lit(False)) == "merged_by_bors"
        return waiting.join(metadata(store), "pr").select("pr", (merged & reviews.has_review_activity(F.col("review_count"), F.lit(0))).alias("qualifies"), fine)

    def extract(store, waiting):
        contexts = records.lines(store.spark, landing.of("context"), "context").withColumnRenamed("pr_number", "pr").select("pr", "base_sha", "initial_files", "final_files", F.lit(True).alias("found"))
        return waiting.join(contexts, "pr", "left").withColumn("error", F.when(F.col("found").isNull(), "no context")).drop("found")

    def parse(store, waiting):
        sources = store.made("extracted").join(waiting, "pr", "left_semi")

        def side(files):
            each = sources.select("pr", F.explode(files).alias("f")).select("pr", F.col("f.path").alias("file_path"), "f.content")
            return blocks.blocks_of(each, "content", "pr", "file_path").select("pr", "file_path", "name", "ordinal", "signature", "full_text")

        pairs = mining.matched_blocks(side("initial_files"), side("final_files"), ["pr", "file_path", "name"], ["ordinal"]).withColumn("key", F.concat_ws("/", "pr", "file_path", "name"))
        diff = mining.bag_diff(pairs, "key", "initial_full_text", "final_full_text")
        keep = mining.meaningful(F.col("added"), F.col("removed"), F.col("n_initial"), F.col("n_final"), mining.migration_only(F.col("initial_full_text"), F.col("final_full_text")))
        found = diff.join(pairs, "key").where(keep).select(
            "pr", F.struct("file_path", F.col("name").alias("declaration"), F.col("initial_ordinal").alias("position"), F.col("initial_full_text").alias("initial"), F.col("final_full_text").alias("final"), "initial_signature", "final_signature", (F.col("added") + F.col("removed")).alias("changed")).alias("pair")
        )
        # Bounded by one request's own declarations.
        per_request = found.groupBy("pr").agg(F.array_sort(F.collect_list("pair")).alias("pairs"))
        return sources.select("pr").join(per_request, "pr", "left").withColumn("error", F.lit(None).cast("string"))

    def pairs_of(store):
        return store.made("parsed").select("pr", F.inline("pairs"))

    def summarize(store, waiting):
        pairs = pairs_of(store).join(waiting, "pr", "left_semi").withColumn("key", F.concat_ws("/", "pr", "file_path", "declaration"))
        shown = assembly.prompt(F.col("pr").cast("string"), F.col("declaration"), F.col("initial"), F.col("final"), F.concat(F.lit("Changed: "), F.col("changed").cast("string")))
        # A phase that dies and is run again finds its answers in the landing; the stand-in needs no pace.
        answers = asked_once(pairs.withColumn("prompt", shown), "key", "prompt", judge, AnswerStore(landing.of("answers")), interval=0)
        labelled = external.labels(answers, "key").join(pairs.select("key", "pr", "file_path", "declaration", "position"), "key")
        per_request = labelled.groupBy("pr").agg(F.array_sort(F.collect_list(F.struct("file_path", "declaration", "position", "verdict", "summary", "categories"))).alias("labels"))
        return waiting.join(per_request, "pr", "left").withColumn("error", F.lit(None).cast("string"))

    def assemble(store, waiting):
        labels = store.made("summarized").join(waiting, "pr", "left_semi").select("pr", F.inline("labels"))
        remarks = metadata(store).select("pr", F.array().cast("array<string>").alias("reviewers"), F.col("review_count").alias("n_remarks"))
        contexts = store.made("extracted").select("pr", "base_sha")
        rows = assembly.dataset_rows(labels, pairs_of(store).drop("position"), metadata(store).select("pr", "title", "created_at", "closed_at"), remarks, contexts, landing.pull_url, F.lit("2024-01-01").cast("date"))
        one = F.struct(*[c for c in rows.columns if c != "pr"])
        return waiting.join(rows.groupBy("pr").agg(F.collect_list(one).alias("rows")), "pr", "left").withColumn("error", F.lit(None).cast("string"))

    return [
        Phase("discovered", discover), Phase("enriched", enrich, qualified=False), Phase("extracted", extract), Phase("parsed", parse, after="extracted"), Phase("summarized", summarize, after="parsed"), Phase("assembled", assemble, after="summarized"),
    ]


def dataset(store: PhaseStore) -> DataFrame:
    return store.made("assembled").select("pr", F.inline("rows"))


def select_and_emit(rows: DataFrame, folder: str, target: int = TARGET) -> DataFrame:
    """Drawn rows with what the audit finds in each, written in one commit with their sidecar and read back."""
    ratio = F.length("final") / F.length("initial")
    eligible = rows.withColumn("ratio", ratio).where((F.col("ratio") < 1) & ~F.col("signature_changed")).withColumn("year", F.year("created"))
    drawn = written(evaluation.round_robin_draw(eligible, target, "pr", "year", ["ratio", "pr", "declaration_name"]), "flow-drawn")
    audited = drawn.select("pr", F.col("declaration_name").alias("declaration"), "file_path", "initial", "final", "initial_lines", "final_lines")
    findings = hygiene.audit(audited, "pr").groupBy("pr").agg(F.count(F.lit(1)).alias("n_findings"))
    out = drawn.join(findings, "pr", "left").withColumn("n_findings", F.coalesce("n_findings", F.lit(0)))
    bundle.write({"dataset": out}, f"{folder}/emitted", "flow", "1", mode="overwrite")
    # The commit's record is what counts; info is a copy of the sidecar for those who read plain files.
    out.sparkSession.createDataFrame([(bundle.info(f"{folder}/emitted", "dataset"),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/info")
    return bundle.read(out.sparkSession, f"{folder}/emitted", "dataset", out.schema)


def mined_flow(spark, sf_dir):
    """Landing, six phases, selection, audit and emission, on all conversations."""
    root = new_path(spark, "flow")
    land(spark, sf_dir, f"{root}/landed")
    store = PhaseStore(spark, f"{root}/phases")
    run_phases(store, phases_of(records.Landing(f"{root}/landed", "https://host.example", "o", "r")))
    rows = select_and_emit(dataset(store), root)
    return rows.select("pr", "pr_url", "pr_title", "declaration_name", "initial", "final", "initial_lines", "final_lines", "line_delta", "summary", "n_remarks", "review_days", "base_sha", "created", "n_findings")


def flow_phases(spark, sf_dir):
    """The status of every record after the flow, and its errors."""
    root = new_path(spark, "flow")
    land(spark, sf_dir, f"{root}/landed")
    store = PhaseStore(spark, f"{root}/phases")
    run_phases(store, phases_of(records.Landing(f"{root}/landed")))
    reached = [F.col(f"{p}_at").isNotNull().alias(p) for p in ("enriched", "extracted", "parsed", "summarized", "assembled")]
    return store.status().select("pr", "qualifies", *reached, "error_count", "last_error")


FLOW_SQL = rf"""
WITH c AS (SELECT conv_id AS pr, turn, role, lower(trim(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ', 'g'))) AS words FROM conversations),
m AS (SELECT pr, count(*) FILTER (role = 'user') AS n_remarks FROM c GROUP BY pr),
p AS (SELECT a.pr, a.turn, 'd' || a.turn AS d, 'theorem d' || a.turn || ' : T := by' || CASE WHEN a.words = '' THEN '' ELSE chr(10) || '  ' || a.words END AS initial,
  'theorem d' || a.turn || ' : T := by' || CASE WHEN b.words = '' THEN '' ELSE chr(10) || '  ' || b.words END AS final FROM c a JOIN c b ON b.pr = a.pr AND b.turn = a.turn + 1 WHERE a.pr % 11 <> 0),
tok AS (SELECT pr, turn, unnest(regexp_extract_all(initial, '{TOKEN_SQL}')) AS token, -1 AS sign FROM p UNION ALL SELECT pr, turn, unnest(regexp_extract_all(final, '{TOKEN_SQL}')), 1 FROM p),
net AS (SELECT pr, turn, token, sum(sign) AS net, count(*) FILTER (sign < 0) AS b, count(*) FILTER (sign > 0) AS a FROM tok GROUP BY ALL),
diff AS (SELECT pr, turn, sum(abs(net))::BIGINT AS changed, least(sum(a), sum(b)) AS shorter FROM net GROUP BY ALL),
high AS (SELECT p.*, changed, n_remarks, length(final) / length(initial) AS ratio, 2019 + p.pr % 5 AS year, make_date(2019 + p.pr % 5, 1 + p.pr % 12, 1) AS created FROM p JOIN diff USING (pr, turn) JOIN m USING (pr)
  WHERE n_remarks >= 1 AND initial <> final AND changed >= {HIGH_CHANGE} AND NOT (changed / shorter < 0.05) AND length(final) < length(initial)),
best AS (SELECT * FROM high QUALIFY row_number() OVER (PARTITION BY pr ORDER BY ratio, d) = 1),
turns AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY ratio, pr, d) AS go FROM best),
drawn AS (SELECT * FROM turns ORDER BY go, year LIMIT {TARGET}),
lined AS (SELECT *, length(initial) - length(replace(initial, chr(10), '')) + 1 AS il, length(final) - length(replace(final, chr(10), '')) + 1 AS fl, replace(initial, chr(10) || ' ', '') AS ci, replace(final, chr(10) || ' ', '') AS cf FROM drawn),
dup AS (SELECT min(pr) AS pr FROM lined GROUP BY ci HAVING count(*) > 1 UNION ALL SELECT min(pr) FROM lined GROUP BY cf HAVING count(*) > 1)
SELECT pr, 'https://host.example/o/r/pull/' || pr AS pr_url, 'Request ' || pr AS pr_title, d AS declaration_name, initial, final, il::BIGINT AS initial_lines, fl::BIGINT AS final_lines, (fl - il)::BIGINT AS line_delta, 'changed ' || changed AS summary, n_remarks,
  (pr % 9)::DOUBLE AS review_days, 'sha' || pr AS base_sha, strftime(created, '%Y-%m-%d') AS created, (SELECT count(*) FROM dup WHERE dup.pr = lined.pr) AS n_findings FROM lined
"""
PHASES_SQL = """WITH m AS (SELECT conv_id AS pr, count(*) FILTER (role = 'user') >= 1 AS qualifies, count(*) AS n FROM conversations GROUP BY ALL),
x AS (SELECT a.conv_id AS pr FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 WHERE a.conv_id % 11 <> 0 GROUP BY ALL),
s AS (SELECT m.pr, qualifies, qualifies AND x.pr IS NOT NULL AS ok FROM m LEFT JOIN x USING (pr))
SELECT pr, qualifies, true AS enriched, ok AS extracted, ok AS parsed, ok AS summarized, ok AS assembled, (qualifies AND NOT ok)::BIGINT AS error_count, CASE WHEN qualifies AND NOT ok THEN 'no context' END AS last_error FROM s"""


def turn_judge(prompt: str) -> Reply:
    """Stands in for a model that is down for one length in seven and speaks prose for another; a token is a character."""
    n = len(prompt)
    if n % 7 == 0:
        raise RuntimeError("down")
    text = "I can't tell." if n % 7 == 1 else json.dumps({"verdict": "HIGH_VALUE" if n % 2 else "LOW_VALUE", "summary": f"{n} long"})
    return Reply(text, n, len(text))


def judged(spark, sf_dir):
    """All turns, each different text asked about once; a second run finds the answers of the first in the store."""
    turns = table(spark, sf_dir, "conversations").select(F.struct("conv_id", "turn").alias("key"), "text")
    store = AnswerStore(new_path(spark, "turn-answers"))
    asked_once(turns.where("turn = 0"), "key", "text", turn_judge, store, interval=0)
    return asked_once(turns, "key", "text", turn_judge, store, interval=0)


def judged_turns(spark, sf_dir):
    answers = written(judged(spark, sf_dir), "judged")
    found = answers.join(external.labels(answers, "key"), "key", "left")
    return found.select("key.conv_id", "key.turn", "verdict", "summary", F.split_part("error", F.lit(":"), F.lit(1)).alias("failure"), "attempts", "input_tokens", "output_tokens")


def judge_usage(spark, sf_dir):
    return usage(judged(spark, sf_dir))


JUDGED_SQL = """WITH c AS (SELECT conv_id, turn, text, length(text) AS n, length(text) % 7 AS m, text IN (SELECT text FROM conversations WHERE turn = 0 AND text IS NOT NULL) AS known FROM conversations),
j AS (SELECT *, CASE WHEN m > 1 THEN CASE WHEN n % 2 = 1 THEN 'HIGH_VALUE' ELSE 'LOW_VALUE' END END AS verdict, CASE WHEN m > 1 THEN n || ' long' END AS summary,
  CASE WHEN text IS NULL THEN 'no prompt' WHEN m = 0 THEN 'RuntimeError' WHEN m = 1 THEN 'ValueError' END AS failure FROM c),
t AS (SELECT *, CASE WHEN text IS NULL OR (m > 1 AND known) THEN 0 ELSE 1 END AS attempts, CASE WHEN m > 1 THEN n ELSE 0 END::BIGINT AS input_tokens,
  CASE WHEN m > 1 THEN length(format('{{"verdict": "{}", "summary": "{}"}}', verdict, summary)) ELSE 0 END::BIGINT AS output_tokens FROM j)
"""
TURNS_SQL = f"{JUDGED_SQL} SELECT conv_id, turn, verdict, summary, failure, attempts, input_tokens, output_tokens FROM t"
USAGE_SQL = f"""{JUDGED_SQL}, d AS (SELECT text, count(*) AS n, any_value(verdict) AS verdict, any_value(attempts) AS attempts, any_value(input_tokens) AS i, any_value(output_tokens) AS o FROM t GROUP BY text)
SELECT coalesce(sum(n), 0)::BIGINT AS prompts, count(text) AS different, count(verdict) AS answered, count(*) - count(verdict) AS failed, coalesce(sum(attempts), 0)::BIGINT AS calls, coalesce(sum(i), 0)::BIGINT AS input_tokens, coalesce(sum(o), 0)::BIGINT AS output_tokens FROM d"""


def ledger_by_batches(spark, sf_dir):
    """The ledger's status kept up over three batches of its events, out of order; equal to the fold over all of them."""
    path = new_path(spark, "ledger-state")
    state = LedgerState(spark, path)
    events = written(status_events(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("message"), F.lit(3))), "ledger-events")
    for batch in range(3):
        state.apply(events.where(F.col("part") == batch).drop("part"), batch)
        state.apply(events.where(F.col("part") == batch).drop("part"), batch)  # what comes again changes nothing
    return state.status()


def cursor_scan(spark, sf_dir):
    """Orders landed as pages and scanned by their cursors, in two runs: the first stops at the page that reaches its limit."""
    path = new_path(spark, "cursor-pages")
    o = table(spark, sf_dir, "orders")
    one = F.to_json(F.struct(F.col("o_orderkey").alias("number"), F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("state")))
    # Pages by key range, so that each is written by one task.
    keyed = o.select(one.alias("value"), (F.col("o_orderkey") / (4 * PAGE)).cast("long").alias("page"))
    keyed.repartition("page").write.partitionBy("page").text(path)
    options = {"transport": "pairquarry.sources.replay:chain", "following": "pairquarry.sources.replay:following", "resource": path}
    cursor.scan(spark, f"{path}-rows", f"{path}-state", **options, limit=str(3 * PAGE))
    cursor.scan(spark, f"{path}-rows", f"{path}-state", **options)
    found = spark.read.schema("cursor string, place int, record string").parquet(f"{path}-rows")
    return found.select(F.from_json("record", "number long, title string, state string").alias("r")).select("r.*")


CURSOR_SQL = "SELECT o_orderkey AS number, o_orderpriority AS title, o_orderstatus AS state FROM orders"

QUERIES = {"mined_flow": mined_flow, "flow_phases": flow_phases, "ledger_by_batches": ledger_by_batches, "cursor_scan": cursor_scan, "judged_turns": judged_turns, "judge_usage": judge_usage}
ORACLE_SQL = {"mined_flow": FLOW_SQL, "flow_phases": PHASES_SQL, "ledger_by_batches": f"WITH {STATUS_SQL} SELECT * FROM status", "cursor_scan": CURSOR_SQL, "judged_turns": TURNS_SQL, "judge_usage": USAGE_SQL}
