"""Queries of the evaluation set. Candidates are order lines; the drawn set, and so all that is dealt and judged, is
limited to the strata's sizes, which is what the draw is for."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pairquarry.functions import code, scan, text
from pairquarry.operators import evaluation as ev
from pairquarry.operators import reviews
from pairquarry.operators.assembly import evaluation_row
from pairquarry.operators.tables import new_path, written
from pairquarry.plans.record_queries import LINE_ORDER, PATH_SQL, line_path
from pairquarry.session import table
from pairquarry.sources import bundle, sinks

CODE_SQL = "CASE WHEN l_partkey % 13 = 0 THEN 'do let e : MetaM Expr' WHEN l_partkey % 13 = 1 THEN 'undo MetaM' WHEN l_partkey % 13 = 2 THEN 'do simp' ELSE 'simp' END"
CANDIDATES_SQL = f"""
cand AS (SELECT l_orderkey AS pr, CASE WHEN l_linenumber <> 7 THEN 'd' || l_linenumber END AS declaration, l_partkey, l_suppkey, l_linenumber, {PATH_SQL} AS file_path, {CODE_SQL} AS code,
  CASE l_returnflag WHEN 'R' THEN 'HIGH_VALUE' WHEN 'N' THEN 'HIGH_VALUE' ELSE 'LOW_VALUE' END AS verdict, l_partkey % 6 = 0 AS signature_changed, l_quantity::BIGINT AS initial_lines, (l_partkey % 50)::BIGINT AS final_lines,
  l_suppkey % 9 <> 0 AS has_feedback, substr(l_shipdate::VARCHAR, 1, 4) AS year, (l_suppkey % 5)::BIGINT AS n_quotes, l_partkey % 3 = 0 AS is_api, {', '.join(c for c in LINE_ORDER if c not in ('l_partkey', 'l_suppkey', 'l_linenumber'))}
  FROM lineitem),
reasoned AS (SELECT cand.*, CASE WHEN verdict <> 'HIGH_VALUE' THEN 'not HIGH_VALUE' WHEN signature_changed THEN 'signature_changed' WHEN initial_lines < 5 THEN 'initial < 5 lines' WHEN NOT has_feedback THEN 'no explicit review feedback'
  WHEN final_lines::DOUBLE / greatest(initial_lines, 1) >= 1.0 THEN 'same-or-longer (not labelable from proof text)' WHEN held_id IS NOT NULL THEN 'PR in the held-out-against set'
  WHEN regexp_matches(file_path, '^(scripts|Archive)/|^Mathlib/Tactic/|/Linter/') THEN 'non-mathematical path' WHEN held_file IS NOT NULL THEN 'declaration+file in the held-out-against set'
  WHEN p_partkey IS NULL THEN 'no parsing record' WHEN p_size % 8 = 0 THEN 'identical once comments are stripped'
  WHEN regexp_matches(code, '(^|[^A-Za-z_])do($|[^A-Za-z_])') AND regexp_matches(code, 'MetaM|Expr') THEN 'metaprogram code' WHEN s_suppkey IS NULL OR s_acctbal < 1000 THEN 'empty rejection_reasons' END AS reason
  FROM cand LEFT JOIN (SELECT DISTINCT item_id AS held_id FROM benchmark) held ON held_id = cand.pr
  LEFT JOIN (SELECT DISTINCT 'Mathlib/Algebra/' || item_id || '.lean' AS held_file FROM benchmark) pair ON declaration IN ('d1', 'd2', 'd3') AND held_file = file_path
  LEFT JOIN (SELECT * FROM part WHERE p_size <> 7) ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey)
"""


def line_categories():
    return F.when(F.col("l_partkey") % 3 == 0, F.array(F.lit("naming"), F.lit("api_design"))).when(F.col("l_partkey") % 3 == 1, F.array(F.lit("naming")))


def candidates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    m = F.col("l_partkey") % 13
    return li.select(
        F.col("l_orderkey").alias("pr"), F.when(F.col("l_linenumber") != 7, F.concat(F.lit("d"), F.col("l_linenumber").cast("string"))).alias("declaration"), line_path().alias("file_path"),
        F.when(m == 0, "do let e : MetaM Expr").when(m == 1, "undo MetaM").when(m == 2, "do simp").otherwise("simp").alias("code"), F.when(F.col("l_returnflag").isin("R", "N"), "HIGH_VALUE").otherwise("LOW_VALUE").alias("verdict"),
        (F.col("l_partkey") % 6 == 0).alias("signature_changed"), F.col("l_quantity").cast("long").alias("initial_lines"), (F.col("l_partkey") % 50).cast("long").alias("final_lines"), (F.col("l_suppkey") % 9 != 0).alias("has_feedback"),
        F.substring(F.col("l_shipdate").cast("string"), 1, 4).alias("year"), (F.col("l_suppkey") % 5).cast("long").alias("n_quotes"), reviews.is_api(line_categories()).alias("is_api"), *LINE_ORDER,
    )


def held_sets(spark, sf_dir):
    """The requests held out, and the (declaration, file) pairs: three declarations of each benchmark file."""
    b = table(spark, sf_dir, "benchmark")
    pairs = b.select(F.explode(F.array(*map(F.lit, ("d1", "d2", "d3")))).alias("declaration"), F.concat(F.lit("Mathlib/Algebra/"), F.col("item_id").cast("string"), F.lit(".lean")).alias("file_path"))
    return b.select(F.col("item_id").alias("pr")), pairs


def proof_texts(spark, sf_dir):
    """The two proofs of each part that has a parsing record."""
    m = F.col("p_partkey") % 13
    code = F.when(m == 0, "do let e : MetaM Expr").when(m == 1, "undo MetaM").when(m == 2, "do simp").otherwise("simp")
    initial = F.concat(F.lit("theorem t : "), "p_name", F.lit(" := by\n  simp"))
    final = F.when(F.col("p_size") % 8 == 0, F.concat(initial, F.lit(" -- "), "p_brand")).otherwise(F.concat(F.lit("theorem t : "), "p_name", F.lit(" := "), code, F.lit("!")))
    return table(spark, sf_dir, "part").where("p_size <> 7").select(F.col("p_partkey").alias("l_partkey"), initial.alias("initial"), final.alias("final"))


def parsed_proofs(spark, sf_dir):
    """What the cascade asks of proofs; whether they are the same but for comments is found once a part."""
    return proof_texts(spark, sf_dir).select("l_partkey", (code.code_only("initial") == code.code_only("final")).alias("same_code"), F.col("final").alias("final_code"))


def reasoned(spark, sf_dir):
    """Candidates with the first rule they break, in the cascade's order; null for the eligible."""
    held_prs, held_pairs = held_sets(spark, sf_dir)
    c = candidates(spark, sf_dir).withColumn("ratio", F.col("final_lines") / F.greatest("initial_lines", F.lit(1)))
    summaries = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.when(F.col("s_acctbal") < 1000, " \n").otherwise(F.col("s_name")).alias("summary"))
    return ev.with_reasons(c, held_prs, held_pairs, parsed_proofs(spark, sf_dir), summaries, ["l_partkey"], ["l_suppkey"])


def reject_tally(spark, sf_dir):
    return ev.tally(reasoned(spark, sf_dir))


def cascade_outcome(spark, sf_dir):
    """Survivors by year and rejected rows by reason, from one pass over the candidates."""
    kept, why = ev.survivors_and_tally(reasoned(spark, sf_dir))
    by_year = kept.groupBy("year").agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("outcome"), "year", "n")
    return by_year.unionByName(why.select(F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("year"), "n"))


OUTCOME_SQL = f"WITH {CANDIDATES_SQL} SELECT coalesce(reason, 'kept') AS outcome, CASE WHEN reason IS NULL THEN year END AS year, count(*) AS n FROM reasoned GROUP BY ALL"


def eligible_rows(spark, sf_dir):
    return reasoned(spark, sf_dir).where("reason IS NULL").groupBy("pr", "year").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_api").alias("n_api"), F.sum("n_quotes").alias("n_quotes"))


def path_and_metaprogram(spark, sf_dir):
    c = candidates(spark, sf_dir)
    return c.groupBy("file_path", "code").agg(F.count(F.lit(1)).alias("n")).select("file_path", "code", "n", F.col("file_path").rlike(ev.NOT_MATHEMATICS).alias("not_mathematics"), ev.metaprogram(F.col("code")).alias("is_metaprogram"))


PATHS_SQL = f"""WITH {CANDIDATES_SQL} SELECT file_path, code, count(*) AS n, any_value(regexp_matches(file_path, '^(scripts|Cache|test|Archive)/|^Mathlib/(Tactic|Util|Lean)/|/Linter/')) AS not_mathematics,
any_value(regexp_matches(code, '(^|[^A-Za-z_])do($|[^A-Za-z_])') AND regexp_matches(code, 'MetaM|Expr')) AS is_metaprogram FROM cand GROUP BY file_path, code"""


def held_out_exclusion(spark, sf_dir):
    """Candidates outside of the held-out requests and outside of the held-out (declaration, file) pairs."""
    c = candidates(spark, sf_dir).select("pr", "declaration", "file_path")
    prs, pairs = held_sets(spark, sf_dir)
    left = c.join(prs, "pr", "left_anti").join(pairs, ["declaration", "file_path"], "left_anti")
    return left.groupBy("pr").agg(F.count(F.lit(1)).alias("n"))


HELD_SQL = f"""WITH {CANDIDATES_SQL} SELECT pr, count(*) AS n FROM cand WHERE pr NOT IN (SELECT item_id FROM benchmark)
AND NOT EXISTS (SELECT 1 FROM benchmark WHERE declaration IN ('d1', 'd2', 'd3') AND file_path = 'Mathlib/Algebra/' || item_id || '.lean') GROUP BY pr"""


def drawn(spark, sf_dir):
    """Stratum B of API rows, then C of others from the requests B left over. Written, as tasks and verdicts all begin here."""
    order = lambda: [-F.col("n_quotes"), F.col("pr"), F.coalesce("declaration", F.lit("")), *LINE_ORDER]
    columns = ["pr", "is_api", "year", "declaration", "file_path", "n_quotes", "code", "initial_lines", "final_lines", *LINE_ORDER]
    # One pass over the candidates: the best of each request for either stratum.
    best = written(ev.best_of_each(reasoned(spark, sf_dir).where("reason IS NULL").select(*columns), ["pr", "is_api"], order()), "best-candidates")
    b = written(ev.draw(best.where("is_api"), ev.API_ROWS, "year", order()).withColumn("stratum", F.lit("B")), "drawn-b")
    c = ev.draw(best.where("NOT is_api").join(b.select("pr"), "pr", "left_anti"), ev.OTHER_ROWS, "year", order()).withColumn("stratum", F.lit("C"))
    return written(b.unionByName(c), "drawn")


def selection_summary(spark, sf_dir):
    return ev.selection_summary(drawn(spark, sf_dir), "stratum")


def evaluation_rows(spark, sf_dir):
    """The drawn rows as the dataset holds them: both proofs, summary and categories, sizes, their difference, and ratios of
    the lines and of the proofs' bodies. Only drawn rows, which are few, are joined with texts and compared."""
    summaries = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("summary"))
    rows = drawn(spark, sf_dir).join(proof_texts(spark, sf_dir), "l_partkey").join(summaries, "l_suppkey")
    ratio = F.col("final_lines") / F.greatest("initial_lines", F.lit(1))
    return rows.select(
        "pr", F.coalesce("declaration", F.lit("(unnamed)")).alias("declaration"), "stratum", "initial", "final", "summary", F.coalesce(F.array_join(line_categories(), ","), F.lit("")).alias("categories"),
        "initial_lines", "final_lines", (F.col("final_lines") - F.col("initial_lines")).alias("line_delta"), *evaluation_row(ratio, scan.similarity("initial", "final")),
    )


#: The bodies are "by simp" and the code with "!": they share " simp", "simp" or a space, twice whose length over both lengths is their ratio.
ROWS_SQL = """SELECT pr, coalesce(declaration, '(unnamed)') AS declaration, stratum, 'theorem t : ' || p_name || ' := by' || chr(10) || '  simp' AS initial, 'theorem t : ' || p_name || ' := ' || code || '!' AS final, s_name AS summary,
CASE l_partkey % 3 WHEN 0 THEN 'naming,api_design' WHEN 1 THEN 'naming' ELSE '' END AS categories, initial_lines, final_lines, final_lines - initial_lines AS line_delta, round(final_lines::DOUBLE / greatest(initial_lines, 1), 4) AS length_ratio,
round(2.0::DOUBLE * CASE code WHEN 'simp' THEN 4 WHEN 'do simp' THEN 5 ELSE 1 END / (length('by simp') + length(code) + 1), 4) AS code_similarity, false AS signature_changed
FROM drawn JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey"""
SUMMARY = "SELECT stratum, count(*) AS n, count(DISTINCT pr) AS n_prs, avg(is_api::INT::DOUBLE) AS api_share FROM drawn GROUP BY stratum"


def year_round_robin(spark, sf_dir):
    return drawn(spark, sf_dir).select("stratum", "pr", "declaration", "year", "turn", "n_quotes")


ORDER_SQL = f"n_quotes DESC, pr, coalesce(declaration, ''), {', '.join(LINE_ORDER)}"
DRAWN = f"""{CANDIDATES_SQL},
b0 AS (SELECT * FROM reasoned WHERE reason IS NULL AND is_api QUALIFY row_number() OVER (PARTITION BY pr ORDER BY {ORDER_SQL}) = 1),
b AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY {ORDER_SQL}) AS turn FROM (SELECT * FROM b0) ORDER BY turn, year LIMIT 60),
c0 AS (SELECT * FROM reasoned WHERE reason IS NULL AND NOT is_api),
c1 AS (SELECT * FROM c0 WHERE pr NOT IN (SELECT pr FROM b) QUALIFY row_number() OVER (PARTITION BY pr ORDER BY {ORDER_SQL}) = 1),
c AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY {ORDER_SQL}) AS turn FROM c1 ORDER BY turn, year LIMIT 190),
drawn AS (SELECT *, 'B' AS stratum FROM b UNION ALL SELECT *, 'C' AS stratum FROM c)
"""


def tasks(spark, sf_dir, rows=None):
    rows = (drawn(spark, sf_dir) if rows is None else rows).select("pr", F.coalesce("declaration", F.lit("(unnamed)")).alias("declaration"), "file_path", "stratum", F.concat(F.lit(" initial "), "initial_lines").alias("initial"), F.concat("code", F.lit(" "), "final_lines", F.lit(" ")).alias("final"))
    return ev.blind_tasks(rows)


TASKS = f"""{DRAWN},
n AS (SELECT *, coalesce(declaration, '(unnamed)') AS decl, row_number() OVER (ORDER BY pr, coalesce(declaration, '(unnamed)')) - 1 AS place FROM drawn),
task AS (SELECT format('v{{:04d}}', (3 * place + rep)::INT) AS task_id, pr, decl AS declaration, file_path, stratum, rep::INT AS rep,
  CASE rep WHEN 0 THEN true WHEN 1 THEN false ELSE ('0x' || substr(sha256(pr || ':' || decl), 1, 2))::INT % 2 = 0 END AS accepted_is_a, 'initial ' || initial_lines AS ini, code || ' ' || final_lines AS fin FROM n, range(3) r(rep))
"""


def blind_tasks(spark, sf_dir):
    t = written(tasks(spark, sf_dir), "tasks")
    return ev.reader_view(t).join(t.select("task_id", "pr", "rep", "stratum", "accepted_is_a"), "task_id")


BLIND_SQL = f"WITH {TASKS} SELECT task_id, declaration, file_path, CASE WHEN accepted_is_a THEN fin ELSE ini END AS proof_a, CASE WHEN accepted_is_a THEN ini ELSE fin END AS proof_b, pr, rep, stratum, accepted_is_a FROM task"


def batch_deal(spark, sf_dir):
    return ev.checked_deal(written(tasks(spark, sf_dir), "tasks")).select("task_id", "rep", "stratum", "batch")


DEAL = f"{TASKS}, dealt AS (SELECT *, rep * 12 + (row_number() OVER (PARTITION BY rep ORDER BY stratum, task_id) - 1) % 12 AS batch FROM task)"


def blind_artifacts(spark, sf_dir):
    """Tasks, key and batches written in one commit, read back and put together again."""
    t = written(tasks(spark, sf_dir), "tasks")
    path = new_path(spark, "blind")
    total = sinks.blind_files(t, ev.checked_deal(t), path)["total_rows"]
    part = lambda name, schema: bundle.read(spark, path, name, schema)
    shown, key = part("tasks", "task_id string, declaration string, file_path string, proof_a string, proof_b string"), part("key", "task_id string, pr long, stratum string, rep int, accepted_is_a boolean")
    batches = part("batches", "batch long, task_ids array<string>").select("batch", F.explode("task_ids").alias("task_id"))
    totals = [F.lit(total[name]).cast("long").alias(f"n_{name}") for name in ("tasks", "batches")]
    return shown.join(key, "task_id").join(batches, "task_id").select("task_id", "batch", "proof_a", "proof_b", "pr", "stratum", "rep", "accepted_is_a", *totals)


ARTIFACTS_SQL = """SELECT task_id, batch, CASE WHEN accepted_is_a THEN fin ELSE ini END AS proof_a, CASE WHEN accepted_is_a THEN ini ELSE fin END AS proof_b, pr, stratum, rep, accepted_is_a,
(SELECT count(*) FROM dealt) AS n_tasks, (SELECT count(DISTINCT batch) FROM dealt) AS n_batches FROM dealt"""


def verdicts(asked):
    """What a stand-in reader says of each task: fixed by a hash of its id. Every 17th task stays unanswered."""
    h = text.to_number(F.substring(F.sha2("task_id", 256), 1, 2))
    t = asked.select("task_id").withColumn("h", h)
    return t.where(F.col("h") % 17 != 0).select("task_id", F.when(F.col("h") % 10 < 5, "A").when(F.col("h") % 10 < 8, "B").otherwise("comparable").alias("verdict"))


PICKS = f"""{TASKS},
h AS (SELECT *, ('0x' || substr(sha256(task_id), 1, 2))::INT AS h FROM task),
verdict AS (SELECT *, CASE WHEN h % 10 < 5 THEN 'A' WHEN h % 10 < 8 THEN 'B' ELSE 'comparable' END AS verdict FROM h WHERE h % 17 <> 0),
p AS (SELECT *, CASE WHEN verdict = 'comparable' THEN 'comparable' WHEN (verdict = 'A') = accepted_is_a THEN 'accepted' ELSE 'initial' END AS pick FROM verdict),
picks AS (SELECT pr, declaration, stratum, count(*) FILTER (pick = 'accepted') AS n_accepted, count(*) FILTER (pick = 'initial') AS n_initial, count(*) FILTER (pick = 'comparable') AS n_comparable, count(*) AS n_picks FROM p GROUP BY ALL),
m AS (SELECT *, CASE WHEN greatest(n_accepted, n_initial, n_comparable) < 2 THEN 'split' WHEN n_accepted >= 2 THEN 'accepted' WHEN n_initial >= 2 THEN 'initial' ELSE 'comparable' END AS majority FROM picks)
"""


def decode_majority(spark, sf_dir):
    return picks_of(tasks(spark, sf_dir))


def picks_of(asked):
    asked = written(asked, "tasks")
    return ev.decoded(verdicts(asked), asked)


def label_support_report(spark, sf_dir):
    both = F.explode(F.array("stratum", F.lit("all")))
    return ev.support(decode_majority(spark, sf_dir).withColumn("stratum", both), ["stratum"])


REPORT_SQL = f"""WITH {PICKS},
x AS (SELECT * FROM m UNION ALL SELECT * REPLACE ('all' AS stratum) FROM m),
s AS (SELECT stratum, count(*) AS n, count(*) FILTER (majority = 'accepted') AS supported, count(*) FILTER (greatest(n_accepted, n_initial, n_comparable) = n_picks) AS unanimous, count(*) FILTER (majority = 'split') AS splits FROM x GROUP BY stratum)
SELECT *, supported::DOUBLE / n AS rate, 1.96::DOUBLE * sqrt((supported::DOUBLE / n) * (1::DOUBLE - supported::DOUBLE / n) / n) * 100::DOUBLE AS half_width FROM s"""


def position_bias(spark, sf_dir):
    return ev.position_bias(verdicts(tasks(spark, sf_dir)))


def failed_pair_drop(spark, sf_dir):
    """Rows of the drawn set with why their label failed; rows without a failure are kept, and so are those nobody judged."""
    rows = drawn(spark, sf_dir)
    d = written(picks_of(tasks(spark, sf_dir, rows)), "picks")
    failed = d.withColumn("failure", ev.failure_kind(d)).where("failure IS NOT NULL").select("pr", "failure")
    return rows.select("pr", "stratum").join(failed, "pr", "left").withColumn("kept", F.col("failure").isNull())


FAILED_SQL = f"""WITH {PICKS},
f AS (SELECT pr, CASE WHEN majority = 'accepted' THEN NULL WHEN n_initial = n_picks THEN 'unanimous initial' WHEN n_comparable = n_picks THEN 'unanimous comparable' WHEN majority = 'split' THEN 'three-way split' ELSE 'majority against' END AS failure FROM m)
SELECT drawn.pr, stratum, failure, failure IS NULL AS kept FROM drawn LEFT JOIN f ON f.pr = drawn.pr"""


def sorted_failures(spark, sf_dir):
    """Failed labels in order, with their stratum, "-" for those of stratum C, as a report lists them."""
    rows = drawn(spark, sf_dir)
    d = written(picks_of(tasks(spark, sf_dir, rows)).drop("stratum"), "picks")
    failed = d.withColumn("failure", ev.failure_kind(d)).where("failure IS NOT NULL")
    known = ev.with_strata(failed, rows.where("stratum = 'B'").withColumn("declaration", F.coalesce("declaration", F.lit("(unnamed)"))), ["pr", "declaration"])
    # At most the drawn rows, so one task may number them.
    return known.select("pr", "declaration", "stratum", "failure", F.row_number().over(Window.orderBy("stratum", "pr", "declaration")).alias("place"))


SORTED_SQL = """,
f AS (SELECT pr, declaration, CASE WHEN stratum = 'B' THEN 'B' ELSE '-' END AS stratum, CASE WHEN majority = 'accepted' THEN NULL WHEN n_initial = n_picks THEN 'unanimous initial'
  WHEN n_comparable = n_picks THEN 'unanimous comparable' WHEN majority = 'split' THEN 'three-way split' ELSE 'majority against' END AS failure FROM m)
SELECT *, row_number() OVER (ORDER BY stratum, pr, declaration)::INT AS place FROM f WHERE failure IS NOT NULL"""


def batch_outcomes(spark, sf_dir):
    """Batches with their tasks and answers. The reader of every seventh batch gave none."""
    dealt = written(ev.deal(tasks(spark, sf_dir)), "dealt")
    answered = verdicts(dealt.where("batch % 7 <> 0"))
    return ev.batch_outcomes(dealt, answered)


OUTCOMES_SQL = """
SELECT batch, count(*) AS n_tasks, count(*) FILTER (batch % 7 <> 0 AND ('0x' || substr(sha256(task_id), 1, 2))::INT % 17 <> 0) AS n_answered,
  count(*) FILTER (batch % 7 <> 0 AND ('0x' || substr(sha256(task_id), 1, 2))::INT % 17 <> 0) > 0 AS ok FROM dealt GROUP BY batch"""


def unanswered_tasks(spark, sf_dir):
    """Tasks without a verdict, with the stratum of their pair where the API stratum holds it."""
    rows = drawn(spark, sf_dir)
    t = written(tasks(spark, sf_dir, rows), "tasks")
    strata = rows.where("stratum = 'B'").select("pr", F.coalesce("declaration", F.lit("(unnamed)")).alias("declaration"), "stratum")
    return ev.with_strata(ev.missing_verdicts(verdicts(t), t).select("task_id", "pr", "declaration"), strata, ["pr", "declaration"])


UNANSWERED_SQL = f"WITH {PICKS} SELECT task_id, pr, declaration, CASE WHEN stratum = 'B' THEN 'B' ELSE '-' END AS stratum FROM h WHERE h % 17 = 0"


def emission_stats(spark, sf_dir):
    t = written(ev.deal(tasks(spark, sf_dir)), "dealt")
    answered = verdicts(t).select("task_id", F.lit(1).alias("answered"))
    j = t.join(answered, "task_id", "left")
    return j.groupBy("rep").agg(F.count(F.lit(1)).alias("n_tasks"), F.count_distinct("batch").alias("n_batches"), F.count_if("accepted_is_a").alias("accepted_as_a"), F.count_if(F.col("answered").isNull()).alias("missing"), F.count_distinct("pr", "declaration").alias("n_pairs"))


STATS_SQL = f"""WITH {DEAL}
SELECT rep, count(*) AS n_tasks, count(DISTINCT batch) AS n_batches, count(*) FILTER (accepted_is_a) AS accepted_as_a, count(*) FILTER (('0x' || substr(sha256(task_id), 1, 2))::INT % 17 = 0) AS missing, count(DISTINCT (pr, declaration)) AS n_pairs FROM dealt GROUP BY rep"""

QUERIES = {
    "reject_tally": reject_tally, "eligible_rows": eligible_rows, "path_and_metaprogram": path_and_metaprogram, "held_out_exclusion": held_out_exclusion, "year_round_robin": year_round_robin, "blind_tasks": blind_tasks,
    "batch_deal": batch_deal, "selection_summary": selection_summary, "evaluation_rows": evaluation_rows, "sorted_failures": sorted_failures, "batch_outcomes": batch_outcomes, "decode_majority": decode_majority, "label_support_report": label_support_report, "position_bias": position_bias, "failed_pair_drop": failed_pair_drop, "emission_stats": emission_stats, "blind_artifacts": blind_artifacts, "unanswered_tasks": unanswered_tasks, "cascade_outcome": cascade_outcome,
}
ORACLE_SQL = {
    "reject_tally": f"WITH {CANDIDATES_SQL} SELECT reason, count(*) AS n FROM reasoned WHERE reason IS NOT NULL GROUP BY reason",
    "eligible_rows": f"WITH {CANDIDATES_SQL} SELECT pr, year, count(*) AS n, count(*) FILTER (is_api) AS n_api, sum(n_quotes)::BIGINT AS n_quotes FROM reasoned WHERE reason IS NULL GROUP BY ALL",
    "path_and_metaprogram": PATHS_SQL, "held_out_exclusion": HELD_SQL, "year_round_robin": f"WITH {DRAWN} SELECT stratum, pr, declaration, year, turn, n_quotes FROM drawn", "blind_tasks": BLIND_SQL,
    "batch_deal": f"WITH {DEAL} SELECT task_id, rep, stratum, batch FROM dealt", "decode_majority": f"WITH {PICKS} SELECT * FROM m", "label_support_report": REPORT_SQL,
    "position_bias": f"WITH {PICKS} SELECT count(*) FILTER (verdict = 'A') AS chose_a, count(*) FILTER (verdict = 'B') AS chose_b, count(*) FILTER (verdict = 'A')::DOUBLE / count(*) FILTER (verdict IN ('A', 'B')) AS bias FROM verdict",
    "selection_summary": f"WITH {DRAWN} {SUMMARY}", "evaluation_rows": f"WITH {DRAWN} {ROWS_SQL}", "sorted_failures": f"WITH {PICKS}{SORTED_SQL}", "batch_outcomes": f"WITH {DEAL} {OUTCOMES_SQL}", "failed_pair_drop": FAILED_SQL, "emission_stats": STATS_SQL, "unanswered_tasks": UNANSWERED_SQL, "blind_artifacts": f"WITH {DEAL} {ARTIFACTS_SQL}", "cascade_outcome": OUTCOME_SQL,
}
