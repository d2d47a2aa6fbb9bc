import json
from datetime import datetime

from pyspark.sql import functions as F

from pairquarry.operators import assembly, evaluation, hygiene
from pairquarry.sources import normalize, sinks


def raw(spark, *records):
    return spark.createDataFrame([(1, json.dumps(r)) for r in records] + [(1, "not json")], "pr int, record string")


def test_raw_records(spark):
    c = normalize.review_comments(raw(spark, {"id": 1, "user": None, "path": "f", "body": None, "created_at": "2024-01-02T03:04:05Z"}, {"id": 2, "user": {"login": "x[bot]"}}), "pr").orderBy("id").collect()
    assert [(r.author, r.body, r.is_bot) for r in c[-2:]] == [("ghost", "", False), ("x[bot]", "", True)]
    assert c[-2].created_at == datetime(2024, 1, 2, 3, 4, 5)
    k = normalize.commits(raw(spark, {"sha": "a", "author": None, "commit": {"message": "m", "author": {"name": "N", "date": "2024-01-01T00:00:00Z"}}, "parents": [{"sha": "p"}]}, {"sha": "b", "commit": {"author": {}}}), "pr").where("sha IS NOT NULL").orderBy("sha").collect()
    assert [(r.author, r.parents) for r in k] == [("N", ["p"]), ("ghost", None)]
    t = normalize.contents(raw(spark, {"content": "w6k=\n", "encoding": "base64"}, {"content": "", "encoding": "base64"}, {"content": "x", "encoding": "none"}), "pr")
    assert sorted(r.content or "" for r in t.collect()) == ["", "", "", "é"] or sorted(r.content or "" for r in t.collect()) == ["", "", "é"]
    assert normalize.files(raw(spark, {"filename": "a", "additions": 1, "deletions": 2}), "pr").where("path = 'a'").first().additions == 1
    assert normalize.reviews(raw(spark, {"id": 1, "user": {"login": "u"}, "state": "APPROVED"}), "pr").where("id = 1").first().author == "u"
    assert normalize.issue_comments(raw(spark, {"id": 1, "user": {"login": "u"}, "body": "b"}), "pr").where("id = 1").first().body == "b"


def test_dataset_rows(spark):
    at = lambda s: datetime.fromisoformat(s)
    labels = spark.createDataFrame([(1, None, "f", "HIGH_VALUE", "s", ["style"], 0), (1, None, "g", "HIGH_VALUE", "t", None, 1), (1, "b", "f", "LOW_VALUE", "u", None, 2), (2, "a", "f", "HIGH_VALUE", "v", None, 0)], "pr int, declaration string, file_path string, verdict string, summary string, categories array<string>, position int")
    pairs = spark.createDataFrame([(1, None, "f", "x\ny", "x", "s", "s"), (1, None, "g", "x", "x", "s", "t"), (2, "a", "f", "x", "x", "s", "s")], "pr int, declaration string, file_path string, initial string, final string, initial_signature string, final_signature string")
    metadata = spark.createDataFrame([(1, "[Merged by Bors] - feat", at("2024-01-01T00:00:00"), at("2024-01-02T12:00:00"))], "pr int, title string, created_at timestamp, closed_at timestamp")
    comments = spark.createDataFrame([(1, "z", False), (1, "b", True)], "pr int, author string, is_bot boolean")
    reviews = spark.createDataFrame([(1, "a", False, " \n"), (1, "z", False, "ok")], "pr int, author string, is_bot boolean, body string")
    contexts = spark.createDataFrame([], "pr int, base_sha string")
    ready, errors = assembly.pending_metadata(spark.createDataFrame([(1,), (2,)], "pr int"), metadata)
    assert [r.pr for r in ready.collect()] == [1] and [r.pr for r in errors.collect()] == [2]
    row = assembly.dataset_rows(labels, pairs, metadata, assembly.people(comments, reviews), contexts, "https://host/pull/", F.lit("2024-02-01")).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.pr_url, r.pr_title, r.declaration_name, r.file_path, r.line_delta, r.signature_changed, r.reviewers, r.n_remarks, r.base_sha, r.created, r.review_days) == ("https://host/pull/1", "feat", "(unnamed)", "f", -1, False, ["a", "z"], 2, "", "2024-01-01", 1.5)
    shown = row and spark.createDataFrame([(None, "i")], "d string, i string").select(assembly.prompt(F.lit("t"), F.col("d"), F.col("i"), F.lit("f"), F.lit("c"))).first()[0]
    assert shown.startswith("## Request\nt\n\n## Declaration\n(unnamed)\n\n## Before\ni")


def test_audit(spark):
    rows = [(1, "N.a", "Mathlib/A", "theorem a : T := by x", "theorem a : T := by x -- y", 1, 1), (2, "b", "Cache/B", "theorem b : T := (", "", 5, 1), (3, "c", "Mathlib/C", "theorem c : T := z", "def c : T := do x : IO Unit", 1, 1)]
    found = hygiene.audit(spark.createDataFrame(rows, "k int, declaration string, file_path string, initial string, final string, initial_lines int, final_lines int"), "k")
    assert sorted(tuple(r) for r in found.collect()) == sorted([
        ("identical_after_comment_strip", 1, ""), ("unbalanced_brackets", 2, "initial"), ("declaration_name_absent", 2, "final"), ("signature_actually_differs", 2, ""), ("empty_proof_body", 2, ""),
        ("line_count_mismatch", 2, ""), ("non_mathematical_path", 2, ""), ("signature_actually_differs", 3, ""), ("metaprogram_code", 3, ""),
    ])
    assert hygiene.report(found, "k").splitlines()[-1] == "total: 9"


def test_checks_of_both_sides_give_a_row_one_finding(spark):
    rows = [(1, "a", "Mathlib/A", "-- a", "-- b", 5, 5), (2, "a", "Mathlib/A", "theorem a := x\n\n", "theorem a := y", 1, 1), (3, "a", "Mathlib/A", "theorem a := x", "theorem a := z", 1, 1)]
    df = spark.createDataFrame(rows, "k int, declaration string, file_path string, initial string, final string, initial_lines int, final_lines int")
    found = [tuple(r) for r in hygiene.audit(df, "k").collect()]
    assert ("duplicate_initial_proof", 2, "2 rows") in found and not [f for f in found if f[0] == "duplicate_final_proof"]
    assert found.count(("empty_proof_body", 1, "")) == found.count(("line_count_mismatch", 1, "")) == 1 and ("line_count_mismatch", 2, "") not in found
    assert [tuple(r) for r in hygiene.duplicate_groups(df, "k", "initial").collect()] == [(2, "2 == 3")]


def test_blind_files_keep_the_key_apart(spark, tmp_path):
    rows = spark.createDataFrame([(n, "d", "f", "B", "i", "f") for n in range(5)], "pr int, declaration string, file_path string, stratum string, initial string, final string")
    tasks = evaluation.blind_tasks(rows)
    sinks.blind_files(tasks, evaluation.deal(tasks, 2), str(tmp_path))
    assert sorted(spark.read.json(str(tmp_path / "tasks")).columns) == sorted(evaluation.TASK_COLUMNS)
    assert spark.read.json(str(tmp_path / "key")).count() == 15 and spark.read.json(str(tmp_path / "batches")).count() == 6
    text = sinks.calibration(spark.createDataFrame([("a", "x", "y", "accepted")], "declaration string, initial string, final string, expected string"))
    assert text.startswith("### a\n\nExpected: accepted")
