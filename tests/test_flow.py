import json
import random
from datetime import datetime, timedelta

import pytest
from conftest import SF
from pyspark.sql import functions as F

from pairquarry.operators import ledger
from pairquarry.operators.ledger_state import LedgerState
from pairquarry.operators.phases import Phase, PhaseStore, committed_folders, run_phases
from pairquarry.plans import flow_queries
from pairquarry.sources import cursor, records


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landed"))
    flow_queries.land(spark, SF, root)
    return records.Landing(root)


def outcome(store):
    return sorted((r.pr, r.declaration_name, r.summary) for r in flow_queries.dataset(store).select("pr", "declaration_name", "summary").collect())


def test_a_run_that_dies_is_taken_up_where_it_stopped(spark, landed, tmp_path):
    whole = PhaseStore(spark, f"{tmp_path}/whole")
    phases = flow_queries.phases_of(landed)
    assert run_phases(whole, phases) == [p.name for p in phases]

    broken = PhaseStore(spark, f"{tmp_path}/broken")
    run_phases(broken, phases[:3])
    # Dies between two phases, then inside one: half of its rows are written, nothing is committed.
    half = f"{tmp_path}/broken/parsed/run-000000"
    broken.made("extracted").select("pr").limit(1).write.parquet(half)
    (tmp_path / "broken/parsed/run-000000/_SUCCESS").unlink()
    assert broken.rows("parsed") is None and broken.status().where("parsed_at IS NOT NULL").count() == 0

    def dies(store, waiting):
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        run_phases(broken, [*phases[:3], Phase("parsed", dies, after="extracted")])
    before = {p.name: broken.runs(p.name) for p in phases[1:2]}
    ran = run_phases(broken, phases)
    assert "enriched" not in ran and {"parsed", "summarized", "assembled"} <= set(ran)
    assert {p.name: broken.runs(p.name) for p in phases[1:2]} == before and committed_folders(spark, f"{tmp_path}/broken/parsed")[1] == []
    assert outcome(broken) == outcome(whole) and outcome(whole)


def test_records_that_fail_are_left_alone_after_three_errors(spark, landed, tmp_path):
    store, phases = PhaseStore(spark, f"{tmp_path}/s"), flow_queries.phases_of(landed)[:3]
    for _ in range(5):
        run_phases(store, phases)
    failed = store.status().where("error_count > 0").collect()
    assert failed and {(r.error_count, r.last_error) for r in failed} == {(ledger.MAX_ERRORS, "no context")}
    assert len(store.runs("extracted")) == 3 and len(store.runs("enriched")) == 1


def test_phases_take_no_more_than_their_limit(spark, landed, tmp_path):
    store, phases = PhaseStore(spark, f"{tmp_path}/s"), flow_queries.phases_of(landed)[:2]
    run_phases(store, phases, limit=2)
    assert store.rows("enriched").count() == 2
    run_phases(store, phases, limit=1)
    assert store.rows("enriched").count() == 3


EVENTS = "pr long, ts timestamp, phase string, qualifies boolean, message string, source string, query string"


def random_events(rnd, n):
    phases = [None, *ledger.ALL_PHASES, "error", "error", "enriched"]
    start = datetime(2024, 1, 1)
    out = []
    for i in range(n):
        phase = rnd.choice(phases)
        out.append((rnd.randint(1, 12), start + timedelta(minutes=i), phase, rnd.random() < 0.5, f"m{i}", rnd.choice(["full_scan", "keyword_search", "keyword_search", "manual" if i % 29 == 0 else "full_scan"]), rnd.choice([None, f"q{i % 5}", f"q{i % 3}"])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_give_what_all_events_give(spark, tmp_path, seed):
    rnd = random.Random(seed)
    events = random_events(rnd, 150)
    rnd.shuffle(events)
    state = LedgerState(spark, f"{tmp_path}/{seed}", buckets=4)
    assert state.status() is None
    for n, part in enumerate((events[:50], events[50:60], events[60:])):
        state.apply(spark.createDataFrame(part, EVENTS), n)
        state.apply(spark.createDataFrame(part, EVENTS), n)
    whole = spark.createDataFrame(events, EVENTS)
    expected = ledger.status_table(whole).join(ledger.folded_candidates(whole), "pr")
    found = state.status()
    assert sorted(map(repr, found.select(*sorted(found.columns)).collect())) == sorted(map(repr, expected.select(*sorted(expected.columns)).collect()))


def test_a_batch_writes_only_the_buckets_it_touches(spark, tmp_path):
    state = LedgerState(spark, str(tmp_path / "s"), buckets=16)
    many = [(n, datetime(2024, 1, 1), "enriched", True, None, None, None) for n in range(200)]
    state.apply(spark.createDataFrame(many, EVENTS), 0)
    one = spark.createDataFrame([(7, datetime(2024, 1, 2), "extracted", None, None, None, None)], EVENTS)
    state.apply(one, 1)
    assert len(state.newest()) == 16 and len([d for d in (tmp_path / "s/batch-000000001").iterdir() if d.name.startswith("bucket=")]) == 1
    read = state.read([int(k) for k, v in state.newest().items() if "batch-000000001" in v])
    assert read.count() < 30 and state.status().where("extracted_at IS NOT NULL").count() == 1 and state.status().count() == 200
    # A batch that was cut off is not seen, and is taken away by the next.
    state.apply(one, 2)
    (tmp_path / "s/batch-000000002/_SUCCESS").unlink()
    assert all("batch-000000002" not in p for p in state.newest().values())
    state.apply(one, 2)
    assert state.status().count() == 200


def test_phase_events_are_no_finds(spark, tmp_path):
    rows = [(1, datetime(2024, 1, 1), None, None, None, "keyword_search", "a"), (1, datetime(2024, 1, 2), "enriched", True, None, None, None), (1, datetime(2024, 1, 3), None, None, None, "full_scan", "b")]
    state = LedgerState(spark, str(tmp_path / "s"))
    for n, r in enumerate(rows):
        state.apply(spark.createDataFrame([r], EVENTS), n)
    got = state.status().first()
    assert (got.source, got.source_query, got.qualifies) == ("full_scan", "a,b", True)


def pages(folder, first, sizes):
    number = sum(len(list(folder.glob("page=*"))) for _ in [0])
    for n, size in enumerate(sizes):
        (folder / f"page={number + n}").mkdir(parents=True)
        (folder / f"page={number + n}/part-0").write_text("".join(json.dumps({"id": first + i}) + "\n" for i in range(size)))
        first += size
    return first


def scanned(spark, tmp_path):
    rows = spark.read.schema("cursor string, place int, record string").parquet(f"{tmp_path}/rows")
    return sorted(json.loads(r.record)["id"] for r in rows.collect())


def test_a_scan_stops_at_the_page_that_reaches_the_limit_and_goes_on_from_its_cursor(spark, tmp_path):
    folder = tmp_path / "pages"
    after = pages(folder, 0, [4, 4, 4, 2])
    options = {"transport": "pairquarry.sources.replay:chain", "resource": str(folder), "pages": "2"}
    run = lambda **more: cursor.scan(spark, f"{tmp_path}/rows", f"{tmp_path}/state", **options, **more)
    run(limit="5")
    assert scanned(spark, tmp_path) == list(range(8))  # whole pages
    run(limit="1")
    assert scanned(spark, tmp_path) == list(range(12))
    run()
    run()
    assert scanned(spark, tmp_path) == list(range(after))
    pages(folder, after, [3])  # what comes later follows the last cursor
    run()
    assert scanned(spark, tmp_path) == list(range(after + 3))


def test_flow_dataset_rows_have_their_url(spark, landed, tmp_path):
    store = PhaseStore(spark, f"{tmp_path}/s")
    run_phases(store, flow_queries.phases_of(landed))
    emitted = flow_queries.select_and_emit(flow_queries.dataset(store), str(tmp_path / "out"), target=3)
    assert emitted.count() == 3 and emitted.select("pr").distinct().count() == 3
    info = json.loads(spark.read.text(f"{tmp_path}/out/info").first()[0])
    assert info["total_rows"] == 3
    assert emitted.where(~F.col("pr_url").endswith(F.col("pr").cast("string"))).count() == 0
