"""A scan whose host tells what follows a page: the driver follows cursors, tasks ask for the records."""

import json
import os

import pytest

from pairquarry.sources import cursor


def fetched(resource, asked):
    from pairquarry.sources import replay

    with open(f"{resource}-tasks", "a") as f:
        f.write(f"{os.getpid()} {asked}\n")
    return replay.chain(resource, asked)


def pages(folder, first, sizes):
    number = len(list(folder.glob("page=*")))
    for n, size in enumerate(sizes):
        (folder / f"page={number + n}").mkdir(parents=True)
        (folder / f"page={number + n}/part-0").write_text("".join(json.dumps({"id": first + i}) + "\n" for i in range(size)))
        first += size
    return first


@pytest.mark.parametrize("per_batch", ["2", "100"])
def test_tasks_ask_for_the_records_and_a_scan_goes_on_from_its_cursor(spark, tmp_path, per_batch):
    folder = tmp_path / "pages"
    after = pages(folder, 0, [4, 4, 4, 2])
    options = {"transport": "tests.test_following:fetched", "following": "pairquarry.sources.replay:following", "resource": str(folder), "pages": per_batch, "together": "1"}
    run = lambda **more: cursor.scan(spark, f"{tmp_path}/rows", f"{tmp_path}/state", **options, **more)
    ids = lambda: sorted(json.loads(r.record)["id"] for r in spark.read.schema("cursor string, place int, record string").parquet(f"{tmp_path}/rows").collect())
    run(limit="5")
    assert ids() == list(range(8))  # whole pages
    run(limit="1")
    assert ids() == list(range(12))
    run()
    run()
    assert ids() == list(range(after))
    pages(folder, after, [3])  # what comes later follows the last cursor
    run()
    assert ids() == list(range(after + 3))
    # Each page's records were asked for once, by tasks.
    assert len((tmp_path / "pages-tasks").read_text().splitlines()) == 5
