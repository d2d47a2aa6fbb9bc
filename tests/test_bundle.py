import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from pairquarry.sources import bundle


def rows(spark, *ks):
    return spark.createDataFrame([(k, f"v{k}") for k in ks], "k int, v string")


def held(spark, path, part):
    return sorted(r.k for r in bundle.read(spark, path, part, "k int, v string").collect())


def test_tables_and_sidecar_in_one_commit(spark, tmp_path):
    path, now = f"{tmp_path}/b", datetime(2024, 1, 2, tzinfo=UTC)
    record = bundle.write({"a": rows(spark, 1, 2, 3).repartition(3), "b": rows(spark, 4), "none": rows(spark)}, path, "set", "0.1", now=now)
    assert record["rows"] == record["total_rows"] == {"a": 3, "b": 1, "none": 0}
    assert [held(spark, path, p) for p in ("a", "b", "none", "other")] == [[1, 2, 3], [4], [], []]
    assert json.loads(bundle.info(path, "a")) == {"name": "set", "version": "0.1", "total_rows": 3, "generated_at": "2024-01-02T00:00:00+00:00"}
    assert spark.read.json(f"{path}/a").count() == 3


def test_append_and_overwrite(spark, tmp_path):
    path = f"{tmp_path}/b"
    bundle.write({"a": rows(spark, 1), "b": rows(spark, 9)}, path)
    again = bundle.write({"a": rows(spark, 2, 3)}, path)
    assert (again["number"], again["rows"], again["total_rows"]) == (1, {"a": 2}, {"a": 3, "b": 1}) and held(spark, path, "a") == [1, 2, 3] and held(spark, path, "b") == [9]
    new = bundle.write({"a": rows(spark, 7), "b": rows(spark)}, path, mode="overwrite")
    assert new["total_rows"] == {"a": 1, "b": 0} and held(spark, path, "a") == [7] and held(spark, path, "b") == []
    assert len(list((tmp_path / "b/a").iterdir())) == 1 and not list((tmp_path / "b/b").iterdir())


def test_a_write_that_fails_leaves_nothing_that_counts(spark, tmp_path):
    path = f"{tmp_path}/b"
    bundle.write({"a": rows(spark, 1)}, path)
    # A task that was still writing when the write was given up may leave a staged file, which the next commit removes.
    files = lambda: sorted(str(p) for p in (tmp_path / "b").rglob("*.json") if "_staged" not in p.parts)
    before = files()
    # One task is done before another fails.
    bad = rows(spark, *range(100)).repartition(4, "k").withColumn("v", F.when(F.col("k") == 77, F.raise_error(F.lit("bad row"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="bad row"):
        bundle.write({"a": bad, "c": rows(spark, 5)}, path)
    assert files() == before and held(spark, path, "a") == [1] and held(spark, path, "c") == []
    left = tmp_path / "b/_staged/given-up"
    left.mkdir(parents=True)
    (left / "a-1.json").write_text("{}\n")
    bundle.write({"a": rows(spark, 2)}, path)
    assert held(spark, path, "a") == [1, 2] and not left.exists()


def test_what_a_killed_commit_moved_does_not_count(spark, tmp_path):
    path = f"{tmp_path}/b"
    bundle.write({"a": rows(spark, 1)}, path)
    (tmp_path / "b/a/a-0.json").write_text('{"k": 5, "v": "moved, but never recorded"}\n')
    assert held(spark, path, "a") == [1]
    assert bundle.write({"a": rows(spark, 2)}, path)["total_rows"] == {"a": 2} and held(spark, path, "a") == [1, 2]
    assert len(list((tmp_path / "b/a").iterdir())) == 2


def test_a_second_writer_of_the_same_commit_fails(tmp_path):
    path = str(tmp_path)
    one, two = (bundle.BundleWriter({"path": path, "parts": "a"}, False) for _ in range(2))
    one.commit([])
    system, folder = bundle.opened(path)
    with pytest.raises(RuntimeError, match="another write"):
        two._put(system, f"{folder}/_commits/00000000.json", {})
