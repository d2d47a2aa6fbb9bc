"""Rows of a small file that are heavy to go through are dealt to many tasks."""

from pairquarry.plans import text_queries

SF = "/root/testdata/sf0.001"


def test_sources_of_one_file_are_dealt_out(spark):
    assert spark.read.parquet(f"{SF}/part.parquet").rdd.getNumPartitions() == 1
    sizes = text_queries.strip_comments_synth(spark, SF).rdd.glom().map(len).collect()
    assert len(sizes) >= 8 and max(sizes) < sum(sizes) / 4


def test_audited_pairs_of_one_file_are_dealt_out(spark):
    sizes = text_queries.audited_parts(spark, SF).rdd.glom().map(len).collect()
    assert len(sizes) >= 8 and max(sizes) < sum(sizes) / 4


def test_keys_of_few_bytes_are_not_put_into_one_task(spark):
    from pairquarry.plans import status_queries

    sizes = [n for n in status_queries.metadata_errors(spark, SF).rdd.glom().map(len).collect() if n]
    assert len(sizes) >= 8 and max(sizes) < sum(sizes) / 4, sizes
