import json
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from pairquarry.llm import bpe, mixing, toxicity
from pairquarry.llm.shared import materialize


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = materialize(stage(spark, docs, SF), "stage")
        kept[name] = before, [r.asDict() for r in docs.collect()]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    before, after = kept["toxicity"]
    model = toxicity.learned(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = toxicity.Scorer(model).scores([d["text"] for d in before])
    assert {d["doc_id"] for d in after} == {d["doc_id"] for d, s in zip(before, scores, strict=True) if s < toxicity.THRESHOLD}
    before, after = kept["exact dedup"]
    last = {}
    for d in before:
        last[d["text"]] = max(last.get(d["text"], -1), d["doc_id"])
    assert sorted(d["doc_id"] for d in after) == sorted(last.values())
    before, after = kept["simhash near-dedup"]
    sets = {d["doc_id"]: shingles(d["text"]) for d in before}
    left = {d["doc_id"] for d in after}
    similar = lambda a, b: len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b]))
    assert not [(a, b) for a in left for b in left if a < b and similar(a, b) >= 0.8]
    assert all(max(similar(a, b) for b in sets if b != a) >= 0.8 for a in set(sets) - left)
    before, after = kept["mix sources"]
    counts = {r.doc_id: r.copies for r in mixing.mix_counts(spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")).select("row.doc_id", "copies").collect()}
    assert sorted(d["doc_id"] for d in after) == sorted(i for i, n in counts.items() for _ in range(n))
    before, after = kept["bpe encode"]
    own = bpe.ByteBpe(bpe.default_path())
    texts = {d["doc_id"]: d["text"] for d in before}
    assert len(after) == len(before) and all(own.decode(__import__("numpy").array(d["ids"], dtype="int64")) == texts[d["doc_id"]] and d["n_tokens"] == len(d["ids"]) for d in after)


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "ids", "n_tokens"]
    assert corpus_pipeline.run(spark, SF).where(F.size("ids") != F.col("n_tokens")).isEmpty()


def test_stages_on_odd_rows_and_on_nothing(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "word " * 30_000, "en", "a", 5), (4, "same text here", "en", "a", 5), (4, "same text here", "en", "a", 5), (5, "same text here", "fr", None, 5), (None, "no id", "en", "b", 5), (6, "other words", None, "b", None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("size", F.lit(1)).withColumn("ids", F.lit("clash"))
    for docs in (odd, odd.limit(0)):
        left = []
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), "odd")
            left.append((name, docs.count()))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == odd.columns
        if left[0][1]:
            # Null and empty texts are equal, and so are the three copies; the row without an id stays.
            assert left[:3] == [("toxicity", 8), ("exact dedup", 5), ("simhash near-dedup", 5)]
        else:
            assert {n for _, n in left} == {0}


def test_ids_that_do_not_decode_to_the_text_stop_the_last_stage(spark, tmp_path, monkeypatch):
    with open(bpe.default_path(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["vocab"]["q"] = spec["model"]["vocab"]["z"]
    (tmp_path / "bpe.json").write_text(json.dumps(spec), encoding="utf-8")
    monkeypatch.setattr(bpe, "default_path", lambda: str(tmp_path / "bpe.json"))
    docs = spark.createDataFrame([(1, "plain"), (2, "q z")], "doc_id long, text string")
    assert corpus_pipeline.encode(spark, docs.where("doc_id = 1"), SF).count() == 1
    with pytest.raises(Exception, match="don't decode"):
        corpus_pipeline.encode(spark, docs, SF).collect()
