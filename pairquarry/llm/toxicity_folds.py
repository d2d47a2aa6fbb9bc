"""Chooses toxicity's Settings by inner folds of its training rows; held-out rows are not read.

    python -m pairquarry.llm.toxicity_folds FOLDER...

prints, for each folder of tables and each candidate, the log loss, and precision and recall at the threshold, of
documents by models of the other folds. Each task of the job fits one model.
"""

from __future__ import annotations

import sys
from dataclasses import astuple, replace

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

from pairquarry.llm import toxicity

FOLDS = 4


def candidates(around: toxicity.Settings) -> list[toxicity.Settings]:
    """The settings themselves, and with one of them changed."""
    steps = {"power": (1, 3), "sharpness": (1.0, 4.0), "clean_weight": (1.0, 2.5), "disguised_weight": (0.2, 1.0)}
    return [around, *(replace(around, **{k: v}) for k, values in steps.items() for v in values)]


def fold_scores(spark: SparkSession, texts: list[str], labels: list[int], settings: list[toxicity.Settings], folds: int = FOLDS) -> pd.DataFrame:
    """(setting, label, score) of every text under every setting, by a model of the other folds."""
    y = np.array(labels)
    fold = toxicity.parts_of(y, folds)

    def fit(batches):
        for pdf in batches:
            for setting, own in zip(pdf["setting"], pdf["fold"], strict=True):
                seen, unseen = np.flatnonzero(fold != own), np.flatnonzero(fold == own)
                model = toxicity.train([texts[i] for i in seen], y[seen].tolist(), settings=settings[setting])
                yield pd.DataFrame({"setting": setting, "label": y[unseen], "score": toxicity.Scorer(model).scores([texts[i] for i in unseen])})

    jobs = spark.createDataFrame([(s, f) for s in range(len(settings)) for f in range(folds)], "setting int, fold int").repartition(len(settings) * folds, "setting", "fold")
    return jobs.mapInPandas(fit, "setting int, label int, score double").toPandas()


def figures(scored: pd.DataFrame) -> tuple[float, float, float]:
    """Log loss, precision and recall."""
    y, p = scored["label"].to_numpy(), scored["score"].clip(1e-6, 1 - 1e-6).to_numpy()
    flagged = p >= toxicity.THRESHOLD
    return float(-np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))), float(y[flagged].mean()) if flagged.any() else 0.0, float(flagged[y == 1].mean())


def main(folders: list[str]) -> None:
    from pairquarry.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    settings = candidates(toxicity.Settings())
    for folder in folders:
        docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
        texts, y, _ = toxicity.training_sample(docs, labels, ~toxicity.held_out("doc_id"), "doc_id", "text", "toxic", toxicity.TRAIN_ROWS, toxicity.TRAIN_CHARS)
        scored = fold_scores(spark, texts, y, settings)
        for n, s in enumerate(settings):
            loss, precision, recall = figures(scored[scored["setting"] == n])
            print(folder, len(y), sum(y), astuple(s), f"log loss {loss:.4f}, precision {precision:.3f}, recall {recall:.3f}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
