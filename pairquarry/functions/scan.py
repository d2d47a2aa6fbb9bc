"""What is read out of texts by Arrow UDFs: similarities of bodies, JSON amid prose."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pairquarry.functions import code


def _longest_run(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Start in a, start in b and length of the longest common run; of equal ones the first in a, then the first in b.

    The runs that end at one character of a are grown from those at the character before, for all ends in b at once."""
    lengths, best = np.zeros(len(b) + 1, np.int32), (0, 0, 0)
    for i, character in enumerate(a):
        lengths[1:] = np.where(b == character, lengths[:-1] + 1, 0)
        j = int(lengths.argmax())
        if lengths[j] > best[2]:
            n = int(lengths[j])
            best = (i + 1 - n, j - n, n)
    return best


def _matched_characters(a: np.ndarray, b: np.ndarray) -> int:
    """The longest common run's length and that of what matches before it and behind it, by the same rule."""
    matched, open_ = 0, [(a, b)]
    while open_:
        a, b = open_.pop()
        at, there, n = _longest_run(a, b) if len(a) and len(b) else (0, 0, 0)
        if n:
            matched += n
            open_ += [(a[:at], b[:there]), (a[at + n :], b[there + n :])]
    return matched


def body_similarity(initial: str, final: str) -> float:
    """Ratcliff-Obershelp ratio of two bodies, in this order; 1 if both are empty. Memory grows with the longer body, time
    with the product of both."""
    a, b = (np.frombuffer(side.encode("utf-32-le", "surrogatepass"), np.uint32) for side in (initial, final))
    if np.array_equal(a, b):
        return 1.0
    return 2.0 * _matched_characters(a, b) / (len(a) + len(b))


def json_object(answer: str) -> str | None:
    """The JSON object in a model's answer, fenced or amid prose, as canonical JSON; null if there is none."""
    text = (answer or "").strip()
    if text.startswith("```"):
        text = "\n".join(line for line in text.split("\n")[1:] if line.strip() != "```").strip()
    decoder = json.JSONDecoder()
    try:
        return json.dumps(json.loads(text), sort_keys=True)
    except ValueError:
        start = text.find("{")
    if start < 0:
        return None
    try:
        return json.dumps(decoder.raw_decode(text, start)[0], sort_keys=True)
    except ValueError:
        return None


def _column(fn, kind: str):
    @F.pandas_udf(kind)
    def mapped(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else fn(v))

    return mapped


def lenient_json(col):
    return _column(json_object, "string")(col)


def similarity(initial, final):
    """body_similarity of two sources' bodies."""

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else body_similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return ratio(code.body(initial), code.body(final))
