"""What the operators share: texts and words as columns, and tables in the cluster's shared folder."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairquarry.operators.tables import written as materialize  # noqa: F401  the operators' name for it

#: Bytes of texts that a task takes apart at once; memory only.
CHUNK_BYTES = 2_000_000
#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str) -> Column:
    """The column's text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of WORDs, without building them: word starts are non-spaces after a space or at the start."""
    squeezed = F.regexp_replace(text, WORD, "w")
    return F.length(F.regexp_replace(squeezed, r"[\x20\x09-\x0D]+", "")).cast("long")


def same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    """Null-safe equality of the named columns, usable as an equi-join."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & a[c].eqNullSafe(b[c])
    return condition


def byte_chunks(column: pa.Array):
    """A binary column without nulls as lists of some CHUNK_BYTES each; a longer value is a list of its own."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_BYTES, "right")))
        yield column.slice(at, to - at).to_pylist()
        at = to
