"""Text functions as columns, with white space and identifiers as the mined sources mean them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as white space at the ends of a text (all Unicode white space and the separators 1C-1F).
SPACE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
# Fixed value: a token is an identifier (subscripts and primes included) or any single character that isn't white space.
TOKEN = r"[a-zA-Z_][\p{L}\p{N}_'.]*|[^\s\x0B\x1c-\x1f\x85\p{Z}]"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def line_count(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")


def stored_or_counted(stored: Column, text: Column) -> Column:
    """A recorded number of lines; if it is missing or 0, the lines of the text, an end of line at its end not counted."""
    counted = F.when(text == "", 0).otherwise(line_count(text) - text.endswith("\n").cast("long"))
    return F.coalesce(F.when(stored != 0, stored), counted).cast("long")


def occurrences(text: Column, what: str) -> Column:
    """How often a one-character string occurs."""
    return (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))).cast("long")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def without_prefix(text: Column, prefix: str) -> Column:
    """The text after an anchored literal prefix, or the text."""
    return F.when(text.startswith(prefix), F.substring(text, len(prefix) + 1, 2**31 - 1)).otherwise(text)


def last_component(name: Column) -> Column:
    """What follows the last dot of a name."""
    return F.element_at(F.split(name, r"\."), -1)


def to_number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("long")


def stable_bit(*parts: Column) -> Column:
    """A coin fixed by the parts: whether the first byte of the SHA-256 of the parts, joined by colons, is even."""
    digest = F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts]), 256)
    return to_number(F.substring(digest, 1, 2)) % 2 == 0
