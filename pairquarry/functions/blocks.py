"""Declarations of a Lean source as rows. Column 0 decides where blocks begin; the rest of a block follows its first line."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keywords of declarations, of what may stand before one, and of other lines that begin a block.
KINDS = ("theorem", "lemma", "def", "instance", "example")
MODIFIERS = ("noncomputable", "protected", "private", "unsafe", "partial", "scoped", "public")
BOUNDARIES = (
    "namespace", "section", "end", "open", "variable", "import", "set_option", "attribute", "class", "structure", "inductive", "abbrev", "opaque",
    "axiom", "mutual", "universe", "export", "omit", "local", "alias", "assert_not_exists", "module", "macro", "syntax", "elab", "deriving",
    "suppress_compilation", "nonrec", "macro_rules", "run_cmd", "initialize", "initialize_simps_projections", "notation", "add_decl_doc",
    "compile_inductive%", "register_simp_attr",
)

SCHEMA = "kind string, name string, signature string, body string, full_text string, start_line int, end_line int"
_NEST = re.compile(r"/-|-/")
_PIECE = re.compile(r'"(?:\\.|[^"\\])*(?:"|\Z)|--[^\n]*|/-|-/|[(\[{]|[)\]}]|:=|\bwhere\b', re.S)
_HEAD = re.compile(rf"(?P<mod>(?:(?:{'|'.join(MODIFIERS)})(?:\s+|$))*)(?P<word>\S*)\s*(?P<next>\S*)")


def commented_lines(lines: list[str]) -> set[int]:
    """Lines that begin inside a block comment. Marks count wherever they stand, in strings and line comments too."""
    inside, depth = set(), 0
    for number, line in enumerate(lines):
        if depth:
            inside.add(number)
        for mark in _NEST.findall(line):
            depth = depth + 1 if mark == "/-" else max(0, depth - 1)
    return inside


def _after_attribute(line: str) -> str | None:
    """What follows a leading @[...]; None if it doesn't close on the line."""
    depth = 0
    for m in re.finditer(r"[\[\]]", line):
        depth += 1 if m[0] == "[" else -1
        if depth == 0:
            return line[m.end() :].strip()
    return None


def line_kind(line: str) -> tuple[str, str] | None:
    """(kind, name) of a declaration, ("", "") for another line that begins a block, None for all others."""
    if line[:1] in ("", " ", "\t") or not line.strip():
        return None
    text = line.strip()
    if text.startswith(("--", "/-", "#")):
        return "", ""
    if text.startswith("@["):
        text = _after_attribute(text) or ""
        if not text:
            return "", ""
    head = _HEAD.match(text)
    word, after = head["word"], head["next"]
    if not word:
        return "", ""
    if word in BOUNDARIES:
        return "", ""
    if word not in KINDS:
        return None
    if word == "example" or not after or (word == "instance" and not (after[0].isalpha() or after[0] == "_")):
        return word, ""
    return word, after.rstrip(":({[")


def body_start(block: str) -> tuple[int, str] | None:
    """Where the first := or where stands outside of brackets, strings and comments; brackets never go below zero."""
    depth = nest = 0
    for m in _PIECE.finditer(block):
        mark = m[0]
        if mark in ("/-", "-/"):
            nest = nest + 1 if mark == "/-" else max(0, nest - 1)
        elif nest or mark[0] == '"' or mark.startswith("--"):
            continue
        elif mark in "([{":
            depth += 1
        elif mark in ")]}":
            depth = max(0, depth - 1)
        elif depth == 0:
            return m.start(), mark
    return None


def parse_blocks(source: str) -> list[tuple]:
    lines = source.splitlines()
    inside = commented_lines(lines)
    starts = [(n, k) for n, line in enumerate(lines) if n not in inside and (k := line_kind(line)) is not None]
    found = []
    for (begin, (kind, name)), end in zip(starts, [*(n for n, _ in starts[1:]), len(lines)], strict=False):
        if not kind:
            continue
        while end > begin + 1 and not lines[end - 1].strip():
            end -= 1
        text = "\n".join(lines[begin:end])
        cut = body_start(text)
        if cut is None:
            continue
        at, mark = cut
        body = (text[at + 2 :] if mark == ":=" else text[at:]).strip()
        if body:
            found.append((kind, name or None, text[:at].rstrip(), body, text, begin + 1, end))
    return found


def blocks_of(sources: DataFrame, source_col: str, *keys: str) -> DataFrame:
    """keys and one row per declaration of each source."""

    @F.pandas_udf(f"array<struct<{SCHEMA.replace(' string', ':string').replace(' int', ':int')}>>")
    def parse(values: pd.Series) -> pd.Series:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return values.map(lambda v: [dict(zip(names, b, strict=True)) for b in parse_blocks(v or "")])

    return sources.select(*keys, F.posexplode(parse(F.col(source_col))).alias("ordinal", "block")).select(*keys, "ordinal", "block.*")


def tactics_only(blocks: DataFrame) -> DataFrame:
    """Declarations whose body begins with by."""
    return blocks.where(F.regexp_replace("body", r"^\s+", "").startswith("by"))


# A hunk's header, and a declaration's name in a line of a hunk.
HUNK = r"^@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@"
DECLARED = r"(?:theorem|lemma|def|instance)[ \t\x0B\f\r]+([\p{L}\p{N}_][\p{L}\p{N}_'.]*)"


def hunks_of(diffs: DataFrame, diff_col: str, key: str) -> DataFrame:
    """One row per hunk: key, hunk (from 1), starts and counts, old, new and context lines, and the declaration named.

    Context lines name the declaration before old and new lines do. Lines before the first header belong to no hunk. A diff
    is cut before its headers, and a hunk's lines are found by their signs: no line is gone through by a function.
    """
    diff = F.col(diff_col)
    pieces = F.split(diff, rf"\n(?={HUNK[1:]})", -1)
    cut = diffs.select(key, diff.rlike(HUNK).cast("int").alias("headed"), F.posexplode(pieces).alias("at", "piece"))
    # What precedes the first header is the first piece, unless the diff begins with a header.
    cut = cut.select(key, (F.col("at") + F.col("headed")).alias("hunk"), "piece").where("hunk > 0")
    number = lambda g: F.regexp_extract("piece", HUNK, g)
    count = lambda g: F.when(number(g) == "", 1).otherwise(number(g).cast("int"))
    rest = lambda signs: F.regexp_extract_all("piece", F.lit(rf"\n[{signs}]([^\n]*)"), F.lit(1))
    split = cut.select(key, "hunk", number(1).cast("int").alias("old_start"), count(2).alias("old_count"), number(3).cast("int").alias("new_start"), count(4).alias("new_count"), rest(" \\-").alias("old_lines"), rest(" +").alias("new_lines"), rest(" ").alias("context_lines"))
    # Names don't reach over the ends of lines, so that the first in the joined lines is that of the first line with one.
    first = lambda ls: F.nullif(F.regexp_extract(F.array_join(ls, "\n"), DECLARED, 1), F.lit(""))
    return split.withColumn("declaration", F.coalesce(first(F.col("context_lines")), first(F.concat("old_lines", "new_lines"))))


def declarations_of(diffs: DataFrame, diff_col: str, key: str) -> DataFrame:
    """(key, declarations): the different declarations that a diff's hunks name, first seen first. Bounded by the diff's own hunks."""
    rows = F.array_sort(F.collect_list(F.struct("hunk", "declaration")))
    named = F.filter(F.transform(rows, lambda r: r["declaration"]), lambda d: d.isNotNull())
    return hunks_of(diffs, diff_col, key).groupBy(key).agg(F.array_distinct(named).alias("declarations"))
