"""Lean sources without their comments, cut into statement and body, as column expressions.

Repeated groups are possessive, which Java's matcher goes through in a loop: long comments and strings cost no stack. Two
ways of tracking depth differ on purpose: comments nest and know strings, the cut counts all brackets without a floor.
The block parser has a third one (blocks.py). Null gives null everywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairquarry.functions import text

#: Comments nested so deep are matched by one expression; deeper ones are folded character by character, with the same result.
NESTED = 4
# Brackets and their partners, and what separates a statement from its body.
OPENING, CLOSING, ASSIGNED, WHERE = "([{⟨", ")]}⟩", ":=", "where"

STRING = r'"(?:\\.|[^"\\])*+(?:"|\\?\z)'
LINE_COMMENT = r"--[^\n]*+"
BRACKETS = r"(\[{⟨)\]}⟩"
# U+10000 is a letter anyway. Java looks behind by whole characters only if its pattern has one beyond U+FFFF.
LETTER = "[\\p{L}\\p{N}\U00010000]"


def _block_comment(depth: int) -> str:
    inside = r"[^/\-]++|/(?!-)|-(?!/)" + (f"|{_block_comment(depth - 1)}" if depth > 1 else "")
    return rf"/-(?:{inside})*+(?:-/|\z)"


REMOVED = rf"(?s)({STRING})|{LINE_COMMENT}|{_block_comment(NESTED)}"
SHALLOW = rf'(?s)\A(?:[^"/\-]++|{STRING}|{LINE_COMMENT}|/(?!-)|-(?!-)|{_block_comment(NESTED)})*+\z'
SPECIAL = r'(?s)[^"\\/\-\n]++|.'
WHOLE_WHERE = rf"(?<!{LETTER}){WHERE}(?!{LETTER})"
CUTS = rf"(?s)[{BRACKETS}]|{ASSIGNED}|{WHOLE_WHERE}|(?:[^{BRACKETS}:w]|:(?!=)|w(?!here(?!{LETTER}))|(?<={LETTER})w)++"


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), where value is computed once, however often it is named."""
    return F.transform(F.array(value), then)[0]


def _given(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def folded(source: Column) -> Column:
    """The source without comments of any depth, by a pass over its special characters.

    State: in code, a line comment, a block comment, a string or behind a backslash in one; the depth; a first half of a mark."""
    state = lambda mode, depth, half, kept: F.struct(F.lit(mode).alias("mode") if isinstance(mode, str) else mode.alias("mode"), depth.cast("int").alias("depth"), half.alias("half"), kept.alias("kept"))
    nothing = F.lit("")

    def step(s, t):
        mode, depth, half, kept = s["mode"], s["depth"], s["half"], s["kept"]
        put = lambda what: F.concat(kept, F.array(what))
        dash, slash = t == "-", t == "/"
        in_code = (
            F.when((half == "/") & dash, state("block", F.lit(1), nothing, kept))
            .when((half == "-") & dash, state("line", depth, nothing, kept))
            .when(dash | slash, state("code", depth, t, put(half)))
            .when(t == '"', state("string", depth, nothing, put(F.concat(half, t))))
            .otherwise(state("code", depth, nothing, put(F.concat(half, t))))
        )
        closed = depth - 1
        in_block = (
            F.when((half == "/") & dash, state("block", depth + 1, nothing, kept))
            .when((half == "-") & slash, state(F.when(closed == 0, "code").otherwise("block"), closed, nothing, kept))
            .otherwise(state("block", depth, F.when(dash | slash, t).otherwise(nothing), kept))
        )
        return (
            F.when(mode == "code", in_code)
            .when(mode == "block", in_block)
            .when(mode == "line", F.when(t == "\n", state("code", depth, nothing, put(t))).otherwise(s))
            .when(mode == "escaped", state("string", depth, nothing, put(t)))
            .otherwise(state(F.when(t == "\\", "escaped").when(t == '"', "code").otherwise("string"), depth, nothing, put(t)))
        )

    # Half a mark at the end is text, unless it stands in a comment.
    end = lambda s: F.concat(F.array_join(s["kept"], ""), F.when(s["mode"] == "code", s["half"]).otherwise(nothing))
    start = state("code", F.lit(0), nothing, F.array().cast("array<string>"))
    return F.aggregate(F.regexp_extract_all(source, F.lit(SPECIAL), F.lit(0)), start, step, end)


def stripped(source) -> Column:
    """The source without nested block comments and line comments; strings, and a stray end of comment, are kept."""
    source = _given(source)
    openings = (F.length(source) - F.length(F.replace(source, F.lit("/-"), F.lit("")))) / 2
    deep = (openings > NESTED) & ~F.rlike(source, F.lit(SHALLOW))
    return F.when(deep, folded(source)).otherwise(F.regexp_replace(source, REMOVED, "$1"))


def squeezed(code: Column) -> Column:
    return text.strip(F.regexp_replace(code, f"{text.SPACE}+", " "))


def code_only(source) -> Column:
    """Comment-free source with white space squeezed: what equality of two versions is judged on."""
    return squeezed(stripped(source))


def statement_end(code: Column) -> Column:
    """How many characters precede the first := or whole-word where outside of all brackets; -1 if there is none. Depth has no floor."""
    state = lambda depth, at, end: F.struct(depth.cast("int").alias("depth"), at.cast("int").alias("at"), end.cast("int").alias("end"))

    def step(s, piece):
        ends = piece.isin(ASSIGNED, WHERE) & (s["depth"] == 0)
        depth = s["depth"] + F.when(piece.isin(*OPENING), 1).when(piece.isin(*CLOSING), -1).otherwise(0)
        return F.when(s["end"] >= 0, s).when(ends, state(s["depth"], s["at"], s["at"])).otherwise(state(depth, s["at"] + F.length(piece), s["end"]))

    return F.aggregate(F.regexp_extract_all(code, F.lit(CUTS), F.lit(0)), state(F.lit(0), F.lit(0), F.lit(-1)), step, lambda s: s["end"])


def _cut(source, part: Callable[[Column, Column], Column]) -> Column:
    ended = _bound(stripped(source), lambda code: F.struct(code.alias("code"), statement_end(code).alias("end")))
    return squeezed(_bound(ended, lambda c: F.when(c["end"] < 0, c["code"]).otherwise(part(c["code"], c["end"]))))


def signature(source) -> Column:
    """The statement: comment-free source up to where its body begins, squeezed."""
    return _cut(source, lambda code, end: F.left(code, end))


def body(source) -> Column:
    """What follows the statement, without its :=, squeezed; all of the source if no body begins."""
    return _cut(source, lambda code, end: text.without_prefix(F.substring(code, end + 1, F.lit(2**31 - 1)), ASSIGNED))


def is_balanced(source) -> Column:
    """Whether all brackets outside comments close in order."""
    state = lambda stack, ok: F.struct(stack.alias("stack"), ok.alias("ok"))

    def step(s, b):
        opens, top = b.isin(*OPENING), F.right(s["stack"], F.lit(1))
        popped = F.left(s["stack"], F.length(s["stack"]) - 1)
        return F.when(opens, state(F.concat(s["stack"], b), s["ok"])).otherwise(state(popped, s["ok"] & (top == F.translate(b, CLOSING, OPENING))))

    marks = F.regexp_extract_all(stripped(source), F.lit(f"[{BRACKETS}]"), F.lit(0))
    return F.aggregate(marks, state(F.lit(""), F.lit(True)), step, lambda s: s["ok"] & (s["stack"] == ""))
