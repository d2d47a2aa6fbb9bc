import difflib
import os
import random
import sys

sys.path.insert(0, os.path.dirname(__file__))
import plain_scanners as plain
import pytest
from pyspark.sql import functions as F

from pairquarry.functions import blocks, code, scan


@pytest.mark.parametrize(
    ("source", "kept"),
    [
        ("a /- b /- c -/ d -/ e", "a  e"),
        ('x "a -- b" y -- gone\nz', 'x "a -- b" y \nz'),
        (r'"a \" -- b" -- c', r'"a \" -- b" '),
        ("a -- to the end", "a "),
        ("a /- open", "a "),
        ("a -/ b", "a -/ b"),
        ("/--/ a", " a"),
        ("", ""),
    ],
)
def test_comments(source, kept):
    assert plain.without_comments(source) == kept


@pytest.mark.parametrize(
    ("source", "statement", "body"),
    [
        ("theorem t (n : N := 1) : T := by simp", "theorem t (n : N := 1) : T", "by simp"),
        ("instance : C where\n  x := 1", "instance : C", "where x := 1"),
        ("def nowhere : N := 2", "def nowhere : N", "2"),
        ("def f ) : N := 2", "def f ) : N := 2", "def f ) : N := 2"),
        ("example : ⟨a := b⟩ := c", "example : ⟨a := b⟩", "c"),
    ],
)
def test_statement_and_body(source, statement, body):
    assert plain.statement(source) == statement
    assert plain.proof_body(source) == body


def test_balanced():
    assert plain.balanced("(a [b] ⟨c⟩)") and not plain.balanced("(a]") and not plain.balanced("(") and plain.balanced("-- (\n")


@pytest.mark.parametrize(
    ("answer", "found"),
    [('{"a": 1}', '{"a": 1}'), ('```json\n{"a": 1}\n```', '{"a": 1}'), ('Well: {"a": "}"} so', '{"a": "}"}'), ("none", None), ("", None), ("{broken", None)],
)
def test_lenient_json(answer, found):
    assert scan.json_object(answer) == found


def test_similarity_is_of_the_bodies_in_their_order():
    a, b = "theorem t : T := abcd xx", "theorem t : T := bcda"
    assert scan.body_similarity(plain.proof_body(a), plain.proof_body(b)) == difflib.SequenceMatcher(None, "abcd xx", "bcda", autojunk=False).ratio()
    assert scan.body_similarity("", "") == 1.0


@pytest.mark.parametrize("letters", ["ab", "ab⟨𝔸 ", "abcdefghij_."])
def test_similarity_equals_a_plain_matcher(letters):
    rng = random.Random(letters)
    for _ in range(150):
        a, b = ("".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2))
        assert scan.body_similarity(a, b) == (difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() if a or b else 1.0)


@pytest.mark.parametrize(
    ("line", "kind"),
    [
        ("  theorem t : T", None),
        ("theorem foo: T", ("theorem", "foo")),
        ("theorem foo.{u} (x)", ("theorem", "foo.{u}")),
        ("instance : C where", ("instance", "")),
        ("example : T := x", ("example", "")),
        ("private noncomputable def f : N", ("def", "f")),
        ("@[simp] lemma a : T", ("lemma", "a")),
        ("@[a] @[b] theorem t : T", None),
        ("@[a", ("", "")),
        ("@[a]", ("", "")),
        ("-- note", ("", "")),
        ("/-! doc -/", ("", "")),
        ("#check x", ("", "")),
        ("nonrec theorem t : T", ("", "")),
        ("noncomputable", ("", "")),
        ("| 0 => 1", None),
        ("", None),
    ],
)
def test_line_kind(line, kind):
    assert blocks.line_kind(line) == kind


def test_blocks():
    source = "/- theorem no : T := x\n-/ theorem skipped : T := y\ntheorem a : T := by\n  simp\n\n\nend X\ndef f : N → N\n| 0 => 1\ndef g := ⟨1⟩\nlemma h (x := 1) : T := /- := -/ z\n"
    found = blocks.parse_blocks(source)
    assert [(b[0], b[1], b[3], b[5], b[6]) for b in found] == [("theorem", "a", "by\n  simp", 3, 4), ("def", "g", "⟨1⟩", 10, 10), ("lemma", "h", "/- := -/ z", 11, 11)]


def test_empty_body_is_dropped():
    assert blocks.parse_blocks("theorem a : T :=\n") == []


@pytest.mark.parametrize(
    ("source", "found"),
    [
        ("theorem a : ⟨x := 1⟩ = T := by simp\n", [("a", "theorem a : ⟨x", "1⟩ = T := by simp")]),
        ('def a := "/-"\ntheorem b : T := x\n-/\ntheorem c : T := x\n', [("a", "def a", '"/-"\ntheorem b : T := x\n-/'), ("c", "theorem c : T", "x")]),
        ("def a := 1\nabbrev b := 2\ndef c (x : N := 3) [d := 4] {e := 5} := 6\n", [("a", "def a", "1"), ("c", "def c (x : N := 3) [d := 4] {e := 5}", "6")]),
        ("@[a] @[b] theorem t : T := x\n", []),
        ("", []),
        ("@[simp]\ntheorem t : T := x\n", [("t", "theorem t : T", "x")]),
        ("theorem t : T := x\ntheorem t : T := y\n", [("t", "theorem t : T", "x"), ("t", "theorem t : T", "y")]),
    ],
)
def test_what_a_block_holds(source, found):
    assert [(b[1], b[2], b[3]) for b in blocks.parse_blocks(source)] == found


def test_a_string_hides_no_split_from_the_canonical_scanner():
    assert plain.statement('def f "a := b" := c') == 'def f "a'


def in_columns(spark, sources):
    rows = spark.createDataFrame(list(enumerate(sources)), "i long, s string")
    made = rows.select("i", code.stripped("s"), code.folded(F.col("s")), code.code_only("s"), code.signature("s"), code.body("s"), code.is_balanced("s"))
    return [tuple(r)[1:] for r in made.orderBy("i").collect()]


def in_python(source):
    if source is None:
        return (None,) * 6
    bare = plain.without_comments(source)
    return bare, bare, plain.canonical(source), plain.statement(source), plain.proof_body(source), plain.balanced(source)


def test_columns_equal_the_plain_scanners(spark):
    rng = random.Random(5)
    pieces = ["/-", "-/", "--", "/", "-", '"', "\\", "\n", " ", "\u3000", "a", "𝔸", "😀", "2", ":=", ":", "=", "w", "where", "here", "(", ")", "[", "]", "⟨", "⟩", "{", "}"]
    mixed = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    nested = ["".join(rng.choice(["/-", "/-", "-/", "x", "--", '"', "\n"]) for _ in range(rng.randint(10, 60))) for _ in range(1000)]
    sources = [None, "", *mixed, *nested]
    for source, found in zip(sources, in_columns(spark, sources), strict=True):
        assert found == in_python(source), repr(source)


def test_long_comments_strings_and_deep_nests_cost_no_stack(spark):
    n = 200_000
    sources = ["/- " + "- " * n + "-/ a := b", '"' + "\\x" * n + '" := b', "-" * n, "/-" * 300 + "x" + "-/" * 300 + " a := b", "/-" * 300, "a " * n + "( := x ) where y"]
    rows = spark.createDataFrame(list(enumerate(sources)), "i long, s string").select("i", code.stripped("s"), code.signature("s"), code.body("s")).orderBy("i").collect()
    for source, row in zip(sources, rows, strict=True):
        assert tuple(row)[1:] == (plain.without_comments(source), plain.statement(source), plain.proof_body(source))
