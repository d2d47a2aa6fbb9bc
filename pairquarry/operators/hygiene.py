"""The ten hygiene checks of an evaluation set, as rows of findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairquarry.functions import code, text
from pairquarry.operators.evaluation import NOT_MATHEMATICS, metaprogram

# The checks by name.
CHECKS = (
    "identical_after_comment_strip", "unbalanced_brackets", "declaration_name_absent", "duplicate_final_proof", "duplicate_initial_proof",
    "signature_actually_differs", "empty_proof_body", "line_count_mismatch", "non_mathematical_path", "metaprogram_code",
)


def _lines(source: Column) -> Column:
    bare = F.regexp_replace(source, rf"{text.SPACE}+\z", "")
    return F.when(bare == "", 0).otherwise(text.line_count(bare))


def audit(rows: DataFrame, key: str) -> DataFrame:
    """(finding, key, side) of rows(key, declaration, file_path, initial, final, initial_lines, final_lines).

    Brackets and names are looked for on each side; all other checks give a row one finding, whichever side fails. A
    group of rows with one canonical text is one finding, under its first key and with its size in place of the side.
    Sources are scanned once; duplicates are found by counting canonical texts, not by collecting them.
    """
    scanned = rows.select(
        "*",
        *[f(s).alias(f"{n}_{s}") for s in ("initial", "final") for n, f in (("code", code.code_only), ("sig", code.signature), ("balanced", code.is_balanced))],
        text.last_component(F.col("declaration")).alias("short_name"),
    )
    both = ("initial", "final")
    none = F.lit("")
    rules = [
        ("identical_after_comment_strip", F.col("code_initial") == F.col("code_final"), none),
        *[("unbalanced_brackets", ~F.col(f"balanced_{s}"), F.lit(s)) for s in both],
        *[("declaration_name_absent", ~F.contains(s, "short_name"), F.lit(s)) for s in both],
        ("signature_actually_differs", F.col("sig_initial") != F.col("sig_final"), none),
        ("empty_proof_body", (F.col("code_initial") == "") | (F.col("code_final") == ""), none),
        ("line_count_mismatch", (F.abs(_lines(F.col("initial")) - F.col("initial_lines")) > 1) | (F.abs(_lines(F.col("final")) - F.col("final_lines")) > 1), none),
        ("non_mathematical_path", F.col("file_path").rlike(NOT_MATHEMATICS), none),
        ("metaprogram_code", metaprogram(F.col("final")), none),
    ]
    hits = F.filter(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.struct(F.lit(name).alias("finding"), side.alias("side"))) for name, rule, side in rules]), lambda h: h.isNotNull())
    found = scanned.select(key, F.explode(hits).alias("h")).select("h.finding", key, "h.side")
    for side in both:
        groups = scanned.groupBy(f"code_{side}").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias(key)).where("n > 1")
        found = found.unionByName(groups.select(F.lit(f"duplicate_{side}_proof").alias("finding"), key, F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("side")))
    return found


def duplicate_groups(rows: DataFrame, key: str, side: str) -> DataFrame:
    """The rows whose side has the same canonical text, joined in order, for a bounded evaluation set; see audit() for any size."""
    groups = rows.groupBy(code.code_only(side).alias("code")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(key)).alias("members")).where("n > 1")
    return groups.select("n", F.array_join(F.col("members").cast("array<string>"), " == ").alias("members"))


def report(findings: DataFrame, key: str, preview: int = 12) -> str:
    """Counts per check with the first findings of each, and the total."""
    counts = {r["finding"]: (r["n"], r["first"]) for r in findings.groupBy("finding").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first")).collect()}
    lines = []
    for check in CHECKS:
        n = counts.get(check, (0, None))[0]
        lines.append(f"{check}: {n}")
        if n:
            some = findings.where(F.col("finding") == check).orderBy(key).limit(preview).collect()
            lines.append("  " + ", ".join(str(r[key]) for r in some))
    return "\n".join([*lines, f"total: {sum(n for n, _ in counts.values())}"])
