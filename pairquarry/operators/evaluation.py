"""The evaluation set: eligibility cascade, stratified draw, blind tasks, verdicts and their report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pairquarry.functions import text
from pairquarry.functions.text import stable_bit
from pairquarry.operators.mining import first_wins, last_wins, null_safe_join
from pairquarry.operators.tables import written

# The strata's sizes, readers of each replicate, replicates, and the columns a reader may see.
API_ROWS, OTHER_ROWS, READERS, REPLICATES = 60, 190, 12, 3
TASK_COLUMNS = ["task_id", "declaration", "file_path", "proof_a", "proof_b"]
KEY_COLUMNS = ("pr", "stratum", "rep", "accepted_is_a")
# Paths that hold no mathematics, and words of code that runs at compile time.
NOT_MATHEMATICS = r"^(scripts|Cache|LongestPole|test|Shake|ImportGraph|Counterexamples|Archive)/|^\.github/|^lakefile|^Mathlib/(Tactic|Util|Lean|Mathport|Testing)/|/Linter/"
DO_WORD = r"(?<![A-Za-z_])do(?![A-Za-z_])"
MONADS = r"\b(MetaM|CommandElabM|TacticM|CoreM|TermElabM|SimpM|IO)\b|TSyntax|Syntax\b|Expr\b"


def metaprogram(code: Column) -> Column:
    return code.rlike(DO_WORD) & code.rlike(MONADS)


def first_failure(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule whose condition holds; null for survivors."""
    out = F
    for name, broken in rules:
        out = out.when(F.coalesce(broken, F.lit(False)), name)
    return out


# The reasons for which a candidate is left out, in the order in which they are looked at.
REASONS = (
    "not HIGH_VALUE", "signature_changed", "initial < 5 lines", "no explicit review feedback", "same-or-longer (not labelable from proof text)", "PR in the held-out-against set",
    "non-mathematical path", "declaration+file in the held-out-against set", "no parsing record", "identical once comments are stripped", "metaprogram code", "empty rejection_reasons",
)
MIN_INITIAL_LINES = 5


def reasons(min_initial_lines: int = MIN_INITIAL_LINES) -> list[str]:
    """REASONS, where the rule on initial lines names its bound."""
    return [f"initial < {min_initial_lines} lines" if r == REASONS[2] else r for r in REASONS]


def with_reasons(
    candidates: DataFrame, held_prs: DataFrame, held_pairs: DataFrame, proofs: DataFrame, summaries: DataFrame, proof_keys: list[str], summary_keys: list[str], min_initial_lines: int = MIN_INITIAL_LINES, require_shrinking: bool = True
) -> DataFrame:
    """candidates with `reason`: the first of REASONS that holds, null for the eligible.

    candidates: pr, declaration, file_path, verdict, signature_changed, has_feedback, initial_lines, ratio and the keys.
    held_prs: pr. held_pairs: declaration, file_path. proofs: proof_keys, same_code, final_code (once a proof, so that
    texts are read once and not for each candidate). Candidates that metadata rules leave out have null texts. summaries: summary_keys, summary. Missing names equal missing names.
    Without require_shrinking, proofs that got no shorter pass that rule.
    """
    known = candidates.join(held_prs.select("pr", F.lit(True).alias("pr_held")).distinct(), "pr", "left")
    known = null_safe_join(known, held_pairs.select("declaration", "file_path", F.lit(True).alias("pair_held")).distinct(), ["declaration", "file_path"])
    of_metadata = [
        F.col("verdict") != "HIGH_VALUE", F.col("signature_changed"), F.col("initial_lines") < min_initial_lines, ~F.col("has_feedback"), F.lit(require_shrinking) & (F.col("ratio") >= 1.0), F.col("pr_held"),
        F.col("file_path").rlike(NOT_MATHEMATICS), F.col("pair_held"),
    ]
    of_texts = [F.col("is_parsed").isNull(), F.col("same_code"), metaprogram(F.col("final_code")), F.coalesce(text.strip(F.col("summary")), F.lit("")) == ""]
    n = len(of_metadata)
    judged = known.withColumn("reason", first_failure(list(zip(reasons(min_initial_lines)[:n], of_metadata, strict=True)))).drop("pr_held", "pair_held")
    # Only what the metadata rules let through meets its texts.
    passed = judged.where("reason IS NULL").drop("reason")
    passed = passed.join(proofs.select(*proof_keys, "same_code", "final_code", F.lit(True).alias("is_parsed")), proof_keys, "left").join(summaries.select(*summary_keys, "summary"), summary_keys, "left")
    passed = passed.withColumn("reason", first_failure(list(zip(reasons()[n:], of_texts, strict=True)))).drop("is_parsed")
    return judged.where("reason IS NOT NULL").unionByName(passed, allowMissingColumns=True)


def tally(df: DataFrame, reason: str = "reason") -> DataFrame:
    return df.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def survivors_and_tally(reasoned: DataFrame, reason: str = "reason", min_initial_lines: int = MIN_INITIAL_LINES) -> tuple[DataFrame, DataFrame]:
    """The rows without a reason, written, and the tally of the others, from one pass.

    Reasons are counted by an observation on the rows as they are written: nothing is shuffled after it, so that a task
    that is run again counts once. Reasons that no row has are left out, as in tally().
    """
    spark, seen, names = reasoned.sparkSession, Observation(), reasons(min_initial_lines)
    counts = [F.count_if(F.col(reason) == r).alias(f"n{i}") for i, r in enumerate(names)]
    kept = written(reasoned.observe(seen, *counts).where(F.col(reason).isNull()), "survivors")
    found = [(r, seen.get[f"n{i}"]) for i, r in enumerate(names)]
    return kept, spark.createDataFrame([(r, n) for r, n in found if n], f"{reason} string, n long")


def round_robin_draw(pool: DataFrame, target: int, pr: str, year: str, order: list) -> DataFrame:
    """target rows, one per pr, taken from the years in turn, each year's best first.

    Only the best `target` rows of a year can be drawn, so Spark limits a year within every task before it ranks it.
    """
    return draw(best_of_each(pool, [pr], order), target, year, order)


def best_of_each(pool: DataFrame, keys: list[str], order: list) -> DataFrame:
    rest = [c for c in pool.columns if c not in keys]
    return pool.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def draw(best: DataFrame, target: int, year: str, order: list) -> DataFrame:
    """target rows, taken from the years in turn, each year's best first."""
    turn = F.row_number().over(Window.partitionBy(year).orderBy(*order))
    return best.withColumn("turn", turn).where(F.col("turn") <= target).orderBy("turn", year).limit(target)


def selection_summary(drawn: DataFrame, *by: str) -> DataFrame:
    """Rows, different records and the share of rows about interfaces."""
    return drawn.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("pr").alias("n_prs"), F.avg(F.col("is_api").cast("double")).alias("api_share"))


def blind_tasks(rows: DataFrame, prefix: str = "v") -> DataFrame:
    """Three tasks per row, each with the two proofs in one order: accepted first, last, and by a stable coin.

    rows is the drawn set (at most API_ROWS + OTHER_ROWS), so one task may number it.
    """
    place = F.row_number().over(Window.orderBy("pr", "declaration")) - 1
    each = rows.withColumn("place", place).withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(REPLICATES - 1))))
    first = F.when(F.col("rep") == 0, True).when(F.col("rep") == 1, False).otherwise(stable_bit(F.col("pr"), F.col("declaration")))
    task = F.format_string(f"{prefix[:1]}%04d", (REPLICATES * F.col("place") + F.col("rep")).cast("int"))
    return each.withColumn("accepted_is_a", first).select(
        task.alias("task_id"), "pr", "declaration", "file_path", "stratum", "rep", "accepted_is_a",
        F.when(F.col("accepted_is_a"), F.trim("final")).otherwise(F.trim("initial")).alias("proof_a"),
        F.when(F.col("accepted_is_a"), F.trim("initial")).otherwise(F.trim("final")).alias("proof_b"),
    )


def assert_blind(shown: DataFrame) -> DataFrame:
    """shown, unless it holds a column that a reader may not see; then it raises."""
    leaks = sorted(set(shown.columns) - set(TASK_COLUMNS))
    if leaks:
        raise ValueError(f"a task shows more than a reader may see: {', '.join(leaks)}")
    return shown


def reader_view(tasks: DataFrame, key: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    """tasks without the columns of the key; raises if others are left than a reader may see."""
    return assert_blind(tasks.drop(*key)).select(*TASK_COLUMNS)


def deal(tasks: DataFrame, readers: int = READERS) -> DataFrame:
    """Each replicate's tasks dealt in turn to its readers, strata one after the other."""
    turn = (F.row_number().over(Window.partitionBy("rep").orderBy("stratum", "task_id")) - 1) % readers
    return tasks.withColumn("batch", (F.col("rep") * readers + turn).cast("long"))


def repeated_in_batch(dealt: DataFrame) -> DataFrame:
    """Batches that hold a row twice; must be empty."""
    return dealt.groupBy("batch", "pr", "declaration").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def checked_deal(tasks: DataFrame, readers: int = READERS) -> DataFrame:
    """deal(), unless a batch would hold a row twice; then it raises. Tasks are few: three for each drawn row."""
    dealt = deal(tasks, readers)
    twice = repeated_in_batch(dealt).orderBy("batch", "pr").first()
    if twice:
        raise ValueError(f"batch {twice['batch']} holds {twice['declaration']} of {twice['pr']} {twice['n']} times")
    return dealt


def batch_outcomes(dealt: DataFrame, answered: DataFrame) -> DataFrame:
    """Each batch's tasks and how many were answered; a batch without an answer has failed."""
    j = dealt.join(answered.select("task_id", F.lit(1).alias("answered")).distinct(), "task_id", "left")
    counts = j.groupBy("batch").agg(F.count(F.lit(1)).alias("n_tasks"), F.count("answered").alias("n_answered"))
    return counts.withColumn("ok", F.col("n_answered") > 0)


def missing_verdicts(verdicts: DataFrame, tasks: DataFrame) -> DataFrame:
    return tasks.join(verdicts.select("task_id").distinct(), "task_id", "left_anti")


def with_strata(rows: DataFrame, strata: DataFrame, keys: list[str]) -> DataFrame:
    """rows with their stratum, or "-" where none is known."""
    return null_safe_join(rows, strata.select(*keys, "stratum").distinct(), keys).withColumn("stratum", F.coalesce("stratum", F.lit("-")))


def anchors(rows: DataFrame, by_name: DataFrame, by_request: DataFrame, order: list) -> DataFrame:
    """Known cases among rows(pr, declaration, ...): the last row of each declaration of by_name(declaration, expected), and
    the first of each (pr, declaration) of by_request. Both lists are short."""
    named = last_wins(rows.join(by_name.select("declaration").distinct(), "declaration", "left_semi"), ["declaration"], order).join(by_name, "declaration")
    asked = first_wins(rows.join(by_request.select("pr", "declaration").distinct(), ["pr", "declaration"], "left_semi"), ["pr", "declaration"], order).join(by_request, ["pr", "declaration"])
    return named.unionByName(asked)


def pick(verdict: Column, accepted_is_a: Column) -> Column:
    return F.when(verdict == "comparable", "comparable").when((verdict == "A") == accepted_is_a, "accepted").otherwise("initial")


def decoded(verdicts: DataFrame, tasks: DataFrame) -> DataFrame:
    """Picks per row: how many readers chose the accepted, the initial, neither; and the majority, or split."""
    joined = tasks.select("task_id", "pr", "declaration", "stratum", "accepted_is_a").join(verdicts.select("task_id", "verdict"), "task_id")
    p = pick(F.col("verdict"), F.col("accepted_is_a"))
    n = lambda what: F.count_if(p == what).alias(f"n_{what}")
    counts = joined.groupBy("pr", "declaration", "stratum").agg(n("accepted"), n("initial"), n("comparable"), F.count(F.lit(1)).alias("n_picks"))
    most = F.greatest("n_accepted", "n_initial", "n_comparable")
    label = F.when(most < 2, "split").when(F.col("n_accepted") == most, "accepted").when(F.col("n_initial") == most, "initial").otherwise("comparable")
    return counts.withColumn("majority", label)


def failure_kind(picks: DataFrame) -> Column:
    return (
        F.when(picks.majority == "accepted", None)
        .when(picks.n_initial == picks.n_picks, "unanimous initial")
        .when(picks.n_comparable == picks.n_picks, "unanimous comparable")
        .when(picks.majority == "split", "three-way split")
        .otherwise("majority against")
    )


def support(picks: DataFrame, by: list[str]) -> DataFrame:
    """n, supported, rate, its normal-approximation half width in points, and rows whose readers all agreed."""
    agreed = F.greatest("n_accepted", "n_initial", "n_comparable") == F.col("n_picks")
    sums = picks.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("majority") == "accepted").alias("supported"), F.count_if(agreed).alias("unanimous"), F.count_if(F.col("majority") == "split").alias("splits"))
    p = F.col("supported") / F.col("n")
    return sums.withColumn("rate", p).withColumn("half_width", 1.96 * F.sqrt(p * (1 - p) / F.col("n")) * 100)


def position_bias(verdicts: DataFrame) -> DataFrame:
    """Share of A among the verdicts that took a side; NaN if none did."""
    a, b = F.count_if(F.col("verdict") == "A"), F.count_if(F.col("verdict") == "B")
    return verdicts.agg(a.alias("chose_a"), b.alias("chose_b"), F.when(a + b > 0, a / (a + b)).otherwise(F.lit(float("nan"))).alias("bias"))
