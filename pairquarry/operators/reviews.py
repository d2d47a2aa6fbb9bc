"""Review records: normalisers, predicates and per-record aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairquarry.functions import text

# Logins of bots, the merge bot's title prefix, and paths of infrastructure.
BOT_LOGINS = ("github-actions[bot]", "mathlib-bors[bot]", "mathlib-merge-conflicts[bot]", "leanprover-bot")
MERGED_PREFIX = "[Merged by Bors] - "
INFRASTRUCTURE = (
    "scripts/", ".github/", "test/", "lakefile", "lean-toolchain", "lake-manifest",
    "Cache/", "LongestPole/", "Shake/", "ImportGraph/",
    "Mathlib/Tactic/", "Mathlib/Util/", "Mathlib/Lean/", "Mathlib/Mathport/", "Mathlib/Testing/",
)
CATEGORIES = ("tactic_hygiene", "generality", "proof_structure", "readability", "naming", "performance", "simp_lemmas", "api_design", "other")
GHOST = "ghost"


def is_bot(login: Column) -> Column:
    return login.isin(*BOT_LOGINS) | login.endswith("[bot]")


def login_or_ghost(*logins: Column) -> Column:
    return F.coalesce(*logins, F.lit(GHOST))


def merge_status(title: Column, state: Column, merged: Column) -> Column:
    return F.when(merged, "github_merged").when(F.upper(state) == "OPEN", "open").when(title.startswith(MERGED_PREFIX), "merged_by_bors").otherwise("closed_not_merged")


def plain_title(title: Column) -> Column:
    return text.without_prefix(title, MERGED_PREFIX)


def is_source(path: Column) -> Column:
    return path.endswith(".lean")


def is_infrastructure(path: Column) -> Column:
    out = F.lit(False)
    for prefix in INFRASTRUCTURE:
        out = out | path.startswith(prefix)
    return out


def coerced_categories(categories: Column) -> Column:
    """Unknown categories become other; repeats stay."""
    return F.transform(categories, lambda c: F.when(c.isin(*CATEGORIES), c).otherwise("other"))


def coerced_verdict(verdict: Column) -> Column:
    return F.when(verdict.isin("HIGH_VALUE", "LOW_VALUE", "CONTEXTUAL"), verdict).otherwise("LOW_VALUE")


def present(content: Column) -> Column:
    """A file's content; an empty one counts as missing."""
    return F.when(content != "", content)


def has_review_activity(n_reviews: Column, n_threads: Column) -> Column:
    return (n_reviews >= 1) | (n_threads >= 1)


def is_api(categories: Column) -> Column:
    """Whether a label is about the design of an interface; false without categories."""
    return F.coalesce(F.array_contains(categories, "api_design"), F.lit(False))


def titled(rows, titles, key: str, order: list):
    """rows with their record's last title, or "PR #n" for records without one."""
    last = titles.groupBy(key).agg(F.max_by("title", F.struct(*order)).alias("title"))
    return rows.join(last, key, "left").withColumn("title", F.coalesce("title", F.concat(F.lit("PR #"), F.col(key).cast("string"))))


def comments_on_pairs(comments, pairs):
    """comments(pr, path, diff_hunk, ...) by the pairs(pr, path, declaration) of their file: priority 1 if the hunk names
    the declaration, 2 if it doesn't or if there is no name. Each comment by each pair: where only what fits a budget is wanted, see
    contexts.reachable_comments."""
    named = F.contains("diff_hunk", "declaration") & (F.col("declaration") != "")
    return comments.join(pairs, ["pr", "path"]).withColumn("priority", F.when(named, 1).otherwise(2))


def noise(body: Column) -> Column:
    """Merge commands and remarks of under 20 characters."""
    b = text.strip(body)
    return b.startswith("bors") | (F.length(b) < 20)


def inline_text(author: Column, path: Column, position: Column, body: Column) -> Column:
    where = F.concat(path, F.coalesce(F.concat(F.lit(":"), position.cast("string")), F.lit("")))
    return F.concat(F.lit("[Inline comment by @"), author, F.lit(" on "), where, F.lit("] "), text.strip(body))


def wall_micros(at: Column) -> Column:
    """Microseconds of a wall-clock time since 1970, whatever the session's zone."""
    seconds = (F.unix_date(F.to_date(at)).cast("long") * 24 + F.hour(at)) * 3600 + F.minute(at) * 60
    return seconds.cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")


def days_between(start: Column, end: Column) -> Column:
    """Days as a double, unrounded; 0 while open."""
    return F.coalesce((wall_micros(end) - wall_micros(start)) / 86400e6, F.lit(0.0))


def decoded_content(content: Column, encoding: Column) -> Column:
    """Base64 content as text; null unless it is base64 and not empty."""
    return F.when((encoding == "base64") & (content != ""), F.decode(F.unbase64(content), "UTF-8"))
