"""Training rows as column expressions: prompts, completions, ids and provenance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import text as T

#: The parts of a prompt.
REPOSITORY, COMMIT = "Repository: ", "\nCommit: "
FAILING = ("\n\nThe test suite `", "` is failing.\n\n── what the suite reported ──\n")
POINTS = ("\n\n── the file it points into: ", " ──\n")
REPAIR_ONE = "\nFind the defect and repair it. Reply with ONLY a unified diff inside a sentinel block:\n\n"
REPAIR_TWO = "\nThere are TWO defects in this file. The failing output above may only point at one of them. Repair both. Reply with ONLY a unified diff inside a sentinel block:\n\n"
FORM = "<<<PATCH>>>\n--- a/<path>\n+++ b/<path>\n@@ ... @@\n...\n<<<END>>>\n"
HUNG = (
    "The suite did not terminate. It was killed after ",
    " ms against a healthy baseline far below that, so the defect is a hang — most likely a loop whose exit condition is now unreachable — rather than a failed assertion.",
)
GAP = "\n        ⋮\n"
#: Radii of excerpts, and how far apart two sites may be to share one.
RADIUS, PAIR_RADIUS, PAIR_SPAN = 14, 8, 24


def hang_story(limit_ms: Column) -> Column:
    return F.concat(F.lit(HUNG[0]), limit_ms.cast("string"), F.lit(HUNG[1]))


def report(verdict: Column, tail: Column, limit_ms: Column, work: str, repo: str) -> Column:
    """What a suite said, as a prompt shows it: the failure alone, without the worker's paths."""
    told = F.when(verdict == "TIMEOUT", hang_story(limit_ms)).otherwise(tail)
    return F.regexp_replace(T.focus_failure(T.strip_worktree(told, work, repo)), r"(?U)^\s+|\s+$", "")


def _prompt(repo: str, commit: Column, suite: Column, said: Column, path: Column, body: Column, ask: str) -> Column:
    return F.concat(
        F.lit(REPOSITORY + repo + COMMIT), F.left(commit, F.lit(9)), F.lit(FAILING[0]), suite, F.lit(FAILING[1]), said,
        F.lit(POINTS[0]), path, F.lit(POINTS[1]), body, F.lit(ask + FORM),
    )


def prompt(repo: str, commit: Column, suite: Column, said: Column, path: Column, broken: Column, line: Column) -> Column:
    """The prompt of one defect: the suite's report and the broken file around the line."""
    return _prompt(repo, commit, suite, said, path, T.excerpt(broken, line, RADIUS), REPAIR_ONE)


def pair_prompt(repo: str, commit: Column, suite: Column, said: Column, path: Column, broken: Column, line_a: Column, line_b: Column) -> Column:
    """The prompt of two defects: one excerpt where they are near, else one of each."""
    lo, hi = F.least(line_a, line_b), F.greatest(line_a, line_b)
    half = lambda x: F.floor(x / 2).cast("int")
    near = T.excerpt(broken, half(lo + hi), half(hi - lo) + PAIR_RADIUS)
    far = F.concat(T.excerpt(broken, lo, PAIR_RADIUS), F.lit(GAP), T.excerpt(broken, hi, PAIR_RADIUS))
    return _prompt(repo, commit, suite, said, path, F.when(hi - lo <= PAIR_SPAN, near).otherwise(far), REPAIR_TWO)


def history_id(sha: Column, path: Column) -> Column:
    return F.concat(F.lit("hist:"), F.left(sha, F.lit(12)), F.lit(":"), path)


def pair_id(path: Column, line_a: Column, line_b: Column) -> Column:
    return F.concat_ws(":", F.lit("pair"), path, F.least(line_a, line_b), F.greatest(line_a, line_b))


def provenance(**sources: Column) -> Column:
    """``caused_by``: the kinds and names that a row goes back to, in order; a kind may be given as kind_1, kind_2."""
    return F.array(*[F.concat(F.lit(kind.split("_")[0] + ":"), name) for kind, name in sources.items()])
