"""Verdict algebra: labels and states as expressions over recorded grader runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the data contract.
VERDICTS = ("FAILED", "TIMEOUT", "FLAKY", "SURVIVED")
OUTCOMES = ("FIXED", "GREEN-BEFORE", "STILL-RED", "NO-GRADER-YET", "UNRUNNABLE")
SCORES = ("SOLVED", "MISSED", "MALFORMED", "CHEATED", "BAD-ROW")
DEADLINE_FLOOR_MS, DEADLINE_FACTOR = 3000, 20


def run_class(exit_code: Column, elapsed_ms: Column) -> Column:
    return F.when(exit_code.isin(124, 137), "timed_out").when(exit_code.isin(126, 127) & (elapsed_ms < 2000), "not_exec").when(exit_code == 0, "ok").otherwise("failed")


def deadline_ms(baseline_ms: Column) -> Column:
    return F.greatest(F.lit(DEADLINE_FLOOR_MS), F.coalesce(baseline_ms * DEADLINE_FACTOR, F.lit(DEADLINE_FLOOR_MS)))


def deadline_seconds(ms: Column) -> Column:
    return F.greatest(F.ceil(ms / 1000.0), F.lit(1)).cast("bigint")


def grade(runs: DataFrame, subject: str = "subject_id") -> DataFrame:
    """(subject, verdict, suite): the first run by ord that is not ok decides; later ones don't count. Runs need ord,
    grader and class; one grouped minimum, combined before the shuffle."""
    red = F.min(F.when(F.col("class") != "ok", F.struct("ord", "class", "grader"))).alias("red")
    out = runs.groupBy(subject).agg(red)
    verdict = F.when(F.col("red").isNull(), "SURVIVED").when(F.col("red.class") == "timed_out", "TIMEOUT").when(F.col("red.class") == "not_exec", "ABORTED").otherwise("FAILED")
    return out.select(subject, verdict.alias("verdict"), F.col("red.grader").alias("suite"))


def confirmed(verdict: Column, confirm_class: Column) -> Column:
    """After the accusing suite ran again on the clean tree: null where it had no second run."""
    red = verdict.isin("FAILED", "TIMEOUT")
    return F.when(red & (confirm_class == "not_exec"), "ABORTED").when(red & confirm_class.isNotNull() & (confirm_class != "ok"), "FLAKY").otherwise(verdict)


def killed(verdict: Column) -> Column:
    return verdict.isin("FAILED", "TIMEOUT")


def history_outcome(has_grader: Column, runnable: Column, parent_red: Column, commit_ok: Column) -> Column:
    return F.when(~runnable, "UNRUNNABLE").when(~has_grader, "NO-GRADER-YET").when(~parent_red, "GREEN-BEFORE").when(commit_ok, "FIXED").otherwise("STILL-RED")


def score(row_ok: Column, reproduced: Column, reply_error: Column, within: Column, applied: Column, red_after: Column) -> Column:
    """Row first, then reply, contract, patch and suites: the first that fails names the score."""
    return (
        F.when(~row_ok, "MALFORMED").when(~reproduced, "BAD-ROW").when(reply_error.isNotNull(), "MALFORMED")
        .when(~within, "CHEATED").when(~applied, "MALFORMED").when(red_after, "MISSED").otherwise("SOLVED")
    )


def rate(hits: Column, total: Column) -> Column:
    """Percent, 0 of nothing."""
    return F.coalesce(hits * 100.0 / F.nullif(total, F.lit(0)), F.lit(0.0))
