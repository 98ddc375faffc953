"""What must hold before a run counts: a green baseline, graders that exist, an oracle that solves every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.functions import verdicts as V

#: Replies of the responders that test the scoring itself.
NULL_REPLY = "I could not determine the defect."
CHEAT_DIFF = "\n@@ -1,3 +1,3 @@\n-import sys\n+import sys  # neutered\n"


def baseline(runs: DataFrame) -> DataFrame:
    """(grader, ms, deadline_ms, state) of the baseline's runs (grader, ord, exit_code, elapsed_ms): each grader's last run."""
    last = runs.groupBy("grader").agg(F.max_by(F.struct("exit_code", "elapsed_ms"), "ord").alias("r"))
    return last.select("grader", F.col("r.elapsed_ms").alias("ms"), V.deadline_ms(F.col("r.elapsed_ms")).alias("deadline_ms"), V.run_class(F.col("r.exit_code"), F.col("r.elapsed_ms")).alias("state"))


def baseline_verdict(measured: DataFrame) -> DataFrame:
    """One row (passed, not_executable, red, total_ms): graders that can't be executed come first, since they say nothing of
    the code; red lists all others that aren't green, by name, with why. Graders are configuration, so the lists are short."""
    names = lambda state, shown: F.array_sort(F.collect_list(F.when(state, shown)))
    missing, red = F.col("state") == "not_exec", F.col("state").isin("failed", "timed_out")
    why = F.concat("grader", F.when(F.col("state") == "timed_out", " (timed out)").otherwise(" (tests failed)"))
    out = measured.agg(names(missing, F.col("grader")).alias("not_executable"), names(red, why).alias("red"), F.coalesce(F.sum("ms"), F.lit(0)).alias("total_ms"))
    return out.select(((F.size("not_executable") == 0) & (F.size("red") == 0)).alias("passed"), "not_executable", "red", "total_ms")


def require_green(measured: DataFrame) -> None:
    """Refuses to go on, by name, unless the baseline passed."""
    v = baseline_verdict(measured).first()
    if v.not_executable:
        raise RuntimeError(f"graders that could not be executed: {', '.join(v.not_executable)}; check PATH and the toolchain, not the code")
    if v.red:
        raise RuntimeError(f"the grader is not green on an unmutated tree: {', '.join(v.red)}")


def usable_graders(graders: DataFrame, parallel: bool, existing: DataFrame | None = None) -> DataFrame:
    """Graders (name, hermetic, ...) of a run: with several workers only hermetic ones; with ``existing`` (name), those that the tree has."""
    some = graders.where("hermetic") if parallel else graders
    return some if existing is None else some.join(F.broadcast(existing.select("name").distinct()), "name", "left_semi")


def respond(rows: DataFrame, kind: str, test_path: str = "tests/test_all.py") -> DataFrame:
    """``rows`` with a reply by a responder that tests the scoring: oracle (the completion), null (no patch) or cheat (edits a test)."""
    replies: dict[str, Column] = {
        "oracle": F.col("completion"), "null": F.lit(NULL_REPLY),
        "cheat": F.lit(f"{T.PATCH_OPEN}\n--- a/{test_path}\n+++ b/{test_path}{CHEAT_DIFF}{T.PATCH_CLOSE}\n"),
    }
    return rows.withColumn("reply", replies[kind])


def require_oracle(scores: DataFrame) -> None:
    """Refuses a scoreboard whose oracle missed a row, or that has none."""
    n = scores.agg(F.count("*").alias("n"), F.count_if(F.col("score") == "SOLVED").alias("solved")).first()
    if not n.n:
        raise RuntimeError("zero rows were scored")
    if n.solved < n.n:
        raise RuntimeError(f"the oracle solved {n.solved} of {n.n} rows: the scoring, not the replies, is at fault")
