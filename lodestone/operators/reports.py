"""Reports over trials, replays and scores: grouped rates and zero-filled distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions import verdicts as V

#: Operator, what it does to a source.
OPERATORS = (
    ("augassign_flip", "turns an augmented assignment round"),
    ("await_drop", "drops an await"),
    ("boolop_swap", "swaps and with or"),
    ("compare_flip", "moves a comparison by its boundary"),
    ("condition_negate", "negates a condition"),
    ("constant_perturb", "changes a constant"),
    ("except_swallow", "empties an exception handler"),
    ("guard_drop", "removes an early exit"),
    ("off_by_one", "adds one to an integer"),
    ("return_none", "returns nothing"),
)


def severity(operator):
    """All ten operators fail silently; any other is loud."""
    return F.when(operator.isin(*[o for o, _ in OPERATORS]), "silent").otherwise("loud")


def by_operator(trials: DataFrame) -> DataFrame:
    """operator, killed, flaky, total, pct, bar."""
    t = trials.groupBy("operator").agg(F.count_if(V.killed(F.col("verdict"))).alias("killed"), F.count_if(F.col("verdict") == "FLAKY").alias("flaky"), F.count("*").alias("total"))
    return t.withColumn("pct", V.rate(F.col("killed"), F.col("total"))).withColumn("bar", F.repeat(F.lit("#"), F.round(F.col("pct") / 5).cast("int"))).orderBy("operator")


def distribution(rows: DataFrame, label: str, labels: tuple[str, ...]) -> DataFrame:
    """label, n, pct for every label, absent ones with 0; the denominator is 1 at least."""
    counted = rows.groupBy(label).agg(F.count("*").alias("n"))
    every = rows.sparkSession.createDataFrame([(x, i) for i, x in enumerate(labels)], f"{label} string, ord int")
    out = every.join(counted, label, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.greatest(F.sum("n").over(Window.partitionBy()), F.lit(1))
    return out.select(label, "ord", "n", (F.col("n") * 100.0 / total).alias("pct"))


def silent_survivors(trials: DataFrame, limit: int = 25) -> DataFrame:
    """Trials that survived (flaky ones apart) by silent operators, in file and line order."""
    return trials.where((F.col("verdict") == "SURVIVED") & (F.col("severity") == "silent")).orderBy("file", "line", "id").limit(limit)
