"""Live verdicts: windowed counts of a stream of grader runs. An extension; the batch queries don't need it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed(runs: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Per event-time window, operator and verdict the number of runs (ts, id, operator, verdict); repeated ids within the
    watermark count once. Works on streams and tables alike."""
    once = runs.withWatermark("ts", late)
    once = once.dropDuplicatesWithinWatermark(["id"]) if runs.isStreaming else once.dropDuplicates(["id"])
    return once.groupBy(F.window("ts", length), "operator", "verdict").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "operator", "verdict", "n")
