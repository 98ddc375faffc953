"""Execution-gated corpus analytics on Spark: every verdict is an expression over recorded test runs."""
