"""Queries on questions: conversations stand for a teacher's replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import questions
from lodestone.plans import adapters as A
from lodestone.plans.registry import query

#: What a teacher answers to the question for a plan, by place of the prompt and kind of conversation: (text, outcome).
_SAID = (
    ("FROM t{n} WHERE a > 7 AND b = \"x\" ORDER BY c LIMIT 5", "verified"), ("from  t{n}  where a>07.0 and b='x' order  by c asc limit 05", "verified"), ("FROM t{n} WHERE b = \"x\" AND a > 7 ORDER BY c LIMIT 5", "mismatch"),
    ("FROM t{n} WHERE a >= 7 AND b = \"x\" ORDER BY c LIMIT 5", "mismatch"), ("SELECT * FROM t{n}", "unparseable"), ("FROM t{n} WHERE a > 7 AND b = \"x\" ORDER BY c DESC LIMIT 5", "mismatch"), ("FROM t{n} WHERE a >", "unparseable"),
)
_K = len(_SAID)


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three prompts a turn, answered by number; turns of every fifth conversation have no prompts, or no answers."""
    c = A.table(spark, sf_dir, "conversations").where("role = 'assistant'")
    n = F.col("turn").cast("string")
    said = lambda i: F.replace(F.element_at(F.array(*[F.lit(x) for x, _ in _SAID]), ((F.col("conv_id") + F.col("turn") + i) % _K + 1).cast("int")), F.lit("{n}"), n)
    kind = F.col("conv_id") % 10
    asked = F.when(kind == 3, F.lit("Here are three:\nok\n")).otherwise(F.concat(F.lit("Sure:\n1. show me t"), n, F.lit("\n2. list them\n- \"all of it, sorted\"\n")))
    answered = F.when(kind != 8, F.concat(F.lit("3. `"), said(2), F.lit("`\n1) "), said(0), F.lit(";\n2. "), said(1)))
    nql = F.concat(F.lit("FROM t"), n, F.lit(" WHERE a > 7 AND b = 'x' ORDER BY c LIMIT 5"))
    return c.select("conv_id", "turn", nql.alias("nql"), asked.alias("asked"), answered.alias("answered"), F.lit("d").alias("domain"), F.concat(F.lit("t"), n).alias("coll"), F.array(F.lit("where"), F.lit("limit")).alias("clauses"), F.lit("m").alias("teacher_model"))


_LIST = "[" + ", ".join(f"'{o}'" for _, o in _SAID) + "]"
_OFFERED = f"""c AS (SELECT conv_id, turn, conv_id % 10 AS kind FROM conversations WHERE role = 'assistant'),
o AS (SELECT conv_id, turn, CAST(p AS INTEGER) AS place, list_extract({_LIST}, (conv_id + turn + p - 1) % {_K} + 1) AS outcome FROM c, (VALUES (1), (2), (3)) AS v(p) WHERE kind NOT IN (3, 8)
 UNION ALL SELECT conv_id, turn, NULL, 'teacher_error' FROM c WHERE kind IN (3, 8))"""


@query(f"WITH {_OFFERED} SELECT conv_id, turn, place, outcome, 'FROM t' || turn || ' WHERE a > 7 AND b = \"x\" ORDER BY c ASC LIMIT 5' AS plan FROM o")
def question_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which prompts lead back to their plan, which to another, and which to none."""
    return questions.offered(_replies(spark, sf_dir), 3).select("conv_id", "turn", "place", "outcome", "plan")


@query(f"""WITH {_OFFERED}, n AS (SELECT count(DISTINCT turn) AS plans, count(*) FILTER (outcome <> 'teacher_error') AS offered, count(*) FILTER (outcome = 'verified') AS verified, count(*) FILTER (outcome = 'mismatch') AS mismatch,
 count(*) FILTER (outcome = 'unparseable') AS unparseable, count(*) FILTER (outcome = 'teacher_error') AS teacher_errors FROM o) SELECT *, verified / greatest(offered, 1) AS rate FROM n""")
def question_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.tally(questions.offered(_replies(spark, sf_dir), 3))


@query(f"""WITH {_OFFERED} SELECT CASE place WHEN 1 THEN 'show me t' || turn WHEN 2 THEN 'list them' ELSE 'all of it, sorted' END AS prompt, 'FROM t' || turn || ' WHERE a > 7 AND b = ''x'' ORDER BY c LIMIT 5' AS nql,
 't' || turn AS coll, 'where,limit' AS clauses, 'teacher' AS source, count(*) AS n FROM o WHERE outcome = 'verified' GROUP BY ALL""")
def question_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified prompts with the plan's own query, however the answer was written."""
    rows = questions.pair_lines(questions.offered(_replies(spark, sf_dir), 3))
    return rows.groupBy("prompt", "nql", "coll", F.array_join("clauses", ",").alias("clauses"), "source").agg(F.count("*").alias("n"))
