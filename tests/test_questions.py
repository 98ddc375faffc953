"""Canonical forms of queries, and which prompts count."""

import json

import pytest
from pyspark.sql import functions as F

from lodestone.operators import questions

ROW = "nql string, asked string, answered string, domain string, coll string, clauses array<string>, teacher_model string"


@pytest.mark.parametrize("text,form", [
    ("from a", "FROM a"), ("  FROM  a.b  Limit 010 ", "FROM a.b LIMIT 10"), ("from a where x='it and that' AND y!=TRUE and z<=-1.50", 'FROM a WHERE x = "it and that" AND y != true AND z <= -1.5'),
    ("FROM a AS OF 5 VALID AS OF 2026-01-02 SEARCH 'q r' ORDER BY f desc TRAVERSE r LIMIT 0", 'FROM a AS OF 5 VALID AS OF "2026-01-02" SEARCH "q r" ORDER BY f DESC TRAVERSE r LIMIT 0'),
    ("FROM a ORDER BY b", "FROM a ORDER BY b ASC"), ("FROM a WHERE x = null", "FROM a WHERE x = null"),
    ("", None), ("FROM", None), ("FROM a LIMIT", None), ("FROM a LIMIT 5 WHERE x = 1", None), ("FROM a WHERE x = nullable", None), ("FROM a WHERE x = 1 OR y = 2", None), ("FROM a; DROP b", None), (None, None),
])
def test_canonical(spark, text, form):
    got = spark.createDataFrame([(text,)], "q string").select(questions.canonical(F.col("q")).alias("f")).first().f
    assert got == form
    if form:  # a form is its own form
        assert spark.createDataFrame([(form,)], "q string").select(questions.canonical(F.col("q")).alias("f")).first().f == form


def test_outcomes_and_lines(spark, tmp_path):
    rows = [("FROM a LIMIT 5", "1. show five\n2. a few of a\n", "2. from a limit 5;\n1. FROM a LIMIT 6", "d", "a", ["limit"], "m"), ("FROM b", "Sure:\n", "1. FROM b", "d", "b", [], "m"), ("FROM c", "1. all of c\n", None, "d", "c", [], "m"), ("FROM a LIMIT 5", "- give me a\n", "no idea", "d", "a", ["limit"], "m")]
    made = questions.offered(spark.createDataFrame(rows, ROW), 8)
    assert sorted((r.nql, r.prompt or "", r.outcome) for r in made.collect()) == [("FROM a LIMIT 5", "a few of a", "verified"), ("FROM a LIMIT 5", "give me a", "unparseable"), ("FROM a LIMIT 5", "show five", "mismatch"), ("FROM b", "", "teacher_error"), ("FROM c", "", "teacher_error")]
    t = questions.tally(made).first()
    assert (t.plans, t.offered, t.verified, t.mismatch, t.unparseable, t.teacher_errors) == (3, 3, 1, 1, 1, 2) and abs(t.rate - 1 / 3) < 1e-9
    assert questions.tally(made.limit(0)).first().rate == 0
    questions.write_pairs(questions.pair_lines(made), f"file://{tmp_path}/p")
    (line,) = [json.loads(r.value) for r in spark.read.text(f"file://{tmp_path}/p").collect()]
    assert set(line) == set(questions.PAIR) and line["reasoning"] is None and line["nql"] == "FROM a LIMIT 5" and line["prompt"] == "a few of a"
