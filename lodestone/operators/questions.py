"""Questions for queries: which phrasings of a query lead back to it. The query language isn't parsed into a tree or run; a query has a canonical form, a
text, and two queries are the same plan when their forms are equal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as T

_NAME = r"[A-Za-z_][A-Za-z0-9_.]*"
_QUOTED = r"\"[^\"]*\"|'[^']*'"
_VALUE = rf"(?:-?[0-9]+(?:\.[0-9]+)?|{_QUOTED}|(?:true|false|null)\b)"
_OPERATOR = r"(?:!=|<=|>=|=|<|>)"
_CONDITION = rf"{_NAME}\s*{_OPERATOR}\s*{_VALUE}"
#: The clauses of a query, in their only order; each group is what the clause holds.
_QUERY = (
    rf"(?is)^\s*from\s+({_NAME})(?:\s+as\s+of\s+([0-9]+))?(?:\s+valid\s+as\s+of\s+({_QUOTED}|[0-9][0-9-]*))?(?:\s+where\s+({_CONDITION}(?:\s+and\s+{_CONDITION})*))?"
    rf"(?:\s+search\s+({_QUOTED}))?(?:\s+order\s+by\s+({_NAME})(?:\s+(asc|desc))?)?(?:\s+traverse\s+({_NAME}))?(?:\s+limit\s+([0-9]+))?\s*$"
)
PAIR = ("prompt", "nql", "plan", "domain", "coll", "clauses", "source", "teacher_model", "reasoning")


def _value(text: Column) -> Column:
    """Quotes are double ones, numbers without idle zeros, words in small letters."""
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    number = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"^(-?)0+(?=[0-9])", "$1"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(F.rlike(text, F.lit("^[\"']")), F.concat(F.lit('"'), inner, F.lit('"'))).when(F.rlike(text, F.lit("^[-0-9]")), number).otherwise(F.lower(text))


def canonical(query: Column) -> Column:
    """The form of a query: keywords in capitals, one space between words, conditions in their order, ASC where no direction is given; null for a
    text that is no query."""
    group = lambda i: F.nullif(F.regexp_extract(query, _QUERY, i), F.lit(""))
    each = lambda i: F.regexp_extract_all(group(4), F.lit(rf"(?is)({_NAME})\s*({_OPERATOR})\s*({_VALUE})"), F.lit(i))
    conditions = F.zip_with(F.zip_with(each(1), each(2), lambda a, b: F.concat_ws(" ", a, b)), each(3), lambda a, b: F.concat_ws(" ", a, _value(b)))
    clause = lambda word, x: F.concat(F.lit(word + " "), x)
    form = F.concat_ws(
        " ", clause("FROM", group(1)), clause("AS OF", _value(group(2))), clause("VALID AS OF", F.when(F.rlike(group(3), F.lit("^[0-9]")), F.concat(F.lit('"'), group(3), F.lit('"'))).otherwise(_value(group(3)))),
        clause("WHERE", F.array_join(conditions, " AND ")), clause("SEARCH", _value(group(5))), F.concat(clause("ORDER BY", group(6)), F.lit(" "), F.coalesce(F.upper(group(7)), F.lit("ASC"))), clause("TRAVERSE", group(8)), clause("LIMIT", _value(group(9))),
    )
    return F.when(F.rlike(query, F.lit(_QUERY)), form)


def check(answer: Column, plan: Column) -> Column:
    """verified where the answer is the plan, mismatch where it is another query, unparseable where it is none."""
    own = canonical(answer)
    return F.when(own.isNull(), "unparseable").when(own == plan, "verified").otherwise("mismatch")


def offered(replies: DataFrame, variants: int) -> DataFrame:
    """A row per prompt of replies (nql, asked: the text with prompts, answered: the text with queries, and more): place, prompt, answer, plan and outcome. A
    reply without prompts, or without a text of answers, gives one row with the outcome teacher_error."""
    r = replies.withColumn("prompts", T.clean_prompts(F.coalesce("asked", F.lit("")), variants))
    lost = (F.size("prompts") == 0) | F.col("answered").isNull()
    good = r.where(~lost).withColumn("answers", T.match_answers(F.col("answered"), F.size("prompts")))
    good = good.withColumn("x", F.explode(F.zip_with(F.zip_with("prompts", "answers", lambda p, a: F.struct(p.alias("p"), a.alias("a"))), F.sequence(F.lit(1), F.size("prompts")), lambda x, i: F.struct(i.alias("place"), x["p"].alias("prompt"), x["a"].alias("answer")))))
    good = good.select(*replies.columns, "x.*").withColumn("plan", canonical(F.col("nql")))
    good = good.withColumn("outcome", check(F.col("answer"), F.col("plan")))
    bad = r.where(lost).select(*replies.columns, F.lit(None).cast("int").alias("place"), F.lit(None).cast("string").alias("prompt"), F.lit(None).cast("string").alias("answer"), canonical(F.col("nql")).alias("plan"), F.lit("teacher_error").alias("outcome"))
    return good.unionByName(bad)


def tally(prompts: DataFrame) -> DataFrame:
    """One row: plans, offered, verified, mismatch, unparseable, teacher_errors, rate (0 of nothing)."""
    n = lambda o: F.count_if(F.col("outcome") == o)
    offers = F.count_if(F.col("outcome") != "teacher_error")
    out = prompts.agg(F.countDistinct("nql").alias("plans"), offers.alias("offered"), *[n(o).alias(o) for o in ("verified", "mismatch", "unparseable")], n("teacher_error").alias("teacher_errors"))
    return out.withColumn("rate", F.when(F.col("offered") > 0, F.col("verified") / F.col("offered")).otherwise(F.lit(0.0)))


def pair_lines(prompts: DataFrame) -> DataFrame:
    """The verified prompts (with domain, coll, clauses, teacher_model) as rows to train on: the query is the plan's own text, never the answer's."""
    good = prompts.where("outcome = 'verified'").withColumns({"source": F.lit("teacher"), "reasoning": F.lit(None).cast("string")})
    return good.select(*PAIR)


def write_pairs(rows: DataFrame, path: str) -> None:
    """JSON Lines with all keys, nulls kept."""
    rows.select(*PAIR).write.mode("overwrite").option("ignoreNullFields", False).json(path)
