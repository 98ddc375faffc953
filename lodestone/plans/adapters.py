"""The test tables seen as trials, grader runs, commits and replies, for Spark and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.operators.reports import OPERATORS, severity

_NAMES = [o for o, _ in OPERATORS]
_SQL_NAMES = ", ".join(f"'{o}'" for o in _NAMES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    kind = F.when(F.col("event_type") == "click", "FAILED").when(F.col("event_type") == "error", "TIMEOUT").when(F.col("event_type") == "purchase", "FLAKY").otherwise("SURVIVED")
    op = F.element_at(F.array(*map(F.lit, _NAMES)), F.col("k") % 10 + 1)
    start = F.col("event_id") % 997
    return e.select(
        F.col("event_id").alias("id"), F.concat(F.lit("u"), F.col("user_id")).alias("file"), op.alias("operator"), kind.alias("verdict"), F.col("k").cast("bigint").alias("line"),
        severity(op).alias("severity"), (F.col("k") % 3).cast("string").alias("scope"), start.alias("start_byte"), (start + F.col("k") % 7 + 1).alias("end_byte"), "ts",
    )


TRIALS = f"""trial AS (SELECT event_id AS id, 'u' || user_id AS file, list_extract([{_SQL_NAMES}], k % 10 + 1) AS operator,
 CASE event_type WHEN 'click' THEN 'FAILED' WHEN 'error' THEN 'TIMEOUT' WHEN 'purchase' THEN 'FLAKY' ELSE 'SURVIVED' END AS verdict,
 CAST(k AS BIGINT) AS line, 'silent' AS severity, CAST(k % 3 AS VARCHAR) AS scope, event_id % 997 AS start_byte, event_id % 997 + k % 7 + 1 AS end_byte, ts
 FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    code = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 124).otherwise(0)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("subject_id"), F.row_number().over(order).alias("ord"), F.concat(F.lit("s"), F.col("l_suppkey") % 11).alias("grader"),
        code.alias("exit_code"), (F.col("l_quantity") * 100).cast("bigint").alias("elapsed_ms"),
    )


RUNS = """run AS (SELECT l_orderkey AS subject_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS ord,
 's' || (l_suppkey % 11) AS grader, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 124 ELSE 0 END AS exit_code, CAST(l_quantity * 100 AS BIGINT) AS elapsed_ms FROM lineitem)"""


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with patch blocks, made alike in both engines from assistant turns: by turn and id closed, twice closed,
    unclosed, empty or none."""
    c = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    n = F.col("conv_id") % 5
    file = F.concat(F.lit("src/m"), (F.col("conv_id") % 7).cast("string"), F.lit(".py"))
    other = F.when(F.col("turn") % 3 == 0, F.lit("tests/t.py")).otherwise(file)
    diff = F.concat(F.lit("--- a/"), other, F.lit("\n+++ b/"), other, F.lit("\n@@ -1,1 +1,1 @@\n-a\n+b\n"))
    block = lambda x: F.concat(F.lit("<<<PATCH>>>\n"), x, F.lit("<<<END>>>\n"))
    reply = F.when(n == 0, block(diff)).when(n == 1, F.concat(block(F.lit("old")), F.lit("again\n"), block(diff))).when(n == 2, F.concat(F.lit("<<<PATCH>>>\n"), diff)).when(n == 3, block(F.lit("\n"))).otherwise(F.lit("no change needed"))
    return c.select("conv_id", "turn", file.alias("file"), reply.alias("reply"))


_DIFF = "'--- a/' || other || chr(10) || '+++ b/' || other || chr(10) || '@@ -1,1 +1,1 @@' || chr(10) || '-a' || chr(10) || '+b' || chr(10)"
REPLIES = f"""reply0 AS (SELECT conv_id, turn, 'src/m' || (conv_id % 7) || '.py' AS file, CASE WHEN turn % 3 = 0 THEN 'tests/t.py' ELSE 'src/m' || (conv_id % 7) || '.py' END AS other FROM conversations WHERE role = 'assistant'),
reply AS (SELECT conv_id, turn, file, CASE conv_id % 5 WHEN 0 THEN '<<<PATCH>>>' || chr(10) || {_DIFF} || '<<<END>>>' || chr(10)
 WHEN 1 THEN '<<<PATCH>>>' || chr(10) || 'old<<<END>>>' || chr(10) || 'again' || chr(10) || '<<<PATCH>>>' || chr(10) || {_DIFF} || '<<<END>>>' || chr(10)
 WHEN 2 THEN '<<<PATCH>>>' || chr(10) || {_DIFF} WHEN 3 THEN '<<<PATCH>>>' || chr(10) || chr(10) || '<<<END>>>' || chr(10) ELSE 'no change needed' END AS reply FROM reply0)"""
EXTRACTED = """block AS (SELECT conv_id, turn, file, reply, list_extract(regexp_extract_all(reply, '(?s)<<<PATCH>>>(.*?)<<<END>>>', 1), -1) AS body0, contains(reply, '<<<PATCH>>>') AS opened FROM reply),
got AS (SELECT conv_id, turn, file, reply, CASE WHEN regexp_replace(body0, '\\s+', '', 'g') <> '' THEN regexp_replace(body0, '^\\n+', '') END AS patch,
 CASE WHEN body0 IS NOT NULL AND regexp_replace(body0, '\\s+', '', 'g') = '' THEN 'empty' WHEN body0 IS NULL AND opened THEN 'unclosed' WHEN body0 IS NULL THEN 'missing' END AS error FROM block)"""


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as a suite's states along a history: F red, O green, P no grader."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("sha"), F.col("o_custkey").alias("suite"), F.col("o_orderstatus").alias("state"), F.lag("o_orderstatus").over(w).alias("parent_state"))


COMMITS = "hist AS (SELECT o_orderkey AS sha, o_custkey AS suite, o_orderstatus AS state, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS parent_state FROM orders)"
