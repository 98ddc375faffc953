"""Queries on trials, runs, histories and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions import text as T
from lodestone.functions import verdicts as V
from lodestone.operators import reports
from lodestone.plans import adapters as A
from lodestone.plans.registry import query
from lodestone.streaming.verdicts import windowed


@query(f"""WITH {A.TRIALS}, t AS (SELECT operator, count(*) FILTER (verdict IN ('FAILED', 'TIMEOUT')) AS killed, count(*) FILTER (verdict = 'FLAKY') AS flaky, count(*) AS total FROM trial GROUP BY operator)
SELECT operator, killed, flaky, total, killed * 100.0::DOUBLE / total AS pct, repeat('#', CAST(round(killed * 100.0::DOUBLE / total / 5) AS INTEGER)) AS bar FROM t""")
def kill_rate_by_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.by_operator(A.trials(spark, sf_dir))


def _labels(labels: tuple[str, ...], name: str) -> str:
    return "label AS (SELECT * FROM (VALUES " + ", ".join(f"('{x}', {i})" for i, x in enumerate(labels)) + f") AS t({name}, ord))"


def _shares(ctes: str, rows: str, name: str, labels: tuple[str, ...]) -> str:
    return f"""WITH {ctes}, {_labels(labels, name)}, n AS (SELECT {name}, count(*) AS n FROM {rows} GROUP BY {name})
SELECT label.{name}, ord, coalesce(n.n, 0) AS n, coalesce(n.n, 0) * 100.0::DOUBLE / greatest((SELECT count(*) FROM {rows} WHERE {name} IN (SELECT {name} FROM label)), 1) AS pct FROM label LEFT JOIN n ON label.{name} = n.{name}"""


@query(_shares(A.TRIALS + ", kept AS (SELECT * FROM trial WHERE verdict <> 'TIMEOUT')", "kept", "verdict", V.VERDICTS))
def verdict_distribution_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(A.trials(spark, sf_dir).where("verdict <> 'TIMEOUT'"), "verdict", V.VERDICTS)


@query(f"""WITH {A.TRIALS} SELECT count(*) AS total, count(*) FILTER (verdict IN ('FAILED', 'TIMEOUT')) AS killed, count(*) FILTER (verdict = 'FLAKY') AS flaky, count(*) FILTER (verdict = 'SURVIVED') AS survived,
 count(DISTINCT file) AS files, coalesce(count(*) FILTER (verdict IN ('FAILED', 'TIMEOUT')) * 100.0::DOUBLE / nullif(count(*), 0), 0) AS kill_rate FROM trial""")
def assay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    killed = F.count_if(V.killed(F.col("verdict")))
    return A.trials(spark, sf_dir).agg(
        F.count("*").alias("total"), killed.alias("killed"), F.count_if(F.col("verdict") == "FLAKY").alias("flaky"), F.count_if(F.col("verdict") == "SURVIVED").alias("survived"),
        F.countDistinct("file").alias("files"), V.rate(killed, F.count("*")).alias("kill_rate"),
    )


@query(f"WITH {A.TRIALS} SELECT file, line, id, operator FROM trial WHERE verdict = 'SURVIVED' AND severity = 'silent' ORDER BY file, line, id LIMIT 25")
def silent_survivors_top25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.silent_survivors(A.trials(spark, sf_dir)).select("file", "line", "id", "operator")


@query(f"WITH {A.TRIALS} SELECT id, verdict = 'SURVIVED' AS survivor, verdict IN ('FAILED', 'TIMEOUT') AS killer, verdict <> 'SURVIVED' AS legacy_killer FROM trial")
def survivors_and_killers(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("verdict")
    return A.trials(spark, sf_dir).select("id", (v == "SURVIVED").alias("survivor"), V.killed(v).alias("killer"), (v != "SURVIVED").alias("legacy_killer"))


@query(f"""WITH {A.RUNS}, b AS (SELECT grader, max(elapsed_ms) AS ms FROM run WHERE exit_code = 0 GROUP BY grader HAVING grader <> 's3'), g AS (SELECT DISTINCT grader FROM run)
SELECT g.grader, b.ms, greatest(3000, coalesce(b.ms * 20, 3000)) AS deadline_ms, greatest(CAST(ceil(greatest(3000, coalesce(b.ms * 20, 3000)) / 1000.0) AS BIGINT), 1) AS deadline_s FROM g LEFT JOIN b ON g.grader = b.grader""")
def baseline_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = A.runs(spark, sf_dir)
    base = runs.where("exit_code = 0 and grader <> 's3'").groupBy("grader").agg(F.max("elapsed_ms").alias("ms"))
    out = runs.select("grader").distinct().join(base, "grader", "left").withColumn("deadline_ms", V.deadline_ms(F.col("ms")))
    return out.withColumn("deadline_s", V.deadline_seconds(F.col("deadline_ms")))


_CLASS = "CASE WHEN exit_code IN (124, 137) THEN 'timed_out' WHEN exit_code IN (126, 127) AND elapsed_ms < 2000 THEN 'not_exec' WHEN exit_code = 0 THEN 'ok' ELSE 'failed' END"
_GRADED = f"""{A.RUNS}, classed AS (SELECT *, {_CLASS} AS class FROM run), red AS (SELECT subject_id, min(ord) FILTER (class <> 'ok') AS o FROM classed GROUP BY subject_id),
graded AS (SELECT red.subject_id, CASE WHEN c.class IS NULL THEN 'SURVIVED' WHEN c.class = 'timed_out' THEN 'TIMEOUT' WHEN c.class = 'not_exec' THEN 'ABORTED' ELSE 'FAILED' END AS verdict, c.grader AS suite
 FROM red LEFT JOIN classed c ON c.subject_id = red.subject_id AND c.ord = red.o)"""


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.grade(A.runs(spark, sf_dir).withColumn("class", V.run_class(F.col("exit_code"), F.col("elapsed_ms"))))


@query(f"WITH {_GRADED} SELECT * FROM graded")
def grade_first_red(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _graded(spark, sf_dir)


@query(f"""WITH {_GRADED.replace("classed AS (", "classed AS MATERIALIZED (").replace("graded AS (", "graded AS MATERIALIZED (")}, second AS MATERIALIZED (SELECT subject_id - 1 AS subject_id, grader AS suite, max(class) AS class FROM classed GROUP BY 1, 2), again AS (SELECT g.subject_id, s.class FROM graded g JOIN second s ON s.subject_id = g.subject_id AND s.suite = g.suite)
SELECT g.subject_id, CASE WHEN verdict IN ('FAILED', 'TIMEOUT') AND class = 'not_exec' THEN 'ABORTED' WHEN verdict IN ('FAILED', 'TIMEOUT') AND class IS NOT NULL AND class <> 'ok' THEN 'FLAKY' ELSE verdict END AS verdict
FROM graded g LEFT JOIN again a ON a.subject_id = g.subject_id""")
def confirm_kill_flaky(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next subject's run of the accusing suite stands for its second run on the clean tree."""
    second = A.runs(spark, sf_dir).withColumn("class", V.run_class(F.col("exit_code"), F.col("elapsed_ms")))
    second = second.groupBy((F.col("subject_id") - 1).alias("subject_id"), F.col("grader").alias("suite")).agg(F.max("class").alias("again"))
    return _graded(spark, sf_dir).join(second, ["subject_id", "suite"], "left").select("subject_id", V.confirmed(F.col("verdict"), F.col("again")).alias("verdict"))


@query("""WITH c AS (SELECT l_orderkey, l_linenumber, list_extract([0, 1, 2, 124, 126, 127, 137], CAST(l_quantity AS INTEGER) % 7 + 1) AS exit_code, l_partkey % 4000 AS elapsed_ms FROM lineitem)
SELECT exit_code, CASE WHEN exit_code IN (124, 137) THEN 'timed_out' WHEN exit_code IN (126, 127) AND elapsed_ms < 2000 THEN 'not_exec' WHEN exit_code = 0 THEN 'ok' ELSE 'failed' END AS class, count(*) AS n FROM c GROUP BY 1, 2""")
def exit_code_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*map(F.lit, (0, 1, 2, 124, 126, 127, 137))), F.col("l_quantity").cast("int") % 7 + 1)
    rows = A.table(spark, sf_dir, "lineitem").select(code.alias("exit_code"), (F.col("l_partkey") % 4000).alias("elapsed_ms"))
    return rows.groupBy("exit_code", V.run_class(F.col("exit_code"), F.col("elapsed_ms")).alias("class")).agg(F.count("*").alias("n"))


_OUTCOME = f"""{A.COMMITS}, outcome AS (SELECT sha, suite, CASE WHEN sha % 50 = 0 THEN 'UNRUNNABLE' WHEN parent_state = 'P' OR state = 'P' THEN 'NO-GRADER-YET' WHEN parent_state <> 'F' THEN 'GREEN-BEFORE' WHEN state = 'O' THEN 'FIXED' ELSE 'STILL-RED' END AS outcome FROM hist WHERE parent_state IS NOT NULL)"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = A.commits(spark, sf_dir).where("parent_state is not null")
    state = V.history_outcome((F.col("parent_state") != "P") & (F.col("state") != "P"), F.col("sha") % 50 != 0, F.col("parent_state") == "F", F.col("state") == "O")
    return h.select("sha", "suite", state.alias("outcome"))


@query(f"WITH {_OUTCOME} SELECT * FROM outcome")
def history_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir)


@query(_shares(_OUTCOME, "outcome", "outcome", V.OUTCOMES).replace("AS (SELECT outcome, count(*) AS n FROM outcome GROUP BY outcome)", "AS (SELECT o.outcome, count(*) AS n FROM outcome o GROUP BY o.outcome)"))
def history_outcome_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(_outcomes(spark, sf_dir), "outcome", V.OUTCOMES)


_SCORED = f"""{A.REPLIES}, {A.EXTRACTED}, files AS (SELECT *, list_distinct(list_transform(regexp_extract_all(patch, '(?m)^(?:\\+\\+\\+ |--- a/)([^\\t\\n]+)', 1), lambda x: regexp_replace(trim(x), '^(?:[ab]/)+', ''))) AS fs FROM got),
scored AS (SELECT conv_id, turn, CASE WHEN conv_id % 11 = 0 THEN 'MALFORMED' WHEN conv_id % 13 = 0 THEN 'BAD-ROW' WHEN error IS NOT NULL THEN 'MALFORMED' WHEN len(list_filter(fs, lambda f: f <> file)) > 0 THEN 'CHEATED' WHEN turn % 7 = 0 THEN 'MALFORMED' WHEN conv_id % 2 = 0 THEN 'MISSED' ELSE 'SOLVED' END AS score FROM files)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    patch, error = T.extract_patch(F.col("reply"))
    r = A.replies(spark, sf_dir).withColumns({"patch": patch, "error": error})
    c, t = F.col("conv_id"), F.col("turn")
    value = V.score(c % 11 != 0, c % 13 != 0, F.col("error"), T.in_contract(T.patched_files(F.col("patch")), F.col("file")), t % 7 != 0, c % 2 == 0)
    return r.select("conv_id", "turn", value.alias("score"))


@query(f"WITH {_SCORED} SELECT * FROM scored")
def score_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir)


@query(_shares(_SCORED, "scored", "score", V.SCORES))
def scoreboard_pass_at_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(_scored(spark, sf_dir), "score", V.SCORES)


@query("""WITH c AS (SELECT conv_id, turn, conv_id % 4 AS r FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, sum(CASE WHEN r = 0 THEN 1 ELSE 0 END) OVER w AS verified, sum(CASE WHEN r = 1 THEN 1 ELSE 0 END) OVER w AS mismatch, sum(CASE WHEN r > 1 THEN 1 ELSE 0 END) OVER w AS unparseable, count(*) OVER w AS offered
FROM c WINDOW w AS (PARTITION BY conv_id % 16 ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING)""")
def tally_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running tally of each of 16 generators."""
    w = Window.partitionBy(F.col("conv_id") % 16).orderBy("conv_id", "turn").rowsBetween(Window.unboundedPreceding, 0)
    r = F.col("conv_id") % 4
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).over(w)
    c = A.table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return c.select("conv_id", "turn", n(r == 0).alias("verified"), n(r == 1).alias("mismatch"), n(r > 1).alias("unparseable"), F.count("*").over(w).alias("offered"))


@query(f"""WITH {A.TRIALS} SELECT date_trunc('hour', ts) AS start, operator, verdict, count(*) AS n FROM trial GROUP BY 1, 2, 3""")
def verdicts_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windowed(A.trials(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")))
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{o}', 'silent', '{d}')" for o, d in reports.OPERATORS) + ") AS t(operator, severity, description)")
def operators_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = spark.createDataFrame(list(reports.OPERATORS), "operator string, description string")
    return dim.select("operator", reports.severity(F.col("operator")).alias("severity"), "description")


@query("""WITH l AS (SELECT l_orderkey, 's' || (l_suppkey % 11) AS g FROM lineitem), w AS (SELECT DISTINCT l_orderkey, g FROM l), have AS (SELECT DISTINCT 's' || (s_suppkey % 9) AS g FROM supplier)
SELECT l_orderkey AS subject_id, string_agg(g, ',' ORDER BY g) AS absent FROM w WHERE g NOT IN (SELECT g FROM have) GROUP BY l_orderkey""")
def contract_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graders that a subject wants and the tree doesn't have."""
    wanted = A.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("subject_id"), F.concat(F.lit("s"), F.col("l_suppkey") % 11).alias("g")).distinct()
    have = A.table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey") % 9).alias("g")).distinct()
    return wanted.join(have, "g", "left_anti").groupBy("subject_id").agg(F.array_join(F.array_sort(F.collect_set("g")), ",").alias("absent"))


@query("""WITH e AS (SELECT o_orderkey AS id, list_distinct([ 'order:' || o_orderkey, 'customer:' || o_custkey, 'status:' || o_orderstatus ]) AS caused_by FROM orders), x AS (SELECT id, unnest(caused_by) AS cause FROM e)
SELECT split_part(cause, ':', 1) AS kind, count(*) AS n, count(DISTINCT cause) AS causes FROM x GROUP BY 1""")
def provenance_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = A.table(spark, sf_dir, "orders")
    caused = F.array(F.concat(F.lit("order:"), "o_orderkey"), F.concat(F.lit("customer:"), "o_custkey"), F.concat(F.lit("status:"), "o_orderstatus"))
    x = o.select(F.explode(caused).alias("cause"))
    return x.groupBy(F.substring_index("cause", ":", 1).alias("kind")).agg(F.count("*").alias("n"), F.countDistinct("cause").alias("causes"))
