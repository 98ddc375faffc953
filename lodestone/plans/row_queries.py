"""Queries that make training rows and hold gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import verdicts as V
from lodestone.operators import gates, rows, sampling
from lodestone.plans import adapters as A
from lodestone.plans.registry import query
from lodestone.sources import files

COMMIT, REPO, WORK, LINES = "0123456789abcdef", "repo", "/tmp/w", 40


def _source(name: Column) -> Column:
    """A file of numbered lines of one width: line i begins at (i - 1) * (5 + the length of its name)."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(LINES)), lambda i: F.concat(F.lpad(i.cast("string"), 3, "0"), F.lit(" "), name, F.lit("\n"))), "")


_LINE = "CASE WHEN i > 40 THEN '' ELSE {bad} || ' ' || file END"
_NUMBERED = "lpad(CAST(i AS VARCHAR), 3, '0')"
_FORM = "'<<<PATCH>>>' || chr(10) || '--- a/<path>' || chr(10) || '+++ b/<path>' || chr(10) || '@@ ... @@' || chr(10) || '...' || chr(10) || '<<<END>>>' || chr(10)"
_REPAIR = "chr(10) || 'Find the defect and repair it. Reply with ONLY a unified diff inside a sentinel block:' || chr(10) || chr(10) || " + _FORM
_REPAIR_BOTH = "chr(10) || 'There are TWO defects in this file. The failing output above may only point at one of them. Repair both. Reply with ONLY a unified diff inside a sentinel block:' || chr(10) || chr(10) || " + _FORM


def _shown(lo: str, hi: str, mark: str, bad: str) -> str:
    """SQL of an excerpt of numbered lines; ``bad`` is SQL for what line i shows first."""
    return f"array_to_string(list_transform(range(greatest({lo}, 1), least({hi}, 41) + 1), lambda i: CASE WHEN i = {mark} THEN '>' ELSE ' ' END || lpad(CAST(i AS VARCHAR), 5, ' ') || ' | ' || {_LINE.format(bad=bad)} || chr(10)), '')"


def _head(commit: str, suite: str, said: str) -> str:
    return f"'Repository: repo' || chr(10) || 'Commit: ' || substr({commit}, 1, 9) || chr(10) || chr(10) || 'The test suite `' || {suite} || '` is failing.' || chr(10) || chr(10) || '── what the suite reported ──' || chr(10) || {said} || chr(10) || chr(10) || '── the file it points into: ' || file || ' ──' || chr(10)"


def _diff(lo: str, hi: str, bad: str) -> str:
    """SQL of a completion that restores lines lo to hi."""
    part = lambda a, b, sign, first: f"array_to_string(list_transform(range({a}, {b} + 1), lambda i: '{sign}' || {first} || ' ' || file || chr(10)), '')"
    begin, end = f"greatest({lo} - 3, 1)", f"least({hi} + 3, 40)"
    return (
        f"'<<<PATCH>>>' || chr(10) || '--- a/' || file || chr(10) || '+++ b/' || file || chr(10) || '@@ -' || {begin} || ',' || ({end} - {begin} + 1) || ' +' || {begin} || ',' || ({end} - {begin} + 1) || ' @@' || chr(10)"
        f" || {part(begin, f'{lo} - 1', ' ', _NUMBERED)} || {part(lo, hi, '-', bad)} || {part(lo, hi, '+', _NUMBERED)} || {part(f'{hi} + 1', end, ' ', _NUMBERED)} || '<<<END>>>' || chr(10)"
    )


_HUNG = "'(no recognised failure marker in this suite''s output; showing the last                  1 lines verbatim)' || chr(10) || 'The suite did not terminate. It was killed after 3000 ms against a healthy baseline far below that, so the defect is a hang — most likely a loop whose exit condition is now unreachable — rather than a failed assertion.'"
_BAD = f"CASE WHEN i = l THEN 'XYZ' ELSE {_NUMBERED} END"
_KILLED = f"""{A.TRIALS}, t AS (SELECT CAST(id AS VARCHAR) AS id, file, operator, verdict, line % 40 + 1 AS l, scope FROM trial WHERE verdict IN ('FAILED', 'TIMEOUT') AND file NOT LIKE '%7')"""


def _trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials with a site of three bytes at the start of a line."""
    t = A.trials(spark, sf_dir).withColumn("line", F.col("line") % LINES + 1).withColumn("id", F.col("id").cast("string"))
    begin = (F.col("line") - 1) * (5 + F.length("file"))
    more = {"start_byte": begin, "end_byte": begin + 3, "after": F.lit("XYZ"), "suite": F.lit("unit"), "tail": F.lit("ok\nFAILED at /tmp/w/w3/a.py\n"), "limit_ms": F.lit(3000)}
    return t.withColumns(more)


def _pristine(trials: DataFrame) -> DataFrame:
    """Sources of all files but those whose name ends in 7, which stand for files that are gone."""
    return trials.select("file").where("file not like '%7'").distinct().select("file", _source(F.col("file")).cast("binary").alias("content"))


@query(f"""WITH {_KILLED} SELECT id, {_head(f"'{COMMIT}'", "'unit'", f"CASE verdict WHEN 'TIMEOUT' THEN {_HUNG} ELSE 'ok' || chr(10) || 'FAILED at a.py' END")} || {_shown('l - 14', 'l + 14', 'l', _BAD)} || {_REPAIR} AS prompt,
 {_diff('l', 'l', _BAD)} AS completion, operator, 'silent' AS severity, file, CAST(l AS INTEGER) AS line, scope, verdict, 'trial:' || id || ',tree:{COMMIT}' AS caused_by, '{COMMIT}' AS repo_commit FROM t""")
def corpus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training row of every killed trial whose file is there."""
    t = _trials(spark, sf_dir)
    good, _ = rows.corpus_rows(t, _pristine(t), COMMIT, REPO, WORK)
    return good.withColumn("caused_by", F.array_join("caused_by", ","))


@query(f"""WITH {A.TRIALS} SELECT file, operator, line % 40 + 1 AS line, 'no pristine file' AS reason FROM trial WHERE verdict IN ('FAILED', 'TIMEOUT') AND file LIKE '%7'""")
def corpus_aborted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Killed trials that could not become rows, with why."""
    t = _trials(spark, sf_dir)
    return rows.corpus_rows(t, _pristine(t), COMMIT, REPO, WORK)[1]


_FIXED = """h AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 14, 'c') AS sha, lpad(CAST(o_custkey AS VARCHAR), 14, 'p') AS parent, 's' || (o_custkey % 5) AS suite, 'src/m' || (o_orderkey % 9) || '.py' AS file, o_orderkey % 40 + 1 AS l FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 9 <> 4)"""


@query(f"""WITH {_FIXED} SELECT 'hist:' || substr(sha, 1, 12) || ':' || file AS id, {_head('parent', 'suite', "'FAILED here'")} || {_shown('l - 14', 'l + 14', 'l', _BAD)} || {_REPAIR} AS prompt, {_diff('l', 'l', _BAD)} AS completion,
 'history' AS operator, 'real' AS severity, file, CAST(l AS INTEGER) AS line, '' AS scope, 'FIXED' AS verdict, 'commit:' || sha || ',parent:' || parent AS caused_by, sha AS repo_commit FROM h""")
def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training row of each file that a fixing commit changed; orders stand for commits, open ones fixed something."""
    o = A.table(spark, sf_dir, "orders")
    key, text = F.col("o_orderkey"), lambda c: F.col(c).cast("string")
    path = F.concat(F.lit("src/m"), (key % 9).cast("string"), F.lit(".py"))
    h = o.select(F.lpad(text("o_orderkey"), 14, "c").alias("sha"), F.lpad(text("o_custkey"), 14, "p").alias("parent"), F.when(F.col("o_orderstatus") == "O", "FIXED").otherwise("STILL-RED").alias("outcome"),
                 F.concat(F.lit("s"), F.col("o_custkey") % 5).alias("suite"), F.lit("FAILED here").alias("tail"), path.alias("file"), (key % LINES + 1).cast("int").alias("line"))
    # a parent is a name of its own for each child here, since each child changes another line
    h = h.withColumn("parent", F.concat_ws("@", "parent", "sha"))
    source, width = F.col("source"), F.length("file") + 5
    broken = F.concat(F.substring(source, F.lit(1), (F.col("line") - 1) * width), F.lit("XYZ"), source.substr((F.col("line") - 1) * width + 4, F.lit(1 << 20)))
    versions = F.array(F.struct("sha", source.alias("text")), F.struct(F.col("parent").alias("sha"), broken.alias("text")))
    blobs = h.where(~F.contains("file", F.lit("m4"))).withColumn("source", _source(F.col("file"))).select("file", F.explode(versions).alias("x")).select("x.sha", "file", "x.text")
    replays = h.select("sha", "parent", "outcome", "suite", "tail", F.array(F.struct("file", "line")).alias("touched"))
    good, _ = rows.history_rows(replays, blobs, REPO, WORK)
    return good.withColumn("caused_by", F.regexp_replace(F.array_join("caused_by", ","), "@.*$", ""))


_TWO = f"CASE WHEN i = a OR i = b THEN 'XYZ' ELSE {_NUMBERED} END"
_PAIRS = """p AS (SELECT o_orderkey, 'src/m' || (o_orderkey % 9) || '.py' AS file, o_orderkey % 40 + 1 AS x, o_custkey % 40 + 1 AS y FROM orders), q AS (SELECT file, least(x, y) AS a, greatest(x, y) AS b, CASE WHEN o_orderkey % 2 = 0 THEN 'same-scope' ELSE 'same-file' END AS affinity, o_orderkey FROM p WHERE x <> y)"""
_NEAR = _shown("(a + b) // 2 - (b - a) // 2 - 8", "(a + b) // 2 + (b - a) // 2 + 8", "(a + b) // 2", _TWO)


@query(f"""WITH {_PAIRS} SELECT 'pair:' || file || ':' || a || ':' || b AS id, {_head(f"'{COMMIT}'", "'unit'", "'FAILED here'")} || CASE WHEN b - a <= 24 THEN {_NEAR} ELSE {_shown('a - 8', 'a + 8', 'a', _TWO)} || chr(10) || '        ⋮' || chr(10) || {_shown('b - 8', 'b + 8', 'b', _TWO)} END || {_REPAIR_BOTH} AS prompt,
 {_diff('a', 'b', _TWO)} AS completion, 'o1+o2' AS operator, 'emergent/' || affinity AS severity, file, a AS line, '' AS scope, 'EMERGENT' AS verdict, 'site:' || file || ':' || a || ',site:' || file || ':' || b || ',tree:{COMMIT}' AS caused_by, '{COMMIT}' AS repo_commit FROM q""")
def pair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training row of each failed pair of sites of a file; orders stand for pairs."""
    o = A.table(spark, sf_dir, "orders")
    file = F.concat(F.lit("src/m"), (F.col("o_orderkey") % 9).cast("string"), F.lit(".py"))
    p = o.select(file.alias("file"), (F.col("o_orderkey") % LINES + 1).alias("a_line"), (F.col("o_custkey") % LINES + 1).alias("b_line"), F.when(F.col("o_orderkey") % 2 == 0, "same-scope").otherwise("same-file").alias("affinity")).where("a_line <> b_line")
    for k, name in (("a", "o1"), ("b", "o2")):
        begin = (F.col(f"{k}_line") - 1) * (5 + F.length("file"))
        p = p.withColumns({f"{k}_start_byte": begin, f"{k}_end_byte": begin + 3, f"{k}_after": F.lit("XYZ"), f"{k}_operator": F.lit(name)})
    pristine = p.select("file").distinct().select("file", _source(F.col("file")).cast("binary").alias("content"))
    good, _ = rows.pair_rows(p.withColumns({"suite": F.lit("unit"), "tail": F.lit("FAILED here")}), pristine, COMMIT, REPO, WORK)
    return good.withColumn("caused_by", F.array_join("caused_by", ","))


@query(f"""WITH {A.RUNS}, m AS (SELECT grader, arg_max(exit_code, subject_id * 100 + ord) AS code, arg_max(elapsed_ms, subject_id * 100 + ord) AS ms FROM run GROUP BY grader)
SELECT count(*) FILTER (code <> 0) = 0 AS passed, CAST(sum(ms) AS BIGINT) AS total_ms, coalesce(string_agg(grader || CASE code WHEN 124 THEN ' (timed out)' ELSE ' (tests failed)' END, ',' ORDER BY grader) FILTER (code <> 0), '') AS red FROM m""")
def baseline_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the graders' last runs were green, and which were not."""
    r = A.runs(spark, sf_dir).withColumn("ord", F.col("subject_id") * 100 + F.col("ord"))
    return gates.baseline_verdict(gates.baseline(r)).select("passed", "total_ms", F.array_join("red", ",").alias("red"))


@query(f"""WITH {A.TRIALS} SELECT CAST(id AS VARCHAR) AS id, file, CASE verdict WHEN 'FAILED' THEN 'Failed' WHEN 'TIMEOUT' THEN 'Timeout' WHEN 'FLAKY' THEN 'Flaky' ELSE 'Survived' END AS kind, CASE WHEN verdict <> 'SURVIVED' THEN 'unit' END AS suite,
 CASE verdict WHEN 'FAILED' THEN 'ok' || chr(10) || 'FAILED at /tmp/w/w3/a.py' || chr(10) END AS tail, CASE verdict WHEN 'TIMEOUT' THEN CAST(3000 AS BIGINT) END AS limit_ms FROM trial""")
def trials_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials written as JSON texts and read back."""
    return files.read_trials(files.trial_json(_trials(spark, sf_dir))).select("id", "file", "kind", "suite", "tail", "limit_ms")


@query(f"""WITH {_KILLED} SELECT r.kind AS responder, CASE r.kind WHEN 'oracle' THEN 'SOLVED' WHEN 'null' THEN 'MALFORMED' ELSE 'CHEATED' END AS score, count(*) AS n FROM t CROSS JOIN (VALUES ('oracle'), ('null'), ('cheat')) AS r(kind) GROUP BY 1, 2""")
def responder_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the scoring judges the replies of its own three responders; applying the oracle's diff must give the pristine file back."""
    from lodestone.functions import text as T
    from lodestone.operators.patches import apply_patch

    t = _trials(spark, sf_dir)
    pristine = _pristine(t)
    good, _ = rows.corpus_rows(t, pristine, COMMIT, REPO, WORK)
    broken = t.select("id", "start_byte", "end_byte", "after")
    out = None
    for kind in ("oracle", "null", "cheat"):
        r = gates.respond(good, kind)
        patch, error = T.extract_patch(F.col("reply"))
        r = r.withColumns({"patch": patch, "error": error}).join(pristine, "file").join(broken, "id")
        whole = F.col("content").cast("string")
        source = F.concat(F.substring(whole, F.lit(1), F.col("start_byte").cast("int")), F.col("after"), whole.substr((F.col("end_byte") + 1).cast("int"), F.lit(1 << 20)))
        r = r.withColumn("applied", apply_patch(source, F.coalesce("patch", F.lit(""))))
        score = V.score(F.lit(True), F.lit(True), F.col("error"), T.in_contract(T.patched_files(F.col("patch")), F.col("file")), F.col("applied").isNotNull(), F.col("applied") != whole)
        part = r.groupBy(F.lit(kind).alias("responder"), score.alias("score")).agg(F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


_ONCE = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file, start_byte, operator ORDER BY id) AS nth FROM trial WHERE {}) WHERE nth = 1"


@query(f"""WITH {A.TRIALS}, a AS ({_ONCE.format("verdict IN ('FAILED', 'TIMEOUT')")}), b AS ({_ONCE.format("verdict = 'SURVIVED'")}),
m AS (SELECT a.id AS a_id, b.id AS b_id, CASE WHEN a.scope = b.scope THEN 'same-scope' ELSE 'same-file' END AS affinity FROM a JOIN b ON a.file = b.file AND a.start_byte <> b.start_byte),
one AS (SELECT *, 0 AS pass FROM m WHERE affinity = 'same-scope' ORDER BY a_id, b_id LIMIT 500), two AS (SELECT *, 1 AS pass FROM m WHERE affinity = 'same-file' ORDER BY a_id, b_id LIMIT 500)
SELECT a_id, b_id, affinity FROM (SELECT * FROM one UNION ALL SELECT * FROM two) ORDER BY pass, a_id, b_id LIMIT 500""")
def sampled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Killers with survivors, same-scope pairs first, then same-file ones, up to a budget."""
    t = A.trials(spark, sf_dir)
    return sampling.sample_across(t.where(V.killed(F.col("verdict"))), t.where("verdict = 'SURVIVED'"), 500).select("a_id", "b_id", "affinity")
