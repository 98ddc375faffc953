"""Queries on routing, sampling and pairing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import pair_samples, routing, sampling
from lodestone.plans import adapters as A
from lodestone.plans.registry import query

#: (needle, graders) in order; the second names no grader that exists, so it never wins.
RULES = (("green", ("fast", "colour")), ("blue", ("ghost",)), ("blue", ("colour",)), ("red", ("slow_one", "fast")), ("light", ("core",)))
GRADERS = (("fast", False), ("colour", False), ("core", False), ("slow_one", True))


def _config(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    rules = spark.createDataFrame([(i, n, list(g)) for i, (n, g) in enumerate(RULES)], "ord int, needle string, names array<string>")
    graders = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(GRADERS)], "ord int, name string, slow boolean")
    return rules, graders


_NAMES = [n for n, _ in GRADERS]
_CASES = " ".join(f"WHEN contains(p_name, '{n}') THEN '{','.join(x for x in g if x in _NAMES)}'" for n, g in RULES if any(x in _NAMES for x in g))
_ROUTED = f"CASE {_CASES} ELSE '{','.join(n for n, s in GRADERS if not s)}' END"


@query(f"SELECT p_name AS file, {_ROUTED} AS graders FROM (SELECT DISTINCT p_name FROM part)")
def focus_routing_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = A.table(spark, sf_dir, "part").select(F.col("p_name").alias("file")).distinct()
    return routing.route(files, *_config(spark)).select("file", F.array_join("graders", ",").alias("graders"))


@query("""WITH l AS (SELECT l_orderkey, 's' || (l_suppkey % 11) AS g, min(l_linenumber) AS o FROM lineitem GROUP BY 1, 2) SELECT l_orderkey AS subject_id, string_agg(g, ',' ORDER BY o, g) AS graders FROM l GROUP BY 1""")
def grader_union_ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("subject_id"), F.col("l_linenumber").alias("pos"), F.array(F.concat(F.lit("s"), F.col("l_suppkey") % 11)).alias("graders"))
    return routing.union_graders(rows, "subject_id").select("subject_id", F.array_join("graders", ",").alias("graders"))


@query(f"""WITH {A.TRIALS}, r AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY start_byte, operator, id) AS turn FROM trial) SELECT file, id, CAST(turn AS INTEGER) AS turn FROM r ORDER BY turn, file LIMIT 200""")
def round_robin_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.round_robin(A.trials(spark, sf_dir), 200, order=("start_byte", "operator", "id")).select("file", "id", "turn")


@query(f"""WITH {A.TRIALS}, s AS (SELECT *, row_number() OVER (PARTITION BY file, scope ORDER BY start_byte, operator, id) AS i FROM trial WHERE verdict = 'SURVIVED'),
p AS (SELECT a.file, a.scope, a.id AS a_id, b.id AS b_id, row_number() OVER (PARTITION BY a.file, a.scope ORDER BY a.i, b.i) - 1 AS k FROM s a JOIN s b ON a.file = b.file AND a.scope = b.scope AND a.i < b.i)
SELECT file, scope, k, a_id, b_id FROM p ORDER BY k, file, scope LIMIT 300""")
def pair_same_scope_kth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.pairs_within(A.trials(spark, sf_dir).where("verdict = 'SURVIVED'"), 300)


_KEY = "least(a.file || ':' || a.start_byte || ':' || a.operator, b.file || ':' || b.start_byte || ':' || b.operator) || '|' || greatest(a.file || ':' || a.start_byte || ':' || a.operator, b.file || ':' || b.start_byte || ':' || b.operator)"
_ACROSS = f"""{A.TRIALS}, m AS (SELECT a.id AS a_id, b.id AS b_id, CASE WHEN a.scope = b.scope THEN 'same-scope' ELSE 'same-file' END AS affinity, {_KEY} AS key, b.line AS b_line
 FROM trial a JOIN trial b ON a.file = b.file AND a.verdict IN ('FAILED', 'TIMEOUT') AND b.verdict = 'SURVIVED' AND (a.end_byte <= b.start_byte OR b.end_byte <= a.start_byte)),
across AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY a_id, b_id) AS nth FROM m) WHERE nth = 1)"""


def _across(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = A.trials(spark, sf_dir)
    return sampling.pairs_across(t.where("verdict in ('FAILED', 'TIMEOUT')"), t.where("verdict = 'SURVIVED'"))


@query(f"WITH {_ACROSS} SELECT key, affinity, a_id, b_id FROM across")
def pair_killer_survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _across(spark, sf_dir).select("key", "affinity", "a_id", "b_id")


@query(f"WITH {_ACROSS} SELECT affinity, count(*) AS n, count(*) FILTER ((a_id + b_id) % 3 = 0) AS killed, count(*) FILTER ((a_id + b_id) % 3 = 0) * 100.0::DOUBLE / greatest(count(*), 1) AS pct FROM across GROUP BY affinity")
def pair_affinity_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.count_if((F.col("a_id") + F.col("b_id")) % 3 == 0)
    return _across(spark, sf_dir).groupBy("affinity").agg(F.count("*").alias("n"), hit.alias("killed"), (hit * 100.0 / F.greatest(F.count("*"), F.lit(1))).alias("pct"))


_2_64 = "18446744073709551616::UHUGEINT"


def _drawn(rows: str, seed: int, below: str) -> str:
    """SQL of ``rows`` (n, ...) with draw, the generator's draw number n modulo ``below``, by wide integers."""
    return f"""(SELECT * EXCLUDE (z), CAST(xor(z, z // 2147483648) % {below} AS BIGINT) AS draw FROM (SELECT * REPLACE ((xor(z, z // 134217728) * 10723151780598845931::UHUGEINT) % {_2_64} AS z) FROM
 (SELECT * REPLACE ((xor(z, z // 1073741824) * 13787848793156543929::UHUGEINT) % {_2_64} AS z) FROM (SELECT *, ({seed}::UHUGEINT + (n + 2)::UHUGEINT * 11400714819323198485::UHUGEINT) % {_2_64} AS z FROM {rows}))))"""


@query(f"""WITH {A.TRIALS}, p AS (SELECT a.id, b.id AS b_id, row_number() OVER (ORDER BY a.id) - 1 AS n FROM trial a JOIN trial b ON b.id = a.id + 1 AND a.file <> b.file) SELECT id, b_id FROM {_drawn("p", 42, "4")} WHERE draw = 0""")
def cross_file_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in four of the cross-file pairs of consecutive trials, by addressed draws."""
    t = A.trials(spark, sf_dir).select("id", "file")
    n = t.select((F.col("id") - 1).alias("id"), F.col("id").alias("b_id"), F.col("file").alias("b_file"))
    return sampling.cross_file_draws(t.join(n, "id").where("file <> b_file").select("id", "b_id"), 42, ["id"])


#: Few trials share a file here, so that the later passes of a sample have something to do.
_WANT, _SEED, _CROSS_PCT = 8000, 42, 10
_SPREAD = f"""{A.TRIALS}, t AS (SELECT id, 'm' || (id % 3001) AS file, CAST(id // 3001 % 2 AS VARCHAR) AS scope, start_byte, operator, verdict FROM trial), a AS (SELECT * FROM t WHERE verdict IN ('FAILED', 'TIMEOUT')), b AS (SELECT * FROM t WHERE verdict = 'SURVIVED')"""


def _spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = A.trials(spark, sf_dir)
    return t.withColumns({"file": F.concat(F.lit("m"), F.col("id") % 3001), "scope": (F.expr("id div 3001") % 2).cast("string")})


@query(f"""WITH {_SPREAD},
near AS (SELECT a.id AS a_id, b.id AS b_id, CASE WHEN a.scope = b.scope THEN 'same-scope' ELSE 'same-file' END AS affinity, {_KEY} AS key FROM a JOIN b ON a.file = b.file AND a.start_byte <> b.start_byte),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY affinity = 'same-file', a_id, b_id) AS c FROM near) WHERE c = 1),
ones AS (SELECT *, row_number() OVER (ORDER BY affinity = 'same-file', a_id, b_id) AS nth FROM once), taken AS (SELECT * FROM ones WHERE nth <= {_WANT}),
budget AS (SELECT least({_WANT} * {_CROSS_PCT} // 100, {_WANT} - count(*)) AS most, count(*) AS n FROM taken),
own AS (SELECT a.*, (SELECT count(*) FROM b) - coalesce(s.n, 0) AS others FROM a LEFT JOIN (SELECT file, count(*) AS n FROM b GROUP BY file) s ON s.file = a.file), based AS (SELECT *, sum(others) OVER (ORDER BY id) - others AS base FROM own),
-- the pairs wanted are among the first draws: killers far behind them are left out of this product
x AS (SELECT a.id AS a_id, b.id AS b_id, {_KEY} AS key, row_number() OVER (ORDER BY a.id, b.id) - 1 AS n FROM based a JOIN b ON a.file <> b.file WHERE a.base < 64 * (SELECT most FROM budget)),
hit AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n) AS c FROM {_drawn("x", _SEED, "4")} WHERE draw = 0), far AS (SELECT a_id, b_id, row_number() OVER (ORDER BY n) AS c FROM hit WHERE c = 1)
SELECT a_id, b_id, affinity, nth FROM taken UNION ALL SELECT a_id, b_id, 'cross-file', n + c FROM far, budget WHERE c <= most""")
def pair_sample_killers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of killer and survivor pairs in full, with the drawn pairs across files."""
    return pair_samples.sample(_spread(spark, sf_dir), _WANT, _SEED, _CROSS_PCT, "killer-survivor").select("a_id", "b_id", "affinity", F.col("nth").cast("bigint").alias("nth"))


@query()
def pair_sample_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of survivor pairs in full. Its random passes are a loop whose tries take one draw or three: a test runs that loop."""
    return pair_samples.sample(_spread(spark, sf_dir), 2000, _SEED, _CROSS_PCT, "survivors").select("a_id", "b_id", "affinity", "nth")
