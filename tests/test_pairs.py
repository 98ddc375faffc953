"""Samples of pairs against the loop that they stand for: one pair, one draw at a time."""

import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import pair_samples, rows, sampling

TRIAL = "id bigint, file string, scope string, start_byte bigint, operator string, verdict string"


def sequential(trials, want, seed, percent, mode):
    spent = 0

    def below(n):
        nonlocal spent
        spent += 1
        return sampling.splitmix64(seed, spent - 1) % n

    out, seen = [], set()

    def put(a, b, affinity):
        key = tuple(sorted((t[1], t[3], t[4]) for t in (a, b)))
        if key in seen:
            return 0
        seen.add(key)
        out.append((a[0], b[0], affinity))
        return 1

    survivors, killers = [t for t in trials if t[5] == "SURVIVED"], [t for t in trials if t[5] in ("FAILED", "TIMEOUT")]
    if mode == "killer-survivor":
        for affinity, most in (("same-scope", want), ("same-file", want), ("cross-file", want * percent // 100)):
            for a in killers:
                for b in survivors:
                    own = "cross-file" if a[1] != b[1] else "same-scope" if a[2] == b[2] else "same-file"
                    if len(out) < want and most and own == affinity and (a[1], a[3]) != (b[1], b[3]) and (own != "cross-file" or below(4) == 0):
                        most -= put(a, b, own)
        return out
    if len(survivors) < 2:
        return out
    scopes, by_file = {}, {}
    for t in survivors:
        scopes.setdefault(t[1:3], []).append(t)
        by_file.setdefault(t[1], []).append(t)
    queues = [[(x, y) for i, x in enumerate(ts) for y in ts[i + 1 :]] for _, ts in sorted(scopes.items())]
    for k in range(max(map(len, queues))):
        for q in queues:
            if k < len(q) and len(out) < want:
                put(*q[k], "same-scope")
    tries = 0
    while len(out) < want and tries < 40 * want:
        tries += 1
        ts = by_file[sorted(by_file)[below(len(by_file))]]
        if len(ts) > 1:
            a, b = ts[below(len(ts))], ts[below(len(ts))]
            if a is not b and a[2] != b[2]:
                put(a, b, "same-file")
    tries, most = 0, want * percent // 100
    while len(out) < want and most and tries < 40 * want:
        tries += 1
        a, b = survivors[below(len(survivors))], survivors[below(len(survivors))]
        if a[1] != b[1]:
            most -= put(a, b, "cross-file")
    return out


def made(seed, n, n_files, n_scopes):
    """Trials of which most are in one file, some sites come twice, and some of those on both sides."""
    r, out = random.Random(seed), []
    for i in range(n):
        if out and r.random() < 0.15:
            out.append((i, *r.choice(out)[1:5], r.choice(["SURVIVED", "FAILED"])))
        else:
            out.append((i, f"f{r.randrange(n_files) if r.random() < 0.6 else 0}", f"s{r.randrange(n_scopes)}", r.randrange(60), r.choice("pq"), r.choice(["SURVIVED", "SURVIVED", "FAILED", "TIMEOUT", "FLAKY"])))
    return out


@pytest.mark.parametrize("mode,case", [("survivors", (40, 5, 3, 120, 30)), ("survivors", (25, 20, 5, 40, 100)), ("killer-survivor", (60, 5, 3, 200, 30)), ("killer-survivor", (25, 20, 5, 100, 100)), ("killer-survivor", (1, 1, 1, 5, 10))])
def test_samples_are_those_of_the_loop(spark, mode, case):
    n, n_files, n_scopes, want, percent = case
    trials = made(n, n, n_files, n_scopes)
    rows = spark.createDataFrame(trials, TRIAL).repartition(3)
    got = [(r.a_id, r.b_id, r.affinity) for r in pair_samples.sample(rows, want, 7, percent, mode).orderBy("nth").collect()]
    assert got == sequential(trials, want, 7, percent, mode)


def test_no_pairs(spark):
    for mode in ("survivors", "killer-survivor"):
        assert pair_samples.sample(spark.createDataFrame([], TRIAL), 5, 1, 50, mode).count() == 0


def test_scope_pairs_of_a_repeated_site_are_one(spark):
    rows = [(1, "f", "s", 5, "p", "SURVIVED"), (2, "f", "s", 5, "p", "SURVIVED"), (3, "f", "s", 9, "p", "SURVIVED"), (4, "f", "s", 11, "p", "SURVIVED")]
    got = [(r.a_id, r.b_id) for r in sampling.pairs_within(spark.createDataFrame(rows, TRIAL), 10).collect()]
    assert got == [(1, 2), (1, 3), (1, 4), (3, 4)]


def test_draws_of_64_bits(spark):
    for seed in (0, 42, 2**63 + 5):
        got = spark.range(50).select((F.col("id") * 7919).alias("n"), sampling.splitmix_bits(seed, F.col("id") * 7919).alias("z"), sampling.splitmix_below(seed, F.col("id") * 7919, 10**12 + 39).alias("r")).collect()
        assert [(r.z % 2**64, r.r) for r in got] == [(sampling.splitmix64(seed, r.n), sampling.splitmix64(seed, r.n) % (10**12 + 39)) for r in got]
    assert spark.range(2).select(sampling.splitmix_below(1, F.col("id"), 0).alias("x")).distinct().collect() == [(0,)]


def test_numbered_rows(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id")).repartition(5)
    assert {(r.id, r.n) for r in sampling.numbered(rows, ["id"], "n").collect()} == {(i, i) for i in range(1000)}


def test_rows_of_a_hot_file_are_dealt(spark, monkeypatch):
    """A file of many trials is copied, so that no task has them all; every trial meets its file once, and those without a file stay."""
    monkeypatch.setattr(rows, "FILE_ROWS", 50)
    trials = spark.range(1000).select(F.when(F.col("id") % 100 == 1, None).when(F.col("id") % 100 == 2, "gone").otherwise("hot").alias("file"), "id")
    trials = trials.unionByName(spark.createDataFrame([("cold", 2000)], "file string, id long"))
    pristine = spark.createDataFrame([("hot", b"h"), ("cold", b"c"), ("unused", b"u")], "file string, content binary")
    held = rows._with_files(trials, pristine)
    assert held.columns == ["file", "id", "content"]
    got = {r.id: (r.file, r.content) for r in held.collect()}
    want = {i: (None, None) if i % 100 == 1 else ("gone", None) if i % 100 == 2 else ("hot", b"h") for i in range(1000)} | {2000: ("cold", b"c")}
    assert held.count() == 1001 and {i: (f, None if c is None else bytes(c)) for i, (f, c) in got.items()} == want
    parts = held.where("file = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1


def test_history_rows_reads_its_sources_once_a_join(spark):
    """The replays and either join of versions read the orders once; each version isn't a scan and a source of its own."""
    from lodestone.plans.row_queries import history_rows

    plan = history_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3
