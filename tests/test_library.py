"""What would be silently wrong: offsets, diffs, replies, routing, locks, runs."""

import json
import subprocess

import pytest
from pyspark.sql import functions as F

from lodestone.functions import content as C
from lodestone.functions import text as T
from lodestone.functions import verdicts as V
from lodestone.operators import locators, patches, routing, runner, sampling
from lodestone.sources import files, git_log
from lodestone.streaming.verdicts import windowed


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("a,b", [("a\nb\nc\n", "a\nx\nc\n"), ("a\n", "a\nb\n"), ("x\n" * 9, "x\n" * 8 + "y\n"), ("é\nb", "é\nc")])
def test_hunk_leads_there_and_back(a, b):
    d = patches.make_hunk("f.py", a, b)
    assert patches.apply_patch_text(a, d) == b and patches.apply_patch_text(b, d, True) == a
    assert patches.apply_patch_text("other\n", d) is None
    assert not any(line == " " for line in d.split("\n")[3:]), "the final newline is no line"


@pytest.mark.parametrize("a,b", [("a\n", "a"), ("a\nb", "a\nb\n"), ("", "a"), ("a", "")])
def test_hunk_of_the_final_newline(a, b):
    d = patches.make_hunk("f.py", a, b)
    assert d and patches.apply_patch_text(a, d) == b and patches.apply_patch_text(b, d, True) == a


def test_column_hunks_are_the_hunks(spark):
    import random

    r = random.Random(6)
    text = lambda: "\n".join(r.choice("abc") for _ in range(r.randint(0, 12))) + r.choice(["", "\n"])
    pairs = [(text(), text()) for _ in range(300)] + [("", ""), ("", "a"), ("a\n", ""), ("a", "a\n"), ("x\n" * 500, "x\n" * 501), ("é\n", "ü")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = {x.i: x.d for x in df.select("i", patches.unified_hunk(F.lit("d/f.py"), F.col("a"), F.col("b")).alias("d")).collect()}
    assert got == {i: patches.make_hunk("d/f.py", *p) for i, p in enumerate(pairs)}
    assert one(spark, patches.unified_hunk(F.lit("f"), F.lit(None).cast("string"), F.lit("a"))) is None


def test_moved_hunk_applies():
    d = patches.make_hunk("f.py", "a\nb\nc\n", "a\nx\nc\n")
    assert patches.apply_patch_text("new\nlines\n" + "a\nb\nc\n", d) == "new\nlines\na\nx\nc\n"


def test_equal_texts_have_no_hunk():
    assert patches.make_hunk("f", "a\n", "a\n") == ""


def test_excerpt_marks_and_clamps(spark):
    t = F.lit("\n".join(f"line {i}" for i in range(1, 31)))
    assert one(spark, T.excerpt(t, F.lit(2), 1)) == "     1 | line 1\n>    2 | line 2\n     3 | line 3\n"
    assert one(spark, T.excerpt(t, F.lit(99), 1)) == "    30 | line 30\n"
    assert one(spark, T.excerpt(F.repeat(F.lit("\n"), F.lit(100_001)), F.lit(100_001), 0)) == ">100001 | \n"


def test_focus_keeps_the_failure(spark):
    out = one(spark, T.focus_failure(F.lit("\n".join(["test ok"] * 80 + ["Traceback (most recent call last)", " f", "ValueError: no"]))))
    assert "ValueError: no" in out and out.count("test ok") <= 20 and "70 earlier lines of passing output omitted" in out
    assert "3 x 4" in one(spark, T.focus_failure(F.lit("  x  bad\n" + "ok\n" * 30 + "3 x 4"))) and "no recognised" not in one(spark, T.focus_failure(F.lit("  x  bad")))
    assert "no recognised failure marker" in one(spark, T.focus_failure(F.lit("a\nb")))


@pytest.mark.parametrize("work", ["/tmp/w", "/tmp/w/"])
def test_worktree_paths(spark, work):
    assert one(spark, T.strip_worktree(F.lit('at "/tmp/w/w11/src/a.py" in /tmp/w'), work, "repo")) == 'at "src/a.py" in repo'
    assert one(spark, T.strip_worktree(F.lit("in /tmp/w/w0, at /tmp/w/w0"), work, "repo")) == "in repo, at repo"


@pytest.mark.parametrize("reply,patch,error", [
    ("<<<PATCH>>>\na\n<<<END>>>\n<<<PATCH>>>\nb\n<<<END>>>", "b\n", None), ("<<<PATCH>>>\nb", None, "unclosed"), ("text", None, "missing"), ("<<<PATCH>>>\n \n<<<END>>>", None, "empty"),
])
def test_extract_patch(spark, reply, patch, error):
    p, e = T.extract_patch(F.lit(reply))
    assert (one(spark, p), one(spark, e)) == (patch, error)


def test_contract_sees_second_files(spark):
    d = F.lit("--- a/src/x.py\n+++ b/src/x.py\n@@\n--- a/tests/t.py\n+++ /dev/null\n")
    assert one(spark, T.patched_files(d)) == ["src/x.py", "tests/t.py"]
    assert one(spark, T.patched_files(F.lit("--- a/q.sql\n+++ b/q.sql\n@@\n--- drop this\n+x\n"))) == ["q.sql"]
    assert one(spark, T.in_contract(T.patched_files(d), F.lit("src/x.py"))) is False


def test_answers(spark):
    assert one(spark, T.match_answers(F.lit("2. from b\n1. from a"), 3)) == ["from a", "from b", ""]
    assert one(spark, T.match_answers(F.lit("from a\nfrom b\nfrom c"), 3)) == ["from a", "from b", "from c"]
    assert one(spark, T.match_answers(F.lit("from a\nfrom b"), 3)) == ["", "", ""]
    assert one(spark, T.match_answers(F.lit("Here you go:\nfrom a\nfrom b"), 3)) == ["", "", ""] and one(spark, T.match_answers(F.lit("Here you go:\nfrom a\nfrom b"), 2)) == ["from a", "from b"]
    assert one(spark, T.match_answers(F.lit("1. from a\n1. from b"), 2)) == ["from b", ""]


def test_prompts(spark):
    text = F.lit("Sure, here:\nheading:\r\n1. Of course it rains\n- okay then\nSurely not\n\"quoted one\"\nabc")
    assert one(spark, T.clean_prompts(text, 9)) == ["Of course it rains", "okay then", "quoted one"]


@pytest.mark.parametrize("text,after", [("7u64", "8u64"), ("1_000i32", "1001i32"), ("0", "1"), ("0099", "100"), ("9" * 45, "1" + "0" * 45), ("1" * 44 + "9u8", "1" * 43 + "20u8"), ("1.5", None), ("0xFF", None), ("1e9", None)])
def test_bump_int(spark, text, after):
    assert one(spark, T.bump_int(F.lit(text))) == after == locators._bumped(text)


def test_splices(spark):
    data = F.lit("0123456789").cast("binary")
    a, b = (F.lit(2), F.lit(4), F.lit("X")), (F.lit(6), F.lit(7), F.lit("YY"))
    for x, y in ((a, b), (b, a)):
        assert one(spark, C.splice_two(data, x, y).cast("string")) == "01X45YY789"
    assert one(spark, C.splice_two(data, a, (F.lit(3), F.lit(5), F.lit("Z")))) is None


def test_trial_id_is_a_content_address(spark):
    import hashlib

    want = hashlib.sha256(b"ab" + b"off_by_one" + (300).to_bytes(8, "little") + (302).to_bytes(8, "little") + b"7").hexdigest()[:16]
    assert one(spark, C.trial_id(F.lit("ab"), F.lit("off_by_one"), F.lit(300), F.lit(302), F.lit("7"))) == want


def test_python_sites_count_bytes():
    src = "s = 'é'; y = a < b\n".encode()
    (site,), refused, error = locators.python_sites(src)
    assert src[site["start_byte"] : site["end_byte"]] == b"<" and site["after"] == "<=" and (refused, error) == (0, None)
    assert locators.python_sites(b"\xff")[2] and locators.python_sites(b"def (")[2]


def test_rust_sites_leave_generics_and_tests_alone():
    src = b"fn f(x: Vec<u8>) -> bool { x.len() < 3 }\n#[cfg(test)]\nmod t { fn g() { let a = 1 < 2; } }\n"
    sites, _, _, excluded = locators.rust_sites(src)
    assert [(s["operator"], s["before"], s["scope"]) for s in sites] == [("compare_flip", "<", "f"), ("off_by_one", "3", "f")] and excluded > 30


def test_statement_edits_take_whole_lines():
    src = b"def f(x):\n    if x:\n        return 1\n    try:\n        g()\n    except E:\n        log(x)\n    return x\n"
    got = {(s["operator"], s["before"], s["after"], s["line"]) for s in locators.python_sites(src)[0]}
    assert ("guard_drop", "    if x:\n        return 1", "    pass", 2) in got and ("except_swallow", "        log(x)", "        pass", 7) in got and ("return_none", "    return x", "    return None", 8) in got


def test_gates(spark):
    from lodestone.operators import gates

    runs = spark.createDataFrame([("a", 0, 0, 10), ("b", 1, 1, 10), ("c", 2, 124, 10), ("d", 3, 127, 5)], "grader string, ord int, exit_code int, elapsed_ms bigint")
    measured = gates.baseline(runs)
    assert tuple(gates.baseline_verdict(measured).first()) == (False, ["d"], ["b (tests failed)", "c (timed out)"], 35)
    with pytest.raises(RuntimeError, match="could not be executed: d"):
        gates.require_green(measured)
    with pytest.raises(RuntimeError, match="b \\(tests failed\\), c"):
        gates.require_green(measured.where("grader <> 'd'"))
    gates.require_green(measured.where("grader = 'a'"))
    graders = spark.createDataFrame([("a", True), ("b", False)], "name string, hermetic boolean")
    assert [r.name for r in gates.usable_graders(graders, True).collect()] == ["a"] and gates.usable_graders(graders, False, graders.where("name = 'b'")).count() == 1
    scores = spark.createDataFrame([("SOLVED",), ("MISSED",)], "score string")
    for bad in (scores, scores.limit(0)):
        with pytest.raises(RuntimeError):
            gates.require_oracle(bad)
    gates.require_oracle(scores.where("score = 'SOLVED'"))


def test_baseline_runs_every_grader(spark):
    import sys

    trees = spark.createDataFrame([("t", p, [("m.py", b"x = 1\n")]) for p in ("baseline", "mutated")], "subject_id string, phase string, files array<struct<path:string,content:binary>>")
    graders = [(n, [sys.executable, "-c", code], {}) for n, code in (("one", "1/0"), ("two", "pass"), ("three", "1/0"))]
    got = runner.run_graders(trees, graders, {n: 20000 for n in ("one", "two", "three")}).collect()
    assert [(r.phase, r.grader, r.exit_code) for r in got] == [("baseline", "one", 1), ("baseline", "two", 0), ("baseline", "three", 1), ("mutated", "one", 1)]


def test_splitmix_is_addressed(spark):
    got = [r.x for r in spark.range(6).select(sampling.splitmix_below(42, F.col("id"), 1000).alias("x")).collect()]
    assert got == [sampling.splitmix64(42, i) % 1000 for i in range(6)] and len(set(got)) > 3


def test_routing_first_rule_wins(spark):
    rules = spark.createDataFrame([(0, "a", ["ghost"]), (1, "a", ["two"])], "ord int, needle string, names array<string>")
    graders = spark.createDataFrame([(0, "one", False), (1, "two", False), (2, "slow", True)], "ord int, name string, slow boolean")
    out = routing.route(spark.createDataFrame([("xa",), ("b",)], "file string"), rules, graders)
    assert {r.file: r.graders for r in out.collect()} == {"xa": ["two"], "b": ["one", "two"]}


def test_claim(tmp_path):
    with files.claim(str(tmp_path)):
        with pytest.raises(RuntimeError, match="--force"), files.claim(str(tmp_path)):
            pass
        with files.claim(str(tmp_path), force=True):
            pass
    with files.claim(str(tmp_path)):
        pass


def test_corpus_is_strict_and_idempotent(spark, tmp_path):
    path = f"file://{tmp_path}/c"
    rows = spark.createDataFrame([("1", "p"), ("2", "q")], "id string, prompt string")
    files.write_corpus(rows, path)
    files.write_corpus(rows, path, append=True)
    assert files.read_corpus(spark, path).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"id":"1"}\n{broken\n')
    with pytest.raises(Exception):
        files.read_corpus(spark, f"file://{tmp_path}/bad.jsonl").collect()


def test_scan_skips(spark, tmp_path):
    for p in ("a.py", "tests/b.py", ".x/c.py", "d/e.py", "d/f.txt", "gen/g.py"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text("x = 1\n")
    got = files.scan(spark, f"file://{tmp_path}", "py", exclude=("/gen/",))
    assert sorted(r.file for r in got.collect()) == ["a.py", "d/e.py"]


def test_git_log(spark, tmp_path):
    def git(*a):
        subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)

    git("init", "-q")
    for i in range(3):
        (tmp_path / "f.py").write_text(f"x = {i}\n")
        git("add", ".")
        git("commit", "-qm", f"c{i}")
    spark.dataSource.register(git_log.GitLog)
    rows = spark.read.format("git_log").option("repo", str(tmp_path)).load().orderBy("ord").collect()
    assert [(r.subject, r.touched) for r in rows] == [("c2", ["f.py"]), ("c1", ["f.py"])]
    assert git_log.file_at(str(tmp_path), rows[0].parent, "f.py") == "x = 1\n"


def test_runner_and_verdicts(spark):
    tree = lambda x: [("m.py", f"x = {x}\n".encode())]
    trees = spark.createDataFrame([("good", "mutated", tree(1)), ("bad", "mutated", tree(2))], "subject_id string, phase string, files array<struct<path:string,content:binary>>")
    import sys

    graders = [("unit", [sys.executable, "-c", "import m; assert m.x == 1"], {"PYTHONPATH": "{REPO}"})]
    runs = runner.run_graders(trees, graders, {"unit": 20000})
    got = V.grade(runs.withColumn("class", V.run_class(F.col("exit_code"), F.col("elapsed_ms")))).collect()
    assert {r.subject_id: r.verdict for r in got} == {"good": "SURVIVED", "bad": "FAILED"}
    assert runner.run_one("/tmp", ["/no/such/program"], {}, 1000)[0] == 127
    assert runner.run_one("/tmp", [sys.executable, "-c", "import time; time.sleep(30)"], {}, 1000)[0] == 124


def test_stream_of_verdicts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"ts": f"2026-01-01 0{h}:10:00", "id": f"{h}{i % 2}", "operator": "o", "verdict": "FAILED"} for h in (1, 2, 5) for i in range(3)]
    (tmp_path / "in/a.json").write_text("\n".join(map(json.dumps, rows)))
    stream = spark.readStream.schema("ts timestamp, id string, operator string, verdict string").json(f"file://{tmp_path}/in")
    q = windowed(stream).writeStream.outputMode("append").format("memory").queryName("v").option("checkpointLocation", f"file://{tmp_path}/ck").start()
    q.processAllAvailable()
    q.stop()
    assert {(str(r.start)[11:13], r.n) for r in spark.table("v").collect()} == {("01", 2), ("02", 2)}


def test_cross_file_draws_cover_all_pairs(spark):
    rows = spark.range(5000).select((F.col("id") * 7 % 5000).alias("id"), F.lit("x").alias("b_id")).repartition(3)
    got = sorted(r.id for r in sampling.cross_file_draws(rows, 42, ["id"]).collect())
    assert got == [i for i in range(5000) if sampling.splitmix64(42, i) % 4 == 0]


def test_cross_file_sample_takes_all_trials(spark):
    from lodestone.plans import adapters, sampling_queries

    trials = {r.id: r.file for r in adapters.trials(spark, "/root/testdata/sf0.01").select("id", "file").collect()}
    pairs = [i for i in sorted(trials) if i + 1 in trials and trials[i] != trials[i + 1]]
    got = sorted(r.id for r in sampling_queries.cross_file_sample(spark, "/root/testdata/sf0.01").collect())
    assert len(trials) > 2000 and got == [i for n, i in enumerate(pairs) if sampling.splitmix64(42, n) % 4 == 0]
