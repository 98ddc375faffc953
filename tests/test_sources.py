"""Sources: pruned trees, ranges of a log, lines with numbers, locators by program."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from lodestone.operators import locators, rows
from lodestone.sources import files, git_log, source_tree

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_skipped_folders_are_never_listed(spark, tmp_path, monkeypatch):
    kept = [f"{a}/{b}/f{i}.py" for a in "cab" for b in "xy" for i in (2, 10, 1)] + ["z.py", "a.py"]
    for p in [*kept, "node_modules/m/k.py", "a/tests/t.py", "a/.git/o.py", "a/n.txt", "gen/g.py"]:
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text(p)
    listed = []
    own = source_tree._Reader.entries
    monkeypatch.setattr(source_tree._Reader, "entries", lambda self, fs, folder: listed.append(folder) or own(self, fs, folder))
    reader = source_tree._Reader({"root": f"file://{tmp_path}", "extension": "py", "exclude": "/gen/", "partitions": "3"})
    got = [x for part in reader.partitions() for x in reader.read(part)]
    assert [f for f, _ in got] == sorted(kept, key=lambda p: p.split("/")) and all(c == f.encode() for f, c in got)
    assert not [x for x in listed if "node_modules" in x or "tests" in x or ".git" in x]
    monkeypatch.undo()
    assert [r.file for r in files.scan(spark, f"file://{tmp_path}", "py", ("/gen/",)).collect()] == [f for f, _ in got]
    assert files.scan(spark, f"file://{tmp_path}/none", "py").count() == 0


@pytest.fixture(scope="module")
def repo(tmp_path_factory):
    path = tmp_path_factory.mktemp("repo")

    def git(*a):
        subprocess.run(["git", "-C", str(path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)

    git("init", "-q")
    for i in range(12):
        name = ("src/a.py", "docs/d.md", "src/b.txt")[i % 3]
        (path / name).parent.mkdir(exist_ok=True)
        (path / name).write_text(f"{i}\n")
        git("add", ".")
        git("commit", "-qm", f"c{i}")
    return str(path)


def test_log_in_ranges(spark, repo, monkeypatch):
    spark.dataSource.register(git_log.GitLog)
    whole = spark.read.format("git_log").option("repo", repo).option("partitions", 5).load()
    assert [r.subject for r in whole.orderBy("ord").collect()] == [f"c{i}" for i in range(11, 0, -1)]
    got = git_log.candidates(spark, repo, ("src/",), "py", 2).collect()
    assert [(r.ord, r.subject, r.touched) for r in got] == [(2, "c9", ["src/a.py"]), (5, "c6", ["src/a.py"])]
    # no commit behind the newest eight is listed
    reader = git_log._Reader({"repo": repo, "sources": "src/", "extension": "py", "newest": "8"})
    asked = []
    monkeypatch.setattr(reader, "touched", lambda sha: asked.append(sha) or [])
    assert [x for p in reader.partitions() for x in reader.read(p)] == [] and len(asked) == 8


def test_filters_on_the_order_are_ranges(spark, repo):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    reader = git_log._RangeReader({"repo": repo})
    left = list(reader.pushFilters([LessThan(("ord",), 7), GreaterThanOrEqual(("ord",), 3), EqualTo(("subject",), "c7")]))
    assert [type(f) for f in left] == [EqualTo] and (reader.low, reader.high) == (3, 7)
    assert [r[3] for p in reader.partitions() for r in reader.read(p)] == ["c8", "c7", "c6", "c5"]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        rows = git_log.commits(spark, repo).where("ord < 2").collect()
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert sorted(r.subject for r in rows) == ["c10", "c11"]


def test_a_commit_that_cannot_be_listed_has_no_files(repo):
    assert git_log._Reader({"repo": repo}).touched("0" * 40) == []


def test_bad_lines_are_named(spark, tmp_path):
    lines = [json.dumps({"id": str(i), "prompt": "p" * 50, "line": i}) for i in range(2000)]
    lines[700], lines[1500], lines[900] = '{"id": broken', '{"id":"x","line":"not a number"}', ""
    (tmp_path / "c.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "d.jsonl").write_text('{"id":"1"}\n\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {(r.file.rsplit("/", 1)[1], r.line) for r in files.bad_lines(spark, f"file://{tmp_path}").collect()}
        assert got == {("c.jsonl", 701), ("c.jsonl", 1501)}
        with pytest.raises(ValueError, match="c.jsonl line 701"):
            files.read_corpus(spark, f"file://{tmp_path}")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert files.read_corpus(spark, f"file://{tmp_path}/d.jsonl").count() == 1


def test_transcripts_grow_and_keep_nulls(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for i in range(2):
        files.append_transcript(spark.createDataFrame([(str(i), "o", "f", 1, "m", "p", "c", None)], files.TRANSCRIPT), path)
    got = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(got) == 2 and all(x["reasoning"] is None and set(x) == {c.split()[0] for c in files.TRANSCRIPT.split(", ")} for x in got)


def test_trials_are_written_in_order(spark, tmp_path):
    made = spark.createDataFrame([(str(i), f"f{i % 3}", "SURVIVED", i * 7 % 10, 0, "s", "t", 1) for i in range(30)], "id string, file string, verdict string, line int, start_byte int, suite string, tail string, limit_ms int")
    files.write_trials(made, f"file://{tmp_path}/t")
    got = [json.loads(x) for p in sorted((tmp_path / "t").glob("part-*")) for x in p.read_text().splitlines()]
    assert [x["file"] for x in got] == sorted(x["file"] for x in got) and len(got) == 30


@pytest.mark.parametrize("language,source", [("python", "# é\ndef f(x):\n    return x < 3\n"), ("rust", "fn f(x: u8)->bool{x<3}\n#[cfg(test)]\nmod t { }\n")])
def test_a_locator_by_program_finds_the_same(spark, language, source):
    made = spark.createDataFrame([("src/a." + language[:2].replace("ru", "rs"), source.encode()), ("src/bad." + language[:2].replace("ru", "rs"), b"(((")], "file string, content binary").coalesce(1)
    program = [sys.executable, "-c", f"import sys; sys.path.insert(0, {ROOT!r}); from lodestone.operators import locators; locators.main(sys.argv[1:])", "{FILE}"]
    key = lambda df: sorted((r.file, r.sha256, r.candidates, r.refused, r.error, r.excluded_test_bytes) for r in df.collect())
    assert key(locators.locate_by(made, program)) == key(locators.locate(made, language))
    failed = locators.locate_by(made, ["sh", "-c", "echo first >&2; echo last words >&2; exit 3"]).collect()
    assert {r.error for r in failed} == {"locator exited 3: last words"}
    assert all(r.error.startswith("locator emitted unparseable JSON") for r in locators.locate_by(made, ["echo", "{FILE}"]).collect())
    assert all(r.error.startswith("spawn") for r in locators.locate_by(made, ["/no/such/program"]).collect())
    assert locators.locate(made, language, contains="bad").count() == 1


def test_a_file_that_moved_makes_no_row(spark):
    trials = spark.createDataFrame([("1", "a.py", "o", "silent", 4, 5, "2", 1, "", "FAILED", "s", "t", 1, "1"), ("2", "a.py", "o", "silent", 0, 1, "y", 1, "", "FAILED", "s", "t", 1, "z")],
        "id string, file string, operator string, severity string, start_byte bigint, end_byte bigint, after string, line bigint, scope string, verdict string, suite string, tail string, limit_ms bigint, before string")
    good, aborted = rows.corpus_rows(trials, spark.createDataFrame([("a.py", b"x = 1\n")], "file string, content binary"), "c", "r", "/w")
    assert [r.id for r in good.collect()] == ["1"] and [r.reason for r in aborted.select(F.col("reason")).collect()] == ["span no longer matches the locator's `before`"]
