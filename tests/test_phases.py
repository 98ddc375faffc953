"""Campaigns, history and scoring by real runs: resumed, flaky, moved and missing."""

import pytest

from lodestone.operators import campaign, gates, locators, replay, runner
from lodestone.operators.campaign import Grader, Target

SOURCE = b"def f(x):\n    if x < 3:\n        return x + 7\n    return x\n"
FILES = "array<struct<path:string,content:binary>>"


def shell(name, script, **more):
    return Grader(name, ("sh", "-c", script), **more)


@pytest.fixture
def sources(spark):
    return spark.createDataFrame([("src/a.py", SOURCE)], "file string, content binary")


def test_campaign_resumes_and_reports(spark, sources, tmp_path):
    log = tmp_path / "log"
    target = Target((shell("fast", f"echo run >> {log}; ! grep -q '<=' src/a.py"), shell("port", "exit 1", hermetic=False)))
    folder, told = f"file://{tmp_path}/runs", []
    for _ in range(2):
        trials, aborted, totals = campaign.campaign(locators.locate(sources), sources, target, (("src/a.py", SOURCE),), folder, batches=3, progress=lambda *x: told.append(x))
        got = {(r.operator, r.line): (r.verdict, r.suite, r.graders) for r in trials.collect()}
        assert got["compare_flip", 2] == ("FAILED", "fast", ["fast"]) and sum(v == "SURVIVED" for v, _, _ in got.values()) == len(got) - 1 == 6
        assert aborted.count() == 0 and (totals.first().candidates, totals.first().killed) == (7, 1)
    # the baseline, seven trials and one confirmation, once each
    assert log.read_text().count("run") == 9 and told == [(1, 3), (2, 3), (3, 3)] * 2


def test_a_suite_that_is_red_without_the_edit_is_flaky(spark, sources, tmp_path):
    # green once, then red whatever the tree holds
    target = Target((shell("moody", f"test ! -e {tmp_path}/seen && touch {tmp_path}/seen"),))
    trials, _, _ = campaign.campaign(locators.locate(sources), sources, target, (("src/a.py", SOURCE),), f"file://{tmp_path}/runs", limit=3)
    assert {r.verdict for r in trials.collect()} == {"FLAKY"}


def test_a_red_baseline_stops_a_campaign(spark, sources, tmp_path):
    with pytest.raises(RuntimeError, match="not green.*bad"):
        campaign.campaign(locators.locate(sources), sources, Target((shell("bad", "exit 1"),)), (("src/a.py", SOURCE),), f"file://{tmp_path}/runs")
    with pytest.raises(RuntimeError, match="no candidates"):
        campaign.campaign(locators.locate(sources.limit(0)), sources, Target((shell("ok", "true"),)), (), f"file://{tmp_path}/more")


def test_graders_that_cannot_run_abort_trials(spark, sources, tmp_path):
    # there for the baseline, gone afterwards
    tool = tmp_path / "tool"
    tool.write_text(f"#!/bin/sh\nrm {tool}\n")
    tool.chmod(0o755)
    trials, aborted, totals = campaign.campaign(locators.locate(sources), sources, Target((Grader("tool", (str(tool),)),)), (("src/a.py", SOURCE),), f"file://{tmp_path}/runs")
    assert trials.count() == 0 and {r.reason for r in aborted.collect()} == {"could not be executed: tool"} and totals.first().aborted == 7


def test_moved_sites_are_reported(spark, sources):
    sites = locators.sites_of(locators.locate(sources))
    moved = spark.createDataFrame([("src/a.py", b"# moved\n" + SOURCE)], "file string, content binary")
    good, aborted = campaign.guarded(sites, moved)
    assert good.count() == 0 and {r.reason for r in aborted.collect()} == {campaign.MOVED}
    assert {r.reason for r in campaign.guarded(sites, moved.limit(0))[1].collect()} == {campaign.GONE}
    assert campaign.guarded(sites, sources)[1].count() == 0


def test_subjects_do_not_meet_each_others_leftovers(spark):
    rows = [(str(i), "mutated", [("a.txt", b"edit"), ("new.txt", b"x")] if i % 2 else [], ["dirty", "clean"]) for i in range(6)]
    subjects = spark.createDataFrame(rows, f"subject_id string, phase string, files {FILES}, graders array<string>").coalesce(1)
    graders = [("dirty", ["sh", "-c", "test ! -e left && touch left && echo more >> b.txt"], {}), ("clean", ["sh", "-c", "grep -qx good b.txt; test $(wc -l < b.txt) = 2"], {})]
    got = runner.run_subjects(subjects, graders, {"dirty": 9000, "clean": 9000}, (("a.txt", b"a\n"), ("b.txt", b"good\n"))).collect()
    assert len(got) == 12 and {r.exit_code for r in got} == {0}


def test_history_phases(spark, tmp_path):
    script = ("t.sh", b"! grep -q bad m.txt\n")
    trees = [("g", [("m.txt", b"fine"), ("tests/t.sh", script[1])]), ("r", [("m.txt", b"bad"), ("tests/t.sh", script[1])]), ("n", [("m.txt", b"bad")])]
    commits = [("g", "r", ["m.txt"]), ("r", "g", ["m.txt"]), ("r2", "r", ["m.txt"]), ("x", "n", ["m.txt"]), ("y", "lost", ["m.txt"])]
    trees.append(("r2", trees[1][1]))
    target = Target((Grader("suite", ("sh", "tests/t.sh")),))
    made = spark.createDataFrame(commits, "sha string, parent string, touched array<string>"), spark.createDataFrame(trees, f"sha string, files {FILES}")
    folder = f"file://{tmp_path}/runs"
    got = {r.sha: (r.outcome, r.suite, r.absent) for r in replay.history(*made, target, {"suite": 9000}, folder).collect()}
    assert got == {"g": ("FIXED", "suite", None), "r": ("GREEN-BEFORE", None, None), "r2": ("STILL-RED", "suite", None), "x": ("NO-GRADER-YET", None, ["suite"]), "y": ("UNRUNNABLE", None, None)}
    # a commit is run only behind a red parent
    assert {r.subject_id for r in runner.Runs(spark, folder).table().where("phase = 'commit'").collect()} == {"g", "r2"}


def test_touched_files_of_a_target(spark):
    commits = spark.createDataFrame([("a", ["src/x.py", "docs/x.py", "src/y.txt"]), ("b", ["docs/z.py"])], "sha string, touched array<string>")
    assert [(r.sha, r.touched) for r in replay.touched_by(commits, ("src/",), "py").collect()] == [("a", ["src/x.py"])]


def test_responders_test_the_scoring(spark, tmp_path):
    fixed, broken = "a = 1\nb = 2\n", "a = 1\nb = 3\n"
    diff = "--- a/m.py\n+++ b/m.py\n@@ -1,2 +1,2 @@\n a = 1\n-b = 3\n+b = 2\n"
    rows = spark.createDataFrame([("1", "m.py", f"<<<PATCH>>>\n{diff}<<<END>>>\n")], "id string, file string, completion string")
    pristine, tree = spark.createDataFrame([("m.py", fixed.encode())], "file string, content binary"), (("m.py", fixed.encode()),)
    assert broken != fixed
    target = Target((shell("unit", "grep -q 'b = 2' m.py"),))
    got = {(r.responder, r.score, r.n) for r in replay.responders_hold(rows, pristine, target, {"unit": 9000}, f"file://{tmp_path}/runs", tree).collect()}
    assert got == {("oracle", "SOLVED", 1), ("null", "MALFORMED", 1), ("cheat", "CHEATED", 1)}
    # a suite that never sees the defect makes the row, not the reply, at fault
    with pytest.raises(RuntimeError, match="solved 0 of 1"):
        replay.responders_hold(rows, pristine, Target((shell("blind", "true"),)), {"blind": 9000}, f"file://{tmp_path}/blind", tree)
    with pytest.raises(RuntimeError, match="zero rows"):
        replay.require_yield(rows.limit(0))


def test_graders_by_name(spark):
    assert runner.script_of(["python3", "tests/a.py"]) == "tests/a.py" and runner.script_of(["/bin/make", "test"]) is None
    g = Target((shell("a", "true"), shell("b", "true", hermetic=False)))
    assert [x.name for x in g.usable(True)] == ["a"] and len(g.usable(False)) == 2
    assert gates.NULL_REPLY


def test_commits_of_equal_trees_share_a_run(spark, tmp_path):
    log = tmp_path / "log"
    script = ("tests/t.sh", f"echo run >> {log}; ! grep -q bad m.txt\n".encode())
    trees = [(str(i), [("m.txt", b"bad" if i % 2 else b"fine"), script]) for i in range(20)]
    commits = [(str(i), str(i - 1), ["m.txt"]) for i in range(1, 20)]
    made = spark.createDataFrame(commits, "sha string, parent string, touched array<string>"), spark.createDataFrame(trees, f"sha string, files {FILES}")
    target = Target((Grader("suite", ("sh", "tests/t.sh")),))
    got = {r.sha: r.outcome for r in replay.history(*made, target, {"suite": 9000}, f"file://{tmp_path}/runs").collect()}
    assert got == {str(i): "GREEN-BEFORE" if i % 2 else "FIXED" for i in range(1, 20)}
    # two trees as parents, and the good one as a commit behind the bad
    assert log.read_text().count("run") == 3


def test_scored_rows_do_not_carry_their_files(spark, tmp_path, monkeypatch):
    held, real = [], replay.materialised
    monkeypatch.setattr(replay, "materialised", lambda df, name: held.append(real(df, name)) or held[-1])
    lines = [f"line {i}\n" for i in range(20_000)]
    text = "".join(lines).encode()
    hunk = lambda i, old, new: f"--- a/m.py\n+++ b/m.py\n@@ -{i},2 +{i},2 @@\n {lines[i - 1]}-{old}\n+{new}\n"
    block = lambda d: f"<<<PATCH>>>\n{d}<<<END>>>\n"
    rows = [(str(i), "m.py", block(hunk(i, "bad", f"line {i}")), block(hunk(i, "bad", f"line {i}" if i % 2 else "bad too"))) for i in range(1, 20)]
    rows.append(("x", "n.py", block(hunk(1, "bad", "line 1")), ""))
    for tree in ((("m.py", text),), ()):
        folder = f"file://{tmp_path}/runs-{len(tree)}"
        held.clear()
        made = spark.createDataFrame(rows, "id string, file string, completion string, reply string"), spark.createDataFrame([("m.py", text)], "file string, content binary")
        out = replay.score(*made, Target((shell("unit", "! grep -q bad m.py"),)), {"unit": 9000}, folder, tree)
        got = {r.id: (r.score, r.suite) for r in out.collect()}
        assert got == {str(i): ("SOLVED", None) if i % 2 else ("MISSED", "unit") for i in range(1, 20)} | {"x": ("MALFORMED", None)}
        assert len(held) == 2 and all(f.where("pristine is not null").isEmpty() == bool(tree) for f in held)


def test_suites_that_judge_lines_share_runs_and_scores_stay(spark, tmp_path):
    text = lambda k: "".join(f"def f{k}_{i}():\n    return {i}\n" for i in range(40))
    files = {f"m{k}.py": text(k).encode() for k in range(3)}
    hunk = lambda k, i, old, new: f"--- a/m{k}.py\n+++ b/m{k}.py\n@@ -1,2 +1,2 @@\n def f{k}_{i}():\n-{old}\n+{new}\n"
    block = lambda d: f"<<<PATCH>>>\n{d}<<<END>>>\n"
    replies = ("    return {i}", "    return bad", "    return 1", None)
    rows = []
    for k in range(3):
        for i in range(40):
            good, reply = f"    return {i}", replies[i % 4]
            rows.append((f"{k}-{i}", f"m{k}.py", block(hunk(k, i, "    bad" if i % 5 else "    dull", good)), "no" if reply is None else block(hunk(k, i, "    bad", reply.format(i=i)))))
    rows.append(("lost", "n.py", block(hunk(0, 1, "    bad", "    return 1")), "no"))
    made = spark.createDataFrame(rows, "id string, file string, completion string, reply string"), spark.createDataFrame(list(files.items()), "file string, content binary")
    log, tree = tmp_path / "log", (*files.items(), ("tests/a.sh", b"! grep -q never *.py\n"))
    got, runs = {}, {}
    for name, lines, more in (("trees", False, ()), ("lines", True, ()), ("red", True, (("old.py", b"bad\n"),))):
        log.write_text("")
        suites = (Grader("a", ("sh", "tests/a.sh"), lines=lines), shell("b", f"echo run >> {log}; ! grep -q bad *.py", lines=lines))
        out = replay.score(*made, Target(suites), {"a": 9000, "b": 9000}, f"file://{tmp_path}/runs-{name}", (*tree, *more)).collect()
        got[name], runs[name] = {r.id: (r.score, r.suite, r.why) for r in out}, log.read_text().count("run")
    assert got["lines"] == got["trees"] and {s for s, _, _ in got["trees"].values()} == {"SOLVED", "MISSED", "MALFORMED", "BAD-ROW"}
    # broken: the clean tree, and two kinds of lines in each of three files; repaired: none and two kinds
    assert runs["lines"] <= 1 + 6 + 9 < 100 < runs["trees"]
    # a suite that is red on the clean tree is run on every row's whole tree
    assert runs["red"] > 100 and {s for s, _, _ in got["red"].values()} == {"MISSED", "MALFORMED"}


def test_diffs_are_applied_by_where_lines_stand():
    import random

    from lodestone.operators import patches

    draw, tried = random.Random(7), 0
    for _ in range(2000):
        lines = [draw.choice("abc\n").strip() + "\n" for _ in range(draw.randint(0, 9))]
        other = lambda x: [draw.choice("abz") + "\n" if draw.random() < 0.2 else s for s in x if draw.random() < 0.9]
        one, two = other(lines), other(other(lines))
        first, second = (patches.make_hunk("f", "".join(x), "".join(y)) for x, y in ((one, lines), (one, two)))
        text = patches.Text("".join(lines))
        want, got = patches.apply_lines(lines, first, True), text.apply(first, True)
        assert (got is None) == (want is None) and (want is None or text.lines(got) == want)
        if want is not None:
            want, got = patches.apply_lines(want, second), text.apply(second, pieces=got)
            assert (got is None) == (want is None)
            if want is not None:
                tried += 1
                assert text.lines(got) == want and text.fresh(got) == "".join(s for s in want if s not in lines)
    assert tried > 500


def test_trials_carry_no_files_and_tasks_read_the_tree_from_broadcasts(spark, tmp_path, monkeypatch):
    held, real = [], runner.materialised
    monkeypatch.setattr(runner, "materialised", lambda df, name: held.append(real(df, name)) or held[-1])
    source = "".join(f"def f_{i}(x):\n    if x < 3:\n        return 'é', x + {i}\n    return x\n" for i in range(50)).encode()
    files = spark.createDataFrame([("src/a.py", source), ("src/b.py", SOURCE)], "file string, content binary")
    target, got = Target((shell("fast", "! grep -q '<=' src/*.py"), shell("core", "! grep -qs 'return None' src/a.py"))), []
    with runner.shipped(files) as sent:
        assert sorted(path for path, _ in sent) == ["src/a.py", "src/b.py"] and not any(isinstance(content, bytes) for _, content in sent)
        for i, tree in enumerate((sent, (("src/a.py", source), ("src/b.py", SOURCE)), (("src/b.py", SOURCE),))):
            held.clear()
            trials, _, _ = campaign.campaign(locators.locate(files), files, target, tree, f"file://{tmp_path}/runs-{i}", limit=20)
            got.append(sorted((r.file, r.operator, r.start_byte, r.verdict, r.suite or "") for r in trials.collect()))
            todo = [f for f in held if "splices" in f.columns]
            # only files that aren't in the tree are carried, and they alone
            assert len(todo) == 1 and todo[0].where("size(files) = 0 and size(splices) = 1").count() == (20, 20, 7)[i]
    assert got[0] == got[1] == got[2] and {(v, s) for _, _, _, v, s in got[0]} == {("FAILED", "fast"), ("FAILED", "core"), ("SURVIVED", "")}
