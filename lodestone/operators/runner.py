"""The one producer with side effects: runs graders on edited trees inside tasks and yields the table of runs.

A tree is (path, content) in order. Contents are bytes, or broadcasts of bytes (``shipped``), which executors hold once for all their tasks and a task reads
one at a time.

Rows (subject_id, phase, files) hold whole trees as (path, content); each task writes one to a temporary folder of its own, runs
the graders in order until the first that isn't ok (all of them in the baseline), and removes it. Materialise the result before use, so that no suite
runs twice, and keep speculation off.
"""

from __future__ import annotations

import contextlib
import os
import shutil
import signal
import subprocess
import sys
import tempfile
import time
from collections.abc import Callable, Iterator

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import patches
from lodestone.sources.files import materialised

RUNS = "subject_id string, phase string, grader string, ord int, exit_code int, elapsed_ms bigint, output string"
TAIL = 60_001


def run_one(folder: str, argv: list[str], env: dict[str, str], deadline_ms: int) -> tuple[int, int, str]:
    """(exit code, milliseconds, output): 124 beyond the deadline, 127 where the program can't be found, 126 where it can't
    be run."""
    began = time.monotonic()
    filled = {k: v.replace("{REPO}", folder) for k, v in env.items()}
    try:
        p = subprocess.Popen([a.replace("{REPO}", folder) for a in argv], cwd=folder, env=os.environ | filled, stdin=subprocess.DEVNULL, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, start_new_session=True)
    except FileNotFoundError as e:
        return 127, 0, f"{e.filename} was not found on PATH"
    except PermissionError as e:
        return 126, 0, str(e)
    try:
        out, _ = p.communicate(timeout=max(1, -(-deadline_ms // 1000)))
        code = p.returncode
    except subprocess.TimeoutExpired:
        os.killpg(p.pid, signal.SIGKILL)
        out, _ = p.communicate()
        code = 124
    return code, int((time.monotonic() - began) * 1000), out.decode("utf-8", "replace").rstrip()[-TAIL:]


def run_graders(trees: DataFrame, graders: list[tuple[str, list[str], dict[str, str]]], deadlines: dict[str, int]) -> DataFrame:
    """Runs of graders (name, argv, env) over trees (subject_id, phase, files array<struct<path, content>>). The baseline runs
    all of them, so that every red one can be named."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for subject, phase, files in zip(pdf["subject_id"], pdf["phase"], pdf["files"], strict=True):
                folder, rows = tempfile.mkdtemp(prefix="tree-"), []
                try:
                    for f in files:
                        path = os.path.join(folder, f["path"])
                        os.makedirs(os.path.dirname(path), exist_ok=True)
                        with open(path, "wb") as w:
                            w.write(bytes(f["content"]))
                    for i, (name, argv, env) in enumerate(graders):
                        code, ms, out = run_one(folder, argv, env, deadlines.get(name, 3000))
                        rows.append((subject, phase, name, i, code, ms, out))
                        if code and phase != "baseline":
                            break
                finally:
                    shutil.rmtree(folder, ignore_errors=True)
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in RUNS.split(", ")])

    return trees.select("subject_id", "phase", "files").mapInPandas(run, RUNS)


Tree = tuple[tuple[str, bytes | Broadcast], ...]


@contextlib.contextmanager
def shipped(files: DataFrame) -> Iterator[Tree]:
    """Files (file, content) as a tree of broadcasts, as long as it is needed. They pass the driver one partition at a time."""
    files, tree = files.select("file", "content"), []
    try:
        for r in files.toLocalIterator():
            tree.append((r.file, files.sparkSession.sparkContext.broadcast(bytes(r.content))))
        yield tuple(tree)
    finally:
        for _, sent in tree:
            sent.destroy()


def _bytes(content: bytes | Broadcast) -> bytes:
    """A content of a tree. A broadcast would keep what it has read as long as its worker lives, so it is read past it, where it is a file."""
    if isinstance(content, bytes):
        return content
    path = getattr(content, "_path", None)
    return content.load_from_path(path) if path else content.value


def script_of(argv: list[str]) -> str | None:
    """The script that a grader runs: the first argument with a slash. A grader without one counts as present everywhere."""
    return next((a for a in argv[1:] if "/" in a), None)


def _write(folder: str, path: str, content: bytes) -> None:
    full = os.path.join(folder, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "wb") as w:
        w.write(content)


def _listing(folder: str) -> dict[str, tuple[int, int]]:
    """What is in a tree, without byte code: path to size and time."""
    out = {}
    for at, names, found in os.walk(folder):
        names[:] = [n for n in names if n != "__pycache__"]
        for f in found:
            s = os.stat(os.path.join(at, f))
            out[os.path.relpath(os.path.join(at, f), folder)] = (s.st_size, s.st_mtime_ns)
    return out


def run_subjects(subjects: DataFrame, graders: list[tuple[str, list[str], dict[str, str]]], deadlines: dict[str, int], tree: Tree = (), absent: bool = False) -> DataFrame:
    """Runs of subjects (subject_id, phase, files, graders): ``files`` lie over the common ``tree``, and ``graders`` are names in
    order. A column ``edits`` (path, diff, reverse) or ``splices`` (path, start, end, after) is applied to what then lies there, so that subjects of a large
    file carry what they change alone.
    A task writes the tree once and takes each subject's files back; a tree that a suite has changed is made anew, so no subject
    meets another's leftovers. With ``absent``, a grader whose script isn't in the tree gets a row without an exit code and is passed over."""
    by = {name: (argv, env) for name, argv, env in graders}
    own = dict(tree)
    edited = [c for c in ("edits", "splices") if c in subjects.columns]

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        folder, clean, lines = None, None, ("", [])  # lines: of the file that was edited last

        def restored(before: dict, paths) -> dict:
            """What the tree must hold to be used again: all as before, but for the times of the files that were put back."""
            now = _listing(folder)
            return before | {p: now[p] for p in paths if p in own and p in now}

        def changed(files, edits, splices) -> dict[str, bytes]:
            """What the subject's files hold."""
            nonlocal lines
            out, rows = {f["path"]: bytes(f["content"]) for f in files}, {}
            for e in edits:
                p = e["path"]
                if p not in rows and p not in out and p != lines[0]:
                    lines = (p, patches.split(_bytes(own[p]).decode("utf-8")))
                rows[p] = patches.apply_lines(rows[p] if p in rows else patches.split(out[p].decode("utf-8")) if p in out else lines[1], e["diff"], bool(e["reverse"]))
                if rows[p] is None:
                    raise ValueError(f"a diff of {p} does not apply")
            out |= {p: "".join(x).encode() for p, x in rows.items()}
            for e in splices:
                p, data = e["path"], out[e["path"]] if e["path"] in out else _bytes(own[e["path"]])
                out[p] = data[: e["start"]] + e["after"].encode() + data[e["end"] :]
            return out

        try:
            for pdf in batches:
                rows = []
                edits, splices = (pdf[c] if c in edited else [()] * len(pdf) for c in ("edits", "splices"))
                for subject, phase, files, names, diffs, spliced in zip(pdf["subject_id"], pdf["phase"], pdf["files"], pdf["graders"], edits, splices, strict=True):
                    before = folder and _listing(folder)
                    if folder is None or before != clean:
                        shutil.rmtree(folder or "", ignore_errors=True)
                        folder = tempfile.mkdtemp(prefix="tree-")
                        for path, content in own.items():
                            _write(folder, path, _bytes(content))
                        before = _listing(folder)
                    held = changed(files, diffs, spliced)
                    for path, content in held.items():
                        _write(folder, path, content)
                    for i, name in enumerate(names):
                        argv, env = by[name]
                        script = script_of(argv) if absent else None
                        if script and not os.path.exists(os.path.join(folder, script.replace("{REPO}", folder))):
                            rows.append((subject, phase, name, i, None, 0, "absent"))
                            continue
                        code, ms, out = run_one(folder, argv, env, deadlines.get(name, 3000))
                        rows.append((subject, phase, name, i, code, ms, out))
                        if code and phase != "baseline":
                            break
                    for path in held:
                        if path in own:
                            _write(folder, path, _bytes(own[path]))
                        else:
                            os.remove(os.path.join(folder, path))
                    clean = restored(before, held)
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in RUNS.split(", ")]).astype({"exit_code": "Int32"})
        finally:
            shutil.rmtree(folder or "", ignore_errors=True)

    return subjects.select("subject_id", "phase", "files", "graders", *edited).mapInPandas(run, RUNS)


class Runs:
    """A table of runs in a folder. What it holds isn't run again: a stopped run goes on where it stopped."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self) -> DataFrame:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], RUNS)
        return self.spark.read.schema(RUNS).parquet(self.folder)

    def missing(self, subjects: DataFrame) -> DataFrame:
        """Subjects that have no run of their phase yet."""
        return subjects.join(self.table().select("subject_id", "phase").distinct(), ["subject_id", "phase"], "left_anti")

    def add(self, subjects: DataFrame, run: Callable[[DataFrame], DataFrame], batches: int = 1, progress: Callable[[int, int], None] | None = None, alike: bool = False) -> int:
        """Runs what is missing, in batches that are each whole in the table or absent, and says how many subjects that were. ``progress``
        hears how many batches of how many are done. With ``alike``, which hermetic graders allow, subjects of the same files and graders share the runs
        of the first of them; each still has rows of its own."""
        todo = self.missing(subjects)
        if alike:
            each = F.transform("files", lambda f: F.concat(F.sha2(f["path"].cast("binary"), 256), F.sha2(f["content"], 256)))
            todo = todo.withColumn("same", F.sha2(F.to_json(F.struct(each.alias("files"), "graders")), 256))
        todo = materialised(todo, "todo")
        n = todo.count()
        firsts = todo
        if alike and n:
            first = materialised(todo.groupBy("phase", "same").agg(F.min("subject_id").alias("subject_id")), "first")
            firsts, runs_of = todo.join(first, ["phase", "same", "subject_id"], "left_semi"), todo.select("phase", "same", "subject_id")
            n = first.count()
        for b in range(batches if n else 0):
            part = firsts.where(F.pmod(F.xxhash64("same" if alike else "subject_id"), F.lit(batches)) == b)
            parts = max(1, min(n // batches // 8 + 1, 4 * self.spark.sparkContext.defaultParallelism))
            dealt = part.repartition(parts)
            if "edits" in dealt.columns:  # a file's subjects one after another
                dealt = dealt.sortWithinPartitions(F.try_element_at("edits", F.lit(1))["path"])
            made = run(dealt)
            if alike:
                made = materialised(made, "made").withColumnRenamed("subject_id", "by").join(first.withColumnRenamed("subject_id", "by"), ["phase", "by"])
                made = runs_of.join(made, ["phase", "same"]).select(*[c.split()[0] for c in RUNS.split(", ")])
            made.write.mode("append").parquet(self.folder)
            if progress:
                progress(b + 1, batches)
        return n


cloudpickle.register_pickle_by_value(sys.modules[__name__])
