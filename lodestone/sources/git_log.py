"""Commits of a git repository as a Spark data source: ``spark.read.format("git_log").option("repo", path)``.

Columns: ord (0 is newest), sha, parent (first parent), subject, touched. Merges and root commits are out. Tasks list ranges of the log on their
own; the driver asks for nothing but the number of commits, and not even that where a range is known: from the option ``newest`` (so many commits
from the head) or, in ``commits``, a filter on ord, which is pushed down. The options ``sources`` (folders, with commas) and ``extension`` leave the other touched
files out, and with them the commits that touch no others. A commit whose files can't be listed has none.
"""

from __future__ import annotations

import subprocess
import sys
from collections.abc import Iterable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

RANGE = 1000  # commits of a task, unless there are few
LOOK = 4  # times the wanted commits are looked at


def git(repo: str, *args: str) -> str:
    return subprocess.run(["git", "-C", repo, *args], capture_output=True, check=True, text=True, timeout=120).stdout


class _Part(InputPartition):
    def __init__(self, begin: int, end: int):
        self.begin, self.end = begin, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.repo, self.parts = options["repo"], int(options.get("partitions", 4))
        self.sources = [s for s in options.get("sources", "").split(",") if s]
        self.extension = options.get("extension", "")
        self.low, self.high = 0, int(options["newest"]) if "newest" in options else None

    def partitions(self) -> list[_Part]:
        end = int(git(self.repo, "rev-list", "--no-merges", "--count", "HEAD")) if self.high is None else self.high
        step = max(1, min(RANGE, -(-(end - self.low) // self.parts)))
        return [_Part(i, min(i + step, end)) for i in range(self.low, end, step)] or [_Part(0, 0)]

    def read(self, partition: _Part):
        n = partition.end - partition.begin
        log = git(self.repo, "log", "--no-merges", "-z", "--format=%H%x09%P%x09%s", f"--skip={partition.begin}", f"--max-count={n}") if n > 0 else ""
        for i, line in enumerate((x for x in log.split("\0") if x), partition.begin):
            sha, parents, subject = line.split("\t", 2)
            if not parents:
                continue
            touched = [f for f in self.touched(sha) if self.mine(f)]
            if touched or not (self.sources or self.extension):
                yield i, sha, parents.split()[0], subject, touched

    def touched(self, sha: str) -> list[str]:
        try:
            names = git(self.repo, "diff-tree", "--no-commit-id", "--name-only", "-r", "-z", sha)
        except subprocess.CalledProcessError:
            return []
        return [x for x in names.split("\0") if x]

    def mine(self, file: str) -> bool:
        return file.endswith("." + self.extension if self.extension else "") and (not self.sources or file.startswith(tuple(self.sources)))


class _RangeReader(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters on ord become the range that is read."""
        for f in filters:
            bounds = {LessThan: (None, 0), LessThanOrEqual: (None, 1), GreaterThan: (1, None), GreaterThanOrEqual: (0, None), EqualTo: (0, 1)}.get(type(f))
            if bounds is None or f.attribute != ("ord",):
                yield f
                continue
            low, high = bounds
            if low is not None:
                self.low = max(self.low, f.value + low)
            if high is not None:
                self.high = f.value + high if self.high is None else min(self.high, f.value + high)


class GitLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "git_log"

    def schema(self) -> str:
        return "ord bigint, sha string, parent string, subject string, touched array<string>"

    def reader(self, schema) -> DataSourceReader:
        return (_RangeReader if self.options.get("pushdown") == "true" else _Reader)(self.options)


def commits(spark: SparkSession, repo: str, **options: str) -> DataFrame:
    """The log; filters on ord are pushed down where the session has spark.sql.python.filterPushdown.enabled."""
    spark.dataSource.register(GitLog)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("git_log").options(repo=repo, pushdown=pushdown, **options).load()


def candidates(spark: SparkSession, repo: str, sources: tuple[str, ...], extension: str, limit: int) -> DataFrame:
    """The newest ``limit`` commits that touch these files, among the newest ``LOOK`` times as many commits; older ones aren't listed."""
    return commits(spark, repo, sources=",".join(sources), extension=extension, newest=str(LOOK * limit)).orderBy("ord").limit(limit)


def file_at(repo: str, sha: str, path: str) -> str:
    return git(repo, "show", f"{sha}:{path}")


def head_commit(repo: str) -> str:
    return git(repo, "rev-parse", "HEAD").strip()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
