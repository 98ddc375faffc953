"""Trials from end to end, in phases over one table of runs: locate, sample, guard, baseline, mutated runs, verdicts, confirmation.

Every phase asks the table what is there and runs the rest, so a stopped campaign resumes by trial id and a finished one runs
nothing. Nothing is left out in silence: sites that no longer hold what the locator saw, and trials whose graders can't be executed,
become rows with a reason.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import content as C
from lodestone.functions import verdicts as V
from lodestone.operators import gates, locators, routing, runner, sampling
from lodestone.sources.files import materialised

BASELINE_MS = 120_000
MOVED, GONE = "span no longer matches the locator's `before`", "no such file in the tree"


@dataclass(frozen=True)
class Grader:
    """A suite. ``lines`` says of it that it judges every line of a source by itself, as a search for words does: it is red where it is red for one line, whatever
    stands around that."""

    name: str
    argv: tuple[str, ...]
    env: dict[str, str] = field(default_factory=dict)
    hermetic: bool = True
    slow: bool = False
    lines: bool = False


@dataclass(frozen=True)
class Target:
    """What is graded, as data: graders in order, and rules (needle, grader names) of which the first that a file's path holds routes it."""

    graders: tuple[Grader, ...]
    rules: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def usable(self, parallel: bool) -> tuple[Grader, ...]:
        return tuple(g for g in self.graders if g.hermetic or not parallel)

    def commands(self) -> list[tuple[str, list[str], dict[str, str]]]:
        return [(g.name, list(g.argv), g.env) for g in self.graders]

    def route(self, files: DataFrame, parallel: bool = True) -> DataFrame:
        """(file, graders): names in order; several workers leave out graders that aren't hermetic, behind the routing."""
        spark = files.sparkSession
        rules = spark.createDataFrame([(i, n, list(g)) for i, (n, g) in enumerate(self.rules)], "ord int, needle string, names array<string>")
        graders = spark.createDataFrame([(i, g.name, g.slow) for i, g in enumerate(self.graders)], "ord int, name string, slow boolean")
        alone = F.array(*[F.lit(g.name) for g in self.usable(parallel)]).cast("array<string>")
        return routing.route(files.select("file").distinct(), rules, graders).select("file", F.filter("graders", lambda g: F.array_contains(alone, g)).alias("graders"))


def graded(runs: DataFrame) -> DataFrame:
    """(subject_id, verdict, suite, tail, ms) of runs of one phase; a grader that wasn't in the tree says nothing."""
    here = runs.where("exit_code is not null").withColumn("class", V.run_class(F.col("exit_code"), F.col("elapsed_ms")))
    verdicts = V.grade(here)
    last = here.groupBy("subject_id").agg(F.max_by("output", "ord").alias("tail"), F.sum("elapsed_ms").alias("ms"))
    return verdicts.join(last, "subject_id")


def baseline(runs: runner.Runs, target: Target, tree: runner.Tree, parallel: bool = True) -> dict[str, int]:
    """Runs every grader on the clean tree, once for the table; refuses by name unless all are green. Gives their deadlines."""
    names = [g.name for g in target.usable(parallel)]
    one = runs.spark.createDataFrame([("baseline", "baseline", [], names)], "subject_id string, phase string, files array<struct<path:string,content:binary>>, graders array<string>")
    runs.add(one, lambda s: runner.run_subjects(s, target.commands(), dict.fromkeys(names, BASELINE_MS), tree))
    measured = gates.baseline(runs.table().where("phase = 'baseline' and exit_code is not null"))
    gates.require_green(measured)
    return {r.grader: r.deadline_ms for r in measured.select("grader", "deadline_ms").collect()}  # a row per grader


def guarded(sites: DataFrame, pristine: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, aborted): sites whose bytes are still what the locator saw, and the others with why."""
    held = sites.join(pristine.select("file", "content"), "file", "left")
    holds = C.span_holds(F.col("content"), F.col("start_byte"), F.col("end_byte"), F.col("before"))
    held = held.withColumn("reason", F.when(F.col("content").isNull(), GONE).when(~F.coalesce(holds, F.lit(False)), MOVED))
    held = held.drop("content")
    return held.where("reason is null").drop("reason"), held.where("reason is not null").select("file", "operator", "line", "reason")


def _subjects(rows: DataFrame, phase: str, graders: Column, files: Column, *more: Column) -> DataFrame:
    return rows.select(F.col("id").alias("subject_id"), F.lit(phase).alias("phase"), files.alias("files"), graders.alias("graders"), *more)


def no_files() -> Column:
    return F.array().cast("array<struct<path:string,content:binary>>")


def campaign(
    located: DataFrame, pristine: DataFrame, target: Target, tree: runner.Tree, folder: str, limit: int | None = None, parallel: bool = True,
    batches: int = 1, progress: Callable[[int, int], None] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(trials, aborted, totals) of located sites. ``tree`` is what the graders run in, the pristine files included; ``folder``
    keeps the runs. ``limit`` takes a sample of so many sites, one of each file in turn."""
    runs = runner.Runs(located.sparkSession, folder)
    sites = locators.sites_of(located)
    sites = sites.withColumn("id", C.trial_id(F.col("sha256"), F.col("operator"), F.col("start_byte"), F.col("end_byte"), F.col("after")))
    seen = materialised(sites, "sites")
    if seen.isEmpty():
        raise RuntimeError("no candidates to try: every file was empty, unparseable, or filtered out")
    picked = seen if limit is None else sampling.round_robin(seen, limit).drop("turn")
    picked = materialised(picked.join(F.broadcast(target.route(pristine, parallel)), "file", "left").withColumn("graders", F.coalesce("graders", F.array().cast("array<string>"))), "picked")
    good, aborted = guarded(picked, pristine)
    deadlines = baseline(runs, target, tree, parallel)
    run = lambda s: runner.run_subjects(s, target.commands(), deadlines, tree)
    # sites of the tree's files carry their splice; those of other files the file, spliced
    names = F.array(*[F.lit(path) for path, _ in tree]).cast("array<string>")
    other = pristine.where(~F.array_contains(names, F.col("file"))).select("file", "content")
    file, start, end, after = F.col("file"), F.col("start_byte"), F.col("end_byte"), F.col("after")
    laid = F.when(F.col("content").isNull(), no_files()).otherwise(F.array(F.struct(file.alias("path"), C.splice(F.col("content"), start, end, after).alias("content"))))
    splices = F.when(F.col("content").isNull(), F.array(F.struct(file.alias("path"), start.alias("start"), end.alias("end"), after.alias("after")))).otherwise(F.array())
    runs.add(_subjects(good.join(other, "file", "left"), "mutated", F.col("graders"), laid, splices.alias("splices")), run, batches, progress)
    first = graded(runs.table().where("phase = 'mutated'"))
    trials = good.join(first.withColumnRenamed("subject_id", "id"), "id", "left").withColumn("verdict", F.coalesce("verdict", F.lit("SURVIVED")))
    # the accusing suite once more, on the clean tree: a suite that is red there has not seen the edit
    accused = trials.where(V.killed(F.col("verdict"))).select("id", F.array("suite").alias("suites"))
    runs.add(_subjects(accused, "confirm", F.col("suites"), no_files()), run, batches, progress)
    again = runs.table().where("phase = 'confirm'").select(F.col("subject_id").alias("id"), V.run_class(F.col("exit_code"), F.col("elapsed_ms")).alias("again"))
    trials = materialised(trials.join(again, "id", "left").withColumn("verdict", V.confirmed(F.col("verdict"), F.col("again"))).drop("again"), "trials")
    broken = trials.where("verdict = 'ABORTED'").select("file", "operator", "line", F.concat(F.lit("could not be executed: "), "suite").alias("reason"))
    done = trials.where("verdict <> 'ABORTED'").withColumn("limit_ms", F.when(F.col("verdict") == "TIMEOUT", _deadline(deadlines)))
    aborted = aborted.unionByName(broken)
    counts = done.agg(F.count("*").alias("trials"), F.count_if(V.killed(F.col("verdict"))).alias("killed"), F.count_if(F.col("verdict") == "FLAKY").alias("flaky"), F.count_if(F.col("verdict") == "SURVIVED").alias("survived"), F.coalesce(F.sum("ms"), F.lit(0)).alias("grading_ms"))
    totals = locators.totals(located).crossJoin(counts).crossJoin(aborted.agg(F.count("*").alias("aborted")))  # one row each
    return done.orderBy("file", "line", "start_byte", "operator"), aborted, totals


def _deadline(deadlines: dict[str, int]) -> Column:
    known = [F.lit(x) for pair in deadlines.items() for x in pair]
    return F.element_at(F.create_map(*known), F.col("suite")) if known else F.lit(None).cast("int")
