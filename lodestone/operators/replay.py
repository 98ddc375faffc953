"""History and replies judged by real runs, in phases over one table of runs.

``history``: a commit's parent is graded first, and the commit itself only where its parent was red, by the suite that was. ``score``: a training
row's own repair is taken back, which must make the tree red; only then is the reply applied and graded. Phases are joins on the table
of runs, so what an earlier phase decides is never run, and a stopped replay resumes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.functions import verdicts as V
from lodestone.operators import gates, patches, routing, runner
from lodestone.operators.campaign import Target, graded, no_files
from lodestone.sources.files import materialised

UNROUTED = "(no grader focused this file)"


def touched_by(commits: DataFrame, sources: tuple[str, ...], extension: str) -> DataFrame:
    """Commits (touched, ...) with only the touched files in these folders with this extension; those without any are out."""
    mine = lambda f: F.endswith(f, F.lit("." + extension)) & F.exists(F.array(*map(F.lit, sources)), lambda s: F.startswith(f, s))
    return commits.withColumn("touched", F.filter("touched", mine)).where(F.size("touched") > 0)


def wanted(commits: DataFrame, target: Target, parallel: bool = True) -> DataFrame:
    """(sha, graders): the ordered distinct union of what the commit's files are routed to."""
    each = commits.select("sha", F.posexplode("touched").alias("pos", "file"))
    routed = each.join(target.route(each.select("file"), parallel), "file")
    return routing.union_graders(routed, "sha")


def _subjects(rows: DataFrame, phase: str) -> DataFrame:
    return rows.select("subject_id", F.lit(phase).alias("phase"), "files", "graders", *[c for c in rows.columns if c == "edits"])


def _red(runs: DataFrame, phase: str) -> DataFrame:
    """(subject_id, verdict, suite, tail, ms) of a phase."""
    return graded(runs.where(F.col("phase") == phase))


def history(commits: DataFrame, trees: DataFrame, target: Target, deadlines: dict[str, int], folder: str, batches: int = 1) -> DataFrame:
    """(sha, parent, outcome, suite, tail, absent, ms) of commits (sha, parent, touched) whose trees (sha, files) are those that can be checked out."""
    runs = runner.Runs(commits.sparkSession, folder)
    run = lambda s: runner.run_subjects(s, target.commands(), deadlines, absent=True)
    alike = all(g.hermetic for g in target.graders)  # then what a tree gives once it gives always, and commits of equal trees share a run
    asked = materialised(commits.join(wanted(commits, target), "sha", "left").withColumn("graders", F.coalesce("graders", F.array().cast("array<string>"))), "asked")
    before = asked.join(trees.select(F.col("sha").alias("parent"), "files"), "parent")
    runs.add(_subjects(before.withColumn("subject_id", F.col("sha")), "parent"), run, batches, alike=alike)
    had = before.select("sha", F.lit(True).alias("had"))
    table = runs.table()
    first = _red(table, "parent").withColumnRenamed("subject_id", "sha")
    absent = table.where("phase = 'parent' and exit_code is null").groupBy(F.col("subject_id").alias("sha")).agg(F.array_sort(F.collect_set("grader")).alias("absent"))
    known = materialised(asked.join(had, "sha", "left").join(first, "sha", "left").join(absent, "sha", "left"), "parents")
    # only where the parent was red, and only by the suite that was
    red = known.where(V.killed(F.col("verdict"))).select("sha", F.array("suite").alias("graders"))
    runs.add(_subjects(red.join(trees, "sha").withColumn("subject_id", F.col("sha")), "commit"), run, batches, alike=alike)
    after = _red(runs.table(), "commit").select(F.col("subject_id").alias("sha"), F.col("verdict").alias("after"), F.col("ms").alias("after_ms"))
    out = known.join(after, "sha", "left")
    runnable = F.col("had").isNotNull() & (F.coalesce("verdict", F.lit("")) != "ABORTED") & (~V.killed(F.coalesce("verdict", F.lit(""))) | (F.col("after").isNotNull() & (F.col("after") != "ABORTED")))
    outcome = V.history_outcome(F.col("verdict").isNotNull(), runnable, V.killed(F.col("verdict")), F.col("after") == "SURVIVED")
    limit = F.create_map(*[F.lit(x) for pair in (deadlines or {"": 0}).items() for x in pair])
    tail = F.when(F.col("verdict") == "TIMEOUT", F.concat(F.lit("suite did not terminate within "), F.element_at(limit, F.col("suite")), F.lit(" ms"))).when(V.killed(F.col("verdict")), F.col("tail"))
    none = F.when(F.size("graders") == 0, F.array(F.lit(UNROUTED)))
    return out.select("sha", "parent", outcome.alias("outcome"), "suite", tail.alias("tail"), F.coalesce("absent", none).alias("absent"), (F.coalesce("ms", F.lit(0)) + F.coalesce("after_ms", F.lit(0))).alias("ms"), "touched")


EDITS = "array<struct<path:string,diff:string,reverse:boolean>>"


def _edits(file: Column, own: Column, reply: Column | None = None) -> Column:
    """The row's own repair taken back, and a reply."""
    steps = [(own, True)] + ([] if reply is None else [(reply, False)])
    return F.array(*[F.struct(file.alias("path"), diff.alias("diff"), F.lit(back).alias("reverse")) for diff, back in steps]).cast(EDITS)


def _tried(rows: DataFrame, pristine: DataFrame, own: str, reply: str | None = None) -> DataFrame:
    """Adds whether a row's own repair can be taken back from its file, and a reply then be applied (``fits``), and the lines that the file then has
    and the pristine one hasn't (``fresh``). Rows are dealt out beside copies of their files, which a task reads one after another."""
    spark = rows.sparkSession
    parts = 4 * spark.sparkContext.defaultParallelism
    copies = max(1, -(-2 * parts // max(1, pristine.count())))
    texts = pristine.where("content is not null").select("file", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy"), F.col("content").alias("_content"))
    dealt = rows.withColumns({"_copy": F.pmod(F.xxhash64("id"), F.lit(copies)).cast("int"), "_content": F.lit(None).cast("binary")})
    both = dealt.unionByName(texts, allowMissingColumns=True).repartition(parts, "file", "_copy").sortWithinPartitions("file", "_copy", F.col("_content").isNull())
    columns = rows.columns

    def run(batches: Iterator) -> Iterator:
        at, text = None, None
        for pdf in batches:
            here, fits, fresh = [], [], []
            for i, (file, content, o, r) in enumerate(zip(pdf["file"], pdf["_content"], pdf[own], pdf[reply] if reply else [None] * len(pdf), strict=True)):
                if content is not None:
                    at, text = file, patches.Text(bytes(content).decode("utf-8", "surrogateescape"))
                    continue
                pieces = text.apply(o, reverse=True) if text and file == at and o is not None else None
                if pieces is not None and r is not None:
                    pieces = text.apply(r, pieces=pieces)
                here.append(i)
                fits.append(pieces is not None)
                fresh.append(None if pieces is None else text.fresh(pieces))
            yield pdf.iloc[here][columns].assign(fits=pd.Series(fits, index=here, dtype=bool), fresh=pd.Series(fresh, index=here, dtype=object))

    return both.mapInPandas(run, rows.schema.add("fits", "boolean").add("fresh", "string"))


def _by_lines(runs: runner.Runs, pristine: DataFrame, target: Target, deadlines: dict[str, int], tree: runner.Tree) -> bool:
    """Whether only the lines that an edit brings in can make a suite red: all suites judge lines by themselves, and are green, in a run, on the whole clean tree."""
    if not target.graders or not all(g.hermetic and g.lines for g in target.graders) or not pristine.where(~F.col("file").isin([path for path, _ in tree])).isEmpty():
        return False
    one = runs.spark.createDataFrame([("baseline", "baseline", [], [g.name for g in target.graders])], "subject_id string, phase string, files array<struct<path:string,content:binary>>, graders array<string>")
    runs.add(one, lambda s: runner.run_subjects(s, target.commands(), deadlines, tree))
    return gates.baseline_verdict(gates.baseline(runs.table().where("phase = 'baseline'"))).first().passed


def score(rows: DataFrame, pristine: DataFrame, target: Target, deadlines: dict[str, int], folder: str, tree: runner.Tree = (), batches: int = 1) -> DataFrame:
    """(id, file, score, why, suite) of rows (id, file, completion, reply) against the pristine files (file, content) of the ``tree``.

    Suites that judge lines by themselves run on the lines that a row's edits bring in, once for all rows that bring in the same, and on the rest of the
    tree once; others run on every row's whole tree."""
    runs = runner.Runs(rows.sparkSession, folder)
    lines = _by_lines(runs, pristine, target, deadlines, tree)
    if lines:
        sources = {r.file for r in pristine.select("file").collect()}
        tree = tuple((path, content) for path, content in tree if path not in sources)
    run = lambda s: runner.run_subjects(s, target.commands(), deadlines, tree)
    own, own_error = T.extract_patch(F.col("completion"))
    names = F.array(*[F.lit(path) for path, _ in tree]).cast("array<string>")
    other = pristine.where(F.lit(not lines) & ~F.array_contains(names, F.col("file"))).select("file", F.col("content").cast("string").alias("pristine"))
    known = pristine.select("file").distinct().withColumn("there", F.lit(True))
    held = rows.select("id", "file", "completion", "reply").join(other, "file", "left").join(F.broadcast(known), "file", "left").join(F.broadcast(target.route(pristine)), "file", "left")
    held = held.withColumns({"own": own, "own_error": own_error, "graders": F.coalesce("graders", F.array().cast("array<string>"))})
    held = _tried(held, pristine, "own")
    held = materialised(held.withColumn("broken", F.col("there").isNotNull() & F.col("own").isNotNull() & F.col("fits")).drop("fits"), "broken")
    laid = lambda text: F.when(text.isNull(), no_files()).otherwise(F.array(F.struct(F.col("file").alias("path"), text.cast("binary").alias("content"))))

    def subjects(some: DataFrame, phase: str, *reply: Column) -> DataFrame:
        """What a row's suites run on: the lines that its edits bring in, or the tree with its edits."""
        own = {"files": laid(F.col("fresh"))} if lines else {"files": laid(F.col("pristine")), "edits": _edits(F.col("file"), F.col("own"), *reply)}
        return _subjects(some.withColumns({"subject_id": F.col("id"), **own}), phase)

    runs.add(subjects(held.where("broken"), "broken"), run, batches, alike=lines)
    first = _red(runs.table(), "broken").select(F.col("subject_id").alias("id"), F.col("verdict").alias("before"))
    asked = held.drop("fresh").join(first, "id", "left").withColumn("reproduced", F.coalesce(V.killed(F.col("before")), F.lit(False)))
    patch, error = T.extract_patch(F.col("reply"))
    asked = asked.withColumns({"patch": F.when(F.col("reproduced"), patch), "error": error})
    asked = asked.withColumn("within", F.coalesce(T.in_contract(T.patched_files(F.col("patch")), F.col("file")), F.lit(True)))
    asked = _tried(asked, pristine, "own", "patch")
    asked = materialised(asked.withColumn("repaired", F.col("patch").isNotNull() & F.col("within") & F.col("fits")).drop("fits"), "asked")
    runs.add(subjects(asked.where("repaired"), "repaired", F.col("patch")), run, batches, alike=lines)
    after = _red(runs.table(), "repaired").select(F.col("subject_id").alias("id"), F.col("verdict").alias("after"), "suite")
    out = asked.join(after, "id", "left")
    value = V.score(F.col("broken"), F.col("reproduced"), F.col("error"), F.col("within"), F.col("repaired"), F.coalesce(V.killed(F.col("after")), F.lit(False)))
    why = (
        F.when(F.col("own_error").isNotNull(), F.concat(F.lit("the corpus row's own completion is unusable: "), "own_error")).when(~F.col("broken"), "could not reconstruct the broken tree from the row")
        .when(~F.col("reproduced"), "the broken tree is green").when(F.col("error").isNotNull(), F.col("error")).when(~F.col("within"), "the patch leaves its file").when(~F.col("repaired"), "the patch does not apply")
    )
    return out.select("id", "file", value.alias("score"), why.alias("why"), F.when(value == "MISSED", F.col("suite")).alias("suite"))


def require_yield(scores: DataFrame) -> None:
    """Refuses a replay that judged nothing: no rows is a fault of the run, not a score of 0."""
    if scores.isEmpty():
        raise RuntimeError("zero rows were scored")


def responders_hold(rows: DataFrame, pristine: DataFrame, target: Target, deadlines: dict[str, int], folder: str, tree: runner.Tree) -> DataFrame:
    """(responder, score, n): how the scoring judges the replies that test it; refuses unless the oracle solves every row."""
    out = None
    for kind in ("oracle", "null", "cheat"):
        # the broken trees are the same for all, and run once
        replied = gates.respond(rows, kind)
        scored = materialised(score(replied, pristine, target, deadlines, f"{folder}-{kind}", tree), "scored")
        if kind == "oracle":
            gates.require_oracle(scored)
        part = scored.groupBy(F.lit(kind).alias("responder"), "score").agg(F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])
