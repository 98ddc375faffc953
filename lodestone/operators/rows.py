"""Training rows from trials, replays and pairs. Each function gives (rows, aborted): rows in the corpus schema, and
(file, operator, line, reason) for whatever couldn't become one, so that nothing is left out in silence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import content as C
from lodestone.functions import render as R
from lodestone.functions import text as T
from lodestone.functions import verdicts as V
from lodestone.operators.patches import unified_hunk

COLUMNS = ("id", "prompt", "completion", "operator", "severity", "file", "line", "scope", "verdict", "caused_by", "repo_commit")


#: Rows of a file that are rendered from one copy of it.
FILE_ROWS = 5_000


def _with_files(trials: DataFrame, pristine: DataFrame) -> DataFrame:
    """``trials`` with their files, or null, by a join in which no file holds its task up: one of many trials is copied, once per
    ``FILE_ROWS`` of them, and they are dealt to the copies by a hash. There is a hot file per ``FILE_ROWS`` trials at most, so
    that these can be broadcast. A number of partitions is named, since rows cost far more than their bytes tell: else adaptive execution would
    gather them in few tasks, or leave them in those of the scan."""
    hot = F.broadcast(trials.groupBy("file").agg(F.ceil(F.count("*") / FILE_ROWS).alias("_copies")).where("_copies > 1 and file is not null"))
    copies = F.coalesce("_copies", F.lit(1).cast("bigint"))
    kinds = dict(trials.dtypes)
    key = F.xxhash64(*[F.col(f"`{c}`") for c in trials.columns if not kinds[c].startswith("map")])
    dealt = trials.join(hot, "file", "left").withColumn("_copy", F.pmod(key, copies)).drop("_copies")
    dealt = dealt.repartition(int(trials.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file", "_copy")
    copied = pristine.join(hot, "file", "left").withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1))).drop("_copies")
    return dealt.join(copied, ["file", "_copy"], "left").drop("_copy")


def _parted(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = judged.where("reason is null")
    return good, judged.where("reason is not null").select("file", "operator", F.col("line").cast("bigint").alias("line"), "reason")


def _finished(good: DataFrame, broken: Column, fixed: Column) -> DataFrame:
    """The completion restores ``fixed`` from ``broken``."""
    return good.withColumn("completion", T.completion(unified_hunk(F.col("file"), broken, fixed))).select(*COLUMNS)


def corpus_rows(trials: DataFrame, pristine: DataFrame, commit: str, repo: str, work: str) -> tuple[DataFrame, DataFrame]:
    """Rows of killed trials (id, file, operator, severity, start_byte, end_byte, after, line, scope, verdict, suite, tail,
    limit_ms) against the pristine files (file, content). With a column ``before``, a site must hold it still: a file that has moved makes no row."""
    held = _with_files(trials.where(V.killed(F.col("verdict"))), pristine)
    held = held.withColumn("data", F.when(F.col("end_byte") <= F.octet_length("content"), C.splice(F.col("content"), F.col("start_byte"), F.col("end_byte"), F.col("after"))))
    reason = F.when(F.col("content").isNull(), "no pristine file").when(F.col("data").isNull(), "candidate span is past the end of the pristine file")
    if "before" in trials.columns:
        holds = C.span_holds(F.col("content"), F.col("start_byte"), F.col("end_byte"), F.col("before"))
        reason = reason.when(~F.coalesce(holds, F.lit(False)), "span no longer matches the locator's `before`")
    good, aborted = _parted(held.withColumn("reason", reason.when(~F.is_valid_utf8("data"), "splice is not utf-8")))
    good = good.withColumns({"broken": F.col("data").cast("string"), "fixed": F.col("content").cast("string"), "repo_commit": F.lit(commit), "line": F.col("line").cast("int")})
    said = R.report(F.col("verdict"), F.col("tail"), F.col("limit_ms"), work, repo)
    good = good.withColumns({
        "prompt": R.prompt(repo, F.col("repo_commit"), F.col("suite"), said, F.col("file"), F.col("broken"), F.col("line")),
        "caused_by": R.provenance(trial=F.col("id"), tree=F.col("repo_commit")),
    })
    return _finished(good, F.col("broken"), F.col("fixed")), aborted


def history_rows(replays: DataFrame, blobs: DataFrame, repo: str, work: str) -> tuple[DataFrame, DataFrame]:
    """Rows of replays (sha, parent, outcome, suite, tail, touched array<struct<file, line>>) that are FIXED, a row per
    touched file; blobs (sha, file, text). Files that a commit adds, removes or leaves alike are no rows; the
    first two are reported."""
    each = replays.where("outcome = 'FIXED'").select("sha", "parent", "suite", "tail", F.explode("touched").alias("t")).select("sha", "parent", "suite", "tail", "t.file", "t.line")
    old = blobs.select(F.col("sha").alias("parent"), "file", F.col("text").alias("broken"))
    each = each.join(old, ["parent", "file"], "left").join(blobs.select("sha", "file", F.col("text").alias("fixed")), ["sha", "file"], "left")
    reason = F.when(F.col("broken").isNull(), "no parent version").when(F.col("fixed").isNull(), "not readable at commit")
    good, aborted = _parted(each.withColumns({"operator": F.lit("history"), "reason": reason}))
    good = good.where("broken <> fixed").withColumn("line", F.col("line").cast("int"))
    said = R.report(F.lit("FAILED"), F.col("tail"), F.lit(0), work, repo)
    good = good.withColumns({
        "id": R.history_id(F.col("sha"), F.col("file")), "severity": F.lit("real"), "scope": F.lit(""), "verdict": F.lit("FIXED"), "repo_commit": F.col("sha"),
        "prompt": R.prompt(repo, F.col("parent"), F.col("suite"), said, F.col("file"), F.col("broken"), F.col("line")),
        "caused_by": R.provenance(commit=F.col("sha"), parent=F.col("parent")),
    })
    return _finished(good, F.col("broken"), F.col("fixed")), aborted


def pair_rows(pairs: DataFrame, pristine: DataFrame, commit: str, repo: str, work: str) -> tuple[DataFrame, DataFrame]:
    """Rows of failed pairs (file, affinity, suite, tail, and start_byte, end_byte, after, line, operator of each site as a_ and b_). A pair
    of two files has a null file: its repair would need two diffs, and it is reported."""
    site = lambda k: tuple(F.col(f"{k}_{c}") for c in ("start_byte", "end_byte", "after"))
    held = _with_files(pairs, pristine).withColumns({"data": C.splice_two(F.col("content"), site("a"), site("b")), "operator": F.concat_ws("+", "a_operator", "b_operator"), "line": F.least("a_line", "b_line")})
    reason = F.when(F.col("file").isNull(), "the repair spans two files").when(F.col("content").isNull(), "no pristine file").when(F.col("data").isNull(), "the sites overlap")
    good, aborted = _parted(held.withColumn("reason", reason.when(~F.is_valid_utf8("data"), "splice is not utf-8")))
    good = good.withColumns({"broken": F.col("data").cast("string"), "fixed": F.col("content").cast("string"), "repo_commit": F.lit(commit)})
    said, high = R.report(F.lit("FAILED"), F.col("tail"), F.lit(0), work, repo), F.greatest("a_line", "b_line")
    good = good.withColumns({
        "id": R.pair_id(F.col("file"), F.col("a_line"), F.col("b_line")), "severity": F.concat(F.lit("emergent/"), "affinity"), "scope": F.lit(""), "verdict": F.lit("EMERGENT"),
        "prompt": R.pair_prompt(repo, F.col("repo_commit"), F.col("suite"), said, F.col("file"), F.col("broken"), F.col("a_line").cast("int"), F.col("b_line").cast("int")),
        "caused_by": R.provenance(site_1=F.concat_ws(":", "file", "line"), site_2=F.concat_ws(":", F.col("file"), high), tree=F.col("repo_commit")),
    })
    return _finished(good, F.col("broken"), F.col("fixed")), aborted
