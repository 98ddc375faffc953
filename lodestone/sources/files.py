"""Source files, corpora and trials as tables; an exclusive claim on an output folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.sources.source_tree import SourceTree

TRANSCRIPT = "id string, operator string, file string, line bigint, teacher_model string, prompt string, content string, reasoning string"
EXAMPLE = "id string, prompt string, completion string, operator string, severity string, file string, line bigint, scope string, verdict string, caused_by array<string>, repo_commit string"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; in local mode alone, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file://" + tempfile.mkdtemp(prefix="lodestone-")


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read from there: what it was when it was written, whatever is lost later."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan(spark: SparkSession, root: str, extension: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(file, content) of files below ``root``, by path relative to it and in path order. Skipped folders are never listed, and files of an
    excluded needle never opened."""
    spark.dataSource.register(SourceTree)
    return spark.read.format("source_tree").options(root=root, extension=extension, exclude=",".join(exclude)).load()


def bad_lines(spark: SparkSession, path: str, schema: str = EXAMPLE) -> DataFrame:
    """(file, line, value) of the lines, from 1, of JSON Lines files that aren't rows of the schema; blank lines are no lines to it.

    A split knows its lines' places, and the counts of the splits before it in its file give the rest."""
    own = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    # written, since the places are those of this reading of the splits
    own = own.withColumns({"task": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    row = F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    wrong = (F.trim("value") != "") & (row.isNull() | row["_bad"].isNotNull())
    own = materialised(own.select("file", "block", "task", "at", F.when(wrong, F.col("value")).alias("value")), "lines")
    splits = own.groupBy("file", "block", "task").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return own.where("value is not null").join(splits.withColumn("before", before), ["file", "block", "task"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "value")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Training rows of JSON Lines files; a bad line is an error that names its file and line, blank lines are not."""
    if first := bad_lines(spark, path).orderBy("file", "line").first():
        raise ValueError(f"{first.file} line {first.line}: {first.value[:160]}")
    return spark.read.schema(EXAMPLE).option("mode", "FAILFAST").json(path)


def append_transcript(replies: DataFrame, path: str) -> None:
    """Adds replies (id, operator, file, line, teacher_model, prompt, content, reasoning) to a transcript of JSON Lines, nulls kept."""
    replies.select(*[c.split()[0] for c in TRANSCRIPT.split(", ")]).write.mode("append").option("ignoreNullFields", False).json(path)


def write_corpus(rows: DataFrame, path: str, append: bool = False) -> None:
    """A content-addressed corpus: with ``append``, rows whose id is there already are left out."""
    if append:
        have = read_corpus(rows.sparkSession, path).select("id")
        rows = rows.join(have, "id", "left_anti")
    rows.write.mode("append" if append else "overwrite").json(path)


def read_trials(texts: DataFrame) -> DataFrame:
    """Trials from JSON texts (value) whose verdict is a word or an object with one field: kind, suite, tail, limit_ms."""
    v = texts.select(F.parse_json("value").alias("v"))
    got = lambda path, kind: F.try_variant_get("v", path, kind)
    word = got("$.verdict", "string")
    object_kind = F.when(got("$.verdict.Failed", "variant").isNotNull(), "Failed").when(got("$.verdict.Timeout", "variant").isNotNull(), "Timeout").when(got("$.verdict.Flaky", "variant").isNotNull(), "Flaky")
    return v.select(
        got("$.id", "string").alias("id"), got("$.file", "string").alias("file"), F.coalesce(object_kind, word).alias("kind"),
        F.coalesce(got("$.verdict.Failed.suite", "string"), got("$.verdict.Timeout.suite", "string"), got("$.verdict.Flaky.suite", "string")).alias("suite"),
        got("$.verdict.Failed.tail", "string").alias("tail"), got("$.verdict.Timeout.limit_ms", "bigint").alias("limit_ms"), got("$.elapsed_ms", "bigint").alias("elapsed_ms"),
    )


def trial_json(trials: DataFrame) -> DataFrame:
    """Trials as JSON texts (value): the verdict is a word, or an object that names its suite and what goes with it.
    ``read_trials`` reads them."""
    kind = F.col("verdict")
    own = lambda name, *fields: F.to_json(F.struct(F.struct(*fields).alias(name)))
    verdict = (
        F.when(kind == "FAILED", own("Failed", "suite", "tail")).when(kind == "TIMEOUT", own("Timeout", "suite", "limit_ms"))
        .when(kind == "FLAKY", own("Flaky", "suite")).otherwise(F.lit('"Survived"'))
    )
    fields = [c for c in ("id", "file", "file_sha256", "candidate", "elapsed_ms", "graders") if c in trials.columns]
    return trials.select(F.to_json(F.struct(*fields, F.parse_json(verdict).alias("verdict"))).alias("value"))


def write_trials(trials: DataFrame, path: str) -> None:
    """A JSON text per line, in order of files, lines and bytes; lines rather than one array, so that tasks write and read them apart."""
    place = [c for c in ("file", "line", "start_byte", "operator", "id") if c in trials.columns]
    trial_json(trials.repartitionByRange(*place).sortWithinPartitions(*place)).write.mode("overwrite").text(path)


def write_replays(replays: DataFrame, path: str) -> None:
    """Replays (commit, outcome, elapsed_ms) as JSON Lines."""
    replays.write.mode("overwrite").json(path)


@contextlib.contextmanager
def claim(folder: str, force: bool = False) -> Iterator[None]:
    """Holds an output folder for one writer on the driver; a second claim is refused unless forced."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, ".claim")
    if force and os.path.exists(path):
        os.remove(path)
    try:
        f = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
    except FileExistsError:
        with open(path) as held:
            raise RuntimeError(f"{folder} is claimed by {held.read().strip()}; use --force to take it over or --out for another folder") from None
    os.write(f, f"pid {os.getpid()} since {int(time.time())}".encode())
    os.close(f)
    try:
        yield
    finally:
        with contextlib.suppress(FileNotFoundError):
            os.remove(path)
