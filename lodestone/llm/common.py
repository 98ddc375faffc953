"""Pieces that several operators share: word expressions, lineage cuts, connected components."""

from __future__ import annotations

import gc
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space and the code points 9 to 13.
SPACE_RE = r"[\x20\x09-\x0D]+"
SALTS = 8
WORD_RE = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it.

    Catalyst inlines projections into lambdas, where they would run again for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text in order; of null, none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RE), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def window_hashes(ws: Column, n: int) -> Column:
    """64-bit hashes of the n-word windows of a word array; shorter arrays have none."""
    return F.when(
        F.size(ws) >= n,
        F.transform(F.sequence(F.lit(1), F.size(ws) - (n - 1)), lambda i: F.xxhash64(*[F.element_at(ws, i + k) for k in range(n)])),
    ).otherwise(F.array().cast("array<bigint>"))


def carried(df: DataFrame, **names: Column) -> DataFrame:
    """``df`` as one struct column ``row`` beside the named ones, so that no column of it can clash with an operator's own;
    ``select("row.*")`` gives it back."""
    return df.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in names.items()])


def row_hash(df: DataFrame, seed: int) -> Column:
    """A hash of all columns of a row; of maps, of their entries in order of keys."""
    kinds = dict(df.dtypes)
    return F.xxhash64(F.lit(seed), *[F.array_sort(F.map_entries(F.col(f"`{c}`"))) if kinds[c].startswith("map") else F.col(f"`{c}`") for c in df.columns])


def doc_key(doc_id: Column) -> Column:
    """doc_id as a number to order by; null comes after all others."""
    return F.coalesce(doc_id.cast("bigint"), F.lit((1 << 63) - 1))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in local mode alone, one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lodestone-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cut(df: DataFrame, name: str = "stage", spent: Iterable[DataFrame] = ()) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it: later steps neither repeat its work
    nor depend on the executors that did it. The tables ``spent``, which only ``df`` still read, are deleted then."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lodestone_path = path
    for x in spent:
        drop_cut(x)
    if not spark.sparkContext.master.startswith("local["):
        gc.collect()  # lets Spark's cleaner remove the shuffle files of what the table replaces, which fill executors' disks
        spark._jvm.System.gc()
    return out


def bounded(df: DataFrame, most: int) -> DataFrame:
    """``df``, written and counted: marked for broadcast with up to ``most`` rows, left to a shuffled join beyond."""
    table = cut(df, "bounded")
    out = F.broadcast(table) if table.count() <= most else table
    out._lodestone_path = table._lodestone_path
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete the table of a former ``cut``; only for tables that no later plan reads."""
    if path := getattr(df, "_lodestone_path", None):
        remove_path(df.sparkSession, path)


def _by_node(edges: DataFrame, low: DataFrame) -> DataFrame:
    """edges (a, b) with low's (a, m) by a, dealt by a and a salt of b: a node may have most edges."""
    left = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    return left.join(low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["a", "salt"]).drop("salt")


def _united(batches: Iterator) -> Iterator:
    """(node, component) of all edges of one task."""
    import pandas as pd

    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    yield pd.DataFrame({"node": list(root), "component": [find(x) for x in list(root)]}, dtype="int64")


def components(edges: DataFrame, finish: int = 0) -> DataFrame:
    """Distributed union-find: (node, component) for every node of ``edges`` (a, b); component is the
    smallest node reachable. With ``finish``, a graph of up to so many edges is finished in one task, by Python.

    Alternates large-star and small-star steps (each a grouped minimum and an equi-join, so the star of a
    hot node is combined before the shuffle and its join salted) until the edges stay the same.
    No edges give an empty table; loops and repeated edges are harmless; null ends are ignored.
    """
    spark = edges.sparkSession
    e = cut(
        edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (now.n, now.h) == state or not now.n:
            break
        state = (now.n, now.h)
        if now.n <= finish:
            out = cut(e.coalesce(1).mapInPandas(_united, "node bigint, component bigint"), "components")
            drop_cut(e)
            return out
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = _by_node(both, low).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _by_node(large, low).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        after = cut(small.where("a <> b").distinct(), "edges")
        drop_cut(e)
        e = after
    return e.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


cloudpickle.register_pickle_by_value(sys.modules[__name__])
