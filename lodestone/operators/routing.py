"""Grader routing: the first rule whose needle a file contains, else every grader that isn't slow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def route(files: DataFrame, rules: DataFrame, graders: DataFrame) -> DataFrame:
    """(file, graders): files (file); rules (ord, needle, names); graders (ord, name, slow). Rules and graders are
    configuration, bounded by what a person writes, so both are broadcast; a rule counts if one of its names exists."""
    known = rules.select("ord", "needle", F.posexplode("names").alias("k", "name")).join(F.broadcast(graders.select("name")), "name")
    known = known.groupBy("ord", "needle").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "name"))), lambda x: x["name"]).alias("names"))
    fallback = graders.where(~F.col("slow")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]).alias("all_names"))
    hit = files.join(F.broadcast(known), F.contains("file", "needle"), "left").groupBy("file").agg(F.min(F.when(F.col("ord").isNotNull(), F.struct("ord", "names"))).alias("first"))
    return hit.join(F.broadcast(fallback)).select("file", F.coalesce("first.names", "all_names").alias("graders"))


def union_graders(routed: DataFrame, key: str) -> DataFrame:
    """Ordered distinct union of the graders of a subject's files, in order of file place: routed (key, pos, graders)."""
    return routed.groupBy(key).agg(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "graders"))), lambda x: x["graders"]))).alias("graders"))
