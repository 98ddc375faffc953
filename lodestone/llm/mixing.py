"""Mixing sources to target weights.

Documents of a source are dealt to blocks by hash; an affine permutation orders the blocks. A source's
words target becomes a quota of block draws: whole rounds of all its blocks, then the first blocks of the
permutation until the words suffice, the last of them in part. A splitting tree hands these quotas to the
output shards: at each node the left half's counts are a multivariate hypergeometric draw, source by
source, so sums are exact at every level. Shards take disjoint runs of the permutation, and each shard is
ordered by a hash of its own.

Prefix sums run on blocks and on bins of blocks, never on all rows of a source in one task; sources themselves, one row
each, are ranked in one. All draws come from hashes of whole rows, so reruns agree, however the rows lie in files. Null source: a source of its own, last in order; null text: size 0;
sources without words get target 0; repeated rows are separate documents; an empty table mixes to nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_RE, bounded, carried, cut, let

WEIGHTS = (5, 2, 1)
TOTAL = 1.5  # words mixed, as a share of all words
MOST = 2.0  # a source's and a document's largest repetition
BLOCK_DOCS = 64
BIN = 1024  # blocks whose sums are looked at together
SHARD_BLOCKS = 4096
TRIES = 100  # of a rejection that accepts about two in three
MOST_BROADCAST = 1_000_000  # repeated rows whose texts are looked up


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """(source, docs, source_size, target): weights by rank of the source, repeating; a target above ``most``
    sizes is cut there and the excess shared again by weight, which is water-filling: sources in order of
    size over weight are full until the rest can take its share."""
    per = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.withColumns({"top": most * F.col("source_size"), "all_words": F.sum("source_size").over(everything), "all_weight": F.sum("weight").over(everything)})
    left = total * F.col("all_words") - F.coalesce(F.sum("top").over(before), F.lit(0.0))
    open_weight = F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / open_weight).withColumn("fits", F.col("level") * F.col("weight") < F.col("top"))
    level = F.min(F.when(F.col("fits"), F.struct((F.col("source_size") / F.col("weight")).alias("r"), "level"))).over(everything)["level"]
    return per.select("source", "docs", "source_size", F.when(level.isNull(), F.col("top")).otherwise(F.least(F.col("top"), level * F.col("weight"))).alias("target"))


def _uniform(*parts: Column | str) -> Column:
    return ((F.shiftrightunsigned(F.xxhash64(*parts), 11)).cast("double") + 0.5) / float(1 << 53)


def _log_factorial(n: Column) -> Column:
    """ln n! of n >= 0: logarithms up to 8, Stirling's series beyond, to about 1e-12."""
    x = n + 1.0
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x) - 1 / (1680 * F.pow(x, F.lit(7.0)))
    return F.when(n < 8, F.element_at(F.array(*[F.lit(math.lgamma(k + 1)) for k in range(8)]), F.greatest(F.least(n, F.lit(7.0)), F.lit(0.0)).cast("int") + 1)).otherwise(series)


#: Fixed values of the ratio-of-uniforms hat: 2 sqrt(2 / e) and 3 - 2 sqrt(3 / e).
_HAT = (2 * math.sqrt(2 / math.e), 3 - 2 * math.sqrt(3 / math.e))


def _hypergeometric(n: Column, q: Column, m: Column, *key: Column) -> Column:
    """A draw of how many of q marked among n fall to m slots, exact at every size: ratio-of-uniforms rejection from a table
    mountain hat (Stadlober 1990). Each try takes two uniforms from the key; all ``TRIES`` fail less than once in 1e20 draws, and
    then the mode is taken."""
    d = lambda x: x.cast("double")
    lo, hi = F.greatest(F.lit(0), m - (n - q)), F.least(q, m)
    mean = d(m) * d(q) / F.greatest(d(n), F.lit(1.0))
    var = mean * (1 - d(q) / F.greatest(d(n), F.lit(1.0))) * (d(n) - d(m)) / F.greatest(d(n) - 1, F.lit(1.0))
    mode = F.greatest(F.least(F.floor((d(m) + 1) * (d(q) + 1) / (d(n) + 2)), d(hi)), d(lo))

    def weight(k: Column) -> Column:
        return -(_log_factorial(k) + _log_factorial(d(q) - k) + _log_factorial(d(m) - k) + _log_factorial(d(n) - d(q) - d(m) + k))

    shape = F.struct(mean.alias("mean"), (_HAT[0] * F.sqrt(F.greatest(var, F.lit(0.0)) + 0.5) + _HAT[1]).alias("width"), mode.alias("mode"), weight(mode).alias("top"), d(lo).alias("lo"), d(hi).alias("hi"))

    def tried(s: Column) -> Column:
        def one(found: Column, i: Column) -> Column:
            x, y = _uniform(*key, i, F.lit("x")), _uniform(*key, i, F.lit("y"))
            k = F.floor(s["mean"] + 0.5 + s["width"] * (y - 0.5) / x).cast("double")
            fits = (k >= s["lo"]) & (k <= s["hi"])
            inside = F.greatest(F.least(k, s["hi"]), s["lo"])
            return F.when(found.isNotNull(), found).when(fits & (2 * F.log(x) <= weight(inside) - s["top"]), k)

        return F.coalesce(F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("double"), one), s["mode"]).cast("bigint")

    return F.when(lo >= hi, lo).otherwise(let(shape, tried))


def split_quotas(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(source, quota) to (shard, source, quota) over 2 ** depth shards by the splitting tree. A node is one
    row that holds its sources' counts; rows number the shards, arrays the sources."""
    nodes = quotas.where("quota > 0").groupBy().agg(F.sort_array(F.collect_list(F.struct("source", F.col("quota").alias("q")))).alias("xs")).select(F.lit(0).cast("bigint").alias("node"), "xs")
    kind = "array<struct<source:string,l:bigint,r:bigint>>"
    for level in range(depth):
        total = F.aggregate("xs", F.lit(0).cast("bigint"), lambda a, x: a + x["q"])

        at = F.lit(level)

        def deal(a: Column, x: Column) -> Column:
            key = (F.lit(seed), at, F.col("node"), x["source"])  # noqa: B023  used within this turn of the loop
            left = _hypergeometric(a["n"], x["q"], a["m"], *key).cast("bigint")
            return let(left, lambda k: F.struct((a["n"] - x["q"]).alias("n"), (a["m"] - k).alias("m"), F.array_append(a["out"], F.struct(x["source"].alias("source"), k.alias("l"), (x["q"] - k).alias("r"))).alias("out")))

        dealt = F.aggregate("xs", F.struct(total.alias("n"), F.floor(total / 2).cast("bigint").alias("m"), F.array().cast(kind).alias("out")), deal)["out"]
        half = lambda side: F.transform("out", lambda x: F.struct(x["source"].alias("source"), x[side].alias("q")))
        nodes = nodes.select("node", dealt.alias("out")).select(F.explode(F.array(F.struct((2 * F.col("node")).alias("node"), half("l").alias("xs")), F.struct((2 * F.col("node") + 1).alias("node"), half("r").alias("xs")))).alias("x")).select("x.*")
        nodes = cut(nodes, "tree")
    return nodes.select(F.col("node").alias("shard"), F.explode("xs").alias("x")).select("shard", "x.source", F.col("x.q").alias("quota"))


def _row_id(docs: DataFrame) -> Column:
    """A hash of all columns of a row; of maps, of their entries in order of keys."""
    kinds = dict(docs.dtypes)
    return F.xxhash64(*[F.array_sort(F.map_entries(F.col(f"`{c}`"))) if kinds[c].startswith("map") else F.col(f"`{c}`") for c in docs.columns])


def mix(docs: DataFrame, seed: int = 20, block_docs: int = BLOCK_DOCS, shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """(sized, draws). sized: a row per document with rid, nth, doc_id, source, size, source_size, target; rid is a hash of the
    whole row, and nth numbers equal ones. draws: a row per copy in the mix with rid, nth, doc_id, size, copy, shard, shuffle_key
    (the order within its shard)."""
    each = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _row_id(docs).alias("rid"))
    sized = each.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.first("source").alias("source"), F.first("size").alias("size"), F.count("*").alias("rows"))
    sized = cut(sized.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows")))).drop("rows"), "sizes")
    per = cut(
        source_targets(sized)
        .withColumn("blocks", F.greatest(F.ceil(F.col("docs") / block_docs), F.lit(1)).cast("bigint"))
        .withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
        .withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size")),
        "targets",
    )
    # the affine step is coprime to the number of blocks: a prime that doesn't divide it
    step = F.when(F.col("blocks") % 1000003 != 0, F.lit(1000003)).otherwise(F.lit(998244353)).cast("bigint")
    at = (F.pmod(F.xxhash64(F.lit(seed), "rid"), F.col("blocks")) * (step % F.col("blocks")) + 7) % F.col("blocks")
    same = sized["source"].eqNullSafe(per["source"])
    placed = sized.join(per.drop("docs"), same).drop(per["source"]).withColumn("rank", at)
    placed = cut(placed, "placed")
    blocks = placed.groupBy("source", "rank", "rest").agg(F.sum("size").alias("words"))
    bins = blocks.groupBy("source", "rest", F.floor(F.col("rank") / BIN).alias("bin")).agg(F.sum("words").alias("words"))
    w = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    edge = bins.withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0))).where("rest > before and rest <= before + words").select("source", "bin", "before")
    inside = blocks.withColumn("bin", F.floor(F.col("rank") / BIN))
    inside = inside.join(edge, inside["source"].eqNullSafe(edge["source"]) & (inside["bin"] == edge["bin"])).select(inside["source"], "rank", "rest", "words", "before")
    w = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    last = cut(
        inside.withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(w), F.lit(0)))
        .where("rest > before and rest <= before + words")
        .select(F.col("source").alias("last_source"), F.col("rank").alias("last_rank"), (F.col("rest") - F.col("before")).alias("part")),
        "edges",
    )
    placed = placed.join(last, placed["source"].eqNullSafe(last["last_source"]), "left").drop("last_source")
    w = Window.partitionBy("source", "rank").orderBy(F.xxhash64(F.lit(seed + 1), "rid"), "rid", "nth").rowsBetween(Window.unboundedPreceding, -1)
    cutting = placed.where("rank = last_rank").withColumn("before", F.coalesce(F.sum("size").over(w), F.lit(0)))
    extra = F.when(F.col("rank") < F.col("last_rank"), 1).otherwise(0)
    some = placed.where("last_rank is null or rank <> last_rank").withColumn("extra", extra)
    some = some.unionByName(cutting.withColumn("extra", F.when(F.col("before") + F.col("size") / 2 <= F.col("part"), 1).otherwise(0)).drop("before"))
    copies = some.withColumn("copies", F.col("rounds") + F.col("extra")).where("copies > 0 and size > 0")
    copies = copies.select("rid", "nth", "doc_id", "source", "size", "blocks", "rank", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"))
    draws = copies.withColumn("draw", F.col("copy") * F.col("blocks") + F.col("rank"))

    quotas = cut(
        per.join(last, per["source"].eqNullSafe(last["last_source"]), "left").select("source", (F.col("rounds") * F.col("blocks") + F.coalesce(F.col("last_rank") + 1, F.lit(0))).alias("quota")), "quotas"
    )
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    depth = max(4, math.ceil(math.log2(max(1, total) / shard_blocks)) if total else 0)
    parts = split_quotas(quotas, depth, seed)
    w = Window.partitionBy("source").orderBy("shard")
    runs = parts.withColumn("end", F.sum("quota").over(w)).where("quota > 0").select(F.col("source").alias("run_source"), "shard", F.explode(F.sequence(F.col("end") - F.col("quota"), F.col("end") - 1)).alias("run_draw"))
    draws = draws.join(runs, (draws["draw"] == runs["run_draw"]) & draws["source"].eqNullSafe(runs["run_source"]))
    draws = draws.select("rid", "nth", "doc_id", "source", "size", "copy", "shard", F.xxhash64(F.lit(seed + 2), "shard", "rid", "copy", "nth").alias("shuffle_key"))
    sized = sized.join(per.select("source", "source_size", "target"), same).select("rid", "nth", "doc_id", sized["source"], "size", "source_size", "target")
    return sized, draws


def taken(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words of its copies in the mix)."""
    sized, draws = mix(docs)
    got = draws.groupBy("rid", "nth").agg(F.sum("size").alias("got"))
    return sized.join(got, ["rid", "nth"], "left").select("doc_id", "size", "source_size", "target", F.coalesce("got", F.lit(0)).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: mix_shard, mix_order, mix_copy and the columns of ``docs`` (but for any of these names), a row
    per copy, shuffled within shards. Equal rows are documents of their own, each with its copies."""
    docs = docs.drop("mix_shard", "mix_order", "mix_copy")
    sized, draws = mix(docs)
    got = draws.select("rid", F.col("shard").alias("mix_shard"), F.col("shuffle_key").alias("mix_order"), F.col("copy").alias("mix_copy"))
    rows = carried(docs, rid=_row_id(docs))
    again = bounded(sized.where("nth = 2").select("rid"), MOST_BROADCAST)  # equal rows: one of them stands for all
    rows = rows.join(again, "rid", "left_anti").unionByName(rows.join(again, "rid", "left_semi").dropDuplicates(["rid"]))
    out = rows.join(got, "rid").select("row.*", "mix_shard", "mix_order", "mix_copy")
    return out.repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_order")
