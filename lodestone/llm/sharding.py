"""Shards of documents along a Hilbert curve, so that a file holds a small box of every metadata dimension.

``place(docs)`` quantises source, language and size to ``2 ** BITS`` cells each, gives every document the index of its cell on the
Hilbert curve through them, and cuts the order of the curve into runs: of equal counts (law ``rows``: at most one apart) or of
equal bytes (law ``bytes``: a run ends within one document of its share). ``shard_documents`` moves the texts, ``write_shards``
writes a folder per shard, in order, with a manifest of each dimension's least and greatest value, and ``shards_for`` names the shards that a
predicate on these dimensions can touch.

Cells hold about equally many values' rows: texts are turned into numbers that keep their order (the seven bytes after the prefix that
all values share), and the edges are approximate percentiles of these, a bounded sketch. A source that holds a third of all rows
fills several cells' worth of rows in one cell, which the other dimensions divide.

Every row gets its exact place without a sort of the table: rows of a cell are dealt to bins by a hash of the row, bins of about
``BIN_ROWS`` rows, in which equal rows are one row with a count; counts are summed up bin by bin within a cell and cell by cell, and there
are at most ``2 ** (3 * BITS)`` cells. Rows that are equal in all columns are interchangeable, which is what makes a rerun
agree wherever a cell's edges do.

A null text has the size of an empty one (8 bytes with its frame) and checksum 0. Null sources and languages come first. Repeated
rows have a place each. Fewer documents than shards leave shards empty; an empty table gives no rows. A column of any name is
carried by ``shard_documents``, but for shard and slot, which it replaces.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded, carried, cut, let, row_hash

SHARDS = 24
BITS = 5  # of each dimension: 32 cells
FRAME = 8  # bytes besides the text
BIN_ROWS = 20_000
ACCURACY = 10_000
MOST_BINS = 1 << 20
MOST_BROADCAST = 200_000
DIMENSIONS = ("source", "lang", "size")
PREFIX = 7  # bytes of a text that order it, after what all share


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """The place of a cell on the Hilbert curve of ``bits`` bits a dimension, by the transposed form of Skilling (2004): undo
    the turns from the highest bit down, Gray-code, and interleave."""
    n, top = len(cells), [F.lit(1 << (bits - 1 - k)).cast("bigint") for k in range(bits)]
    begin = F.array(*[c.cast("bigint") for c in cells])
    xor = lambda a, b: a.bitwiseXOR(b)

    def turn(x: Column, step: Column) -> Column:
        i, q = F.pmod(step, F.lit(n)), F.element_at(F.array(*top), (F.floor(step / n) + 1).cast("int"))
        own, low, none = F.element_at(x, i + 1), q - 1, F.lit(0).cast("bigint")
        swap = xor(F.element_at(x, 1), own).bitwiseAND(low)
        up = own.bitwiseAND(q) != 0
        return F.transform(x, lambda v, j: xor(v, F.when(up, F.when(j == 0, low).otherwise(none)).otherwise(F.when((i > 0) & ((j == 0) | (j == i)), swap).otherwise(none))))

    undone = F.aggregate(F.sequence(F.lit(0), F.lit(n * (bits - 1) - 1)), begin, turn)
    gray = lambda x: F.transform(x, lambda _, j: F.aggregate(F.slice(x, 1, j + 1), F.lit(0).cast("bigint"), xor))

    def flipped(x: Column) -> Column:
        last = F.element_at(x, -1)
        t = reduce(xor, [F.when(last.bitwiseAND(F.lit(1 << k).cast("bigint")) != 0, F.lit((1 << k) - 1).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for k in range(1, bits)])
        return let(t, lambda t: F.transform(x, lambda v: xor(v, t)))

    def woven(x: Column) -> Column:
        parts = [F.shiftleft(F.shiftright(F.element_at(x, i + 1), b).bitwiseAND(F.lit(1).cast("bigint")), b * n + n - 1 - i) for b in range(bits) for i in range(n)]
        return reduce(lambda a, p: a.bitwiseOR(p), parts)

    return let(let(let(undone, gray), flipped), woven)


def _number(text: Column, shared: int) -> Column:
    """A number that orders texts by the bytes after the shared ones; null is least."""
    part = F.rpad(F.hex(F.substring(text.cast("binary"), shared + 1, PREFIX)), 2 * PREFIX, "0")
    return F.coalesce(F.conv(part, 16, 10).cast("bigint"), F.lit(-1).cast("bigint"))


def _shared(low: bytes | None, high: bytes | None) -> int:
    """Bytes that all texts from ``low`` to ``high`` begin with."""
    n = 0
    while low and high and n < min(len(low), len(high)) and low[n] == high[n]:
        n += 1
    return n


def _cell(value: Column, edges: list[int]) -> Column:
    """How many edges are at or below the value."""
    return F.size(F.filter(F.array(*[F.lit(e).cast("bigint") for e in edges]), lambda e: e <= value)) if edges else F.lit(0)


def _dimensions(slim: DataFrame, bits: int) -> DataFrame:
    """``slim`` (source, lang, size, ...) with its place on the curve."""
    ends = slim.agg(*[f(F.col(c).cast("binary")).alias(f"{c}_{n}") for c in ("source", "lang") for n, f in (("lo", F.min), ("hi", F.max))]).first()
    shared = {c: _shared(*(None if (x := ends[f"{c}_{n}"]) is None else bytes(x) for n in ("lo", "hi"))) for c in ("source", "lang")}
    values = {"source": _number(F.col("source"), shared["source"]), "lang": _number(F.col("lang"), shared["lang"]), "size": F.col("size")}
    parts = [k / (1 << bits) for k in range(1, 1 << bits)]
    edges = slim.agg(*[F.percentile_approx(v, parts, ACCURACY).alias(c) for c, v in values.items()]).first()
    return slim.withColumn("curve", hilbert_index([_cell(v, sorted(set(edges[c] or []))) for c, v in values.items()], bits))


def place(docs: DataFrame, shards: int = SHARDS, law: str = "rows", bits: int = BITS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: runs have no such promise), source, lang, curve, r1 and r2 (hashes of
    the row)."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"no law {law}")
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), (F.octet_length(text) + FRAME).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        row_hash(docs, 0).alias("r1"), row_hash(docs, 1).alias("r2"),
    )
    slim = cut(slim, "slim")
    kinds = ["curve", "r1", "r2", "doc_id", "source", "lang", "size", "text_crc32"]
    once = cut(_dimensions(slim, bits).groupBy(*kinds).agg(F.count("*").alias("n")), "cells", [slim])
    cells = cut(once.groupBy("curve").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("bytes"), F.count("*").alias("kinds")), "counts")
    over = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 ** (3 * bits) rows
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0).cast("bigint"))
    total = cells.agg(F.sum("n"), F.sum("bytes")).first()
    n, volume = total[0] or 0, total[1] or 0
    # bins of a cell, in order of the hash: as many as keep them at BIN_ROWS kinds
    bins = F.least(F.greatest(F.ceil(F.col("kinds") / BIN_ROWS), F.lit(1)), F.lit(MOST_BINS)).cast("bigint")
    known = F.broadcast(cells.select("curve", bins.alias("bins"), before("n", over).alias("cell_n"), before("bytes", over).alias("cell_bytes")))
    at = once.join(known, "curve").withColumn("bin", F.floor(F.shiftrightunsigned("r1", 24) * F.col("bins") / (1 << 40)).cast("bigint"))
    sums = at.groupBy("curve", "bin").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("bytes"))
    w = Window.partitionBy("curve").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("curve", "bin", before("n", w).alias("bin_n"), before("bytes", w).alias("bin_bytes"))
    w = Window.partitionBy("curve", "bin").orderBy("r1", "r2", "doc_id", "source", "lang", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    each = at.join(sums, ["curve", "bin"])
    each = each.withColumns({"rank": F.col("cell_n") + F.col("bin_n") + before("n", w), "start": F.col("cell_bytes") + F.col("bin_bytes") + before(F.col("n") * F.col("size"), w)})
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    each = each.withColumns({"rank": F.col("rank") + F.col("copy"), "start": F.col("start") + F.col("copy") * F.col("size")})
    if law == "rows":
        each = each.withColumn("shard", F.expr(f"cast((rank * {shards}L) div {max(n, 1)}L as int)"))
        each = each.withColumn("slot", F.col("rank") - F.expr(f"(shard * {n}L + {shards - 1}) div {shards}L"))
    else:
        middle = F.col("start") + F.floor(F.col("size") / 2)
        each = cut(each.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / max(volume, 1))).cast("int")), "ranks", [once])
        firsts = F.broadcast(each.groupBy("shard").agg(F.min("rank").alias("first")))  # a row per shard
        each = each.join(firsts, "shard").withColumn("slot", F.col("rank") - F.col("first"))
    return each.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source", "lang", "curve", "r1", "r2", "copy")


def shard_documents(docs: DataFrame, shards: int = SHARDS, law: str = "rows") -> DataFrame:
    """The rows of ``docs`` with shard and slot. Of equal rows one is moved and takes all their places."""
    docs = docs.drop("shard", "slot")
    placed = place(docs, shards, law).select("r1", "r2", "copy", "shard", "slot")
    again = bounded(placed.where("copy = 1").select("r1", "r2"), MOST_BROADCAST)
    rows = carried(docs, r1=row_hash(docs, 0), r2=row_hash(docs, 1))
    rows = rows.join(again, ["r1", "r2"], "left_anti").unionByName(rows.join(again, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"]))
    return rows.join(placed, ["r1", "r2"]).select("row.*", "shard", "slot")


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, law: str = "rows") -> DataFrame:
    """Writes a folder per shard, its files in order of the slots, and gives the manifest: per shard rows, bytes, and of source, language and size the least and
    greatest value and whether there are nulls."""
    out = cut(shard_documents(docs, shards, law), "sharded")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    size = F.octet_length(F.coalesce("text", F.lit(""))) + FRAME
    each = out.select("shard", "source", "lang", size.cast("bigint").alias("size"))
    ends = [f(c).alias(f"{n}_{c}") for c in DIMENSIONS for n, f in (("least", F.min), ("most", F.max))] + [(F.count_if(F.col(c).isNull()) > 0).alias(f"null_{c}") for c in DIMENSIONS]
    return cut(each.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ends), "manifest", [out])


def shards_for(manifest: DataFrame, **within: tuple) -> DataFrame:
    """The manifest's rows of shards that can hold a row with each named dimension within (least, most), ends included."""
    keep = F.lit(True)
    for c, (lo, hi) in within.items():
        keep = keep & (F.col(f"least_{c}") <= F.lit(hi)) & (F.col(f"most_{c}") >= F.lit(lo))
    return manifest.where(keep)
