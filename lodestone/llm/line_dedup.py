"""Fuzzy line dedup by MinHash: of lines that are alike, one stays.

Lines of ``least`` code points or more, and blank ones never, take part. The functions start at ``LEAST`` unless told
otherwise; the query and the pipeline take every line that isn't blank (``ALL``).

1. Equal lines are one node, and are made so before they are signed. A line's signature is made of minima of hashes of the shingles
   that are verified later: all its strings of ``SHINGLE`` characters of the line in lower case (signed as UTF-16 units; of a shorter
   line, itself). 49 minima make 28 bands of seven (49 for short lines), the buckets, and a sketch of 192 bits, four of a minimum. Bands are that long because
   unrelated lines share a tenth of their shingles, so that those of shorter ones meet in numbers that grow with the square of the table.
2. Each line first meets the least line of a bucket, of these the one that most of its buckets have. Buckets that span components still
   are searched further: a pivot meets all others, in rounds, and is out then. When the pairs that are left cost no more than a
   pass, or rounds no longer halve them, they are looked at in blocks, so no bucket is left unsearched by its size. There lines are
   candidates where their sketches agree in ``AGREE`` places or more, which by the binomial fewer than one in 200 pairs of the similarity sought miss.
3. Candidates count when the exact Jaccard similarity of their shingle sets is 0.8 or more. A bitmap of a line's shingles
   bounds it from above, which spares most texts of pairs that fall short and loses none.
4. Distributed union-find makes components; of each, the occurrence in the smallest doc_id (then by line hash, then by
   text hash and place) stays.

All steps are DataFrame expressions. Defined cases: null text has no lines and stays null; an empty text has one empty
line; rows are told apart by doc_id and text, so rows with the same of both count as one and others never share their
lines; null doc_ids come after all others; extra columns of any name are carried. Lines, texts and shingles are told apart by
64-bit hashes.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, carried, components, cut, doc_key, drop_cut, let

LEAST = 30
ALL = 1
SHINGLE = 5
SIDE = 7  # minima are SIDE squared
SLOPES = 4  # bands are SLOPES times SIDE
SHORT = 128  # bytes of UTF-16 up to which a line has the bands of all slopes: of few shingles, minima vary together
HASHES = 4  # of a shingle, by turns for the minima
NIBBLES = 48  # minima in the sketch
AGREE = 31  # of them, for a candidate
RUN = 4  # shingles that one row of the signing takes
WORDS = 16  # of 64 bits, in the bitmap of a line's shingles
BLOCK = 512  # members of a bucket that meet in a task
MOST_BROADCAST = 1_000_000  # buckets of several lines; ids of lines whose texts are looked up
_BLANK = r" \t\n\x0B\f\r"


def _rows(docs: DataFrame) -> DataFrame:
    """(doc, copy, text): what tells rows apart, and orders them."""
    return docs.select(doc_key(F.col("doc_id")).alias("doc"), F.xxhash64("text").alias("copy"), "text")


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """(doc, copy, pos, line) of the lines that take part."""
    rows = _rows(docs).select("doc", "copy", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return rows.where((F.length("line") >= least) & (F.length(F.expr(f"btrim(line, '{_BLANK}')")) > 0))


def _units(line: Column) -> Column:
    """A line in lower case as two bytes a UTF-16 unit, of which substrings cost what they are long."""
    return F.encode(F.lower(line), "UTF-16BE")


def _signatures(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(id, doc, n, sketch, buckets) of distinct lines: doc their smallest, n their occurrences. Lines become distinct first, each task's
    before they are shuffled, and what deals them out by id serves the minima too. A row takes ``RUN`` shingles (at the end of a line, its last
    ones again, which alter no minimum), since finding a line among the groups costs more than hashing a shingle. Further hashes of a
    shingle are made of its first."""
    lines = _lines(docs, least).groupBy(F.xxhash64("line").alias("id")).agg(F.min("doc").alias("doc"), F.count("*").alias("n"), F.first("line").alias("line"))
    lines = lines.select("id", "doc", "n", _units(F.col("line")).alias("units"))
    lines = lines.select("id", "doc", "n", "units", F.greatest(F.octet_length("units") - (2 * SHINGLE - 1), F.lit(1)).alias("last"))
    runs = lines.select("id", "doc", "n", "units", "last", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(2 * RUN))).alias("at"))
    shingle = lambda k: F.xxhash64(F.substring("units", F.least(F.col("at") + 2 * k, "last"), 2 * SHINGLE))
    runs = runs.select("id", "doc", "n", "last", *[shingle(k).alias(f"h0_{k}") for k in range(RUN)])
    runs = runs.select("*", *[F.xxhash64(F.lit(j), f"h0_{k}").alias(f"h{j}_{k}") for j in range(1, HASHES) for k in range(RUN)])
    size = SIDE * SIDE
    minima = [F.min(F.least(*[F.col(f"h{i % HASHES}_{k}").bitwiseXOR(F.lit(c)) for k in range(RUN)])).alias(f"m{i}") for i, c in enumerate(_constants(size))]
    signed = runs.groupBy("id").agg(F.min("doc").alias("doc"), F.min("n").alias("n"), F.min("last").alias("last"), *minima)
    buckets = [F.xxhash64(F.lit(b), *[F.col(f"m{k}") for k in band]) for b, band in enumerate(_bands())]
    usual = F.array(*buckets[: SLOPES * SIDE])
    buckets = F.when(F.col("last") <= SHORT, F.concat(usual, F.array(*buckets[SLOPES * SIDE :]))).otherwise(usual)
    nibbles = [F.shiftleft(F.xxhash64(f"m{k}").bitwiseAND(F.lit(15)), 4 * (k % 16)) for k in range(NIBBLES)]
    words = [functools.reduce(lambda x, y: x.bitwiseOR(y), nibbles[k : k + 16]).alias(f"s{k // 16}") for k in range(0, NIBBLES, 16)]
    return signed.select("id", "doc", "n", F.struct(*words).alias("sketch"), buckets.alias("buckets"))


def _agree(a: str, b: str) -> Column:
    """In how many of their places two sketches agree."""

    def apart(w: int) -> Column:
        x = F.col(f"{a}.s{w}").bitwiseXOR(F.col(f"{b}.s{w}"))
        odd = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))
        return F.bit_count(odd.bitwiseAND(F.lit(0x1111111111111111)))

    return F.lit(NIBBLES) - functools.reduce(lambda x, y: x + y, [apart(w) for w in range(NIBBLES // 16)])


def _bands() -> list[list[int]]:
    """Places of minima in each band: sloped lines of the affine plane over the integers modulo ``SIDE``, a prime, on which
    the minima are points; those of short lines alone come last. Two bands share one minimum at most."""
    cells = range(SIDE)
    return [[SIDE * x + (slope * x + shift) % SIDE for x in cells] for slope in [*cells[1:], 0] for shift in cells]


def _constants(n: int) -> list[int]:
    """Signed 64-bit numbers; those of one hash differ in their first five bits. The hash least by ``h xor c`` is the one that shares c's
    leading bits longest, so each constant looks first at shingles of its own."""
    out = []
    for k in range(n):
        z = ((k + 1) * 0x9E3779B97F4A7C15) & (1 << 64) - 1
        z = ((z ^ z >> 30) * 0xBF58476D1CE4E5B9) & (1 << 64) - 1
        z = (z & (1 << 59) - 1) | (11 * (k // HASHES) % 32) << 59
        out.append(z - (1 << 64) if z >> 63 else z)
    return out


def _shingles(low: str) -> Column:
    """Hashes of the strings of SHINGLE characters of a line in lower case, one from each place; of a shorter line, of itself.
    A character is four bytes, so that a substring costs what it is long."""
    at = lambda x: F.sequence(F.lit(1), F.greatest(F.octet_length(x) - (4 * SHINGLE - 1), F.lit(1)), F.lit(4))
    return let(F.encode(F.col(low), "UTF-32"), lambda x: F.transform(at(x), lambda i: F.xxhash64(F.substring(x, i, F.lit(4 * SHINGLE)))))


def _bitmaps(texts: DataFrame) -> DataFrame:
    """(id, bits): per line a struct of n, its places of shingles, and ``WORDS`` words with a bit for the hash of each."""
    lines = texts.select("id", F.encode("low", "UTF-32").alias("units")).withColumn("last", F.greatest(F.octet_length("units") - (4 * SHINGLE - 1), F.lit(1)))
    runs = lines.select("id", "units", "last", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(4 * RUN))).alias("at"))
    shingle = lambda k: F.xxhash64(F.substring("units", F.least(F.col("at") + 4 * k, "last"), F.lit(4 * SHINGLE)))
    runs = runs.select("id", "last", *[shingle(k).alias(f"h{k}") for k in range(RUN)])
    runs = runs.select("id", "last", *[F.expr(f"shiftleft(1L, cast(h{k} & 63 as int))").alias(f"bit{k}") for k in range(RUN)], *[F.shiftrightunsigned(f"h{k}", 6).bitwiseAND(F.lit(WORDS - 1)).alias(f"at{k}") for k in range(RUN)])
    part = lambda w: functools.reduce(lambda x, y: x.bitwiseOR(y), [F.when(F.col(f"at{k}") == w, F.col(f"bit{k}")).otherwise(F.lit(0).cast("bigint")) for k in range(RUN)])
    words = runs.groupBy("id").agg(F.max("last").alias("last"), *[F.bit_or(part(w)).alias(f"w{w}") for w in range(WORDS)])
    return words.select("id", F.struct(F.floor((F.col("last") + 3) / 4).alias("n"), *[f"w{w}" for w in range(WORDS)]).alias("bits"))


def _near(x: str, y: str) -> Column:
    """Whether lines of these bitmaps may be alike. Sets of a and b elements at 0.8 or more differ in (a + b) / 9 elements at
    most, each bit in which the bitmaps differ needs one of its own, and a line has at least as many places as elements."""
    apart = functools.reduce(lambda a, b: a + b, [F.bit_count(F.col(f"{x}.w{w}").bitwiseXOR(F.col(f"{y}.w{w}"))) for w in range(WORDS)])
    return 9 * apart <= F.col(f"{x}.n") + F.col(f"{y}.n")


def _verified(pairs: DataFrame, texts: DataFrame, single: bool = False) -> DataFrame:
    """The pairs (a, b) of ids whose lines are alike; ``single`` if no b is in two pairs. Explodes of one element keep Catalyst from writing their columns out at
    each use, which would hash shingles again and again."""
    with_a = pairs.join(texts.toDF("a", "ta"), "a")
    both = with_a.join(texts.toDF("b", "tb"), "b")
    if not single:
        both = both.repartition("a", "b")  # a pivot has many pairs
    sets = both.select("a", "b", F.explode(F.array(F.struct(_shingles("ta").alias("a"), _shingles("tb").alias("b")))).alias("x"))
    sizes = sets.select("a", "b", F.explode(F.array(F.struct(F.size(F.array_intersect("x.a", "x.b")).alias("both"), F.size(F.array_union("x.a", "x.b")).alias("either")))).alias("x"))
    return sizes.where("5 * x.both >= 4 * x.either").select("a", "b")


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of rows (id, sketch, id2, sketch2) whose sketches agree."""
    some = met.where((F.col("id") != F.col("id2")) & (_agree("sketch", "sketch2") >= AGREE))
    return some.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()


def _open(at: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the buckets (bucket, id) that span components still: with component, k, the bucket's members, and main
    the component that has most, k_main, of them."""
    own = at.select("bucket", "id").join(found.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    counts = own.groupBy("bucket", "component").agg(F.count("*").alias("c"))
    wide = counts.groupBy("bucket").agg(F.sum("c").alias("k"), F.max("c").alias("k_main"), F.max_by("component", "c").alias("main")).where("k_main < k")
    return own.join(wide, "bucket")


def _met(at: DataFrame) -> DataFrame:
    """(id, sketch, id2, sketch2) of members of a bucket that are of different components, each once a bucket. A bucket
    is dealt into blocks of ``BLOCK``, and block meets block, so that no task has a large bucket. Members of the
    main component only meet the others."""
    block = lambda n: F.pmod(F.xxhash64(F.lit(5), "id"), n).cast("int")
    sized = at.withColumn("n_rest", F.ceil((F.col("k") - F.col("k_main")) / BLOCK)).withColumn("n_all", F.ceil(F.col("k") / BLOCK)).withColumn("rest", F.col("component") != F.col("main"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    left = sized.where("rest").select("bucket", block(F.col("n_rest")).alias("i"), upto("n_all").alias("j"), "id", "sketch", F.col("component").alias("c1"))
    right = sized.select("bucket", block(F.col("n_all")).alias("j"), upto("n_rest").alias("i"), F.col("id").alias("id2"), F.col("sketch").alias("sketch2"), F.col("component").alias("c2"), "rest")
    return left.join(right, ["bucket", "i", "j"]).where("c1 <> c2 and (not rest or id < id2)")


def similar_lines(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lines, found): lines (id, doc, n, sketch, buckets) of distinct lines; found (node, component) of those that have
    others alike."""
    lines = cut(_signatures(docs, least), "lines")
    held = lines.select("id", F.explode("buckets").alias("bucket"))
    shared = held.repartition("bucket").groupBy("bucket").agg(F.min("id").alias("id2"), F.count("*").alias("k")).where("k > 1").select("bucket", "id2")
    shared = bounded(shared, MOST_BROADCAST)  # most buckets hold one line
    held = cut(held.join(shared, "bucket"), "held", [shared])
    some = bounded(held.select("id").distinct(), MOST_BROADCAST)
    texts = _lines(docs, least).select(F.xxhash64("line").alias("id"), "line").join(some, "id", "left_semi")
    texts = cut(texts.groupBy("id").agg(F.min("line").alias("line")).select("id", F.lower("line").alias("low")), "texts", [some])
    # each line meets the least line of a bucket, the one with which it shares most
    stars = held.where("id <> id2").repartition("id").groupBy("id", "id2").agg(F.count("*").alias("k"))
    links = cut(_verified(stars.groupBy("id").agg(F.max_by("id2", "k").alias("a")).select("a", F.col("id").alias("b")), texts, single=True), "links")
    found = cut(components(links), "components")
    # buckets of several components: more pivots, then what is left
    at, left, most = cut(_open(held, found), "open", [held]), None, 4 * lines.count()
    sketches, bits = lines.select("id", "sketch"), None
    while True:
        work, left = left, at.select("bucket", "k", "k_main").distinct().agg(F.sum(F.expr("(k - k_main) * k"))).first()[0] or 0
        if not left:
            break
        if bits is None:
            some = at.select("id").distinct()
            sketches, bits = cut(sketches.join(some, "id", "left_semi"), "sketches"), cut(_bitmaps(texts.join(some, "id", "left_semi")), "bitmaps")
        last = left <= most or work is not None and 2 * left > work
        if last:
            met = _met(at.join(sketches, "id"))
        else:
            pivots = at.groupBy("bucket").agg(F.min("id").alias("id2"), F.min_by("component", "id").alias("c2"))
            met = cut(at.join(pivots, "bucket").where("id <> id2"), "met", [at])
        pairs = met if last else met.where("component <> c2").select("id", "id2").distinct().join(sketches, "id").join(sketches.toDF("id2", "sketch2"), "id2")
        near = cut(_pairs(pairs), "pairs").join(bits.toDF("a", "bits"), "a").join(bits.toDF("b", "bits2"), "b").where(_near("bits", "bits2"))
        links = cut(links.unionByName(_verified(near.select("a", "b"), texts)), "links", [links, found])
        found = cut(components(links), "components")
        if last:
            break
        at = cut(_open(met, found), "open", [met])
    for x in (texts, links, at):
        drop_cut(x)
    return lines, found


def decisions(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc, copy, gone): places of the lines to remove, sorted, per row of documents that has any."""
    lines, found = similar_lines(docs, least)
    joined = lines.select("id", "doc", "n").join(found.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    joined = cut(joined.where("n > 1 or component <> id").unionByName(joined.where("n = 1 and component = id").join(found.select(F.col("component").alias("id")).distinct(), "id", "left_semi")), "copies", [lines, found])
    keepers = joined.groupBy("component").agg(F.min(F.struct("doc", "id")).alias("keep"))
    fate = bounded(joined.join(keepers, "component").select("id", F.col("keep.doc").alias("keep_doc"), F.col("keep.id").alias("keep_id")), MOST_BROADCAST)
    at = cut(_lines(docs, least).select("doc", "copy", "pos", F.xxhash64("line").alias("id")).join(fate, "id"), "occurrences", [joined, fate])
    first = at.where("id = keep_id and doc = keep_doc").groupBy("doc", "id").agg(F.min(F.struct("copy", "pos")).alias("x")).select("doc", "id", "x.*")
    gone = at.select("doc", "copy", "pos", "id").join(first, ["doc", "id", "copy", "pos"], "left_anti")
    return gone.groupBy("doc", "copy").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def removed_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, removed (places of lines, from 0)."""
    gone = decisions(docs, least)
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("bigint")
    own = docs.select("doc_id", n.alias("n_lines"), doc_key(F.col("doc_id")).alias("doc"), F.xxhash64("text").alias("copy"))
    removed = F.coalesce("gone", F.array().cast("array<int>"))
    return own.join(gone, ["doc", "copy"], "left").select("doc_id", "n_lines", F.size(removed).cast("bigint").alias("n_removed"), removed.alias("removed"))


def dedup_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` without the removed lines, in the same columns; n_chars, if there, is that of the new text."""
    gone = decisions(docs, least)
    rows = carried(docs, doc=doc_key(F.col("doc_id")), copy=F.xxhash64("text")).join(gone, ["doc", "copy"], "left")
    kept = let(F.split("row.text", "\n", -1), lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("gone")), lambda i: F.get(x, i)), "\n"))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(kept)
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(dict(docs.dtypes)["n_chars"])
    return rows.select(*[(new.get(c, F.col(f"row.`{c}`"))).alias(c) for c in docs.columns])
