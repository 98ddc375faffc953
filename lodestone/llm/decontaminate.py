"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders; windows of template words are hashed and joined between
benchmark items and documents. For each alignment of an item with a document the slots are read back: the same item
value must stand for the same document value all along, so a re-parameterised question is caught and a
chance meeting of templates isn't. A document is contaminated where an alignment's matching windows
cover enough of the item.

The window table of the benchmark, and the ids of documents that a step looks up, are broadcast only where their counted
rows are under ``MOST_BROADCAST``; above, both sides are joined by hash. Document windows never meet one another, so a passage that many documents share costs what
it is long.

Names are told in two ways, as capitalised words inside a sentence and as all words with a capital, and each way's
alignments are judged by themselves. Windows with many slots count where their plain words are equal, or where the whole
item is found with slots that agree.

Defined cases: null and empty texts match nothing; items of fewer than ``LEAST`` words match as exact sequences of words,
items shorter than a window are one window; each text of a null item_id is an item; repeated rows of documents or items count once; extra columns are ignored by ``find_leaks``
and carried by ``drop_leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RE, bounded, carried, cut, let

WINDOW = 8
LEAST = 5
MOST_SLOTS = 4  # placeholders in a window; one with more says too little alone
MIN_WINDOWS = 2  # of an alignment; all of them in an item that has fewer
MOST_BROADCAST = 500_000
#: Unit words that become a placeholder after a number.
UNITS = "km|kg|cm|mm|m|g|mg|l|ml|s|ms|min|h|hz|khz|mhz|ghz|kb|mb|gb|tb|w|kw|v|kv|a|usd|eur|gbp|dollars?|euros?|pounds?|cents?|years?|months?|weeks?|days?|hours?|minutes?|seconds?|meters?|metres?|miles?|feet|inches|grams?|liters?|litres?|percent"
_STRIP = r"[^\p{L}\p{N}\x20\x09-\x0D]+"
SLOT_RE = "zq(num|name|unit)"


def template_words(text: Column, all_capitals: bool = False) -> Column:
    """Words with placeholders; word i is word i of ``plain_words``. Names are capitalised words inside a sentence, or with
    ``all_capitals`` all words that begin with a capital."""
    # a look ahead, or the number before a unit, comes first: most places fail there, before a look behind
    name = r"(?=\p{Lu})(?<![\p{L}\p{N}])\p{Lu}\p{L}*(?:['’]\p{Lu}\p{L}*)*" if all_capitals else r"(?=\p{Lu})(?<=[\p{Ll}\p{N},;] )\p{Lu}\p{Ll}+"
    t = F.regexp_replace(F.coalesce(text, F.lit("")), name, "zqname")
    t = F.regexp_replace(t, r"\d[\d.,:/]*", "zqnum")
    t = F.regexp_replace(t, rf"zqnum( ?)(?i:{UNITS})(?![\p{{L}}\p{{N}}])", "zqnum$1zqunit")
    return _split(t)


def plain_words(text: Column) -> Column:
    return _split(F.coalesce(text, F.lit("")))


def _split(t: Column) -> Column:
    return F.filter(F.split(F.lower(F.regexp_replace(t, _STRIP, "")), SPACE_RE), lambda w: w != "")


def _steps(n: int) -> list[int]:
    """Distances at which hashes of windows are joined, until those of ``n`` words are made: of two that overlap at the end."""
    out, m = [], 1
    while m < n:
        out.append(min(m, n - m))
        m += out[-1]
    return out


def _joined(ws: list[Column]) -> Column:
    """The hash of one window of words."""
    hs = [F.xxhash64(w) for w in ws]
    for step in _steps(len(ws)):
        hs = [F.xxhash64(x, y) for x, y in zip(hs, hs[step:], strict=False)]
    return hs[0]


def _windows(ws: Column, n: int) -> Column:
    """``_joined`` of each ``n``-word window of an array: a hash of each word and then log2(n) joins, not n words a window."""
    out = F.transform(ws, lambda w: F.xxhash64(w))
    for step in _steps(n):
        size = lambda x: F.greatest(F.size(x) - step, F.lit(0))  # noqa: B023, E731
        out = let(out, lambda x: F.zip_with(F.slice(x, F.lit(1), size(x)), F.slice(x, F.lit(1 + step), size(x)), lambda a, b: F.xxhash64(a, b)))  # noqa: B023
    return F.when(F.size(ws) >= n, out).otherwise(F.array().cast("array<bigint>"))


def _items(items: DataFrame) -> DataFrame:
    """(item, item_id, kind, t, p, slots, size, n_windows) of each item and kind of template; item tells texts of null
    item_id apart. slots are (place in the item, value)."""
    own = F.when(F.col("item_id").isNull(), F.col("text"))
    one = items.where("text is not null").groupBy("item_id", own.alias("own")).agg(F.min("text").alias("text"))
    w = one.select(F.xxhash64("item_id", F.lit(1), "own").alias("item"), "item_id", template_words(F.col("text")).alias("t1"), template_words(F.col("text"), True).alias("t2"), plain_words(F.col("text")).alias("p")).where(F.size("p") > 0)
    kinds = F.when(F.expr("t1 = t2") | (F.size("p") < LEAST), F.array(F.struct(F.lit(1).alias("kind"), F.col("t1").alias("t")))).otherwise(F.array(F.struct(F.lit(1).alias("kind"), F.col("t1").alias("t")), F.struct(F.lit(2).alias("kind"), F.col("t2").alias("t"))))
    w = w.select("item", "item_id", "p", F.explode(kinds).alias("x")).select("item", "item_id", "x.kind", "x.t", "p")
    w = w.withColumn("slots", _slots("t", "p", F.lit(0))).withColumn("size", F.least(F.size("t"), F.lit(WINDOW)))
    return w.withColumn("n_windows", F.size("t") - F.col("size") + 1)


def _slots(t: str, p: str, start: Column) -> Column:
    found = F.transform(t, lambda x, i: F.when(F.rlike(x, F.lit(SLOT_RE)), F.struct((start + i).alias("at"), F.get(p, start + i).alias("value"))))
    return F.filter(found, lambda x: x.isNotNull())


def _item_windows(one: DataFrame) -> DataFrame:
    """(h, size, plain, item, kind, item_pos, n_windows, slots, dense) of the windows of ``_items``. A window of more than
    ``MOST_SLOTS`` slots is dense: its template says too little alone. It has a row by its plain words, which counts as any
    other, and one by its template, if that has a word, which only leads to a look at the whole item. Items under
    ``LEAST`` words are found by their plain words only."""
    at = one.select("item", "kind", "t", "p", "size", "n_windows", F.explode(F.sequence(F.lit(0), F.col("n_windows") - 1)).alias("item_pos"))
    at = at.withColumn("w", F.slice("t", F.col("item_pos") + 1, F.col("size"))).withColumn("slots", _slots("w", "p", F.col("item_pos")))
    few = F.col("size") < LEAST
    dense = ~few & (F.size("slots") > MOST_SLOTS)
    ways = [F.when(few | dense & (F.col("kind") == 1), F.struct(F.lit(True).alias("plain"), F.lit(False).alias("dense"))), F.when(~few & (F.size("slots") < F.col("size")), F.struct(F.lit(False).alias("plain"), dense.alias("dense")))]
    at = at.withColumn("way", F.explode(F.filter(F.array(*ways), lambda x: x.isNotNull()))).select("*", "way.plain", "way.dense")
    at = at.withColumn("slots", F.when(few, F.slice("slots", 1, 0)).otherwise(F.col("slots")))
    word = lambda k: F.when(F.col("plain"), F.get("p", F.col("item_pos") + k)).otherwise(F.get("t", F.col("item_pos") + k))
    h = F.coalesce(*[F.when(F.col("size") == n, _joined([word(k) for k in range(n)])) for n in range(1, WINDOW + 1)])
    return at.select(h.alias("h"), "size", "plain", "item", "kind", "item_pos", "n_windows", "slots", "dense")


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, n_windows): one row per document and benchmark item that it holds; matched is the most
    windows of an alignment whose slots agree."""
    whole_items = cut(_items(items), "items")
    known = cut(_item_windows(whole_items), "windows")
    sizes = sorted((r["plain"], r["size"]) for r in known.groupBy("plain", "size").agg(F.count("*").alias("n")).collect())  # 2 WINDOW at most
    small = known.count() <= MOST_BROADCAST
    rows = docs.select("doc_id", template_words(F.col("text")).alias("t"), template_words(F.col("text"), True).alias("t2"), (plain_words(F.col("text")) if any(p for p, _ in sizes) else F.array().cast("array<string>")).alias("p"))
    lists = [(plain, n, "p" if plain else t) for plain, n in sizes for t in (("p",) if plain else ("t", "t2"))]
    # of a pair of lists by both templates, the second gives what differs
    windows = rows.select("doc_id", F.posexplode(_of_sizes(lists)).alias("k", "hs"))
    of = lambda values, kind: F.element_at(F.array(*map(F.lit, values)) if values else F.array().cast(f"array<{kind}>"), F.col("k") + 1)
    windows = windows.select("doc_id", of([x[1] for x in lists], "int").alias("size"), of([x[0] for x in lists], "boolean").alias("plain"), F.posexplode("hs").alias("doc_pos", "h")).where("h is not null")
    hits = windows.join(F.broadcast(known) if small else known, ["h", "size", "plain"])
    hits = cut(hits.select("doc_id", "item", "kind", "doc_pos", "item_pos", "n_windows", "slots", "dense", (F.col("doc_pos") - F.col("item_pos")).alias("shift")).dropDuplicates(["doc_id", "item", "kind", "doc_pos", "item_pos", "dense"]), "hits")
    by = ["doc_id", "item", "kind", "shift"]
    # slots: item value against document value at the same place of the alignment
    slotted = hits.where("size(slots) > 0 and not dense")
    ids = bounded(hits.where("size(slots) > 0").select(F.col("doc_id").alias("_id")).distinct(), MOST_BROADCAST)  # else the texts would be shuffled to meet them
    held = docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), "left_semi")
    texts = held.select(F.col("doc_id").alias("_id"), plain_words(F.col("text")).alias("p"), F.xxhash64("text").alias("copy"))
    pairs = slotted.select(*by, F.explode("slots").alias("s")).distinct()
    pairs = pairs.join(texts, pairs["doc_id"].eqNullSafe(texts["_id"])).select(*by, "copy", F.col("s.value").alias("value"), F.get("p", F.col("shift") + F.col("s.at")).alias("other"))
    odd = (
        pairs.groupBy(*by, "copy", "value").agg((F.min("other") != F.max("other")).alias("odd"))
        .groupBy(*by, "copy").agg(F.max("odd").alias("odd"))
        .groupBy(*by).agg(F.min("odd").alias("odd"))
    )
    odd = odd.where("odd").select(F.col("doc_id").alias("_id"), F.col("item").alias("_item"), F.col("kind").alias("_kind"), F.col("shift").alias("_shift"))
    # an alignment whose slots disagree keeps its windows without slots
    plain = hits.where("not dense")
    judged = plain.join(odd, plain["doc_id"].eqNullSafe(odd["_id"]) & (plain["item"] == odd["_item"]) & (plain["kind"] == odd["_kind"]) & (plain["shift"] == odd["_shift"]), "left")
    fine = judged.where(F.col("_item").isNull() | (F.size("slots") == 0))
    best = fine.groupBy(*by).agg(F.countDistinct("item_pos").alias("matched"), F.max("n_windows").alias("n_windows")).select("doc_id", "item", "matched", "n_windows")
    if not known.where("dense").isEmpty():
        best = best.unionByName(_whole(hits, held, whole_items, small))
    names = whole_items.select("item", "item_id").distinct()
    best = best.join(F.broadcast(names) if small else names, "item").where(F.col("matched") >= F.least(F.lit(MIN_WINDOWS), F.col("n_windows")))
    return best.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("n_windows").alias("n_windows"))


def _whole(hits: DataFrame, held: DataFrame, items: DataFrame, small: bool) -> DataFrame:
    """(doc_id, item, matched, n_windows) of the alignments at dense windows where the document has the template of the
    whole item, and each value of the item stands for one value all along."""
    at = hits.where("dense").select("doc_id", "item", "kind", "shift", "n_windows").distinct()
    whole = items.select("item", "kind", F.col("t").alias("item_t"), F.col("slots").alias("all_slots"))
    at = at.join(F.broadcast(whole) if small else whole, ["item", "kind"])
    texts = held.select(F.col("doc_id").alias("_id"), template_words(F.col("text")).alias("t1"), template_words(F.col("text"), True).alias("t2"), plain_words(F.col("text")).alias("p"))
    met = at.where("shift >= 0").join(texts, at["doc_id"].eqNullSafe(texts["_id"]))
    here = lambda t: F.slice(t, F.col("shift") + 1, F.size("item_t")) == F.col("item_t")
    pairs = F.array_distinct(F.transform("all_slots", lambda s: F.struct(s["value"].alias("value"), F.get("p", F.col("shift") + s["at"]).alias("other"))))
    same = F.size(pairs) == F.size(F.array_distinct(F.transform("all_slots", lambda s: s["value"])))
    return met.where((here("t1") | here("t2")) & same).select("doc_id", "item", F.col("n_windows").cast("bigint").alias("matched"), "n_windows")


def _of_sizes(lists: list[tuple[bool, int, str]]) -> Column:
    """Hashes of windows for each (plain, size, column); those by ``t2`` are null where ``t`` gives the same."""
    if not lists:
        return F.array().cast("array<array<bigint>>")

    def both(n: int) -> Column:
        second = lambda first: F.when(F.expr("t = t2"), F.array().cast("array<bigint>")).otherwise(F.zip_with(_windows(F.col("t2"), n), first, lambda x, y: F.when(x != y, x)))
        return let(_windows(F.col("t"), n), lambda first: F.array(first, second(first)))

    return F.flatten(F.array(*[F.array(_windows(F.col("p"), n)) if plain else both(n) for plain, n, c in lists if c != "t2"]))


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; each row by its own text, whatever else has its doc_id."""
    key = F.xxhash64("doc_id", "text")
    bad = bounded(find_leaks(docs.select(key.alias("doc_id"), "text"), items).select(F.col("doc_id").alias("key")).distinct(), MOST_BROADCAST)
    return carried(docs, key=key).join(bad, "key", "left_anti").select("row.*")
