"""N-gram Jaccard self-join: documents whose shingle sets reach a similarity link; components of links.

1. Sets. Equal sets become one class with a representative; copies are never expanded into pairs.
2. Short lists. Any two sets of similarity t share an element of their first n - ceil(t n) + 1 elements in any order
   that is the same for all. The order here: a hash-chosen part of the elements first, rarest first by their counted
   frequency, then the rest. Representatives that share such an element are joined into coarse clusters by
   distributed union-find on stars, so a frequent element costs what its list is long.
3. T-occurrence within a cluster. Inverted lists of its elements; a set's short lists are merged (by a sort that
   merges sorted runs, where DivideSkip has a heap) and counted, its
   long lists probed by binary search, as in DivideSkip: counts below T less the number of long lists are out,
   and the rest must reach the required overlap exactly. Only links that join two components are returned.
4. Clusters above a block's size are cut into blocks. Each block is searched with some pivots that all blocks share;
   then the members that share an element of their prefixes with another component are dealt anew by component, and only
   pairs of blocks that hold more than one component are searched, so no link between different components is lost and no
   group is in one task.

Defined cases: null or empty texts have no set and link with nothing; texts with fewer words than a shingle have
their whole sequence as one; repeated rows link; a doc_id that stands on rows with different texts links them;
rows of null doc_id take part as one document per set, and have
the component of what they link with (null, if no row there has a doc_id); doc_ids are below 2 ** 62; extra columns are ignored by ``link`` and carried by ``drop_linked``.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, bounded, carried, components, cut, drop_cut, let, window_hashes, words

BLOCK_SETS = 2048
BLOCK_ELEMENTS = 1_500_000
PIVOTS = 16
MOST_BROADCAST = 1_000_000  # ids of documents whose texts are looked up
FINISH = 500_000  # edges of a graph whose components are found in one task
ROOM = 0.15  # share of a set's elements that are counted beyond a prefix: sets that share less than it leave keep to elements of their own
LONG_WEIGHT = 0.02  # of DivideSkip: how many lists count as long


def shingle_set(text: Column, n: int) -> Column:
    """Sorted distinct hashes of the n-word shingles of a text in ASCII lower case."""
    few = lambda ws: F.when(F.size(ws) > 0, F.array(F.xxhash64(F.lit(-1), ws))).otherwise(F.array().cast("array<bigint>"))
    return let(words(ascii_lower(text)), lambda ws: F.when(F.size(ws) >= n, F.sort_array(F.array_distinct(window_hashes(ws, n)))).otherwise(few(ws)))


def _t_occurrence(sets: list, comp: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of positions whose sets link, one for each two components (``comp``) that they join."""
    import numpy as np

    n = np.array([len(s) for s in sets])
    order = np.argsort(n, kind="stable")
    sizes = n[order]
    count = len(order)
    flat = np.concatenate([sets[i] for i in order]) if count else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(count), sizes)
    _, token = np.unique(flat, return_inverse=True)
    by = np.lexsort((owner, token))
    token_s, owner_s = token[by], owner[by]
    starts = np.searchsorted(token_s, np.arange(token_s[-1] + 2 if len(token_s) else 1))
    keys = token_s.astype(np.int64) * count + owner_s  # sorted: the inverted lists end to end
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    root = {c: c for c in comp}
    own = [comp[i] for i in order]

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    links = []
    low = np.searchsorted(sizes * den, sizes * num)  # the first set that is long enough for each
    for x in range(count):
        mine = token[offsets[x] : offsets[x + 1]]
        size, lo = int(sizes[x]), int(low[x])
        if lo >= x:
            continue
        length = starts[mine + 1] - starts[mine]
        mine = mine[np.argsort(length, kind="stable")]
        most = -(-num * size // den)  # the least overlap that any partner needs
        n_long = min(most - 1, int(most / (LONG_WEIGHT * np.log2(max(2, int(length.max()))) * 100 + 1)))
        short, long = mine[: size - n_long], mine[size - n_long :]
        # merge of the short lists, each from the first partner that is long enough to x itself
        a = np.searchsorted(keys, short.astype(np.int64) * count + lo)
        b = np.searchsorted(keys, short.astype(np.int64) * count + x)
        k = b - a
        if not k.sum():
            continue
        at = np.repeat(a - np.concatenate(([0], np.cumsum(k)[:-1])), k) + np.arange(k.sum())
        merged = np.sort(owner_s[at], kind="stable")  # of sorted lists end to end: a merge
        ends = np.append(np.flatnonzero(merged[1:] != merged[:-1]), len(merged) - 1)
        counts = np.diff(np.append(-1, ends))
        enough = np.flatnonzero(counts >= most - n_long)
        if not len(enough):
            continue
        mine_root = find(own[x])
        enough = enough[np.argsort(-counts[enough], kind="stable")]
        some, counts = merged[ends[enough]], counts[enough]
        for first in range(0, len(some), 64):  # the likeliest first; later ones are mostly joined by then
            live = np.array([k for k in range(first, min(first + 64, len(some))) if find(own[some[k]]) != mine_root], np.int64)
            if not len(live):
                continue
            part, got = some[live], counts[live]
            if len(long):
                probe = (long.astype(np.int64)[:, None] * count + part[None, :]).ravel()
                place = np.searchsorted(keys, probe)
                hit = (place < len(keys)) & (keys[np.minimum(place, len(keys) - 1)] == probe)
                got = got + hit.reshape(len(long), len(part)).sum(0)
            for y, both in zip(part, got, strict=True):
                if den * int(both) >= num * (size + int(sizes[y]) - int(both)):
                    other = find(own[y])
                    if other != mine_root:
                        root[other] = mine_root
                        links.append((int(order[x]), int(order[y])))
    return links


def _search(groups: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) within the groups (g1, g2) of rows (node, comp, els)."""

    def run(pdf):
        import pandas as pd

        found = _t_occurrence(list(pdf["els"]), pdf["comp"].tolist(), num, den)
        node = pdf["node"].tolist()
        return pd.DataFrame([(node[x], node[y]) for x, y in found], columns=["a", "b"], dtype="int64")

    return groups.groupBy("g1", "g2").applyInPandas(run, "a bigint, b bigint")


def _postings(reps: DataFrame) -> DataFrame:
    """(node, el): the elements of each representative's prefix that others have too."""
    els = reps.select("node", F.explode("first").alias("el"))
    shared = els.groupBy("el").agg(F.count("*").alias("df")).where("df > 1")
    ranked = els.join(shared, "el").withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy("df", "el")))
    # elements of frequency 1 stand before: what is left of the prefix after them
    counted = ranked.groupBy("node").agg(F.count("*").alias("n_shared"))
    have = reps.select("node", "prefix", F.size("first").alias("n_first"))
    left = have.join(counted, "node").select("node", (F.col("prefix") - (F.col("n_first") - F.col("n_shared"))).alias("left")).where("left > 0")
    own = ranked.join(left, "node").where("rank <= left").select("node", "el")
    more = reps.select("node", F.explode("more").alias("el"))
    return own.unionByName(more)


def _sets(docs: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """Per row (doc_id, n, k1, k2, prefix, first, more): size and hashes of its set, the size of its prefix, the chosen part of
    its elements, and as many others as the prefix may need."""
    part = round(1 / ((den - num) / den + ROOM))
    chosen = lambda h: F.pmod(h, F.lit(part)) == 0
    sets = docs.select("doc_id", shingle_set(F.col("text"), shingle).alias("els"))
    sets = sets.select("doc_id", F.element_at(F.transform(F.array("els"), lambda s: F.struct(
        F.size(s).cast("bigint").alias("n"), F.xxhash64(s).alias("k1"), F.xxhash64(F.lit(7), s).alias("k2"),
        F.filter(s, chosen).alias("first"), F.filter(s, lambda h: ~chosen(h)).alias("others"))), 1).alias("x")).select("doc_id", "x.*")
    prefix = F.col("n") - F.floor((num * F.col("n") + den - 1) / den) + 1
    sets = sets.withColumn("prefix", F.when(F.col("n") > 0, prefix).otherwise(0).cast("int"))
    return sets.select("doc_id", "n", "k1", "k2", "prefix", "first", F.slice("others", 1, F.greatest(F.col("prefix") - F.size("first"), F.lit(0))).alias("more"))


def _stars(postings: DataFrame) -> DataFrame:
    """(a, b): each node of an element's list with the least of it."""
    stars = postings.groupBy("el").agg(F.min("node").alias("b"), F.count("*").alias("k")).where("k > 1")
    return postings.join(stars, "el").select(F.col("node").alias("a"), "b")


def _dealt_anew(large: DataFrame, postings: DataFrame, links: DataFrame) -> DataFrame:
    """(g1, g2, node, comp): groups in which members (node, n) of clusters of several blocks meet those of other
    components. Only members that share an element of their prefixes with another component take part, in the
    clusters that such elements alone make."""
    comps = cut(components(links, FINISH), "components")
    own = postings.join(large.select("node").distinct(), "node", "left_semi")
    own = own.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node")).select("node", "el", "comp")
    own = cut(own, "own", [comps])
    mixed = own.groupBy("el").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 < c2").select("el")
    still = cut(own.join(mixed, "el"), "open", [own])
    finer = cut(components(_stars(still), FINISH).select("node", F.col("component").alias("cluster")), "finer")
    large = cut(large.join(still.select("node", "comp").distinct(), "node").join(finer, "node"), "large", [still, finer])
    per = large.groupBy("cluster", "comp").agg(F.count("*").alias("c_sets"), F.sum("n").alias("c_els"))
    per = per.withColumn("c_blocks", F.greatest(F.ceil(F.col("c_sets") / BLOCK_SETS), F.ceil(F.col("c_els") / BLOCK_ELEMENTS)))
    pure = (F.col("c_sets") * 2 >= BLOCK_SETS) | (F.col("c_els") * 2 >= BLOCK_ELEMENTS)
    per = per.withColumn("pure", F.when(pure, F.col("comp")))
    rest = per.where("pure is null").groupBy("cluster").agg(F.greatest(F.ceil(F.sum("c_sets") / BLOCK_SETS), F.ceil(F.sum("c_els") / BLOCK_ELEMENTS)).alias("r_blocks"))
    dealt = large.join(per.select("cluster", "comp", "pure", "c_blocks"), ["cluster", "comp"]).join(rest, "cluster", "left")
    slot = F.when(F.col("pure").isNull(), F.pmod(F.xxhash64("comp"), F.col("r_blocks"))).otherwise(F.pmod(F.xxhash64("node"), F.col("c_blocks")))
    dealt = cut(dealt.select("cluster", "node", "comp", "pure", F.concat_ws(":", F.coalesce(F.col("pure").cast("string"), F.lit("")), slot).alias("block")), "dealt", [large])
    some = dealt.select("cluster", "block", "pure").distinct()
    left, right = some.toDF("cluster", "b1", "p1"), some.toDF("cluster", "b2", "p2")
    pairs = left.join(right, "cluster").where("b1 <= b2 and (p1 is null or p2 is null or p1 <> p2)")
    sides = pairs.select("cluster", "b1", "b2", F.explode(F.array_distinct(F.array("b1", "b2"))).alias("block"))
    return cut(sides.join(dealt, ["cluster", "block"]).select(F.concat_ws("|", "b1", "b2").alias("g2"), F.col("cluster").alias("g1"), "node", "comp"), "groups", [dealt])


NAMELESS = 1 << 62  # nodes from here on stand for sets of rows without a doc_id


def _node(doc_id: Column, k1: Column) -> Column:
    return F.coalesce(doc_id.cast("bigint"), k1.bitwiseAND(F.lit(NAMELESS - 1)).bitwiseOR(F.lit(NAMELESS)))


def link(docs: DataFrame, shingle: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Per row of documents: doc_id, n_shingles, component_id, for links of num/den similarity or more."""
    sets = cut(_sets(docs, shingle, num, den).withColumn("node", _node(F.col("doc_id"), F.col("k1"))), "sets")
    slim = cut(sets.select("doc_id", "node", "n", "k1", "k2"), "slim")
    classes = cut(slim.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("node").alias("node")), "classes")
    # the other rows of a class go by their ids, so that sets stay where they are
    named = classes.select("k1", "k2", "n", F.col("node").alias("_node"))
    other = slim.where("n > 0").join(named, ["k1", "k2", "n"]).where("node <> _node").select("node", "k1", "k2").distinct()
    reps = sets.drop("doc_id").where("n > 0").join(bounded(other, MOST_BROADCAST), ["node", "k1", "k2"], "left_anti")
    # repeated rows are few: only their sets are moved to leave one of each
    key = ["node", "k1", "k2"]
    again = bounded(slim.groupBy(*key).agg(F.count("*").alias("k")).where("k > 1").drop("k"), MOST_BROADCAST)
    reps = reps.join(again, key, "left_anti").unionByName(reps.join(again, key, "left_semi").dropDuplicates(key))
    postings = cut(_postings(reps), "postings", [sets])
    clusters = cut(components(_stars(postings), FINISH).withColumnRenamed("component", "cluster"), "clusters")
    clusters = clusters.join(classes.groupBy("node").agg(F.max("n").alias("n")), "node")
    sized = clusters.groupBy("cluster").agg(F.count("*").alias("sets"), F.sum("n").alias("elements"))
    sized = sized.withColumn("blocks", F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("elements") / BLOCK_ELEMENTS)).cast("int"))
    held = bounded(clusters.join(sized, "cluster"), MOST_BROADCAST)
    own = _node(F.col("doc_id"), F.xxhash64(shingle_set(F.col("text"), shingle)))
    texts = docs.select(own.alias("node"), "text").join(held, "node")  # texts stay where they are if the clusters' ids are few
    members = cut(texts.select("node", "cluster", "n", "sets", "blocks", shingle_set(F.col("text"), shingle).alias("els")), "members", [held])
    # first round: blocks, each with the pivots of its cluster
    pivot = F.pmod(F.xxhash64(F.lit(3), "node"), F.greatest(F.floor(F.col("sets") / PIVOTS), F.lit(1))) == 0
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    at = F.when((F.col("blocks") > 1) & pivot, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    links = cut(_search(members.select(F.col("cluster").alias("g1"), F.explode(at).alias("g2"), "node", F.col("node").alias("comp"), "els"), num, den), "links")
    # second round: clusters of several blocks, dealt by component
    large = members.where("blocks > 1").select("node", "n").distinct()
    if not large.isEmpty():
        groups = _dealt_anew(large, postings, links)
        links = cut(links.unionByName(_search(groups.join(members.select("node", "els"), "node"), num, den)), "links", [links, groups])
    drop_cut(members)
    drop_cut(postings)
    joined = components(links, FINISH)
    found = classes.join(joined, "node", "left").groupBy("k1", "k2").agg(F.min(F.coalesce("component", "node")).alias("c"))
    out = slim.join(found.withColumnsRenamed({"k1": "_k1", "k2": "_k2"}), (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("n") > 0), "left")
    named = F.when(F.col("c") < NAMELESS, F.col("c"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(named, "doc_id").alias("component_id"))


def drop_linked(docs: DataFrame, shingle: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` that are the smallest doc_id of their component; rows of null doc_id stay."""
    gone = bounded(link(docs, shingle, num, den).where("doc_id <> component_id").select(F.col("doc_id").alias("id")).distinct(), MOST_BROADCAST)
    return carried(docs, id=F.col("doc_id")).join(gone, "id", "left_anti").select("row.*")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
