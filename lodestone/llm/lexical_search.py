"""Ranked lexical search: the best documents for each query text, exactly, from a clustered index.

``search(docs, items)`` gives per item the first ``TOP`` documents with a score above 0. The steps:

* A tree of recursive graph bisections (swaps of documents between halves while the summed log-gaps of their terms fall) is fitted on
  a sample of about ``SAMPLE`` documents, at most ``MOST_SAMPLE``. Every document then goes down the tree by the same cost, which orders the corpus into
  ``2 ** DEPTH`` clusters of documents with like terms. The sample only decides who stands beside whom: all documents are indexed and results
  don't depend on it.
* Each cluster is packed into shards of about ``SHARD_DOCS`` documents: postings by term with their impacts, and each term's greatest impact.
* A query's bound for a cluster is the sum of its terms' weights times the greatest impacts there. Queries visit clusters in order of their
  bounds, twice as many in each round, until no unvisited cluster's bound reaches the query's score at rank ``TOP`` (equal ones
  are visited, as doc_id decides ties). Shards of a visited cluster are passed over by their own bounds in the same way.

The queries come in blocks of at most about ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` bytes, and the index of a block holds the terms that its items
name: what the driver and a task hold of the queries is bounded, and the corpus is read once a block.

Terms are runs of digits, ASCII letters and characters beyond ASCII; only A to Z are folded. A null or empty text, or one without terms, has
none: such a document never scores and counts nowhere, and such an item gives no rows. Rows that share a doc_id are documents of
their own, as repeated rows are; null doc_ids come last among equal scores. Repeated items give their rows again. Empty tables give
no rows. Other columns are ignored.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, drop_cut

TOP = 20
DEPTH = 5
SAMPLE, MOST_SAMPLE = 2048, 4096
BUCKETS = 1 << 14  # of hashed terms, for the tree alone
SWEEPS = 12  # of swaps at a node
SHARD_DOCS = 8192
BLOCK_ITEMS, BLOCK_BYTES = 1024, 64 << 20
SALTS = 16
NULL_ID = (1 << 63) - 1
RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"
#: Bytes that end a term become spaces, A to Z small letters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def _buckets(found):
    import numpy as np

    return np.unique(np.fromiter((zlib.crc32(t) & (BUCKETS - 1) for t in found), np.int64, len(found)))


def _log_gaps(d, n):
    """Bits, about, of the gaps between d of n documents, for each term."""
    import numpy as np

    return d * np.log2(n / (d + 1.0))


def bisection_tree(sets: list, depth: int = DEPTH):
    """Rows of term weights, one per inner node in heap order: a document goes left where its terms' weights sum to 0 or less."""
    import numpy as np

    tree = np.zeros(((1 << depth) - 1, BUCKETS), np.float32)

    def spread(own: list, sides) -> tuple:
        """Per document the sum of a value per term."""
        ends = np.cumsum([len(sets[i]) for i in own])
        sums = np.concatenate([[0.0], np.cumsum(sides[np.concatenate([sets[i] for i in own])])])
        return sums[ends] - sums[np.concatenate([[0], ends[:-1]])]

    def split(node: int, own: list) -> None:
        if node >= len(tree) or len(own) < 2:
            return
        # halves by a random projection at first: like documents begin together, and swaps don't just exchange two equal halves
        near = np.argsort(spread(own, np.random.default_rng(node).choice([-1.0, 1.0], BUCKETS)), kind="stable")
        own = [own[i] for i in near]
        left, right = own[: len(own) // 2], own[len(own) // 2 :]
        degree = lambda side: np.bincount(np.concatenate([sets[i] for i in side]), minlength=BUCKETS).astype(float)
        for _ in range(SWEEPS):
            a, b, n, m = degree(left), degree(right), len(left), len(right)
            now = _log_gaps(a, n) + _log_gaps(b, m)
            to_right = now - _log_gaps(np.maximum(a - 1, 0), n) - _log_gaps(b + 1, m)
            to_left = now - _log_gaps(a + 1, n) - _log_gaps(np.maximum(b - 1, 0), m)
            go, come = spread(left, to_right), spread(right, to_left)
            i, j = np.argsort(-go, kind="stable"), np.argsort(-come, kind="stable")
            k = min(n, m)
            swaps = int(np.argmin(np.append(go[i[:k]] + come[j[:k]] > 1e-9, False)))
            if not swaps:
                break
            for x, y in zip(i[:swaps], j[:swaps], strict=True):
                left[x], right[y] = right[y], left[x]
        a, b, n, m = degree(left), degree(right), len(left), len(right)
        tree[node] = _log_gaps(a + 1, n) - _log_gaps(a, n) - _log_gaps(b + 1, m) + _log_gaps(b, m)
        split(2 * node + 1, left)
        split(2 * node + 2, right)

    split(0, [i for i, s in enumerate(sets) if len(s)])
    return tree


def _leaf(tree, buckets) -> int:
    node = 0
    while node < len(tree):
        node = 2 * node + (1 if tree[node, buckets].sum() <= 0 else 2)
    return node - len(tree)


def fit_tree(docs: DataFrame, depth: int = DEPTH):
    """The tree of a bounded sample, chosen by a hash of doc_id and text."""
    import numpy as np

    h = F.xxhash64(F.lit(12), "doc_id", "text")
    one_in = max(1, docs.count() // SAMPLE)
    some = docs.where(F.pmod(h, F.lit(one_in)) == 0).select(h.alias("h"), "text")

    def sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [_buckets(set(terms(t.as_py()))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["h", "terms"])

    def fit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        rows = sorted((h, s) for batch in batches for h, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        yield pa.RecordBatch.from_pydict({"tree": [bisection_tree([np.array(s, np.int64) for _, s in rows], depth).tobytes()]})

    # a table in between: a limit over repeated rows would move them all
    sample = cut(some.mapInArrow(sets, "h bigint, terms array<bigint>").groupBy("h").agg(F.first("terms").alias("terms")).limit(MOST_SAMPLE), "sample")
    found = sample.repartition(1).mapInArrow(fit, "tree binary").first()
    drop_cut(sample)
    if found is None:
        return np.zeros(((1 << depth) - 1, BUCKETS), np.float32)
    return np.frombuffer(bytes(found[0]), np.float32).reshape((1 << depth) - 1, BUCKETS)


def _profiles(docs: DataFrame, tree, known: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, cluster, h, ids, tfs) of every document with terms: its length, its leaf of the tree, and its known terms."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                own = Counter(terms(batch.column(1)[i].as_py()))
                if not own:
                    continue
                mine = [(known[t], k) for t, k in own.items() if t in known]
                ids, tfs = np.array([x for x, _ in mine], np.int32), np.array([k for _, k in mine], np.int32)
                rows.append((batch.column(0)[i].as_py(), sum(own.values()), _leaf(tree, _buckets(own)), batch.column(2)[i].as_py(), ids.tobytes(), tfs.tobytes()))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "n", "cluster", "h", "ids", "tfs"])

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64(F.monotonically_increasing_id()).alias("h"))
    return own.mapInArrow(run, "doc_id bigint, n bigint, cluster int, h bigint, ids binary, tfs binary")


_SHARD = "cluster int, shard bigint, doc_ids binary, terms binary, ends binary, docs binary, impacts binary, most binary"


def _packed(profiles: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Shards: per row the documents of one, its postings by term with their impacts, and each term's greatest impact."""
    sizes = profiles.groupBy("cluster").agg(F.ceil(F.count("*") / SHARD_DOCS).alias("shards"))  # a row per cluster
    dealt = profiles.join(F.broadcast(sizes), "cluster").withColumn("shard", F.pmod("h", "shards"))

    def pack(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values("doc_id", kind="stable")
        counts = np.array([len(x) // 4 for x in pdf["ids"]], np.int64)
        ids, tfs = (np.frombuffer(b"".join(pdf[c]), np.int32) for c in ("ids", "tfs"))
        m = 75 + 25 * pdf["n"].to_numpy(np.int64) * n_docs // n_terms
        doc = np.repeat(np.arange(len(pdf), dtype=np.int32), counts)
        tf = tfs.astype(np.int64)
        impact = (1_000_000_000 * tf // (1000 * tf + 12 * m[doc])).astype(np.int32)
        order = np.argsort(ids, kind="stable")
        own, begins = np.unique(ids[order], return_index=True)
        impact = impact[order]
        most = np.maximum.reduceat(impact, begins) if len(own) else impact
        ends = np.append(begins[1:], len(ids)).astype(np.int64)[: len(own)]
        doc_ids = pdf["doc_id"].astype("Int64").fillna(NULL_ID).to_numpy(np.int64)
        cols = (doc_ids, own.astype(np.int32), ends, doc[order], impact, most)
        return pd.DataFrame([(int(pdf["cluster"].iloc[0]), int(pdf["shard"].iloc[0]), *(c.tobytes() for c in cols))], columns=[x.split()[0] for x in _SHARD.split(", ")])

    return dealt.select("cluster", "shard", "doc_id", "n", "ids", "tfs").groupBy("cluster", "shard").applyInPandas(pack, _SHARD)


def _frequencies(shards: DataFrame, size: int):
    """Documents that hold each known term."""
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        df = np.zeros(size, np.int64)
        for batch in batches:
            for t, e in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                df[np.frombuffer(t, np.int32)] += np.diff(np.frombuffer(e, np.int64), prepend=0)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for r in shards.select("terms", "ends").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect():  # the terms of a block
        out[r[0]] = r[1]
    return out


def _bound(own, most, query) -> int:
    """The greatest score that documents with these greatest impacts can have."""
    import numpy as np

    ids, gains = query
    at = np.searchsorted(own, ids)
    have = at < len(own)
    have[have] = own[at[have]] == ids[have]
    return int((gains[have] * most[at[have]].astype(np.int64)).sum())


def _bounds(shards: DataFrame, queries: list) -> dict[int, dict[int, int]]:
    """Per query its bound of each cluster: the greatest of its shards'."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        best: dict[tuple[int, int], int] = {}
        for batch in batches:
            for cluster, t, m in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                own, most = np.frombuffer(t, np.int32), np.frombuffer(m, np.int32)
                for q, query in enumerate(queries):
                    if b := _bound(own, most, query):
                        best[q, cluster] = max(best.get((q, cluster), 0), b)
        cols = [[q for q, _ in best], [c for _, c in best], list(best.values())]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=["q", "cluster", "bound"])

    out: dict[int, dict[int, int]] = {}
    got = shards.select("cluster", "terms", "most").mapInArrow(run, "q bigint, cluster bigint, bound bigint").groupBy("q", "cluster").agg(F.max("bound").alias("bound"))
    for r in got.collect():  # queries of a block times clusters
        out.setdefault(r.q, {})[r.cluster] = r.bound
    return out


def _first(scores, ids, top: int):
    """Places of the first ``top`` by score and then id."""
    import numpy as np

    return np.lexsort((ids, -scores))[:top]


def _visit(shards: DataFrame, queries: list, visits: dict[int, list[int]], least: list[int], top: int) -> list[tuple[int, int, int]]:
    """(query, doc_id, score) of the first ``top`` documents of each query in the clusters that it visits now, of those that
    score ``least`` or more."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        best: dict[int, tuple] = {}
        floor = list(least)
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["doc_ids"], np.int64)
                own, ends = np.frombuffer(row["terms"], np.int32), np.frombuffer(row["ends"], np.int64)
                docs, impacts, most = (np.frombuffer(row[c], np.int32) for c in ("docs", "impacts", "most"))
                for q in visits.get(row["cluster"], ()):
                    if _bound(own, most, queries[q]) < floor[q]:
                        continue
                    acc = np.zeros(len(ids), np.int64)
                    at = np.searchsorted(own, queries[q][0])
                    for i, term, gain in zip(at, *queries[q], strict=True):
                        if i < len(own) and own[i] == term:
                            part = slice(ends[i - 1] if i else 0, ends[i])
                            acc[docs[part]] += gain * impacts[part].astype(np.int64)
                    k = np.flatnonzero(acc >= floor[q])
                    if len(k) > top:  # those that can't be among the first go before the sort
                        k = k[acc[k] >= np.partition(acc[k], len(k) - top)[len(k) - top]]
                    if len(k):
                        s, d = best.get(q, (np.array([], np.int64), np.array([], np.int64)))
                        s, d = np.append(s, acc[k]), np.append(d, ids[k])
                        f = _first(s, d, top)
                        best[q] = s[f], d[f]
                        if len(f) == top:
                            floor[q] = max(floor[q], int(s[f[-1]]))
        for q, (s, d) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), q)), pa.array(d), pa.array(s)], names=["q", "doc_id", "score"])

    by = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "doc_id"))
    found = shards.where(F.col("cluster").isin(sorted(visits))).mapInArrow(run, "q bigint, doc_id bigint, score bigint")
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).withColumn("nth", by("q", "salt")).where(F.col("nth") <= top)
    return [tuple(r) for r in found.withColumn("nth", by("q")).where(F.col("nth") <= top).select("q", "doc_id", "score").collect()]


def _ranked(shards: DataFrame, queries: list, top: int) -> list[list[tuple[int, int]]]:
    """Per query its first (score, doc_id), best first, by rounds of visits with exact stopping."""
    bounds = _bounds(shards, queries)
    found: list[list[tuple[int, int]]] = [[] for _ in queries]
    waiting = {q: sorted(b, key=lambda c: (-b[c], c)) for q, b in bounds.items()}  # noqa: B023
    take = 1
    while True:
        least = [f[-1][0] if len(f) == top else 1 for f in found]
        visits: dict[int, list[int]] = {}
        for q, clusters in waiting.items():
            waiting[q] = [c for c in clusters if bounds[q][c] >= least[q]]
            for c in waiting[q][:take]:
                visits.setdefault(c, []).append(q)
            waiting[q] = waiting[q][take:]
        if not visits:
            return found
        for q, doc_id, score in _visit(shards, queries, visits, least, top):
            found[q].append((score, doc_id))
        found = [sorted(f, key=lambda x: (-x[0], x[1]))[:top] for f in found]
        take *= 2


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the first ``top`` documents (doc_id, text) of each item (item_id, text)."""
    import math

    import numpy as np

    spark = docs.sparkSession
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-size.n // BLOCK_ITEMS), -(-(size.bytes or 0) // BLOCK_BYTES))
    tree, result = None, spark.createDataFrame([], RESULT)
    for b in range(blocks):
        asked = [(r.item_id, Counter(terms(r.text))) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).select(F.col("item_id").cast("bigint").alias("item_id"), "text").collect()]
        known = {t: i for i, t in enumerate(sorted({t for _, c in asked for t in c}))}
        if not known:
            continue
        tree = fit_tree(docs) if tree is None else tree
        profiles = cut(_profiles(docs, tree, known), "profiles")
        n_docs, n_terms = profiles.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        shards = cut(_packed(profiles, n_docs, n_terms), "shards", [profiles])
        df = _frequencies(shards, len(known))
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
        queries = []
        for _, c in asked:
            ids = sorted(known[t] for t in c)
            gains = {known[t]: k * weight[known[t]] for t, k in c.items()}
            queries.append((np.array(ids, np.int64), np.array([gains[i] for i in ids], np.int64)))
        rows = [(asked[q][0], k + 1, None if d == NULL_ID else d, s) for q, f in enumerate(_ranked(shards, queries, top)) for k, (s, d) in enumerate(f)]
        drop_cut(shards)
        result = result.unionByName(cut(spark.createDataFrame(rows, RESULT), "ranked"))
    return result


cloudpickle.register_pickle_by_value(sys.modules[__name__])
