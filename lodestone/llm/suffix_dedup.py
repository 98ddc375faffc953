"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of ``K`` bytes that covers it also starts earlier: in a smaller doc_id, or earlier in its document.

1. Every window of K bytes has a signature, the least hash of its M-byte pieces; equal windows have equal ones. Each
   document is cut into runs of windows of one signature, and only runs whose signature occurs twice, or whose least
   piece does within them, go on.
2. Runs of equal content form a class; all but the earliest are repeats as a whole, found by a grouped minimum that is
   combined before the shuffle, so thousands of copies of a passage cost no text.
3. Where a signature has several classes, their earliest runs meet in a shard with their bytes. A shard's suffix array is
   made by induced sorting: suffixes are classified, leftmost-smaller positions are bucketed and their substrings sorted
   by inducing, named, and the reduced string is ordered; two more passes induce all suffixes. Passes are linear and
   go bucket by bucket in numpy. Neighbours are compared in text order (permuted common prefixes), and all but
   the earliest of neighbours that share K bytes are repeats.
   The reduced string is ordered by the same procedure again while its names are few against its length, and by rank
   doubling where buckets would hold little each; order deeper than K bytes is never read.
4. A signature whose classes exceed ``MOST_SHARD`` bytes is not gathered: its runs are cut anew by other pieces, as often as
   it takes.

Defined cases: null and empty texts have no bytes; texts under K bytes lose none; rows are told apart by doc_id and text:
those with the same of both count as one place, so neither is the other's repeat, and of several texts of one doc_id, or of
none, that of the smaller hash comes first; a null doc_id comes after all others; extra columns are ignored. Class equality rests on
64 bits of content hash beside the signature and the length.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, doc_key, drop_cut

K = 100
M = 32  # bytes of a piece; K - M + 1 pieces a window
SHARD = 1_000_000  # bytes of text in a shard, about
MOST_SHARD = 2_000_000
CHUNK = 1_000_000  # bytes that are hashed at once, unless a text is longer
_R = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POWERS: dict = {}


def _table(level: int = 0):
    import numpy as np

    return np.random.default_rng(20240229 + level).integers(0, 1 << 64, 256, np.uint64)


def _powers(n: int):
    """Powers of an odd number and of its inverse, to n."""
    import numpy as np

    if _POWERS.get("n", 0) < n:
        size = max(n, 2 * CHUNK)
        both = []
        for r in (_R, pow(_R, -1, 1 << 64)):
            x = np.full(size, r, np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        _POWERS.update(n=size, both=both)
    return _POWERS["both"]


def _mixed(h):
    import numpy as np

    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def prefix_hashes(v):
    """Sums P with which the string [s, e) hashes to (P[e] - P[s]) * inverse power of s."""
    import numpy as np

    up, _ = _powers(len(v) + 1)
    p = np.zeros(len(v) + 1, np.uint64)
    np.cumsum(v * up[: len(v)], out=p[1:])
    return p


def runs_of(texts: list[bytes], level: int = 0) -> list[tuple]:
    """Per text its runs by the pieces' hashes of a level: (starts, windows, signatures, contents, whether the least piece stands there twice) as arrays."""
    import numpy as np

    table, out, i = _table(level), [], 0
    none = (*[np.zeros(0, np.int64)] * 4, np.zeros(0, bool))
    wide = K - M + 1

    def sliding(x, best):
        step = 1
        while 2 * step <= wide:
            x = best(x[:-step], x[step:])
            step *= 2
        return best(x[: len(x) - (wide - step)], x[wide - step :]) if wide > step else x

    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        if size < K:
            out += [none] * (j - i)
            i = j
            continue
        v = table[np.frombuffer(b"".join(texts[i:j]), np.uint8)]
        h, step = v, 1
        while step < M:
            h = h[:-step] * np.uint64(_R * (2 * step + 1) & _MASK | 1) + h[step:]
            step *= 2
        h = _mixed(h)
        low = sliding(h, np.minimum)
        # a piece is some window's least if the greatest least of the windows around it is its own hash
        edge = np.zeros(wide - 1, np.uint64)
        least = np.flatnonzero(sliding(np.concatenate((edge, low, edge)), np.maximum) == h)
        least_h = h[least]
        p, (_, down), at = prefix_hashes(v), _powers(size + 1), 0
        for t in texts[i:j]:
            n = len(t) - K + 1
            if n <= 0:
                out.append(none)
            else:
                mine = low[at : at + n]
                starts = np.concatenate(([0], np.flatnonzero(mine[1:] != mine[:-1]) + 1))
                windows = np.diff(np.append(starts, n))
                s = starts + at
                content = _mixed((p[s + windows + K - 1] - p[s]) * down[s])
                sig = mine[starts]
                a, b = np.searchsorted(least, s), np.searchsorted(least, s + windows + wide - 1)
                k = b - a
                inside = np.repeat(a - np.concatenate(([0], np.cumsum(k)[:-1])), k) + np.arange(k.sum())
                same = np.bincount(np.repeat(np.arange(len(s)), k), least_h[inside] == np.repeat(sig, k), len(s))
                out.append((starts, windows, sig.view(np.int64), content.view(np.int64), same > 1))
            at += len(t)
        i = j
    return out


def _chains(q, first):
    """Places down from each q to where its run of one character begins, ``first[q]``: all of distance 0, then of 1, ..."""
    import numpy as np

    n = q - first[q] + 1
    back = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return (np.repeat(q, n) - back)[np.argsort(back, kind="stable")]


def _induce(s, order, is_l, n_chars: int):
    """Suffixes induced from sorted leftmost-smaller ones: larger types bucket by bucket upward, smaller types downward.

    When a bucket's turn comes, what others put there is complete and moves on as one batch; what it puts into the bucket
    itself are runs of its character, a second batch.
    """
    import numpy as np

    edge = np.append(True, s[1:] != s[:-1])
    first = np.maximum.accumulate(np.where(edge, np.arange(len(s)), 0))

    def push(buckets, p) -> None:
        if len(p):
            ch = s[p]
            by = np.argsort(ch, kind="stable")
            p, ch = p[by], ch[by]
            edges = np.flatnonzero(ch[1:] != ch[:-1]) + 1
            for c, part in zip(ch[np.append(0, edges)].tolist(), np.split(p, edges), strict=True):
                buckets[c].append(part)

    def spread(buckets, c: int, of_type) -> list:
        """The batches of bucket c, in order; what they induce goes to other buckets."""
        if not buckets[c]:
            return []
        batch = np.concatenate(buckets[c])
        q = batch[batch > 0] - 1
        q = q[of_type[q]]
        same = s[q] == c
        push(buckets, q[~same])
        if not same.any():
            return [batch]
        own = _chains(q[same], first)
        q = own[own > 0] - 1
        q = q[of_type[q]]
        push(buckets, q[s[q] != c])
        return [batch, own]

    stars: list = [[] for _ in range(n_chars)]
    push(stars, order)
    up: list = [[] for _ in range(n_chars)]
    for c in range(n_chars):
        up[c] = spread(up, c, is_l)
        for part in stars[c]:
            p = part[part > 0] - 1
            push(up, p[is_l[p]])
    is_s = ~is_l
    down: list = [[] for _ in range(n_chars)]
    for c in range(n_chars - 1, -1, -1):
        # the smaller type stands last in a bucket and is filled from its end; reversed lists keep that order
        down[c] = spread(down, c, is_s)
        for part in reversed(up[c]):
            p = part[::-1]
            p = p[p > 0] - 1
            push(down, p[is_s[p]])
    out = []
    for c in range(n_chars):
        out += up[c]
        out += [x[::-1] for x in reversed(down[c])]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _doubled(names, depth: int):
    """Suffixes of a string of names sorted by their first ``depth``, by ranks of doubled lengths."""
    import numpy as np

    rank, step, top = names.astype(np.int64), 1, int(names.max())
    while step < depth and top < len(rank):
        ahead = np.concatenate((rank[step:], np.zeros(min(step, len(rank)), np.int64)))[: len(rank)]
        key = rank * (len(rank) + 2) + ahead
        by = np.argsort(key, kind="stable")
        k = key[by]
        rank = np.empty_like(rank)
        rank[by] = np.concatenate(([0], np.cumsum(k[1:] != k[:-1]))) + 1
        step, top = 2 * step, int(rank.max())
    return np.argsort(rank, kind="stable")


def _sorted_suffixes(s, n_chars: int, depth: int):
    """Suffixes of an array of characters under ``n_chars``, which ends with its only 0, sorted by ``depth`` at least; that of
    the 0 alone is left out."""
    import numpy as np

    n = len(s)
    # classify: a suffix is of the larger type if the next differing character is smaller
    sign = np.sign(np.diff(s))
    at = np.where(sign != 0, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    is_l = np.append(np.append(sign, 0)[at] < 0, False)
    stars = np.flatnonzero(~is_l[1:] & is_l[:-1]) + 1
    if len(stars) > 1:
        first = _induce(s, stars, is_l, n_chars)
        known = np.zeros(n, bool)
        known[stars] = True
        ordered = first[known[first]]  # by their substrings
        # name the substrings: each reaches to the next leftmost-smaller position
        end = np.zeros(n, np.int64)
        end[stars] = np.minimum(np.append(stars[1:], n - 1) + 1, n)
        p = prefix_hashes(_mixed((s.astype(np.uint64) + np.uint64(1)) * np.uint64(_R)))
        _, down = _powers(n + 1)
        h = (p[end[ordered]] - p[ordered]) * down[ordered]
        length = end[ordered] - ordered
        names = np.zeros(n, np.int64)
        names[ordered] = np.concatenate(([0], np.cumsum((h[1:] != h[:-1]) | (length[1:] != length[:-1])))) + 1
        names = names[stars]
        top = int(names.max())
        if top == len(names) - 1:  # 0 is the end's
            by = np.argsort(names)
        elif top * top <= 16 * len(names):  # few names: the same again
            by = np.append(len(names) - 1, _sorted_suffixes(names, top + 1, depth // 2 + 1))
        else:  # buckets would hold little each
            by = _doubled(names, depth)
        stars = stars[by]
    return _induce(s, stars, is_l, n_chars)


def suffix_array(data: bytes, depth: int = K):
    """Suffixes of a byte string, sorted at least by their first ``depth`` bytes."""
    import numpy as np

    return _sorted_suffixes(np.append(np.frombuffer(data, np.uint8).astype(np.int64) + 1, 0), 257, depth)


def repeats_in(texts: list[bytes], docs: list[int], starts: list[int]) -> list[tuple[int, int]]:
    """(doc, place) of all windows of the texts that stand at an earlier (doc, place) too; text i lies at starts[i] of
    docs[i]. The K bytes of neighbours are compared by 64-bit hashes."""
    import numpy as np

    data = b"\0".join(texts) + b"\0"  # compared windows lie within texts, so the divider needs no code of its own
    sizes = np.array([len(t) for t in texts])
    offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
    sa = suffix_array(data)
    sa = sa[sa < len(data)]
    owner = np.searchsorted(offsets, sa, "right") - 1
    inside = sa - offsets[owner] + K <= sizes[owner]
    sa, owner = sa[inside], owner[inside]
    if not len(sa):
        return []
    p = prefix_hashes(_table()[np.frombuffer(data, np.uint8)])
    _, down = _powers(len(data) + 1)
    # common prefixes permuted into text order: whether the suffix and its neighbour before share K bytes
    phi = np.full(len(data), -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    here = np.flatnonzero(phi >= 0)
    there = phi[here]
    shared = np.zeros(len(data), bool)
    shared[here] = (p[here + K] - p[here]) * down[here] == (p[there + K] - p[there]) * down[there]
    group = np.cumsum(~shared[sa])
    doc, place = np.array(docs)[owner], np.array(starts)[owner] + sa - offsets[owner]
    by = np.lexsort((place, doc, group))
    later = np.concatenate(([False], group[by][1:] == group[by][:-1]))
    # the earliest place may stand there twice: repeated rows of a document
    first = np.maximum.accumulate(np.where(later, 0, np.arange(len(by))))
    d, q = doc[by], place[by]
    gone = later & ~((d == d[first]) & (q == q[first]))
    return list(zip(d[gone].tolist(), q[gone].tolist(), strict=True))


def _spans(places: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Sorted places of windows as (doc, start, end) of the bytes that they cover, merged."""
    out: list[tuple[int, int, int]] = []
    for d, a in sorted(places):
        if out and out[-1][0] == d and a <= out[-1][2]:
            out[-1] = (d, out[-1][1], a + K)
        else:
            out.append((d, a, a + K))
    return out


def _runs(docs: DataFrame) -> DataFrame:
    """(sig, content, doc, copy, start, windows, again) of all runs of rows (doc, copy, data)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                found = runs_of([x or b"" for x in part.column(2).to_pylist()])
                k = [len(x[0]) for x in found]
                doc, copy = (np.repeat(part.column(c).to_numpy(zero_copy_only=False), k) for c in (0, 1))
                starts, windows, sig, content, again = (np.concatenate([x[c] for x in found]) for c in range(5))
                if len(doc):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (sig, content, doc, copy, starts, windows, again)], ["sig", "content", "doc", "copy", "start", "windows", "again"])

    return docs.mapInArrow(run, "sig bigint, content bigint, doc bigint, copy bigint, start bigint, windows bigint, again boolean")


def _period(part: bytes) -> int:
    """The least distance up to that of a window's pieces at which a long part repeats itself, or 0."""
    if len(part) > 3 * K:
        for p in range(1, K - M + 2):
            if part.startswith(part[p : 2 * p + K]) and part[p:] == part[:-p]:
                return p
    return 0


def _recut(parts: DataFrame, level: int) -> DataFrame:
    """Runs (sig, doc, copy, start, part, again) of the parts (sig, doc, copy, start, part) by another level's hashes beside
    the signature that they have. No hashes cut a part that repeats itself, so its first period goes on, and a row of null
    sig has the rest, which is repeated."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                out, rows = [], batch.slice(first, 500).to_pylist()
                for r in rows:
                    if p := _period(r["part"]):
                        out.append(r | {"sig": None, "more": 0, "start": r["start"] + p, "part": r["part"][p:], "again": False})
                        r["part"] = r["part"][: p - 1 + K]
                for r, (starts, windows, sig, _, again) in zip(rows, runs_of([r["part"] for r in rows], level), strict=True):
                    for s, w, g, x in zip(starts.tolist(), windows.tolist(), sig.tolist(), again.tolist(), strict=True):
                        out.append(r | {"more": g, "start": r["start"] + s, "part": r["part"][s : s + w - 1 + K], "again": x})
                if out:
                    yield pa.RecordBatch.from_pylist(out, pa.schema([(n, pa.int64()) for n in ("sig", "more", "doc", "copy", "start")] + [("part", pa.binary()), ("again", pa.bool_())]))

    found = parts.select("sig", "doc", "copy", "start", "part").mapInArrow(run, "sig bigint, more bigint, doc bigint, copy bigint, start bigint, part binary, again boolean")
    return found.withColumn("sig", F.when(F.col("sig").isNotNull(), F.xxhash64("sig", "more"))).drop("more")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, copy, start, end) of repeated bytes of rows (doc, copy, data); spans may overlap."""
    runs = _runs(docs)
    twice = cut(runs.groupBy("sig").agg(F.sum(F.when(F.col("again"), 2).otherwise(1)).alias("k")).where("k > 1").select("sig"), "signatures")
    runs = cut(runs.join(twice, "sig"), "runs", [twice])
    place = F.struct("doc", "copy", "start")
    classes = cut(runs.groupBy("sig", "content", "windows").agg(F.min(place).alias("first"), F.count("*").alias("k"), F.max("again").alias("again")), "classes")
    several = classes.groupBy("sig").agg(F.count("*").alias("n"), F.sum(F.col("windows") + K).alias("bytes"), F.max("again").alias("again")).where("n > 1 or again").select("sig", "bytes")
    # whole runs
    whole = runs.join(classes.where("k > 1").select("sig", "content", "windows", "first"), ["sig", "content", "windows"]).where(place != F.col("first"))
    spans = cut(whole.select("doc", "copy", "start", (F.col("start") + F.col("windows") - 1 + K).alias("end")), "spans", [runs])
    # the earliest run of each class, with its bytes, where a signature has several classes or a run can repeat within itself
    firsts = classes.join(several, "sig").select("sig", "first.*", "windows", "bytes")
    lists = firsts.groupBy("doc", "copy").agg(F.collect_list(F.struct("sig", "start", "windows", "bytes")).alias("runs"))  # a document's own runs
    held = docs.join(lists, ["doc", "copy"]).select("doc", "copy", F.explode("runs").alias("r"), "data")
    part = F.expr(f"substring(data, cast(r.start + 1 as int), cast(r.windows - 1 + {K} as int))")
    held = cut(held.select("r.sig", "r.bytes", "doc", "copy", "r.start", part.alias("part")), "parts", [classes])

    def sort_shard(pdf):
        import pandas as pd

        docs = list(zip(pdf["doc"].tolist(), pdf["copy"].tolist(), strict=True))
        rows = sorted(set(docs))
        at = {x: i for i, x in enumerate(rows)}
        found = _spans(repeats_in(pdf["part"].tolist(), [at[x] for x in docs], pdf["start"].tolist()))
        return pd.DataFrame([(*rows[i], a, b) for i, a, b in found], columns=["doc", "copy", "start", "end"], dtype="int64")

    level = 0
    while True:
        fits = held.where(F.col("bytes") <= MOST_SHARD)
        shards = max(1, (fits.agg(F.sum(F.length("part"))).first()[0] or 0) // SHARD)
        fits = fits.withColumn("shard", F.pmod(F.xxhash64("sig", F.lit(level)), F.lit(shards)))
        spans = cut(spans.unionByName(fits.groupBy("shard").applyInPandas(sort_shard, "doc bigint, copy bigint, start bigint, end bigint")), "spans", [spans])
        large = held.where(F.col("bytes") > MOST_SHARD)
        if large.isEmpty():
            drop_cut(held)
            return spans
        # signatures with too many bytes for one shard are cut anew by other pieces, and equal runs are classes again
        level += 1
        finer = cut(_recut(large, level).withColumn("content", F.xxhash64("part")), "finer", [held])
        known = finer.where("sig is not null").groupBy("sig", "content", F.length("part").alias("size")).agg(F.min(place).alias("first"), F.max("again").alias("again"))
        known = cut(known, "classes")
        mine = finer.withColumn("size", F.length("part")).drop("again").join(known, ["sig", "content", "size"])
        gone = mine.where(place != F.col("first")).unionByName(finer.where("sig is null"), allowMissingColumns=True)
        spans = cut(spans.unionByName(gone.select("doc", "copy", "start", (F.col("start") + F.length("part")).alias("end"))), "spans", [spans])
        sums = known.groupBy("sig").agg(F.count("*").alias("n"), F.sum("size").cast("bigint").alias("bytes"), F.max("again").alias("again")).where("n > 1 or again").select("sig", "bytes")
        held = cut(mine.where(place == F.col("first")).drop("first", "again", "content", "size").join(sums, "sig"), "parts", [finer, known])


def _with_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, data, spans): sorted (start, end) to remove, null if none. Rows are told apart by doc_id and text."""
    rows = docs.select("doc_id", doc_key(F.col("doc_id")).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))
    own = rows.select("doc", "copy", "data")
    spans = repeated_spans(own).groupBy("doc", "copy").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))  # of one document
    return rows.join(spans, ["doc", "copy"], "left").select("doc_id", "data", "spans")


def _cut_text(data: bytes, spans) -> tuple[bytes, int, int]:
    kept, at, removed, n = [], 0, 0, 0
    merged: list[list[int]] = []
    for x in spans or ():
        if merged and x["start"] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], x["end"])
        else:
            merged.append([x["start"], x["end"]])
    for a, b in merged:
        kept.append(data[at:a])
        at, removed, n = b, removed + b - a, n + 1
    kept.append(data[at:])
    return b"".join(kept), removed, n


def cut_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the remaining bytes of each row's text."""
    rows = _with_spans(docs.select("doc_id", "text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                data = part.column(1).to_pylist()
                done = [_cut_text(d, s) for d, s in zip(data, part.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(d) for d in data], pa.int64()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64()), pa.array([x[0] for x in done], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return cut_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
