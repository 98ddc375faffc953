"""Hard negatives of embeddings by distributed radix selection.

``mine(embeddings)`` scores every row against each anchor (an integer inner product), takes an anchor's best rows of its own
label as positives, and for each anchor and positive the best rows of other labels whose score lies in a window below the positive's.

The best k of a window are found without gathering the window: tasks count their rows by a digit of the distance from the window's
top, the sums say which bucket holds the kth row, and the next digit splits that bucket only. When a bucket is one score wide, the
rows at or above it are gathered, of equal scores at most k from a task. A task sends no buckets below the one that holds
its own kth row, since the kth of all rows can't lie lower.

Anchors grow with the rows, so they are taken in blocks of about ``BLOCK``: a block's anchors and windows are all that the driver
or a closure holds, and each pass reads the rows where they stand, without a shuffle of vectors.

Rows of null label, null vector, or with a null or non-finite component take no part. Rows equal in vec_id, label and vector, as quantised, count
once; rows that share only a vec_id are rows of their own, but none of an anchor's own vec_id is its positive. A null vec_id is no anchor
and comes after all others among equal scores. A shorter vector counts as padded with zeros; an empty one scores 0. Products must fit
62 bits. A table without
anchors, or an empty one, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, drop_cut

BLOCK = 2048  # anchors at a time, about: what the driver and a task's closure hold
STRIP = 256  # anchors scored at a time within a task
DIGIT = 1024  # buckets of a pass
POSITIVES, NEGATIVES = 5, 10
LEVELS, FLIP_EVERY, ANCHOR_EVERY, CLASSES = 256, 7, 100, 10
LOW, HIGH, OF = 30, 90, 100  # a negative's score lies in these parts of the positive's
NULL_ID = (1 << 63) - 1
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
_FOUND = "wid bigint, id bigint, score bigint, row bigint"


def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, q, row) of the rows that take part: labels with every seventh flipped, components as integers of 256
    levels, and a hash that tells rows apart which share a vec_id."""
    e = F.col("embedding")
    fine = F.col("label").isNotNull() & e.isNotNull() & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    flipped = F.coalesce(F.col("vec_id") % FLIP_EVERY == 0, F.lit(False))
    label = F.when(flipped, F.pmod(F.col("label").cast("bigint") + 1, F.lit(CLASSES))).otherwise(F.col("label")).cast("bigint")
    q = F.transform(e, lambda x: F.floor(LEVELS * x.cast("double")).cast("bigint"))
    rows = embeddings.where(fine).select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), q.alias("q"))
    return rows.withColumn("row", F.xxhash64("vec_id", "label", "q")).dropDuplicates(["vec_id", "label", "q"])


def _matrix(column, dim: int):
    """The vectors of an Arrow list column as rows, padded to ``dim``."""
    import numpy as np

    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), dtype=np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _products(anchors, rows):
    """Exact integer inner products: by floating point where no sum can pass 2 ** 52."""
    import numpy as np

    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), dtype=np.int64)
    if float(np.abs(anchors).max()) * float(np.abs(rows).max()) * anchors.shape[1] < 2**52:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors @ rows.T


class _Windows:
    """Windows of one block: each belongs to an anchor and has inclusive bounds lo and hi, and an interval [off, off + span) of
    distances from hi in which its kth row lies."""

    def __init__(self, ids, labels, vectors, anchor, lo, hi, same: bool, k: int):
        import numpy as np

        self.ids, self.labels, self.vectors, self.same, self.k = ids, labels, vectors, same, k
        self.anchor, self.lo, self.hi = (np.asarray(x, dtype=np.int64) for x in (anchor, lo, hi))
        self.off, self.span = np.zeros(len(self.lo), np.int64), self.hi - self.lo + 1
        self.need = np.full(len(self.lo), k, np.int64)

    def open(self) -> bool:
        return bool((self.span > 1).any())

    def size(self):
        return -(-self.span // DIGIT)

    def narrowed(self, counts) -> None:
        """Takes each window to the bucket that holds its kth row; a window with fewer rows is all taken."""
        import numpy as np

        size = self.size()
        by: dict[int, list] = {}
        for w, b, n in counts:
            by.setdefault(w, []).append((b, n))
        for w in range(len(self.lo)):
            if self.span[w] <= 1:
                continue
            before = 0
            for b, n in sorted(by.get(w, [])):
                if before + n >= self.need[w]:
                    self.off[w] += b * size[w]
                    self.span[w] = min(size[w], self.hi[w] - self.lo[w] + 1 - self.off[w])
                    self.need[w] -= before
                    break
                before += n
            else:
                self.off[w], self.span[w] = self.hi[w] - self.lo[w], 1  # fewer than k: down to the window's end
                self.need[w] = np.iinfo(np.int64).max

    def cutoff(self):
        return self.hi - self.off


def _scored(w: _Windows, batch, dim: int) -> Iterator[tuple]:
    """Per anchor its windows, the places of the batch that are eligible and their scores, and the batch's ids."""
    import numpy as np

    ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
    labels = batch.column(1).to_numpy(zero_copy_only=False)
    vectors = _matrix(batch.column(2), dim)
    order = np.argsort(w.anchor, kind="stable")
    begin = np.searchsorted(w.anchor[order], np.arange(len(w.ids) + 1))
    for first in range(0, len(w.ids), STRIP):
        scores = _products(w.vectors[first : first + STRIP], vectors)
        for a in range(first, min(first + STRIP, len(w.ids))):
            own = order[begin[a] : begin[a + 1]]
            if len(own):
                fits = (labels == w.labels[a]) & (ids != w.ids[a]) if w.same else labels != w.labels[a]
                at = np.flatnonzero(fits)
                yield own, at, scores[a - first][at], ids


def _counts(rows: DataFrame, w: _Windows, dim: int) -> list[tuple[int, int, int]]:
    """(window, bucket, rows) summed over all tasks, from each task only down to the bucket of its own kth row."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        size, seen = w.size(), {}
        for batch in batches:
            for own, _, scores, _ in _scored(w, batch, dim):
                for i in own:
                    if w.span[i] <= 1:
                        continue
                    u = w.hi[i] - scores - w.off[i]
                    u = u[(u >= 0) & (u < w.span[i])]
                    if len(u):
                        if i not in seen:
                            seen[i] = np.zeros(DIGIT, np.int64)
                        seen[i] += np.bincount(u // size[i], minlength=DIGIT)
        out = ([], [], [])
        for i, h in seen.items():
            b = np.flatnonzero(h)
            b = b[: np.searchsorted(np.cumsum(h[b]), w.need[i]) + 1]
            for x, v in zip(out, (np.full(len(b), i), b, h[b]), strict=True):
                x.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["w", "b", "n"])

    sums = rows.mapInArrow(run, "w bigint, b bigint, n bigint").groupBy("w", "b").agg(F.sum("n").alias("n"))
    # of a window only the buckets down to its kth row are of use: at most k of a task
    before = F.sum("n").over(Window.partitionBy("w").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    return [tuple(r) for r in sums.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < w.k).select("w", "b", "n").collect()]


def _gathered(rows: DataFrame, w: _Windows, dim: int) -> DataFrame:
    """(wid, id, score, row, nth): the first k rows of each window."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        least, best = w.cutoff(), {}
        for batch in batches:
            hashes = batch.column(3).to_numpy(zero_copy_only=False)
            for own, at, scores, ids in _scored(w, batch, dim):
                for i in own:
                    k = np.flatnonzero((scores >= max(least[i], w.lo[i])) & (scores <= w.hi[i]))
                    if len(k):
                        new = np.stack([-scores[k], ids[at[k]], hashes[at[k]]])
                        if i in best:
                            new = np.concatenate([best[i], new], axis=1)
                        best[i] = new[:, np.lexsort((new[2], new[1], new[0]))[: w.k]]
        if best:
            cols = np.concatenate([np.vstack([np.full(v.shape[1], i), v]) for i, v in best.items()], axis=1)
            ids = pa.array(cols[2], mask=cols[2] == NULL_ID)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0]), ids, pa.array(-cols[1]), pa.array(cols[3])], names=["wid", "id", "score", "row"])

    by = Window.partitionBy("wid").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return rows.mapInArrow(run, _FOUND).withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= w.k)


def _best(rows: DataFrame, w: _Windows, dim: int) -> DataFrame:
    """Radix passes until each window's kth score is known, then the rows at or above it."""
    while w.open():
        w.narrowed(_counts(rows, w, dim))
    return _gathered(rows, w, dim)


def mine(embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, block: int = BLOCK) -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of other labels in the positive's window, best first."""
    import numpy as np

    spark = embeddings.sparkSession
    rows = cut(quantised(embeddings), "vectors")
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    # no score passes the largest square of a norm
    square = F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, dim, most = anchors.count(), *rows.agg(F.max(F.size("q")), F.max(square)).first()
    dim, most = dim or 0, min(int(most or 0) + 1, (1 << 62) - 1)
    blocks, out = -(-n // block), []
    for b in range(blocks):
        some = anchors.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("vec_id", "label", "q").orderBy("vec_id", "row").collect()
        if not some:
            continue
        vectors = np.zeros((len(some), dim), np.int64)
        for i, r in enumerate(some):
            vectors[i, : len(r.q)] = r.q
        own = (np.array([r.vec_id for r in some], np.int64), np.array([r.label for r in some], np.int64), vectors)
        each = np.arange(len(some))
        near = _best(rows, _Windows(*own, each, np.full(len(some), -most), np.full(len(some), most), True, positives), dim).orderBy("wid", "nth").collect()
        pos = np.array([r.score for r in near], np.int64)
        windows = _Windows(*own, [r.wid for r in near], -((-LOW * pos) // OF), (HIGH * pos) // OF, False, negatives)
        known = spark.createDataFrame([(i, some[r.wid].vec_id, r.id, r.score) for i, r in enumerate(near)], "wid bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
        found = _best(rows, windows, dim).withColumnsRenamed({"id": "negative_id", "score": "negative_score", "nth": "rank"})
        out.append(cut(found.join(known, "wid").select(*[x.split()[0] for x in RESULT.split(", ")]), "negatives"))
    drop_cut(rows)
    result = spark.createDataFrame([], RESULT)
    for x in out:
        result = result.unionByName(x)
    return result


cloudpickle.register_pickle_by_value(sys.modules[__name__])
