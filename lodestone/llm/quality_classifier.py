"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Class means and covariances come from grouped sums over the labelled training rows; covariances are shrunk
towards their diagonal and the pooled one, and their Cholesky factors are kept as constants. A text's score is the
difference of its two log densities by forward substitution, through a logistic curve that is fitted on a
histogram of training differences.

Training rows: those with a label and crc32(doc_id as text) mod 4 other than 2. Labels, lang, source and doc_id
are never inputs. Only sums of fixed size come to the driver. Defined cases: null text is empty, and empty texts
have a score; null doc_id is scored and never trained on; several labels of a document count as their least;
without training rows of both classes the score is 0.5; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut
from .quality_rules import text_statistics

FEATURES = ("x_n", "x_len", "x_sym", "x_div", "x_up", "x_dup", "x_rep")
SHRINK_POOLED, SHRINK_DIAGONAL = 0.05, 0.05
FLOOR = 0.02  # standard deviation added to each feature
CUT = 0.7
_BIN = 0.25  # of the histogram of log-density differences
_MOST = 60.0  # of the histogram alone; scores go on beyond


def features(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the transformed statistics, written once."""
    s = docs.select("doc_id", text_statistics(F.col("text")).alias("s")).select("doc_id", "s.*")
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return cut(
        s.select(
            "doc_id",
            F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"),
            F.log1p("n_words").alias("x_n"),
            F.log1p(F.col("word_chars") / n).alias("x_len"),
            F.asinh(10 * F.col("n_symbols") / n).alias("x_sym"),
            (F.log(F.col("n_distinct") + 1.0) / F.log(n + 1.0)).alias("x_div"),
            F.asinh(10 * F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))).alias("x_up"),
            F.asinh(10 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("x_dup"),
            F.asinh(10 * F.col("n_repeat_words") / n).alias("x_rep"),
        ),
        "features",
    )


def _log_density(mean: np.ndarray, factor: np.ndarray, log_prior: float) -> Column:
    y: list[Column] = []
    for i, f in enumerate(FEATURES):
        z = F.col(f) - float(mean[i])
        for j in range(i):
            z = z - y[j] * float(factor[i, j])
        y.append(z / float(factor[i, i]))
    return F.lit(log_prior - float(np.log(np.diag(factor)).sum())) - 0.5 * sum((v * v for v in y[1:]), y[0] * y[0])


def _calibrate(counts: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Logistic slope and offset by Newton steps over (difference, label, rows)."""
    d, y, k = (np.array(x, float) for x in zip(*counts, strict=True))
    a, b = 0.1, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * d + b, -35, 35)))
        g = np.array([(k * (y - p) * d).sum() - 1e-3 * a, (k * (y - p)).sum()])
        w = k * p * (1 - p) + 1e-9
        h = np.array([[(w * d * d).sum() + 1e-3, (w * d).sum()], [(w * d).sum(), w.sum()]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-7:
            break
    return max(float(a), 1e-3), float(b)


def fit(rows: DataFrame, labels: DataFrame) -> Column:
    """The score column for rows of ``features``, learnt from labels (doc_id, quality) of rows not held out."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    train = cut(rows.where("not held_out").join(known, "doc_id").select("y", *FEATURES), "train")
    p = len(FEATURES)
    sums = [F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)] + [F.avg(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"c{i}_{j}") for i in range(p) for j in range(i + 1)]
    got = {r["y"]: r for r in train.where("y in (0, 1)").groupBy("y").agg(F.count("*").alias("n"), *sums).collect()}
    if set(got) != {0, 1}:
        return F.lit(0.5)
    n = {y: got[y]["n"] for y in got}
    mean = {y: np.array([r[f"m{i}"] for i in range(p)]) for y, r in got.items()}
    cov = {}
    for y, r in got.items():
        c = np.array([[r[f"c{max(i, j)}_{min(i, j)}"] for j in range(p)] for i in range(p)]) - np.outer(mean[y], mean[y])
        cov[y] = c + FLOOR**2 * np.eye(p)
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
    dens = {}
    for y in got:
        c = (1 - SHRINK_POOLED) * cov[y] + SHRINK_POOLED * pooled
        c = (1 - SHRINK_DIAGONAL) * c + SHRINK_DIAGONAL * np.diag(np.diag(c))
        dens[y] = _log_density(mean[y], np.linalg.cholesky(c), math.log(n[y] / (n[0] + n[1])))
    diff = dens[1] - dens[0]
    counts = train.where("y in (0, 1)").groupBy(F.round(F.greatest(F.least(diff, F.lit(_MOST)), F.lit(-_MOST)) / _BIN).alias("b"), "y").agg(F.count("*").alias("k")).collect()
    a, b = _calibrate([(r["b"] * _BIN, r["y"], r["k"]) for r in counts])
    return 1 / (1 + F.exp(-(diff * a + b)))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    rows = features(docs)
    scored = rows.select("doc_id", "held_out", fit(rows, labels).alias("score"))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
