"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Minimum covariance determinant: in each group, from a start of medians and interquartile ranges,
concentration steps refit mean and covariance on the share of rows that lie nearest by Mahalanobis
distance; the last fit judges all rows. Everything is a DataFrame expression: the features are one pass
over the texts, a step is two grouped sums over narrow rows, and distances use a Cholesky factor that is
written out as column arithmetic.

Defined cases: a null or empty text has no words and fails the base rules; null lang or source is a group
of its own; groups of fewer than ``MIN_GROUP`` fitted rows use their language's fit, and then the fit of all
rows, however few; repeated rows are judged alike, each on its own row; extra columns of any name are carried by
``apply_rules`` and left out by ``score_documents``; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_RE, bounded, carried, cut, doc_key, let, window_hashes, words

FEATURES = ("f_len", "f_sym", "f_div", "f_up", "f_dup")
#: Standard deviations added to each feature: a group of equal texts still has a covariance.
FLOOR = (0.04, 0.25, 0.025, 0.15, 0.4)
SUBSET = 0.75  # share of rows in the concentrated fit
STEPS = 3
#: P(chi2_5 <= q) = 0.75 at q = 6.626; the fit of that ball is too narrow by this factor.
CONSISTENCY = 1.41
CUTOFF = 45.0  # squared distance; chi2 with 5 degrees exceeds it with p < 2e-8
MOST_BROADCAST = 1_000_000  # rejected rows
SHORT = 20  # words: the statistics of a text of n words count as n / (n + SHORT) certain
MIN_GROUP = 40
SALTS = 32  # parts in which a group's rows meet its fit


def text_statistics(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_distinct, n_upper."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_replace(x, SPACE_RE, "") != "")

    def repeated(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        twice = lambda s: F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        covered = lambda at: F.aggregate(
            at, F.struct(F.lit(-5).alias("p"), F.lit(0).cast("bigint").alias("n")), lambda a, p: F.struct(p.alias("p"), (a["n"] + F.least(F.lit(5), p - a["p"])).alias("n"))
        )["n"]
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(let(placed, lambda s: covered(F.sort_array(F.transform(twice(s), lambda x: x["p"])))))

    return let(
        words(text),
        lambda ws: F.struct(
            F.size(ws).cast("bigint").alias("n_words"),
            F.length(F.regexp_replace(t, SPACE_RE, "")).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            let(window_hashes(ws, 5), repeated).alias("n_repeat_words"),
            F.size(lines).cast("bigint").alias("n_lines"),
            F.size(F.array_distinct(ws)).cast("bigint").alias("n_distinct"),
            F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("bigint").alias("n_upper"),
        ),
    )


def with_features(df: DataFrame) -> DataFrame:
    """Adds base_failed and the transformed statistics, from the columns of ``text_statistics``."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return df.withColumns(
        {
            "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
            "f_len": F.log(F.greatest(F.col("word_chars") / n, F.lit(0.1))),
            "f_sym": F.asinh(10 * F.col("n_symbols") / n),
            "f_div": F.log(F.greatest(F.col("n_distinct"), F.lit(1)) + 1.0) / F.log(n + 1.0),
            "f_up": F.asinh(10 * F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))),
            "f_dup": F.asinh(10 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        }
    )


def _squared_distance() -> Column:
    """Mahalanobis distance of f_* from m_*, with c_ij: forward substitution through the Cholesky factor."""
    p = len(FEATURES)
    low: dict[tuple[int, int], Column] = {}
    y: list[Column] = []
    for i in range(p):
        low[i, i] = F.col(f"l_{i}_{i}")
        z = F.col(FEATURES[i]) - F.col(f"m_{i}")
        for j in range(i):
            z = z - F.col(f"l_{i}_{j}") * y[j]
        y.append(z / low[i, i])
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _factored(fit: DataFrame) -> DataFrame:
    """From means and covariances (m_i, c_i_j), the lower Cholesky factor l_i_j, each level one projection."""
    p = len(FEATURES)
    for j in range(p):
        d = F.col(f"c_{j}_{j}")
        for k in range(j):
            d = d - F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}")
        fit = fit.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(d, F.lit(1e-9))))
        for i in range(j + 1, p):
            s = F.col(f"c_{i}_{j}")
            for k in range(j):
                s = s - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            fit = fit.withColumn(f"l_{i}_{j}", s / F.col(f"l_{j}_{j}"))
    return fit.select("g", "n", *[f"m_{i}" for i in range(p)], *[f"l_{i}_{j}" for i in range(p) for j in range(i + 1)])


def _moments(rows: DataFrame, factor: float) -> DataFrame:
    p = len(FEATURES)
    f = FEATURES
    sums = [F.avg(f[i]).alias(f"m_{i}") for i in range(p)] + [F.avg(F.col(f[i]) * F.col(f[j])).alias(f"x_{i}_{j}") for i in range(p) for j in range(i + 1)]
    fit = rows.groupBy("g").agg(F.count("*").alias("n"), *sums)
    cov = {f"c_{i}_{j}": (F.col(f"x_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}")) * factor + F.lit(FLOOR[i] ** 2 if i == j else 0.0) for i in range(p) for j in range(i + 1)}
    return _factored(fit.withColumns(cov))


def _salted(table: DataFrame) -> DataFrame:
    """A copy of each group's row for every salt: the group of all rows isn't joined in one task."""
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def fit_mcd(rows: DataFrame) -> DataFrame:
    """Fits by group ``g`` of rows (g, f_*): concentration steps, then the factors of the last fit (cut)."""
    p = len(FEATURES)
    start = rows.groupBy("g").agg(F.count("*").alias("n"), *[F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q_{i}") for i, x in enumerate(FEATURES)])
    start = start.withColumns({f"m_{i}": F.col(f"q_{i}")[1] for i in range(p)})
    start = start.withColumns(
        {f"c_{i}_{j}": F.pow((F.col(f"q_{i}")[2] - F.col(f"q_{i}")[0]) / 1.349, 2) + FLOOR[i] ** 2 if i == j else F.lit(0.0) for i in range(p) for j in range(i + 1)}
    )
    fit = cut(_factored(start), "mcd")
    rows = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    for _ in range(STEPS):
        # a fine logarithmic histogram of distances gives each group's quantile by partial counts
        at = rows.join(_salted(fit), ["g", "salt"]).withColumn("bin", F.floor(F.log(_squared_distance() + 1e-6) * 50))
        counts = at.groupBy("g", "bin").agg(F.count("*").alias("k"))
        up = Window.partitionBy("g").orderBy("bin")
        limit = (
            counts.withColumn("below", F.sum("k").over(up) - F.col("k"))
            .withColumn("all", F.sum("k").over(Window.partitionBy("g")))
            .where(F.col("below") < SUBSET * F.col("all"))
            .groupBy("g")
            .agg(F.max("bin").alias("most"))
        )
        limit = cut(limit, "limits")  # as a table it has a size, by which Spark may broadcast it
        near = at.join(_salted(limit), ["g", "salt"]).where("bin <= most").select("g", *FEATURES)
        fit = cut(_moments(near, CONSISTENCY), "mcd")
    return fit


def _row_key() -> Column:
    """What a verdict depends on, beside the document's id."""
    return F.xxhash64("text", "lang", "source")


def _judged(docs: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, copy, lang, source, the statistics, base_failed, distance, kept."""
    stats = docs.select("doc_id", "lang", "source", _row_key().alias("copy"), text_statistics(F.col("text")).alias("s")).select("doc_id", "copy", "lang", "source", "s.*")
    rows = cut(with_features(stats), "quality")
    keys = {
        "g1": F.to_json(F.struct(F.lit(1).alias("level"), "lang", "source")),
        "g2": F.to_json(F.struct(F.lit(2).alias("level"), "lang")),
        "g3": F.to_json(F.struct(F.lit(3).alias("level"))),
    }
    good = rows.where("not base_failed").withColumns(keys)
    fits = fit_mcd(good.select(F.explode(F.array(*keys)).alias("g"), *FEATURES)).where((F.col("n") >= MIN_GROUP * SUBSET) | (F.col("g") == keys["g3"]))
    chosen = good.select(*keys).distinct()
    for k in ("g1", "g2"):
        chosen = chosen.join(fits.select(F.col("g").alias(k), F.lit(1).alias(f"has_{k}")), k, "left")
    chosen = chosen.select("g1", F.coalesce(F.when(F.col("has_g1") == 1, F.col("g1")), F.when(F.col("has_g2") == 1, F.col("g2")), F.col("g3")).alias("g"))
    model = chosen.join(fits, "g").drop("g", "n")
    judged = rows.withColumn("g1", keys["g1"]).join(model, "g1", "left").withColumn("distance", F.when(~F.col("base_failed"), _squared_distance()))
    return judged.select(
        "doc_id", "copy", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
        (~F.col("base_failed") & (F.coalesce(F.col("distance") * F.col("n_words") / (F.col("n_words") + SHORT), F.lit(0.0)) <= CUTOFF)).alias("kept"),
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, lang, source, the statistics, base_failed, distance (null where the
    base rules fail), kept."""
    return _judged(docs).drop("copy")


def apply_rules(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns; each row by its own text, whatever else has its doc_id.
    Rejected rows are looked up, which are fewer, so texts stay where they are while those fit a broadcast."""
    gone = bounded(_judged(docs).where("not kept").select(doc_key(F.col("doc_id")).alias("doc"), "copy").distinct(), MOST_BROADCAST)
    return carried(docs, doc=doc_key(F.col("doc_id")), copy=_row_key()).join(gone, ["doc", "copy"], "left_anti").select("row.*")
