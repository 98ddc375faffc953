"""Samples of sites and of pairs of sites, in orders that any run repeats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions import content as C
from lodestone.sources import files

OPERATORS = 16  # that may edit the same byte, at most
GAMMA = 0x9E3779B97F4A7C15


def round_robin(sites: DataFrame, n: int, file: str = "file", order: tuple[str, ...] = ("start_byte", "operator")) -> DataFrame:
    """n sites, one of each file in path order per round. Only the first n sites of a file can be taken, which bounds the
    window's output before the limit."""
    turn = F.row_number().over(Window.partitionBy(file).orderBy(*order))
    return sites.withColumn("turn", turn).where(F.col("turn") <= n).orderBy("turn", file).limit(n)


def scope_pairs(sites: DataFrame, most: int, order: tuple[str, ...] = ("start_byte", "operator", "id")) -> DataFrame:
    """The pairs number 0 to ``most - 1`` of every (file, scope): file, scope, k, a_id, b_id, key. Sites have id, file, scope, start_byte, operator.

    A scope's pairs are numbered by place, not listed and sorted: (i, j) of m sites is number i*m - i*(i+1)/2 + j - i - 1, so the first of
    them need a scope's first ``most + 1`` sites only, which the window picks before it shuffles."""
    sizes = sites.groupBy("file", "scope").agg(F.count("*").alias("m")).where("m > 1")
    place = F.row_number().over(Window.partitionBy("file", "scope").orderBy(*order))
    s = sites.withColumn("i", place).where(F.col("i") <= most + 1).withColumn("i", F.col("i") - 1).join(sizes, ["file", "scope"])
    first = s.select("file", "scope", "m", "i", F.col("id").alias("a_id"), F.col("start_byte").alias("a_start"), F.col("operator").alias("a_op"))
    base = F.col("i") * F.col("m") - (F.col("i") * (F.col("i") + 1) / 2).cast("bigint")
    first = first.withColumn("base", base).where(F.col("base") < most)
    last = F.least(F.col("m") - 1, F.lit(most) - F.col("base") + F.col("i"))
    first = first.where(last > F.col("i")).withColumn("j", F.explode(F.sequence(F.col("i") + 1, last.cast("int"))))
    second = s.select("file", "scope", F.col("i").alias("j"), F.col("id").alias("b_id"), F.col("start_byte").alias("b_start"), F.col("operator").alias("b_op"))
    out = first.join(second, ["file", "scope", "j"])
    key = C.pair_key(F.col("file"), F.col("a_start"), F.col("a_op"), F.col("file"), F.col("b_start"), F.col("b_op"))
    return out.select("file", "scope", (F.col("base") + F.col("j") - F.col("i") - 1).cast("bigint").alias("k"), "a_id", "b_id", key.alias("key"))


def pairs_within(sites: DataFrame, want: int, order: tuple[str, ...] = ("start_byte", "operator", "id")) -> DataFrame:
    """The first ``want`` of the k-th pairs of every (file, scope) in turn, the first of each key: two trials of one site are one site.

    Keys repeat only where sites do, so the first numbers of each scope mostly do; where they don't, twice as many are looked at."""
    most, largest = want, sites.groupBy("file", "scope").count().agg(F.max("count")).first()[0] or 0
    while True:
        first = F.row_number().over(Window.partitionBy("key").orderBy("k", "file", "scope"))
        out = scope_pairs(sites, most, order).withColumn("nth", first).where("nth = 1").drop("nth").orderBy("k", "file", "scope").limit(want)
        if most >= largest * (largest - 1) // 2 or out.count() == want:
            return out.select("file", "scope", "k", "a_id", "b_id")
        most *= 2


def pairs_across(killers: DataFrame, survivors: DataFrame) -> DataFrame:
    """Killer and survivor in one file, same-scope pairs first: an equi-join on the file; cross-file pairs are drawn
    apart by ``cross_file_draws``. Overlapping sites and repeated keys are out."""
    a = killers.select(*[F.col(c).alias(f"a_{c}") for c in ("id", "file", "scope", "start_byte", "end_byte", "operator")])
    b = survivors.select(*[F.col(c).alias(f"b_{c}") for c in ("id", "file", "scope", "start_byte", "end_byte", "operator")])
    met = a.join(b, F.col("a_file") == F.col("b_file")).where((F.col("a_end_byte") <= F.col("b_start_byte")) | (F.col("b_end_byte") <= F.col("a_start_byte")))
    met = met.withColumn("affinity", C.affinity(F.col("a_file"), F.col("a_scope"), F.col("b_file"), F.col("b_scope")))
    met = met.withColumn("key", C.pair_key(F.col("a_file"), F.col("a_start_byte"), F.col("a_operator"), F.col("b_file"), F.col("b_start_byte"), F.col("b_operator")))
    first = F.row_number().over(Window.partitionBy("key").orderBy("a_id", "b_id"))
    return met.withColumn("nth", first).where("nth = 1").drop("nth")


def sample_across(killers: DataFrame, survivors: DataFrame, want: int, order: str = "id") -> DataFrame:
    """(a_id, b_id, affinity): ``want`` pairs of a killer and a survivor, same-scope ones first, then those of one file, each
    in order of the killers and then of the survivors. Sites count once; no two of a pair begin at the same byte.

    A pair of the first ``want`` has one of the first ``want`` killers that have a partner, and one of that killer's first
    ``want`` partners, so a hot file is never paired out: what meets is bounded by the budget."""
    once = lambda df: df.withColumn("nth", F.row_number().over(Window.partitionBy("file", "start_byte", "operator").orderBy(order))).where("nth = 1")
    a = once(killers).select(*[F.col(c).alias(f"a_{c}") for c in ("id", "file", "scope", "start_byte")])
    b = once(survivors).select(*[F.col(c).alias(f"b_{c}") for c in ("id", "file", "scope", "start_byte")])
    out = None
    for turn, (name, by) in enumerate((("same-scope", ("file", "scope")), ("same-file", ("file",)))):
        keys = [F.col(f"a_{c}") == F.col(f"b_{c}") for c in by]
        other = F.lit(True) if name == "same-scope" else F.col("a_scope") != F.col("b_scope")
        fits = other & (F.col("a_start_byte") != F.col("b_start_byte"))
        # sites begin at a byte once per operator, so a killer passes over few of its scope's survivors
        ranked = F.row_number().over(Window.partitionBy("b_file", "b_scope").orderBy("b_id"))
        some = b.withColumn("rank", ranked).where(F.col("rank") <= want + OPERATORS).drop("rank")
        first = a.join(some.select("b_file", "b_scope", "b_start_byte"), [*keys, fits], "left_semi").orderBy("a_id").limit(want)
        met = first.join(some, [*keys, fits]).orderBy("a_id", "b_id").limit(want)
        part = met.select("a_id", "b_id", F.lit(name).alias("affinity"), F.lit(turn).alias("turn"))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("turn", "a_id", "b_id").limit(want).drop("turn")


def ranked_across(killers: DataFrame, survivors: DataFrame, want: int, order: str = "id") -> DataFrame:
    """(a_id, b_id, a_order, b_order, affinity, turn, key): as ``sample_across``, but pairs count once by key, in either order, and sites by key and scope.

    Keys mostly come once, or twice, once from either side; where they come more often than twice the budget allows for, twice as many pairs are looked at."""
    once = lambda df: df.withColumn("nth", F.row_number().over(Window.partitionBy("file", "scope", "start_byte", "operator").orderBy(order))).where("nth = 1")
    own = ("id", "file", "scope", "start_byte", "operator")
    a = once(killers).select(*[F.col(c).alias(f"a_{c}") for c in own], F.col(order).alias("a_order"))
    b = once(survivors).select(*[F.col(c).alias(f"b_{c}") for c in own], F.col(order).alias("b_order"))
    out, count = None, 0
    for turn, (name, by) in enumerate((("same-scope", ("file", "scope")), ("same-file", ("file",)))):
        keys = [F.col(f"a_{c}") == F.col(f"b_{c}") for c in by]
        other = F.lit(True) if name == "same-scope" else F.col("a_scope") != F.col("b_scope")
        fits = other & (F.col("a_start_byte") != F.col("b_start_byte"))
        most = 2 * want
        while True:
            # sites begin at a byte once per operator, so a killer passes over few of its scope's survivors
            ranked = F.row_number().over(Window.partitionBy("b_file", "b_scope").orderBy("b_order"))
            some = b.withColumn("rank", ranked).where(F.col("rank") <= most + OPERATORS).drop("rank")
            first = a.join(some.select("b_file", "b_scope", "b_start_byte"), [*keys, fits], "left_semi").orderBy("a_order").limit(most)
            met = first.join(some, [*keys, fits]).orderBy("a_order", "b_order").limit(most)
            key = C.pair_key(F.col("a_file"), F.col("a_start_byte"), F.col("a_operator"), F.col("b_file"), F.col("b_start_byte"), F.col("b_operator"))
            met = files.materialised(met.select("a_id", "b_id", "a_order", "b_order", F.lit(name).alias("affinity"), F.lit(turn).alias("turn"), key.alias("key")), "met")
            nth = F.row_number().over(Window.partitionBy("key").orderBy("a_order", "b_order"))
            part = met.withColumn("nth", nth).where("nth = 1").drop("nth")
            part = part if out is None else part.join(out.select("key"), "key", "left_anti").select(*part.columns)
            found = part.count()
            if found + count >= want or met.count() < most:  # else keys repeat so often that pairs behind them count
                break
            most *= 2
        out, count = part if out is None else out.unionByName(part), count + found
    return out.orderBy("turn", "a_order", "b_order").limit(want)


def splitmix64(seed: int, n: int) -> int:
    """Draw n, from 0, of the generator with this seed; draws are addressed, so any task can make any of them."""
    mask = (1 << 64) - 1
    z = (seed + (n + 2) * GAMMA) & mask
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
    return z ^ (z >> 31)


_LOW32, _PIECE = (1 << 32) - 1, (1 << 16) - 1


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pieces(z: Column) -> list[Column]:
    """64 bits in four, the least first."""
    return [F.shiftrightunsigned(z, 16 * k).bitwiseAND(F.lit(_PIECE).cast("bigint")) for k in range(4)]


def _times(z: Column, by: int) -> Column:
    """Product of 64 bits, by sums of 16-bit products that no addition overflows."""

    def product(z: Column) -> Column:
        a, c = _pieces(z), [(by >> 16 * k) & _PIECE for k in range(4)]
        column = lambda k: sum((a[i] * F.lit(c[k - i]).cast("bigint") for i in range(1, k + 1)), a[0] * F.lit(c[k]).cast("bigint"))
        low = lambda s: s.bitwiseAND(F.lit(_PIECE).cast("bigint"))
        carry = lambda s: F.shiftrightunsigned(s, 16)
        return _let(F.struct(*[column(k).alias(f"s{k}") for k in range(4)]), lambda s: _let(F.struct(low(s["s0"]).alias("r"), (s["s1"] + carry(s["s0"])).alias("c"), s["s2"].alias("d"), s["s3"].alias("e")), lambda t: _let(
            F.struct(t["r"].bitwiseOR(F.shiftleft(low(t["c"]), 16)).alias("r"), (t["d"] + carry(t["c"])).alias("d"), t["e"].alias("e")), lambda u: u["r"].bitwiseOR(F.shiftleft(low(u["d"]), 32)).bitwiseOR(F.shiftleft(u["e"] + carry(u["d"]), 48)))))

    return _let(z, product)


def _plus(z: Column, n: int) -> Column:
    """Sum of 64 bits."""
    half = lambda x: x.bitwiseAND(F.lit(_LOW32).cast("bigint"))
    low = half(z) + F.lit(n & _LOW32).cast("bigint")
    return F.shiftleft(F.shiftrightunsigned(z, 32) + F.lit(n >> 32).cast("bigint") + F.shiftrightunsigned(low, 32), 32).bitwiseOR(half(low))


def splitmix_bits(seed: int, index: Column) -> Column:
    """Column of draws as 64 bits, in columns of their own kind: ``splitmix64`` for every index."""
    fold = lambda z, k: _let(z, lambda z: z.bitwiseXOR(F.shiftrightunsigned(z, k)))
    z = _let(_times(index.cast("bigint") + 2, GAMMA), lambda z: _plus(z, seed & (1 << 64) - 1))
    return fold(_times(fold(_times(fold(z, 30), 0xBF58476D1CE4E5B9), 27), 0x94D049BB133111EB), 31)


def splitmix_below(seed: int, index: Column, below: int | Column) -> Column:
    """Column of draws modulo ``below``, which must be less than 2 ** 47; 0 of nothing."""
    m = below if isinstance(below, Column) else F.lit(below)
    m = m.cast("bigint")
    rest = lambda z: reduce(lambda r, p: (r * (1 << 16) + p) % F.greatest(m, F.lit(1)), reversed(_pieces(z)), F.lit(0).cast("bigint"))
    return _let(splitmix_bits(seed, index), rest)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds each row's place in ``order``, from 0. Rows are dealt by ranges of the order and written, so that the places of a range's rows stay; the
    ranges' counts, a row per task, give the offsets. The order must tell rows apart for a rerun to agree."""
    at = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    at = files.materialised(at, "numbered").withColumn("_range", F.shiftrightunsigned("_at", 33))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = at.groupBy("_range").agg(F.count("*").alias("n")).select("_range", before.alias("_before"))
    return at.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_range", "_before")


def cross_file_draws(pairs: DataFrame, seed: int, order: list[str], one_in: int = 4) -> DataFrame:
    """One in ``one_in`` of eligible cross-file pairs, by draws in their order."""
    return numbered(pairs, order, "_n").where(splitmix_below(seed, F.col("_n"), one_in) == 0).drop("_n")
