"""Samples of pairs in full: which pairs a seed draws, without the list of all pairs.

A sample has ``want`` pairs at most. Survivor pairs take the k-th pair of every scope in turn, then random pairs of one file and of two scopes, then
random pairs across files. Killer and survivor pairs take those of a scope, then those of a file, in order, and then one in four of those across
files. Pairs across files are at most a percentage of ``want``. The draws are those of one generator that runs through the passes, and the pairs
are those of the sequential loop over them:

* draws are addressed, so any task makes any of them, and a pass looks at a stretch of draws at a time, as long as it finds too few pairs;
* pair number n across files is addressed by rank: sums over the killers' partners give the killer, and the number of survivors of its own
  file that stand before gives the partner, so killers are never joined with survivors;
* a try of the second pass takes one draw or three, so where a try starts depends on all before it. A block of draws maps each of
  three ways to enter it to a way to leave it; the maps, a row per block, are followed one after the other, and then each block knows its
  starts.

Trials have id, file, scope, start_byte, operator and verdict. ``order`` is the order of the trials, and tells them apart. What the driver holds
grows with ``want``, never with the trials. A table without pairs gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions import content as C
from lodestone.functions import verdicts as V
from lodestone.operators.sampling import numbered, ranked_across, scope_pairs, splitmix_below
from lodestone.sources.files import materialised

TRIES = 40  # times the wanted pairs: where a random pass gives up
ONE_IN = 4
BLOCK = 512  # draws
_SITE = ("id", "file", "scope", "start_byte", "operator")


def _prefixed(sites: DataFrame, side: str, *more: str) -> DataFrame:
    return sites.select(*[F.col(c).alias(f"{side}_{c}") for c in (*_SITE, *more)])


def _key() -> Column:
    return C.pair_key(*[F.col(f"{s}_{c}") for s in ("a", "b") for c in ("file", "start_byte", "operator")])


def _fresh(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
    """(n, a_id, b_id, key): the first of each key by n, without known keys."""
    first = F.row_number().over(Window.partitionBy("key").orderBy("n"))
    out = pairs.select("n", "a_id", "b_id", "key").withColumn("nth", first).where("nth = 1").drop("nth")
    return out if known is None else out.join(known.select("key"), "key", "left_anti").select("n", "a_id", "b_id", "key")


class _Taken:
    """Pairs found so far, in order; each part is written when it is found."""

    def __init__(self, ids: str):
        self.rows, self.count, self.ids = None, 0, ids

    def add(self, part: DataFrame, affinity: str | None, most: int) -> int:
        """Adds the first ``most`` of a part (n, a_id, b_id, key) and says how many came."""
        shown = part.withColumn("affinity", F.lit(affinity)) if affinity else part
        part = materialised(shown.orderBy("n").limit(most).withColumn("turn", F.lit(self.count)), "pairs")
        n = part.count()
        self.rows = part if self.rows is None else self.rows.unionByName(part)
        self.count += n
        return n

    def result(self) -> DataFrame:
        place = F.row_number().over(Window.orderBy("turn", "n"))  # at most as many rows as were wanted
        return self.rows.select(place.alias("nth"), "a_id", "b_id", "affinity", "key")


def _stretch(left: int, turn: int) -> int:
    """How many tries to look at next for so many missing pairs: twice as many every time."""
    return (8 * left + 64) << turn


def _starts(files: DataFrame, n_files: int, seed: int, begin: int, tries: int) -> tuple[DataFrame, int]:
    """(n, file_no, many) of the tries that start in a stretch of draws from ``begin``, and the first draw behind them: a try takes three draws
    where its file has more than one site, else one."""
    length = -(-3 * tries // BLOCK) * BLOCK
    draws = _draws(files, begin, length).withColumn("file_no", splitmix_below(seed, F.col("n"), n_files))
    draws = draws.join(files.select("file_no", (F.col("sites") > 1).alias("many")), "file_no")
    blocks = draws.groupBy(F.floor((F.col("n") - begin) / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("n", "many", "file_no"))).alias("xs"))
    wait = lambda entry: F.aggregate("xs", F.lit(entry), lambda w, x: F.when(w > 0, w - 1).when(x["many"], 2).otherwise(0))
    blocks = materialised(blocks.withColumns({f"w{e}": wait(e) for e in range(3)}), "draws")
    enter, entries = 0, []
    for r in blocks.select("block", "w0", "w1", "w2").orderBy("block").collect():  # a row per block of the stretch
        entries.append((r.block, enter))
        enter = r[1 + enter]
    entered = files.sparkSession.createDataFrame(entries, "block bigint, entry int")
    kind = "struct<w:int,at:array<struct<n:bigint,many:boolean,file_no:bigint>>>"
    state = F.struct(F.col("entry").alias("w"), F.array().cast("array<struct<n:bigint,many:boolean,file_no:bigint>>").alias("at")).cast(kind)
    step = lambda s, x: F.when(s["w"] > 0, F.struct((s["w"] - 1).alias("w"), s["at"].alias("at"))).otherwise(F.struct(F.when(x["many"], 2).otherwise(0).alias("w"), F.concat(s["at"], F.array(x)).alias("at"))).cast(kind)
    found = blocks.join(F.broadcast(entered), "block").select(F.explode(F.aggregate("xs", state, step)["at"]).alias("x")).select("x.*")
    return found, begin + length + enter


def _draws(like: DataFrame, begin: int, length: int) -> DataFrame:
    return like.sparkSession.range(begin, begin + length).withColumnRenamed("id", "n")


def _same_file_draws(pool: DataFrame, files: DataFrame, want: int, seed: int, taken: _Taken) -> int:
    """Random pairs of one file and two scopes until there are enough or the tries are used up; gives the next draw. ``pool`` has file_no and
    place (in its file)."""
    n_files, begin, tried, turn = files.count(), 0, 0, 0
    while taken.count < want and tried < TRIES * want:
        most = TRIES * want - tried
        starts, after = _starts(files, n_files, seed, begin, min(_stretch(want - taken.count, turn), most))
        turn += 1
        starts = materialised(starts.orderBy("n").limit(most), "starts")  # as many as the stretch has
        drawn = starts.where("many").join(files.select("file_no", "sites"), "file_no")
        drawn = drawn.withColumns({"i": splitmix_below(seed, F.col("n") + 1, F.col("sites")), "j": splitmix_below(seed, F.col("n") + 2, F.col("sites"))}).where("i <> j")
        a, b = _prefixed(pool, "a", "file_no", "place"), _prefixed(pool, "b", "file_no", "place")
        met = drawn.join(a, (F.col("file_no") == F.col("a_file_no")) & (F.col("i") == F.col("a_place"))).join(b, (F.col("file_no") == F.col("b_file_no")) & (F.col("j") == F.col("b_place")))
        met = met.where("not (a_scope <=> b_scope)").withColumn("key", _key())
        taken.add(_fresh(met, taken.rows), "same-file", want - taken.count)
        last = starts.agg(F.count("*"), F.max(F.struct("n", "many"))).first()
        tried += last[0]
        begin = last[1].n + (3 if last[1].many else 1) if last[0] == most else after
    return begin


def _cross_file_tries(pool: DataFrame, size: int, want: int, budget: int, seed: int, begin: int, taken: _Taken) -> None:
    """Random pairs across files, two draws each."""
    cross, tried, turn = 0, 0, 0
    while taken.count < want and cross < budget and tried < TRIES * want:
        left = min(want - taken.count, budget - cross)
        n = min(_stretch(left, turn), TRIES * want - tried)
        turn += 1
        tries = _draws(pool, tried, n)
        tries = tries.withColumns({"i": splitmix_below(seed, begin + 2 * F.col("n"), size), "j": splitmix_below(seed, begin + 2 * F.col("n") + 1, size)}).where("i <> j")
        met = tries.join(_prefixed(pool, "a", "rank"), F.col("i") == F.col("a_rank")).join(_prefixed(pool, "b", "rank"), F.col("j") == F.col("b_rank"))
        met = met.where("a_file <> b_file").withColumn("key", _key())
        cross += taken.add(_fresh(met, taken.rows), "cross-file", left)
        tried += n


def _by_place(sites: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Sites with rank (among all), file_no and place (in the file), and files (file, file_no, sites)."""
    pool = numbered(sites, order, "rank")
    pool = numbered(pool, ["file", "rank"], "_in_files")
    files = pool.groupBy("file").agg(F.count("*").alias("sites"), F.min("_in_files").alias("_first"))
    files = materialised(numbered(files, ["file"], "file_no"), "files")
    pool = pool.join(files.drop("sites"), "file").withColumn("place", F.col("_in_files") - F.col("_first")).drop("_in_files", "_first")
    return materialised(pool, "pool"), files.drop("_first")


def survivor_pairs(trials: DataFrame, want: int, seed: int, cross_file_pct: int, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """(nth, a_id, b_id, affinity, key): pairs of survivors."""
    pool, files = _by_place(trials.where("verdict = 'SURVIVED'").select(*dict.fromkeys((*_SITE, *order))), list(order))
    size, ids = pool.count(), dict(trials.dtypes)["id"]
    taken = _Taken(ids)
    if size < 2:
        return trials.sparkSession.createDataFrame([], f"nth int, a_id {ids}, b_id {ids}, affinity string, key string")
    most, largest = max(want, 1), pool.groupBy("file", "scope").count().agg(F.max("count")).first()[0]
    while True:
        first = F.row_number().over(Window.partitionBy("key").orderBy("k", "file", "scope"))
        found = materialised(scope_pairs(pool, most, ("rank",)).withColumn("nth", first).where("nth = 1").orderBy("k", "file", "scope").limit(want), "pairs")
        if most >= largest * (largest - 1) // 2 or found.count() == want:
            break
        most *= 2
    turn = F.row_number().over(Window.orderBy("k", "file", "scope"))  # at most ``want`` rows
    taken.add(found.withColumn("n", turn.cast("bigint")).select("n", "a_id", "b_id", "key"), "same-scope", want)
    begin = _same_file_draws(pool, files, want, seed, taken)
    _cross_file_tries(pool, size, want, want * cross_file_pct // 100, seed, begin, taken)
    return taken.result()


def _partners(draws: DataFrame, killers: DataFrame, survivors: DataFrame) -> DataFrame:
    """Pairs of the draws (n) across files: killers have base (the number of their first pair) and file, survivors rank, place and file."""
    # the killer whose stretch of numbers holds n: the last one that begins at n or before
    marks = killers.select(F.col("base").alias("at"), F.lit(0).alias("kind"), F.struct("base", *_SITE).alias("killer"))
    marks = marks.unionByName(draws.select(F.col("n").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(marks.schema["killer"].dataType).alias("killer")))
    w = Window.orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)  # as many rows as draws are looked at
    pairs = marks.withColumn("killer", F.last("killer", ignorenulls=True).over(w)).where("kind = 1")
    pairs = materialised(pairs.select(F.col("at").alias("n"), *[F.col(f"killer.{c}").alias(f"a_{c}") for c in _SITE], (F.col("at") - F.col("killer.base")).alias("j")), "drawn")
    # survivor j of those outside a file has rank j and as many more as the file has at or before that place
    far = pairs.agg(F.max("j")).first()[0]
    if far is None:
        far = -1
    wanted = pairs.select(F.col("a_file").alias("file"), F.col("j").alias("at")).distinct()
    own = survivors.select("file", (F.col("rank") - F.col("place")).alias("at")).where(F.col("at") <= far).join(wanted.select("file").distinct(), "file", "left_semi")
    own = own.groupBy("file", "at").agg(F.count("*").alias("c"))
    both = own.withColumn("kind", F.lit(0)).unionByName(wanted.select("file", "at", F.lit(0).cast("bigint").alias("c"), F.lit(1).alias("kind")))
    w = Window.partitionBy("file").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("rank", F.col("at") + F.sum("c").over(w)).where("kind = 1").select(F.col("file").alias("a_file"), F.col("at").alias("j"), "rank")
    return pairs.join(found, ["a_file", "j"]).join(_prefixed(survivors, "b", "rank"), F.col("rank") == F.col("b_rank")).withColumn("key", _key())


def _cross_file_ranks(killers: DataFrame, survivors: DataFrame, want: int, budget: int, seed: int, order: tuple[str, ...], taken: _Taken) -> None:
    """One in ``ONE_IN`` of the pairs across files, in order of the killers and then of the survivors."""
    survivors, files = _by_place(survivors, list(order))
    size = survivors.count()
    own = killers.join(files.select("file", "sites"), "file", "left").withColumn("others", size - F.coalesce("sites", F.lit(0))).where("others > 0")
    sums = own.agg(F.sum("others"), F.min("others")).first()
    total, fewest = sums[0] or 0, sums[1] or 1
    begin, cross, turn = 0, 0, 0
    while begin < total and taken.count < want and cross < budget:
        left = min(want - taken.count, budget - cross)
        end = min(total, begin + ONE_IN * _stretch(left, turn))
        turn += 1
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        first = own.orderBy(*order).limit(-(-end // fewest))  # no more killers than numbers looked at
        first = materialised(first.withColumn("base", F.coalesce(F.sum("others").over(w), F.lit(0))).where(F.col("base") < end), "killers")
        draws = _draws(own, begin, end - begin).where(splitmix_below(seed, F.col("n"), ONE_IN) == 0)
        cross += taken.add(_fresh(_partners(draws, first, survivors), taken.rows), "cross-file", left)
        begin = end


def killer_survivor_pairs(trials: DataFrame, want: int, seed: int, cross_file_pct: int, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """(nth, a_id, b_id, affinity, key): pairs of a killer and a survivor."""
    columns = [*dict.fromkeys((*_SITE, *order))]
    killers, survivors = trials.where(V.killed(F.col("verdict"))).select(*columns), trials.where("verdict = 'SURVIVED'").select(*columns)
    ranked = order[0] if len(order) == 1 else None
    if ranked is None:
        killers, survivors = (numbered(x, list(order), "_order") for x in (killers, survivors))
        order, ranked = ("_order",), "_order"
    taken = _Taken(dict(trials.dtypes)["id"])
    near = ranked_across(killers, survivors, want, ranked)
    turn = F.row_number().over(Window.orderBy("turn", "a_order", "b_order"))  # at most ``want`` rows
    taken.add(near.withColumn("n", turn.cast("bigint")).select("n", "a_id", "b_id", "key", "affinity"), None, want)
    _cross_file_ranks(killers, survivors, want, want * cross_file_pct // 100, seed, order, taken)
    return taken.result()


def sample(trials: DataFrame, want: int, seed: int, cross_file_pct: int = 10, mode: str = "killer-survivor", order: tuple[str, ...] = ("id",)) -> DataFrame:
    """Pairs by mode: ``survivors`` or ``killer-survivor``."""
    return {"survivors": survivor_pairs, "killer-survivor": killer_survivor_pairs}[mode](trials, want, seed, cross_file_pct, order)
