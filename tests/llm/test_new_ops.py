"""Hard negatives, lexical search and sharding against brute force, with nulls, ties, repeated rows, extra columns and empty tables; and
rows that linking and archives must not lose."""

import collections
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lodestone.llm import hard_negatives, lexical_search, ngram_join, queries, sharding, warc
from tests.compare import differences, duck

VECTORS = "vec_id bigint, embedding array<float>, label int, score string, q string"
DOCS = "doc_id bigint, text string, lang string, source string, n bigint, rank string, shard string, curve string"
ITEMS = "item_id bigint, text string, score string"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_whole_tables_against_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, "/root/testdata/sf0.01"), duck("/root/testdata/sf0.01"), queries.ORACLES[name]) == ""


def mined(rows):
    """The contract, one anchor at a time; rows equal in all count once."""
    live = {}
    for i, x, label in rows:
        if label is not None and x is not None and all(y is not None and math.isfinite(y) for y in x):
            live[i, tuple(math.floor(256 * y) for y in x), (label + 1) % 10 if i is not None and i % 7 == 0 else label] = None
    inner = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = collections.Counter()
    for a, v, label in live:
        if a is None or a % 100:
            continue
        place = lambda s, i: (-s, i is None, i or 0)
        scored = [(inner(v, w), i, m) for i, w, m in live]
        own = sorted(((s, i) for s, i, m in scored if m == label and i != a), key=lambda t: place(*t))[:5]
        for s, p in own:
            found = sorted(((t, i) for t, i, m in scored if m != label and 30 * s <= 100 * t <= 90 * s), key=lambda t: place(*t))[:10]
            out.update((a, p, k + 1, i, s, t) for k, (t, i) in enumerate(found))
    return out


@pytest.mark.parametrize("digit,block", [(1024, 2048), (3, 2)])
def test_hard_negatives(spark, monkeypatch, digit, block):
    monkeypatch.setattr(hard_negatives, "DIGIT", digit)
    r = random.Random(1)
    vector = lambda: [r.gauss(0, 0.4) for _ in range(8)]
    common = [0.5] * 8
    rows = [(i * 5, vector(), r.randrange(3)) for i in range(150)]
    rows += [(2000 + i, common, r.randrange(3)) for i in range(80)]  # ties
    rows += [(3000, None, 1), (3001, [1.0, None], 1), (3002, [float("nan")] * 8, 1), (3003, [float("inf")] * 8, 1), (3004, vector(), None), (None, vector(), 1), (None, common, 2), (3100, [], 1), (3200, [0.25, 0.5], 2), (3300, common, 0), (3300, vector(), 1)]
    rows += [rows[0], rows[0], rows[20]]
    as_floats = [(i, None if x is None else [None if y is None else float(__import__("struct").unpack("f", __import__("struct").pack("f", y))[0]) for y in x], m) for i, x, m in rows]
    df = spark.createDataFrame([(i, x, m, "s", "q") for i, x, m in rows], VECTORS).repartition(4)
    got = collections.Counter(tuple(x) for x in hard_negatives.mine(df, block=block).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == mined(as_floats) and len(got) > 100


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS)).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(1, [0.5], 1, "", ""), (100, [0.5], 2, "", "")], VECTORS)).count() == 0


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, top=20):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = [(i, collections.Counter(TERM.findall((t or "").translate(fold)))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, n_terms, df = len(found), sum(n for _, _, n in found), collections.Counter(t for _, c, _ in found for t in c)
    out = collections.Counter()
    for item, text in items:
        scored = []
        for i, c, n in found:
            m = 75 + (25 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in TERM.findall((text or "").translate(fold)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        out.update((item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top]))
    return out


@pytest.mark.parametrize("shard_docs,block", [(8192, 1024), (7, 3)])
def test_lexical_search(spark, monkeypatch, shard_docs, block):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", block)
    r = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "naïve x", "A1", "ß"]
    text = lambda n: " ".join(r.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=n))
    docs = [(i, text(r.randint(1, 60)).upper() if i % 9 == 0 else text(r.randint(1, 60)) + "." + text(3)) for i in range(120)]
    docs += [(200 + i, docs[3][1]) for i in range(40)]  # ties
    docs += [(300, None), (301, ""), (302, " .,;\x00\x7f"), (303, "w1 " * 20000), (None, docs[3][1]), (None, text(9)), docs[5], docs[5]]
    items = [(i, text(r.randint(1, 12))) for i in range(9)] + [(20, None), (21, "..."), (22, "unknown words"), (23, docs[3][1]), (None, "w1 w2 w2"), (0, "w5"), (0, "w5")]
    table = spark.createDataFrame([(i, t, "en", "s", 1, "r", "s", "c") for i, t in docs], DOCS).repartition(3)
    got = collections.Counter(tuple(x) for x in lexical_search.search(table, spark.createDataFrame([(*x, "s") for x in items], ITEMS)).select("item_id", "rank", "doc_id", "score").collect())
    assert got == ranked(docs, items)
    none = table.limit(0)
    assert lexical_search.search(none, spark.createDataFrame([(1, "w1", "")], ITEMS)).count() == 0 == lexical_search.search(table, spark.createDataFrame([], ITEMS)).count()


def test_bisection_parts_unlike_documents():
    import numpy as np

    sets = [np.arange(20) + (100 if i % 2 else 0) for i in range(16)]
    tree = lexical_search.bisection_tree(sets, 1)
    leaves = [lexical_search._leaf(tree, s) for s in sets]
    assert set(leaves) == {0, 1} and leaves == [leaves[0], leaves[1]] * 8


def test_hilbert_curve_visits_neighbours(spark):
    cells = spark.range(512).select((F.col("id") % 8).alias("a"), (F.floor(F.col("id") / 8) % 8).alias("b"), F.floor(F.col("id") / 64).alias("c"))
    got = sorted(tuple(r) for r in cells.select(sharding.hilbert_index([F.col("a"), F.col("b"), F.col("c")], 3).alias("h"), "a", "b", "c").collect())
    assert [h for h, *_ in got] == list(range(512))
    assert all(sum(abs(p - q) for p, q in zip(x[1:], y[1:], strict=True)) == 1 for x, y in zip(got, got[1:], strict=False))


def _corpus(spark):
    r = random.Random(4)
    rows = [(i, "x" * r.randint(0, 3000), r.choice(["en", "de", None]), f"host{r.randint(0, 30):03}" if i % 3 else "hot") for i in range(900)]
    rows += [(1000, None, "en", None), (1001, "", None, None), (None, "é" * 50, "fr", "hot"), (1002, "y" * 200000, "en", "hot")] + [(5000, "same", "en", "hot")] * 300
    return rows, spark.createDataFrame([(*x, 1, "r", "s", "c") for x in rows], DOCS).repartition(5)


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_sharding(spark, monkeypatch, law):
    monkeypatch.setattr(sharding, "BIN_ROWS", 10)
    rows, docs = _corpus(spark)
    got = sharding.place(docs, law=law).collect()
    own = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == own and {r.law for r in got} == {law}
    slots, sizes = collections.defaultdict(list), collections.Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    if law == "rows":
        assert len(slots) == 24 and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    else:
        share, most = sum(sizes.values()) / 24, max(r.size for r in got)
        assert all(abs(sizes[s] - share) <= most for s in range(24))
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert all(a.curve <= b.curve for a, b in zip(order, order[1:], strict=False))
    again = sharding.place(docs.repartition(2), law=law).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.shard, r.slot)
    assert sorted(map(key, got), key=str) == sorted(map(key, again), key=str)


def test_small_and_empty_shards(spark):
    rows, docs = _corpus(spark)
    for law in ("rows", "bytes"):
        assert sharding.place(docs.limit(0), law=law).count() == 0
        assert sharding.place(docs.limit(5), law=law).select("shard").distinct().count() <= 5
    with pytest.raises(ValueError):
        sharding.place(docs, law="keys")


def test_shards_of_a_source_are_few(spark, tmp_path):
    rows, docs = _corpus(spark)
    manifest = sharding.write_shards(docs, f"file://{tmp_path}/out", 24)
    back = spark.read.parquet(f"file://{tmp_path}/out")
    assert collections.Counter((r.doc_id, r.text, r.rank, r.curve) for r in back.collect()) == collections.Counter((i, t, "r", "c") for i, t, _, _ in rows)
    assert sum(r["rows"] for r in manifest.collect()) == len(rows)
    for lo, hi in (("host000", "host002"), ("hot", "hot")):
        named = {r.shard for r in sharding.shards_for(manifest, source=(lo, hi)).collect()}
        held = {r.shard for r in back.where(F.col("source").between(lo, hi)).select("shard").distinct().collect()}
        assert held <= named
    few = sharding.shards_for(manifest, source=("host000", "host002"), size=(8, 600)).count()
    assert few <= 8, few


def test_linking_through_a_row_without_doc_id(spark):
    words = [f"w{i}" for i in range(130)]
    near = lambda *edits: " ".join(f"e{i}" if i in edits else w for i, w in enumerate(words))
    rows = [(5, near()), (None, near(20, 21)), (9, near(20, 21, 40, 41)), (None, "alone a b c d"), (None, "alone a b c d"), (11, None), (None, None), (7, "x y z")]
    got = ngram_join.link(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 9, 10).collect()
    sets = {t: {tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for _, t in rows if t}
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    assert alike(rows[0][1], rows[1][1]) and alike(rows[1][1], rows[2][1]) and not alike(rows[0][1], rows[2][1])
    assert collections.Counter((r.doc_id, r.component_id) for r in got) == collections.Counter([(5, 5), (None, 5), (9, 5), (None, None), (None, None), (11, 11), (None, None), (7, 7)])


def test_archives_keep_pages_of_long_urls(spark):
    rows = [(1, "http://x/" + "a" * 1_200_000, "<p>one</p>" * 30), (2, "http://y/\x01é\n b", "two"), (3, "http://z/" + "b" * 70_000, "<p>one</p>" * 30)]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert set(got) == {1, 2, 3} and got[1].record_type == "response" and got[3].refers_to == 1


def test_damaged_headers_end_at_the_next_record():
    import io

    parts = [warc.make_record(i, "http://x/" + "u" * 9000, b"payload %d" % i, None) for i in range(4)]
    broken = parts[1].replace(b"\r\n\r\n", b"\r\n", 1)[:6000]
    out = list(warc.salvage(io.BytesIO(parts[0] + broken + parts[2] + parts[3])))
    assert [r["page_id"] for r in out if r["kind"] == "record"] == [0, 2, 3] and [r["kind"] for r in out].count("gap") == 1
