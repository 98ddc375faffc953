"""Line dedup of a whole table against brute force; empty tables in every stage; columns whose names clash."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import line_dedup, mixing, quality_classifier, queries, warc

SF = "/root/testdata/sf0.001"


def test_line_dedup_of_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = collections.defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        for k, line in enumerate(r.text.split("\n")):
            if line.strip(" \t\n\x0b\f\r"):
                at[line].append((r.doc_id, k))
    lines = sorted(at, key=len)
    sets = []
    for x in lines:
        low = x.lower()
        sets.append({low[i : i + 5] for i in range(len(low) - 4)} if len(low) >= 5 else {low})
    holders, root = collections.defaultdict(list), list(range(len(lines)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for j, s in enumerate(sets):
        shared = collections.Counter(i for x in s for i in holders[x])
        for i, both in shared.items():
            if 5 * both >= 4 * (len(s) + len(sets[i]) - both):
                root[find(i)] = find(j)
        for x in s:
            holders[x].append(j)
    groups = collections.defaultdict(list)
    for i, x in enumerate(lines):
        groups[find(i)] += at[x]
    removed = {(r.doc_id, k) for r in line_dedup.removed_lines(docs, line_dedup.ALL).collect() for k in r.removed}
    wrong = 0
    for places in groups.values():
        kept = [p for p in places if p not in removed]
        wrong += not (len(kept) == 1 and kept[0][0] == min(places)[0])
    assert removed and wrong == 0, (wrong, len(groups))


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stages_of_an_empty_table(spark, place):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    name, stage = corpus_pipeline.STAGES[place]
    out = stage(spark, docs, SF)
    assert out.count() == 0
    if place < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns, name


def _clashing(df, *names):
    return df.select("*", *[F.lit("clash").alias(n) for n in names])


def test_clashing_columns(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    plain = lambda df: collections.Counter(tuple(r) for r in df.collect())
    assert plain(warc.round_trip(_clashing(pages, "key", "digest", "n", "refers_to", "payload_digest"))) == plain(queries.op5_warc(spark, SF))
    noisy = _clashing(documents, "size", "target", "blocks", "rank", "rid", "nth", "score", "held_out", "quality", "label", "features")
    assert plain(mixing.taken(noisy).select("doc_id", "size")) == plain(mixing.taken(documents).select("doc_id", "size"))
    mine, other = (quality_classifier.score_documents(d, labels).select("doc_id", "held_out", F.round("score", 9), "predicted") for d in (noisy, documents))
    assert plain(mine) == plain(other)


def test_line_dedup_bitmaps_bound_pairs(spark):
    """Of lines that share a passage, the texts of pairs that fall well short aren't met; no alike pair is lost."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9)))
    passage = [word() for _ in range(22)]
    rows = [" ".join(passage + [word() for _ in range(rng.choice((0, 1, 2, 4, 12, 18)))]) for _ in range(60)] + ["ab", "ab\U0001f600cdé", "abababababababab" * 9, "abababababababab" * 20]
    texts = spark.createDataFrame(list(enumerate(rows)), "id long, low string")
    bits = line_dedup._bitmaps(texts)
    both = bits.toDF("a", "bits").crossJoin(bits.toDF("b", "bits2")).where("a < b")
    near = {(r.a, r.b) for r in both.where(line_dedup._near("bits", "bits2")).select("a", "b").collect()}
    sets = [{x[i : i + 5] for i in range(max(len(x) - 4, 1))} for x in rows]
    pairs = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in range(len(rows)) for a in range(b)}
    alike, short = {p for p, j in pairs.items() if j >= 0.8}, {p for p, j in pairs.items() if j < 0.65}
    assert len(alike) > 100 and alike <= near
    assert len(short) > 100 and len(short & near) <= len(short) / 20
    links = line_dedup._verified(spark.createDataFrame(sorted(near), "a long, b long"), texts)
    assert {(r.a, r.b) for r in links.collect()} == alike


def test_lines_that_share_a_passage_seldom_share_a_bucket(spark):
    """Lines well below the similarity sought meet seldom: pairs in a bucket don't grow with the square of the table."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9)))
    passage = [word() for _ in range(12)]
    rows = [" ".join(passage + [word() for _ in range(9)]) for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    buckets = {r.doc: set(r.buckets) for r in line_dedup._signatures(docs).collect()}
    met = sum(bool(buckets[a] & buckets[b]) for b in range(len(rows)) for a in range(b))
    assert len(buckets) == 100 and met <= 0.1 * 4950, met
