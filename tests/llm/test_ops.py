"""Each numbered operator and the pipeline against brute force on small tables with nulls, empties, ties, repeated rows,
extra and clashing columns, and empty tables."""

import collections
import hashlib
import io
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, line_dedup, mixing, ngram_join, quality_classifier, quality_rules, queries, secret_scan, suffix_dedup, token_counts, warc
from lodestone.llm.common import components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, rank string, size string, copy string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "r", "z", "c") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base, passage = text(120), text(60)
    out = [(i, text(r.randint(12, 150)) + "\n" + text(20), f"s{i % 3}") for i in range(60)]
    out += [(100 + i, base, "s0") for i in range(5)]  # copies
    for i in range(12):  # near copies
        w = base.split()
        w[r.randrange(len(w))] = f"edit{i}"
        out.append((200 + i, " ".join(w), "s0"))
    out += [(300 + i, text(30) + " " + passage + "\n" + text(10), None) for i in range(8)]
    out += [(400, None, "s1"), (401, "", "s1"), (402, "two words", "s1"), (403, "two words", "s1"), (404, " \n\t ", None), (405, "é" * 90, "s2"), (None, text(50), "s2")]
    out += [(406, "ab " * 3000, "s2"), (407, "x" * 5000, "s2"), (408, text(20000), "s2")]
    out += [out[0], out[0]]  # repeated rows
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return make(spark, rows).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return make(spark, [])


def counted(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_components(spark):
    pairs = [(1, 2), (2, 3), (3, 3), (7, 6), (6, 5), (5, 9), (2, 1), (None, 4)]
    assert dict(tuple(r) for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()) == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5, 9: 5}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def _spans(t):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for k, kind, pat, least in ((1, "access", "AKIA[A-Z0-9]+", 20), (2, "hex", "[0-9a-f]+", 24)):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pat, t) if len(m[0]) >= least]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def test_secret_scan(spark, docs, empty):
    texts = [
        "é password = 'abcdef' token:abc", "API_KEY=12345678 apikey: zz_zzzz\U0001F600secret=token:abcdefgh", "AKIA" + "A" * 16 + " AKIA123", "f" * 24 + "g" + "0a" * 30, "PassWD \"x", None, "",
        "a" * 24 + " token = \"" + "b1" * 12 + "\" SECRET=AKIA" + "B" * 20, "ghp_" + "a1B2" * 9, "postgres://user:secretpw@host", "x" * 100000 + " secret:abcdef1",
    ]
    got = secret_scan.digest(make(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    assert len(got) == len(texts)
    for r in got:
        want = _spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), texts[r.doc_id]
        assert r.n_assign == want.count("assign") and r.n_hex == want.count("hex") and set(filter(None, want.split(","))) <= set(r.spans.split(","))
    assert any("github" in r.spans for r in got) and any("url_login" in r.spans for r in got)
    assert secret_scan.digest(docs).count() == docs.count() and secret_scan.digest(empty).count() == 0


def test_trigram_queries():
    assert secret_scan.trigram_query("[0-9a-f]{24,}") == []
    assert secret_scan.trigram_query("AKIA[A-Z]+") == [{frozenset({"aki", "kia"})}]
    assert secret_scan.trigram_query("(?:abcd|xyz)[0-9]+") == [{frozenset({"abc", "bcd"}), frozenset({"xyz"})}]


def test_token_counts(spark, rows, docs, empty):
    got = token_counts.count_tokens(docs)
    assert counted(got.select("doc_id")) == collections.Counter((i,) for i, _, _ in rows)
    by = {r.doc_id: r.n_tokens for r in got.collect()}
    assert by[400] == by[401] == 0 and by[408] > 10000
    assert token_counts.count_tokens(empty).count() == 0


def test_token_counts_are_the_tokenizers(spark, rows, docs):
    """Brute force: each text by the public vocabulary itself."""
    import base64

    import tiktoken

    with open(f"{token_counts.TOKENIZERS}/{token_counts.VOCABULARY}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = collections.Counter((i, len(own.encode_ordinary(t or ""))) for i, t, _ in rows)
    assert counted(token_counts.count_tokens(docs).select("doc_id", "n_tokens")) == want


def test_blocks_stitch(spark, tmp_path):
    import numpy as np

    lengths = [0, 5, 0, 1000, 3, 0, 2500, 7]
    ids = np.concatenate([np.append(np.arange(n) % 9, 99) for n in lengths]).astype("<u2")
    (tmp_path / "000003.bin").write_bytes(ids.tobytes() + np.arange(4).astype("<u2").tobytes())
    got = token_counts.stitch(token_counts.scan_blocks(spark, f"file://{tmp_path}", end=99, block=64)).collect()
    assert sorted((r.ordinal, r.n_tokens) for r in got) == list(enumerate([*lengths, 4])) and {r.shard for r in got} == {3}


def test_line_dedup(spark, docs, empty):
    a = "the quick brown fox jumps over the lazy dog again and again today"
    b = a.replace("lazy", "hazy")
    own = make(spark, [(1, f"{a}\nshort\n{a}", "s"), (2, f"{b}\nshort\nanother line that is quite unlike the first one", "s"), (3, a, "s"), (4, None, "s"), (5, "", "s"), (3, a, "s")])
    got = {r.doc_id: r for r in line_dedup.removed_lines(own).collect()}
    assert [list(got[i].removed) for i in (1, 2, 3, 4, 5)] == [[2], [0], [0], [], []] and [got[i].n_lines for i in (1, 4, 5)] == [3, 0, 1]
    out = line_dedup.dedup_lines(own)
    assert out.columns == own.columns and {r.doc_id: r.text for r in out.collect()} == {1: f"{a}\nshort", 2: "short\nanother line that is quite unlike the first one", 3: "", 4: None, 5: ""}
    assert line_dedup.removed_lines(docs).count() == docs.count() and line_dedup.removed_lines(empty).count() == 0


def _line_sets(line):
    low = line.lower()
    return {low[i : i + 5] for i in range(len(low) - 4)} or {low}


def _gone_lines(docs, least):
    """Brute force: places of removed lines by doc_id, for distinct ids that aren't null."""
    first = {}
    for i, t in sorted(docs):
        for p, x in enumerate(t.split("\n")):
            if len(x) >= least and x.strip(" \t\n\v\f\r"):
                first.setdefault(x, []).append((i, p))
    lines, root = list(first), {x: x for x in first}
    sets = {x: _line_sets(x) for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, x in enumerate(lines):
        for y in lines[:n]:
            both = len(sets[x] & sets[y])
            if 5 * both >= 4 * (len(sets[x]) + len(sets[y]) - both):
                root[find(x)] = find(y)
    parts = collections.defaultdict(list)
    for x in lines:
        parts[find(x)] += first[x]
    gone = collections.Counter(i for at in parts.values() for i, _ in at)
    gone.subtract(collections.Counter(min(at)[0] for at in parts.values()))
    return {i: n for i, n in gone.items() if n}


def test_line_dedup_finishes_large_buckets(spark):
    """Lines of one template share buckets, each with one near copy: few pivots of a bucket find few of the pairs."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(4, 7)))
    frame = [word() for _ in range(10)]
    docs = []
    for i in range(300):
        x = " ".join(frame + [word()] + frame[:1] + [word()])
        docs += [(2 * i, x), (2 * i + 1, x + "x")]
    got = {d.doc_id: d.n_removed for d in line_dedup.removed_lines(make(spark, [(i, t, "s") for i, t in docs])).collect() if d.n_removed}
    assert got == _gone_lines(docs, 30) and len(got) >= 300


@pytest.mark.parametrize("n_words,low,high,edits", [(4, 10, 14, 1), (8, 12, 15, 2), (12, 3, 8, 1)])
def test_line_signatures_recall(spark, n_words, low, high, edits):
    """Near copies alone, of few and long words and of prose: nearly all pairs of 0.8 or more share a bucket."""
    r, pairs = random.Random(n_words), []
    while len(pairs) < 400:
        x = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(low, high))) for _ in range(n_words))
        y = list(x)
        for _ in range(edits):
            y[r.choice([k for k, c in enumerate(x) if c != " "])] = r.choice("0123456789")
        a, b = _line_sets(x), _line_sets("".join(y))
        if x != "".join(y) and 5 * len(a & b) >= 4 * len(a | b):
            pairs.append((x, "".join(y)))
    docs = make(spark, [(2 * i + k, t, "s") for i, p in enumerate(pairs) for k, t in enumerate(p)])
    got = {d.doc: set(d.buckets) for d in line_dedup._signatures(docs).collect()}
    assert sum(bool(got[2 * i] & got[2 * i + 1]) for i in range(len(pairs))) >= 0.97 * len(pairs)


def test_line_dedup_query_takes_short_lines(spark, tmp_path):
    long = "the quick brown fox jumps over the lazy dog again and again today"
    docs = [(1, f"Menu\n}}\n\n{long}\n \t"), (2, "menu\n}\n\nshort line\n \t"), (3, f"short line\n}}\nshort lime\n{long}!"), (4, "ab\nabc\nab")]
    make(spark, [(i, t, "s") for i, t in docs]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: list(r.removed) for r in queries.op3_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: [], 2: [0, 1], 3: [0, 1, 3], 4: [2]}
    assert {i: len(x) for i, x in got.items() if x} == _gone_lines(docs, 1)


def test_rows_that_share_an_id_keep_their_own_text(spark):
    """Rows of one doc_id, or of none, lose nothing that stands once; columns named as an operator's own are carried."""
    a, b = "the quick brown fox jumps over the lazy dog once more today", "sphinx of black quartz judge my vow and go home at last"
    rows = [(1, a), (1, b), (None, a), (None, b + " other words"), (None, "x" * 40)]
    own = spark.createDataFrame([(i, t, "g", "d", "k") for i, t in rows], "doc_id bigint, text string, _gone string, _doc string, gone string")
    got = {(r.doc_id, r.text) for r in line_dedup.dedup_lines(own).collect()}
    assert got == {(1, a), (1, b), (None, ""), (None, b + " other words"), (None, "x" * 40)} or got == {(1, a), (1, b), (None, ""), (None, "x" * 40)}
    assert line_dedup.dedup_lines(own).columns == own.columns == ngram_join.drop_linked(own).columns
    r = random.Random(4)
    long = ["".join(r.choice("abcdefgh ") for _ in range(150)) for _ in range(3)]
    texts = [(1, long[0]), (1, long[1]), (None, long[2]), (None, long[2][:120] + "tail"), (2, long[0] + long[1])]
    cut = {(x.doc_id, x.n_bytes): x.n_removed for x in suffix_dedup.digest(make(spark, [(i, t, "s") for i, t in texts])).collect()}
    first = [cut[None, 150], cut[None, 124]]
    assert cut[1, 150] == 0 and cut[2, 300] == 300 and sorted(first) == [0, 120]


def _linked(rows, k, num, den):
    sets = collections.defaultdict(set)
    for i, t, _ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] |= set(zip(*[w[j:] for j in range(k)], strict=False)) if len(w) >= k else {tuple(w)} if w else set()
    ids = [i for i in sets if i is not None]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in ids:
        for y in ids:
            if x < y and sets[x] and den * len(sets[x] & sets[y]) >= num * len(sets[x] | sets[y]):
                p, q = sorted((find(x), find(y)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k,num,den,block", [(3, 9, 10, 2048), (5, 4, 5, 4)])
def test_ngram_join(spark, rows, docs, empty, monkeypatch, k, num, den, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    got = ngram_join.link(docs, k, num, den).collect()
    want = _linked(rows, k, num, den)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert ngram_join.link(empty, k, num, den).count() == 0
    left = ngram_join.drop_linked(docs, k, num, den)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i, (_, c) in want.items() if i == c} | {None}


def test_warc_round_trip(spark):
    html = ["é" * 60, "short", "short", None, "", "é" * 60, "x" * 99, "x" * 100, "x" * 100, os.urandom(40000).hex()]
    pages = spark.createDataFrame([(i, f"http://h/{i}\r\n" if i % 2 else None, h, "extra") for i, h in enumerate(html)] + [(None, "u", "null id", "e")], "page_id bigint, url string, html string, type string")
    got = {r.page_id: r for r in warc.round_trip(pages.repartition(3)).collect()}
    assert len(got) == 11 and got[None].payload_bytes == 7
    for i, h in enumerate(html):
        data = (h or "").encode()
        to = {5: 0, 8: 7}.get(i)
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].refers_to, got[i].record_type) == (len(data), hashlib.sha256(data).hexdigest(), to, "response" if to is None else "revisit")
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_warc_salvage(packed):
    parts = [warc.make_record(i, "http://x", os.urandom(3000) if i % 2 else b"abc" * 1000, None) for i in range(40)]
    parts = [zlib.compress(p, 6, 31) if packed else p for p in parts]
    at = [0]
    for p in parts:
        at.append(at[-1] + len(p))
    data = bytearray(b"".join(parts))
    data[at[10] + len(parts[10]) // 2] ^= 0xFF
    data[at[20]] ^= 0xFF
    data = bytes(data[: at[30]]) + os.urandom(3_000_000) + bytes(data[at[30] : -7])
    out = list(warc.salvage(io.BytesIO(data)))
    assert {x["page_id"] for x in out if x["kind"] == "record"} == set(range(40)) - {10, 20, 39}
    gaps = [(x["start"], x["end"]) for x in out if x["kind"] == "gap"]
    assert gaps[:2] == [(at[10], at[11]), (at[20], at[21])] and gaps[2] == (at[30], at[30] + 3_000_000) and gaps[-1][1] == len(data)


@pytest.mark.parametrize("damage", ["none", "inside", "cut"])
def test_warc_salvage_within_a_member(damage):
    """An archive packed as one member gives the records before and, where it inflates, after the damage."""
    parts = [warc.make_record(i, "http://x", os.urandom(2000).hex().encode(), None) for i in range(30)]
    if damage == "inside":
        parts[7] = parts[7][:-100] + b"?" + parts[7][-99:]
    data = zlib.compress(b"".join(parts), 1, 31)
    data = data[: len(data) * 2 // 3] if damage == "cut" else data
    out = list(warc.salvage(io.BytesIO(data)))
    ids = [x["page_id"] for x in out if x["kind"] == "record"]
    gaps = [x for x in out if x["kind"] == "gap"]
    if damage == "none":
        assert ids == list(range(30)) and not gaps
    elif damage == "inside":
        assert ids == [i for i in range(30) if i != 7] and "inflated bytes" in gaps[0]["reason"]
    else:
        assert ids == list(range(len(ids))) and 15 <= len(ids) < 30 and gaps[-1]["end"] == len(data)


def test_warc_page_on_two_payloads(spark):
    a, b = "a" * 200, "b" * 200
    rows = [(5, a), (7, a), (7, b), (None, a), (None, "c" * 200), (None, "c" * 200)]
    got = collections.Counter((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id bigint, url string, html string")).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    c = "c" * 200
    assert got == collections.Counter([(5, sha(a), "response", None), (7, sha(a), "revisit", 5), (7, sha(b), "response", None), (None, sha(a), "revisit", 5), (None, sha(c), "response", None), (None, sha(c), "response", None)])


def test_quality_classifier_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.score_documents(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got.held_out]
    assert held.held_out.equals(held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)) and len(held) > 50
    assert (held.predicted == held.quality).mean() > 0.95 and got.score.between(0, 1).all()


def test_quality_classifier_edges(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (1, None, 0)], "doc_id bigint, quality int, toxic int")
    got = quality_classifier.score_documents(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality_classifier.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.score_documents(empty, labels).count() == 0


def _stats(t):
    t = t or ""
    ws = WORD.findall(t)
    c = collections.Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    covered = {j for i in range(len(ws) - 4) if c[tuple(ws[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return len(ws), sum(map(len, ws)), sum(x in "#*$%&|<>" for x in t), dup, len(covered)


def test_quality_rules(spark, rows, docs, empty):
    more = rows + [(500, "a#b | <c>\nsame line\nsame line\n" + "one two three four five six " * 3, "s0"), (501, "   \x1c word " * 6, None)]
    got = quality_rules.score_documents(make(spark, more)).collect()
    want = {i: _stats(t) for i, t, _ in more}
    assert len(got) == len(more)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)
    kept = quality_rules.apply_rules(docs)
    assert kept.columns == docs.columns and 60 <= kept.count() < docs.count()
    assert quality_rules.score_documents(empty).count() == 0


def _distances(x):
    """The fit of all rows with numpy: squared distances of the features x."""
    import numpy as np

    x, floor = np.asarray(x, float), np.diag(np.square(quality_rules.FLOOR))
    q = np.sort(x, 0)[[int(np.ceil(p * len(x))) - 1 for p in (0.25, 0.5, 0.75)]]
    m, c = q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2) + floor
    far = lambda: np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m)
    for _ in range(quality_rules.STEPS):
        b = np.floor(np.log(far() + 1e-6) * 50)
        near = x[b <= max(v for v in b if (b < v).sum() < quality_rules.SUBSET * len(b))]
        m, c = near.mean(0), np.cov(near.T, bias=True) * quality_rules.CONSISTENCY + floor
    return far()


def test_quality_fit_of_few_rows(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8)))
    texts = [" ".join(word() for _ in range(60)) for _ in range(20)] + [" ".join(f"#{word().upper()}$$%{i}" for i in range(60))]
    docs = make(spark, [(i, t, f"s{i % 2}") for i, t in enumerate(texts)])
    stats = quality_rules.with_features(docs.select("doc_id", quality_rules.text_statistics(F.col("text")).alias("s")).select("doc_id", "s.*")).orderBy("doc_id")
    want = _distances([[x[f] for f in quality_rules.FEATURES] for x in stats.collect()])
    got = {x.doc_id: x for x in quality_rules.score_documents(docs).collect()}
    assert [got[i].distance for i in range(21)] == pytest.approx(list(want), rel=1e-6)
    assert [got[i].kept for i in range(21)] == [d * 60 / 80 <= quality_rules.CUTOFF for d in want] and not got[20].kept
    assert got[0].kept


def test_decontamination_windows_are_joined_from_halves(spark):
    """A window's hash costs log2 of its words and is that of the item's window."""
    ws = [f"w{i % 5}" for i in range(11)] + ["é", "x"]
    one = spark.createDataFrame([(ws,)], "ws array<string>")
    for n in range(1, 9):
        got = one.select(decontaminate._windows(F.col("ws"), n)).first()[0]
        want = one.select(F.array(*[decontaminate._joined([F.get("ws", F.lit(i + k)) for k in range(n)]) for i in range(len(ws) - n + 1)])).first()[0]
        assert got == want and len({tuple(ws[i : i + n]) for i in range(len(got))}) == len(set(got))
        assert one.select(decontaminate._windows(F.lit([]).cast("array<string>"), n)).first()[0] == []
    assert one.select(decontaminate._windows(F.col("ws"), 8).alias("h"))._jdf.queryExecution().analyzed().toString().count("xxhash64") == 4


def test_decontamination(spark, docs, empty):
    item = "If Anna has 12 apples and gives 3 apples to Ben then how many apples does Anna keep in total"
    same = "we read: If Anna has 40 apples and gives 7 apples to Carl then how many apples does Anna keep in total right"
    odd = "x If Anna has 12 apples and gives 3 apples to Ben then nothing else of this stays in the text at all"
    items = spark.createDataFrame([(1, item, "e"), (2, "tiny", "e"), (3, None, "e"), (4, "five words are enough here", "e"), (1, item, "e")], "item_id bigint, text string, matched string")
    own = make(spark, [(1, same, "s"), (2, odd, "s"), (3, "nothing of the kind", "s"), (4, None, "s"), (5, "so five words are enough here too", "s"), (1, same, "s"), (6, "", "s")])
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(own, items).collect()}
    assert (1, 1) in got and (5, 4) in got and not {d for d, _ in got} & {3, 4, 6}
    left = decontaminate.drop_leaks(own, items)
    assert left.columns == own.columns and not {1, 5} & {r.doc_id for r in left.collect()}
    assert decontaminate.find_leaks(empty, items).count() == 0 and decontaminate.find_leaks(docs, items.limit(0)).count() == 0


def test_slots_must_agree(spark):
    item = "take 5 and add 5 then name the number that is left over at the end"
    good, bad = item.replace("5", "8"), "take 5 and add 6 then count up"
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    own = make(spark, [(1, good, "s"), (2, bad + " to nothing", "s")])
    assert {r.doc_id for r in decontaminate.find_leaks(own, items).collect()} == {1}


def test_dense_and_short_items(spark):
    sums, table = "Compute 12 + 7 * 3 - 4 / 2 + 9 * 6 =", "1 2 3 4 5 6 7 8 9"
    items = spark.createDataFrame([(1, sums), (2, "Who wrote Hamlet"), (3, table), (None, "where does the river end after the last bend"), (4, "add 3 and 3 and 4 and 4 and 5 and 5 now")], "item_id bigint, text string")
    own = make(spark, [
        (1, "so " + sums + " what", "s"), (2, "Compute 14 + 8 * 5 - 3 / 1 + 6 * 4 = 9", "s"), (3, "Compute 14 + 8 * 5 and no more", "s"), (4, "he asked who wrote Hamlet then", "s"),
        (5, "who wrote the Hamlet", "s"), (6, "see " + table, "s"), (7, "see 3 1 4 1 5 9 2 6 5 3 5", "s"), (8, "tell where does the river end after the last bend", "s"),
    ])
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(own, items).collect()} == {(1, 1), (2, 1), (4, 2), (6, 3), (8, None)}


def test_names_that_begin_sentences(spark):
    item = "Tom has 5 red apples. Anna has 3 pears. Ben eats 2 plums. Tom buys 4 figs."
    good = "Eve has 7 red apples. Carl has 9 pears. Mia eats 6 plums. Eve buys 8 figs."
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    own = make(spark, [(1, good, "s"), (2, "He said: " + good.replace("Carl", "CARL"), "s"), (3, "The cat sat. Then it ran off. Nobody saw 3 pears there.", "s")])
    assert {r.doc_id for r in decontaminate.find_leaks(own, items).collect()} == {1, 2}


def test_mixing(spark, rows, docs, empty):
    got = mixing.taken(docs).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert collections.Counter((r.doc_id, r["size"]) for r in got) == collections.Counter((i, size(t)) for i, t, _ in rows)
    per = collections.defaultdict(int)
    for _, t, s in rows:
        per[s] += size(t)
    order = sorted([s for s in per if s is not None]) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, free = {}, set(per)
    left = 1.5 * sum(per.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * per[s]}
        if not over:
            goal |= share
            break
        for s in over:
            goal[s] = 2.0 * per[s]
            left -= goal[s]
        free -= over
    source = {i: s for i, _, s in rows}
    sums = collections.defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(goal[source[r.doc_id]]) and r.source_size == per[source[r.doc_id]] and r.taken <= 2 * r["size"]
        sums[source[r.doc_id]] += r.taken
    for s in per:
        assert abs(sums[s] - goal[s]) <= max(size(t) for _, t, x in rows if x == s) / 2 + 1
    assert collections.Counter(map(tuple, got)) == counted(mixing.taken(docs.repartition(5)))
    assert mixing.taken(empty).count() == 0


def test_splitting_tree_is_exact(spark):
    q = spark.createDataFrame([("a", 1000), ("b", 37), (None, 5), ("c", 0)], "source string, quota bigint")
    parts = mixing.split_quotas(q, 4, 1)
    assert {r.source: r.q for r in parts.groupBy("source").agg(F.sum("quota").alias("q")).collect()} == {"a": 1000, "b": 37, None: 5}
    shards = [r.q for r in parts.groupBy("shard").agg(F.sum("quota").alias("q")).collect()]
    assert len(shards) == 16 and max(shards) - min(shards) <= 1


def test_hypergeometric_draws_are_exact(spark):
    """Small counts against all probabilities, large ones against mean and deviation."""
    import math

    n, q, m, draws = 50, 20, 25, 20_000
    i = F.col("id")
    got = collections.Counter(r.k for r in spark.range(draws).select(mixing._hypergeometric(F.lit(n), F.lit(q), F.lit(m), i).alias("k")).collect())
    want = {k: draws * math.comb(q, k) * math.comb(n - q, m - k) / math.comb(n, m) for k in range(q + 1)}
    some = [k for k in want if want[k] >= 20]
    assert sum((got[k] - want[k]) ** 2 / want[k] for k in some) < 2.2 * len(some) and not set(got) - set(want)
    n, q, m = 3_000_000_000, 900_000_000, 1_500_000_001
    big = spark.range(draws).select(mixing._hypergeometric(F.lit(n), F.lit(q), F.lit(m), i).cast("double").alias("k")).agg(F.avg("k").alias("mean"), F.stddev("k").alias("sd")).first()
    sd = math.sqrt(m * (q / n) * (1 - q / n) * (n - m) / (n - 1))
    assert abs(big.mean - m * q / n) < 5 * sd / math.sqrt(draws) and abs(big.sd / sd - 1) < 0.03
    for n, q, m, k in ((5, 5, 2, 2), (5, 0, 2, 0), (1, 1, 0, 0), (0, 0, 0, 0), (7, 3, 7, 3)):
        assert spark.range(1).select(mixing._hypergeometric(F.lit(n), F.lit(q), F.lit(m), i).alias("k")).first().k == k


def test_mixed_documents(docs):
    out = mixing.mixed_documents(docs)
    assert set(docs.columns) < set(out.columns) and out.count() > 0
    first = counted(out)
    assert first == counted(mixing.mixed_documents(docs.repartition(7))), "reruns agree, however the rows lie"
    words = sum(len(WORD.findall(r.text or "")) for r in out.select("text").collect())
    assert words == mixing.taken(docs).agg(F.sum("taken")).first()[0]


def _removed(rows):
    seen, out = {}, {}
    for i, t in sorted({(i if i is not None else 1 << 62, t or "") for i, t, _ in rows}):
        b = t.encode()
        covered = [False] * len(b)
        for p in range(len(b) - 99):
            if seen.setdefault(b[p : p + 100], (i, p)) != (i, p):
                covered[p : p + 100] = [True] * 100
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        runs = sum(c and not (j and covered[j - 1]) for j, c in enumerate(covered))
        out[i] = (len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("most", [2_000_000, 300])
def test_suffix_dedup(spark, rows, docs, empty, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_SHARD", most)
    monkeypatch.setattr(suffix_dedup, "SHARD", 5000)
    got = suffix_dedup.digest(docs).collect()
    want = _removed(rows)
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id if r.doc_id is not None else 1 << 62], r.doc_id
    if most > 300:
        assert suffix_dedup.digest(empty).count() == 0


def test_suffix_array():
    for seed in range(20):
        r = random.Random(seed)
        base = bytes(r.choice(b"abc") for _ in range(r.randint(1, 300)))
        d = b"".join(r.choice([base, base[3:50], bytes([r.randint(0, 255)]), b"aaaa" * r.randint(1, 9)]) for _ in range(r.randint(1, 8)))
        keys = [d[i : i + 100] for i in suffix_dedup.suffix_array(d) if i < len(d)]
        assert len(keys) == len(d) and keys == sorted(keys)


def _in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage on what its predecessor kept, against brute force; rows of null doc_id keep their own fate."""
    import corpus_pipeline

    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    item = "what is the largest river that flows through the northern plains of the old kingdom"
    shared = text(25)
    docs = [(i, text(60) + "\n" + text(20)) for i in range(24)]
    docs += [(30, text(60) + "\n" + shared), (31, text(60) + "\n" + shared), (None, text(60)), (None, text(3)), (40, text(4)), (41, None), (42, ""), (43, " ".join(f"#{word().upper()}$$%{i}" for i in range(60)))]
    near = text(90).split(" ")
    broken = lambda k: " ".join(near[:k]) + "\n" + " ".join(near[k:])
    docs += [(50, broken(45)), (51, broken(75) + " end"), (52, text(40) + " " + item + " " + text(40))]
    own = spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 2}", len(t or ""), "g") for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint, _gone string")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, own, str(tmp_path))
        assert out.columns == own.columns
        rows_in, rows_out = ([(x.doc_id, x.text) for x in df.collect()] for df in (own, out))
        own = spark.createDataFrame(out.collect(), own.schema)
        got[name] = rows_in, rows_out
    rows_in, rows_out = got["quality rules"]
    passed = [x for x in _in_order(rows_in) if len(WORD.findall(x[1] or "")) >= 10]
    stats = quality_rules.with_features(spark.createDataFrame([(n, t) for n, (_, t) in enumerate(passed)], "n int, text string").select("n", quality_rules.text_statistics(F.col("text")).alias("s")).select("n", "s.*")).orderBy("n").collect()
    far = _distances([[x[f] for f in quality_rules.FEATURES] for x in stats])
    assert _in_order(rows_out) == [x for x, s, d in zip(passed, stats, far, strict=True) if d * s.n_words / (s.n_words + quality_rules.SHORT) <= quality_rules.CUTOFF]
    assert 43 not in {i for i, _ in rows_out} and sum(i is None for i, _ in rows_out) == 1 and len(rows_out) >= 27
    rows_in, rows_out = got["line dedup"]
    gone = _gone_lines([(i if i is not None else 1 << 62, t) for i, t in rows_in], 1)
    before, after = ({i if i is not None else 1 << 62: t.split("\n") for i, t in rows} for rows in (rows_in, rows_out))
    lost = {i: len(x) - (len(after[i]) if any(after[i]) else 0) for i, x in before.items()}
    assert {i: n for i, n in lost.items() if n} == gone and gone.get(31) == 1 and 51 not in gone
    rows_in, rows_out = got["near copies"]
    linked = _linked([(i, t, None) for i, t in rows_in], 5, 4, 5)
    assert _in_order(rows_out) == _in_order([(i, t) for i, t in rows_in if i is None or linked[i][1] == i])
    rows_in, rows_out = got["decontamination"]
    assert _in_order(rows_out) == _in_order([(i, t) for i, t in rows_in if i != 52]) and len(rows_out) < len(rows_in)
    mixed = corpus_pipeline.mixture(spark, own, str(tmp_path))
    words = collections.Counter()
    for x in mixed.collect():
        words[x.source] += len(WORD.findall(x.text))
    goal = {f"s{(x.doc_id or 0) % 2}": x.target for x in mixing.taken(own).collect()}
    assert all(abs(words[s] - goal[s]) <= 80 for s in goal)
    assert corpus_pipeline.quality(spark, own.limit(0), str(tmp_path)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    got = out.toPandas()
    assert {"doc_id", "text", "mix_shard", "mix_copy"} <= set(got.columns) and 20 < got.doc_id.nunique() < 200
    assert got.groupby("doc_id").size().max() <= 2
