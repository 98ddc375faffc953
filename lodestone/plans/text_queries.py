"""Queries on texts: candidates, splices, excerpts, patches, model replies, corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import content as C
from lodestone.functions import text as T
from lodestone.operators import locators, patches
from lodestone.plans import adapters as A
from lodestone.plans.registry import query
from lodestone.sources import files


_MARKED = """regexp_matches(x, 'Traceback \\(most recent call last\\)|(Assertion|Syntax|Name|Type|Value|Key|Attribute|Import|Runtime)Error|error\\(s\\)|FAILED|FAIL[: ]|  x  |✗')"""


@query("""WITH f AS (SELECT page_id, unnest(regexp_extract_all(html, '<=|>=|==|!=|<|>')) AS op FROM pages)
SELECT page_id, op AS before, CASE op WHEN '<' THEN '<=' WHEN '<=' THEN '<' WHEN '>' THEN '>=' WHEN '>=' THEN '>' WHEN '==' THEN '!=' ELSE '==' END AS after, count(*) AS n FROM f GROUP BY 1, 2, 3""")
def compare_flip_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    flips = F.create_map(*[F.lit(x) for pair in locators.FLIPS.items() for x in pair])
    found = A.table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<=|>=|==|!=|<|>"), F.lit(0))).alias("before"))
    return found.groupBy("page_id", "before", F.element_at(flips, F.col("before")).alias("after")).agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS n FROM documents), g AS (SELECT doc_id, n, CASE WHEN ltrim(n, '0') = '' THEN '0' ELSE ltrim(n, '0') END AS d FROM f), h AS (SELECT *, rtrim(d, '9') AS p FROM g)
SELECT doc_id, n AS before, CASE WHEN length(d) <= 30 THEN CAST(CAST(d AS HUGEINT) + 1 AS VARCHAR) ELSE (CASE WHEN p = '' THEN '1' ELSE substr(p, 1, length(p) - 1) || (CAST(right(p, 1) AS INTEGER) + 1) END) || repeat('0', length(d) - length(p)) END AS after, count(*) AS sites FROM h GROUP BY 1, 2, 3""")
def off_by_one_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = A.table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))).alias("before"))
    return found.groupBy("doc_id", "before", T.bump_int(F.col("before")).alias("after")).agg(F.count("*").alias("sites"))


@query("""WITH f AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\b(and|or)\\b', 1)) AS w FROM documents WHERE lang = 'en') SELECT doc_id, w AS before, CASE w WHEN 'and' THEN 'or' ELSE 'and' END AS after, count(*) AS n FROM f GROUP BY 1, 2, 3""")
def boolop_candidates_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = A.table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b(and|or)\b"), F.lit(1))).alias("before"))
    return found.groupBy("doc_id", "before", F.when(F.col("before") == "and", "or").otherwise("and").alias("after")).agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT page_id, len(regexp_extract_all(html, '<=|>=|==|!=|<|>')) AS candidates, page_id % 4 = 0 AS loud FROM pages)
SELECT page_id AS file, CAST(sum(candidates) AS BIGINT) AS candidates, CAST(sum(CASE WHEN loud THEN 0 ELSE candidates END) AS BIGINT) AS silent FROM f GROUP BY ROLLUP (page_id)""")
def candidate_report_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.table(spark, sf_dir, "pages").select(F.col("page_id").alias("file"), F.regexp_count("html", F.lit("<=|>=|==|!=|<|>")).alias("n"))
    return p.rollup("file").agg(F.sum("n").alias("candidates"), F.sum(F.when(F.col("file") % 4 == 0, 0).otherwise(F.col("n"))).alias("silent"))


_LE = " || ".join(f"substr(h, {i}, 2)" for i in range(15, 0, -2))


@query(f"""WITH p AS (SELECT page_id, sha256(html) AS sha, lpad(to_hex(page_id * 37), 16, '0') AS h, lpad(to_hex(page_id * 37 + 2), 16, '0') AS h2 FROM pages),
q AS (SELECT page_id, sha, lower({_LE}) AS a, lower({_LE.replace('(h,', '(h2,')}) AS b FROM p)
SELECT page_id, substr(sha256(CAST(sha || 'compare_flip' AS BLOB) || from_hex(a) || from_hex(b) || CAST('<=' AS BLOB)), 1, 16) AS id FROM q""")
def content_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("page_id") * 37
    return A.table(spark, sf_dir, "pages").select("page_id", C.trial_id(F.sha2("html", 256), F.lit("compare_flip"), start, start + 2, F.lit("<=")).alias("id"))


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def file_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query("""SELECT p_partkey, substr(p_name, 1, 2) || 'XY' || substr(p_name, 5) AS one, substr(p_name, 1, 1) || 'ab' || substr(p_name, 3, 2) || 'Q' || substr(p_name, 6) AS two, substr(p_name, 3, 2) = 'ee' AS holds FROM part""")
def splice_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, n = F.col("p_name").cast("binary"), F.lit
    two = C.splice_two(data, (n(4), n(5), n("Q")), (n(1), n(2), n("ab")))
    return A.table(spark, sf_dir, "part").select("p_partkey", C.splice(data, n(2), n(4), n("XY")).cast("string").alias("one"), two.cast("string").alias("two"), C.span_holds(data, n(2), n(4), n("ee")).alias("holds"))


@query("""WITH r AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), b AS (SELECT doc_id, l, doc_id % 5 + 1 AS line, least(greatest(1, doc_id % 5 + 1 - 2), len(l)) AS lo FROM r),
c AS (SELECT *, greatest(least(len(l), line + 2), lo) AS hi FROM b)
SELECT doc_id, array_to_string(list_transform(range(lo, hi + 1), lambda i: CASE WHEN i = line THEN '>' ELSE ' ' END || repeat(' ', greatest(5 - length(CAST(i AS VARCHAR)), 0)) || CAST(i AS VARCHAR) || ' | ' || l[i] || chr(10)), '') AS excerpt FROM c""")
def excerpt_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "documents").select("doc_id", T.excerpt(F.col("text"), (F.col("doc_id") % 5 + 1).cast("int"), 2).alias("excerpt"))


@query(f"""WITH o AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text || chr(10) || 'FAILED one step' || chr(10) || text WHEN 1 THEN text || chr(10) || '  x  bad' || chr(10) || '3 x 4' || chr(10) || text ELSE text || chr(10) || '3 x 4' END AS t FROM documents),
l AS (SELECT doc_id, CASE WHEN t = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(regexp_replace(replace(t, chr(13) || chr(10), chr(10)), '\\n\\z', ''), chr(10)) END AS l FROM o),
m AS (SELECT doc_id, l, list_max(list_filter(range(0, len(l)), lambda i: list_transform([l[i + 1]], lambda x: {_MARKED})[1])) AS last FROM l),
w AS (SELECT doc_id, l, last, greatest(last - 12, 0) AS lo, least(last + 40, len(l)) AS hi, greatest(len(l) - 40, 0) AS f FROM m)
SELECT doc_id, CASE WHEN last IS NULL THEN '(no recognised failure marker in this suite''s output; showing the last                  ' || (len(l) - f) || ' lines verbatim)' || chr(10) || array_to_string(list_slice(l, f + 1, f + 40), chr(10))
 ELSE CASE WHEN lo > 0 THEN '… ' || lo || ' earlier lines of passing output omitted …' || chr(10) ELSE '' END || array_to_string(list_slice(l, lo + 1, hi), chr(10)) END AS focus FROM w""")
def focus_last_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id") % 4
    out = F.when(n == 0, F.concat("text", F.lit("\nFAILED one step\n"), "text")).when(n == 1, F.concat("text", F.lit("\n  x  bad\n3 x 4\n"), "text")).otherwise(F.concat("text", F.lit("\n3 x 4")))
    return A.table(spark, sf_dir, "documents").select("doc_id", T.focus_failure(out).alias("focus"))


#: Outputs that name the work folder /tmp/w, dealt by page, and what is left: {u} is the page's address, {n} a worker's number.
_PATHS = (
    ("at /tmp/w/n{n}/{u} in /tmp/w and /tmp/w/w0, then x/y", "at {u} in repo and repo, then x/y"), ("File '/tmp/w/history/a.py', line 3", "File 'a.py', line 3"), ("cd /tmp/w/baseline; (/tmp/w/w{n}) /tmp/w/: done", "cd repo; (repo) repo: done"),
    ("/var/tmp/w2/a /tmp/x/w{n}/b", "/varrepo2/a /tmp/x/w{n}/b"), ("{u}", "{u}"),
)
_LEFT = "list_extract(['" + "', '".join(x.replace("'", "''") for _, x in _PATHS) + f"'], page_id % {len(_PATHS)} + 1)"


@query(f"""SELECT page_id, replace(replace({_LEFT}, '{{u}}', url), '{{n}}', CAST(page_id % 12 AS VARCHAR)) AS text FROM pages""")
def strip_work_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.element_at(F.array(*[F.lit(x) for x, _ in _PATHS]), (F.col("page_id") % len(_PATHS) + 1).cast("int"))
    text = F.replace(F.replace(told, F.lit("{u}"), F.col("url")), F.lit("{n}"), (F.col("page_id") % 12).cast("string"))
    return A.table(spark, sf_dir, "pages").select("page_id", T.strip_worktree(text, "/tmp/w/", "repo").alias("text"))


@query(f"WITH {A.REPLIES}, {A.EXTRACTED} SELECT conv_id, turn, patch, error FROM got")
def extract_last_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    patch, error = T.extract_patch(F.col("reply"))
    return A.replies(spark, sf_dir).select("conv_id", "turn", patch.alias("patch"), error.alias("error"))


@query(f"""WITH {A.REPLIES}, {A.EXTRACTED}, f AS (SELECT conv_id, turn, file, list_distinct(list_transform(regexp_extract_all(patch, '(?m)^(?:\\+\\+\\+ |--- a/)([^\\t\\n]+)', 1), lambda x: regexp_replace(trim(x), '^(?:[ab]/)+', ''))) AS fs FROM got WHERE patch IS NOT NULL)
SELECT conv_id, turn, array_to_string(fs, ',') AS files, len(list_filter(fs, lambda x: x <> file)) = 0 AS within FROM f""")
def patch_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    patch, _ = T.extract_patch(F.col("reply"))
    named = A.replies(spark, sf_dir).withColumn("patch", patch).where("patch is not null").withColumn("fs", T.patched_files(F.col("patch")))
    return named.select("conv_id", "turn", F.array_join("fs", ",").alias("files"), T.in_contract(F.col("fs"), F.col("file")).alias("within"))


_LIST = "'Sure, here they are:' || chr(10) || 'Heading:' || chr(13) || chr(10) || 'Of course not' || chr(10) || '1. ' || substr(text, 1, 30) || chr(10) || '- \"' || substr(text, 5, 20) || '\"' || chr(10) || 'ab' || chr(10) || '* ' || substr(text, 2, 12)"


@query(f"""WITH c AS (SELECT conv_id, turn, {_LIST} AS t FROM (SELECT conv_id, turn, regexp_replace(text, '[^a-zA-Z ]', '', 'g') AS text FROM conversations)),
l AS (SELECT conv_id, turn, list_transform(string_split(t, chr(10)), lambda x: trim(trim(trim(trim(regexp_replace(trim(replace(x, chr(13), '')), '^\\s*(?:[-*•] |[0-9]+[.)] )', '')), '"'), ))) AS l FROM c)
SELECT conv_id, turn, array_to_string(list_slice(list_filter(l, lambda x: strlen(x) >= 4 AND NOT ends_with(x, ':') AND NOT regexp_matches(x, '(?i)^(?:here are|sure|certainly)')), 1, 3), '|') AS prompts FROM l""")
def clean_prompt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = A.table(spark, sf_dir, "conversations").withColumn("text", F.regexp_replace("text", "[^a-zA-Z ]", ""))
    part = lambda a, b: F.substring("text", a, b)
    t = F.concat(F.lit("Sure, here they are:\nHeading:\r\nOf course not\n1. "), part(1, 30), F.lit('\n- "'), part(5, 20), F.lit('"\nab\n* '), part(2, 12))
    return c.select("conv_id", "turn", F.array_join(T.clean_prompts(t, 3), "|").alias("prompts"))


@query("""WITH c AS (SELECT conv_id, turn, conv_id % 6 AS r, 'from t' || turn AS q FROM conversations)
SELECT conv_id, turn, CASE r WHEN 0 THEN q || ' b|' || q || ' a|' WHEN 1 THEN q || ' x|' || q || ' y|' || q || ' z' WHEN 2 THEN '||' WHEN 3 THEN q || ' x|' || q || ' y|' || q || ' z' WHEN 4 THEN q || ' b||' ELSE q || ' a|' || q || ' n|' || q || ' c' END AS answers FROM c""")
def match_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered out of order with one missing; three without numbers; two; three after narration; a number twice; numbered
    and not, three of the latter."""
    q = F.concat(F.lit("from t"), F.col("turn").cast("string"))
    told = lambda *parts: F.concat(*[q if x is None else F.lit(x) for x in parts])
    texts = (
        told("2. ", None, " a\n1) `", None, " b;`"), told(None, " x\n", None, " y;\n", None, " z"), told(None, " x\n", None),
        told("Here you go:\n- ", None, " x\n", None, " y\n* ", None, " z\nthat is all"), told("1. ", None, " a\n1. ", None, " b"), told(None, " a\n2. ", None, " n\n", None, " b\n9. ", None, " c"),
    )
    text = F.element_at(F.array(*texts), (F.col("conv_id") % 6 + 1).cast("int"))
    return A.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(T.match_answers(text, 3), "|").alias("answers"))


#: Answers of several shapes, dealt by conversation: what a chat model says ({q} is its query), and the query that counts.
_ANSWERS = (
    ("Here you go:\n```sql\n{q};\n```\n", "{q}"), ("```{q}```", "{q}"), ("`{q};`", "{q}"), ("  {q} ;; \r\nthanks", "{q}"), ("no idea;\nsorry", "no idea"), ("", ""),
    ("`x`\n`FROM {q}`;", "FROM {q}`"), ("```sql\nselect 1\n```", "sql"),
)
_TOLD = "['" + "', '".join(a.replace("{q}", "<q>") for _, a in _ANSWERS) + "']"


@query(f"""SELECT conv_id, turn, replace(list_extract({_TOLD}, conv_id % {len(_ANSWERS)} + 1), '<q>', 'from t' || turn || ' where a = 1') AS q FROM conversations""")
def clean_query_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query in fenced, quoted, narrated and empty answers, and in those without one."""
    told = F.element_at(F.array(*[F.lit(x) for x, _ in _ANSWERS]), (F.col("conv_id") % len(_ANSWERS) + 1).cast("int"))
    answer = F.replace(told, F.lit("{q}"), F.concat(F.lit("from t"), F.col("turn").cast("string"), F.lit(" where a = 1")))
    return A.table(spark, sf_dir, "conversations").select("conv_id", "turn", T.clean_query(answer).alias("q"))


@query("SELECT doc_id, sha256(right(regexp_replace(text || '  ' || chr(10), '\\s+$', ''), 60001)) AS tail_sha FROM documents")
def tail_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "documents").select("doc_id", F.sha2(T.tail_window(F.concat("text", F.lit("  \n"))), 256).alias("tail_sha"))


@query("""SELECT event_id AS id, 'u' || user_id AS file, CASE event_type WHEN 'click' THEN 'Failed' WHEN 'error' THEN 'Timeout' ELSE 'Survived' END AS kind, CASE event_type WHEN 'click' THEN 'core' WHEN 'error' THEN 'slow' END AS suite FROM events""")
def trials_variant_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials as JSON whose verdict is a word or an object, read back."""
    e = A.table(spark, sf_dir, "events")
    verdict = F.when(F.col("event_type") == "click", F.lit('{"Failed":{"suite":"core","tail":"t"}}')).when(F.col("event_type") == "error", F.lit('{"Timeout":{"suite":"slow","limit_ms":3000}}')).otherwise(F.lit('"Survived"'))
    value = F.concat(F.lit('{"id":"'), "event_id", F.lit('","file":"u'), "user_id", F.lit('","elapsed_ms":5,"verdict":'), verdict, F.lit("}"))
    return files.read_trials(e.select(value.alias("value"))).select(F.col("id").cast("bigint").alias("id"), "file", "kind", "suite")


@query("""SELECT event_id AS id, 'u' || user_id AS file, event_type AS operator FROM events""")
def corpus_jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as JSON Lines and read back under the corpus schema."""
    import uuid

    path = f"{files.shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    e = A.table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), F.concat(F.lit("u"), "user_id").alias("file"), F.col("event_type").alias("operator"))
    files.write_corpus(e, path)
    return files.read_corpus(spark, path).select(F.col("id").cast("bigint").alias("id"), "file", "operator")


def _sources(spark: SparkSession, sf_dir: str, language: str) -> DataFrame:
    """A small source per part, with non-ASCII text before its sites."""
    n = F.col("p_size").cast("string")
    if language == "python":
        body = F.concat(F.lit("# é\ndef f_"), F.col("p_partkey").cast("string"), F.lit("(x):\n    s = 'é'; y = x < "), n, F.lit("\n    if not x and y:\n        return None\n    try:\n        x += "), n, F.lit("\n    except ValueError:\n        raise\n    if x == 0:\n        return s\n    return x\n"))
    else:
        body = F.concat(F.lit("fn f_"), F.col("p_partkey").cast("string"), F.lit("(x: Vec<u8>) -> bool { let y = x.len() < "), n, F.lit("u64; if y && true { x += 1; } y }\n#[cfg(all(test, unix))]\nmod t { fn g() { let a = 1 < 2; } }\n"))
    return A.table(spark, sf_dir, "part").select(F.concat(F.lit("src/p"), F.col("p_partkey").cast("string")).alias("file"), body.cast("binary").alias("content"))


def _sites(head: str, sites: tuple) -> str:
    """SQL of the sites (operator, text between the site before and this one, before, after, line) of one source per part: {k} is
    its key, {n} its size, {m} that plus one. Offsets are bytes of the text that stands before; a site that lies in another
    gives the place it starts at by the text since that one's start."""
    full = lambda x: "replace(replace(replace('" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "', '{k}', CAST(p_partkey AS VARCHAR)), '{n}', CAST(p_size AS VARCHAR)), '{m}', CAST(p_size + 1 AS VARCHAR))"
    out = [
        f"SELECT 'src/p' || p_partkey AS file, '{op}' AS operator, CAST(strlen({full(head + text)}) AS BIGINT) AS start_byte, CAST(strlen({full(head + text + before)}) AS BIGINT) AS end_byte, {full(before)} AS before, {full(after)} AS after, CAST({line} AS BIGINT) AS line, 'f_' || p_partkey AS scope FROM part"
        for op, text, before, after, line in sites
    ]
    return " UNION ALL ".join(out)


_HEAD = "# é\ndef f_{k}(x):\n"
_L3 = "    s = 'é'; y = x < {n}\n"
_L4 = "    if not x and y:\n        return None\n"
_L6 = "    try:\n        x += {n}\n    except ValueError:\n        raise\n"
_L10 = "    if x == 0:\n        return s\n"
_PY = (
    ("compare_flip", "    s = 'é'; y = x ", "<", "<=", 3), ("off_by_one", "    s = 'é'; y = x < ", "{n}", "{m}", 3),
    ("guard_drop", _L3, _L4[:-1], "    pass", 4), ("boolop_swap", _L3 + "    if not x ", "and", "or", 4), ("constant_perturb", _L3 + _L4[:-5], "None", "0", 5),
    ("augassign_flip", _L3 + _L4 + "    try:\n        x ", "+=", "-=", 7), ("off_by_one", _L3 + _L4 + "    try:\n        x += ", "{n}", "{m}", 7),
    ("except_swallow", _L3 + _L4 + _L6[:-14], "        raise", "        pass", 9), ("guard_drop", _L3 + _L4 + _L6, _L10[:-1], "    pass", 10),
    ("condition_negate", _L3 + _L4 + _L6 + "    if ", "x == 0", "not (x == 0)", 10), ("compare_flip", _L3 + _L4 + _L6 + "    if x ", "==", "!=", 10), ("off_by_one", _L3 + _L4 + _L6 + "    if x == ", "0", "1", 10),
    ("return_none", _L3 + _L4 + _L6 + "    if x == 0:\n", "        return s", "        return None", 11), ("return_none", _L3 + _L4 + _L6 + _L10, "    return x", "    return None", 12),
)
_RS = "fn f_{k}(x: Vec<u8>) -> bool { let y = x.len() "
_RUST = (
    ("compare_flip", "", "<", "<=", 1), ("off_by_one", "< ", "{n}u64", "{m}u64", 1), ("boolop_swap", "< {n}u64; if y ", "&&", "||", 1),
    ("constant_perturb", "< {n}u64; if y && ", "true", "false", 1), ("augassign_flip", "< {n}u64; if y && true { x ", "+=", "-=", 1), ("off_by_one", "< {n}u64; if y && true { x += ", "1", "2", 1),
)
_SITE = ("file", "operator", "start_byte", "end_byte", "before", "after", "line", "scope")


@query(_sites(_HEAD, _PY))
def locate_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locators.sites_of(locators.locate(_sources(spark, sf_dir, "python"))).select(*_SITE)


@query(_sites(_RS, _RUST))
def locate_rust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locators.sites_of(locators.locate(_sources(spark, sf_dir, "rust"), "rust")).select(*_SITE)


#: Rust sources of several shapes, dealt by key: (source, sites, refused, text of the excluded items).
_HIDDEN = "#[cfg(all(test, unix))]\nmod t { fn g() { let a = 1 < 2; } }\n"
_SHAPES = (
    ("#[cfg(test)]\nuse a::b;\nfn f_{k}(x: u8)->bool{x<{n}&&!y}\n", (
        ("compare_flip", "#[cfg(test)]\nuse a::b;\nfn f_{k}(x: u8)->bool{x", "<", "<=", 3), ("off_by_one", "#[cfg(test)]\nuse a::b;\nfn f_{k}(x: u8)->bool{x<", "{n}", "{m}", 3),
        ("boolop_swap", "#[cfg(test)]\nuse a::b;\nfn f_{k}(x: u8)->bool{x<{n}", "&&", "||", 3)), 0, ""),
    ("/// é\nimpl<T: Fn(u8) -> bool> S<T> {\n  fn f_{k}(&self) -> Vec<Vec<u8>> { let c = |a: &u8| a>&0xFF; self.0.1|=Vec::<u8>::new(); vec![1 < 2] }\n}\n", (
        ("compare_flip", "/// é\nimpl<T: Fn(u8) -> bool> S<T> {\n  fn f_{k}(&self) -> Vec<Vec<u8>> { let c = |a: &u8| a", ">", ">=", 3),
        ("augassign_flip", "/// é\nimpl<T: Fn(u8) -> bool> S<T> {\n  fn f_{k}(&self) -> Vec<Vec<u8>> { let c = |a: &u8| a>&0xFF; self.0.1", "|=", "&=", 3)), 1, ""),
    (_HIDDEN + "fn f_{k}(x: u64) -> u64 { match x { {n}u64 => 1.5, _ if x as usize + 1 == y => 1e9, } }\n", (
        ("off_by_one", _HIDDEN + "fn f_{k}(x: u64) -> u64 { match x { ", "{n}u64", "{m}u64", 3), ("off_by_one", _HIDDEN + "fn f_{k}(x: u64) -> u64 { match x { {n}u64 => 1.5, _ if x as usize + ", "1", "2", 3),
        ("compare_flip", _HIDDEN + "fn f_{k}(x: u64) -> u64 { match x { {n}u64 => 1.5, _ if x as usize + 1 ", "==", "!=", 3)), 0, _HIDDEN[:-1]),
    ("fn f_{k}() { if a { b(true) } else { || false } ; let v: [u8; {n}] = \"x < 1\"; }\nfn g() { '('; }\n", (
        ("constant_perturb", "fn f_{k}() { if a { b(", "true", "false", 1), ("constant_perturb", "fn f_{k}() { if a { b(true) } else { || ", "false", "true", 1),
        ("off_by_one", "fn f_{k}() { if a { b(true) } else { || false } ; let v: [u8; ", "{n}", "{m}", 1)), 0, ""),
    ("fn f_{k}( { x < {n} }\n", (), 0, ""),
)


def _rust_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = lambda x: F.replace(F.replace(F.lit(x), F.lit("{k}"), F.col("p_partkey").cast("string")), F.lit("{n}"), F.col("p_size").cast("string"))
    body = F.element_at(F.array(*[filled(x) for x, _, _, _ in _SHAPES]), (F.col("p_partkey") % len(_SHAPES) + 1).cast("int"))
    return A.table(spark, sf_dir, "part").select(F.concat(F.lit("src/p"), F.col("p_partkey").cast("string")).alias("file"), body.cast("binary").alias("content"))


def _part(i: int) -> str:
    return f" WHERE p_partkey % {len(_SHAPES)} = {i}"


@query(" UNION ALL ".join(" UNION ALL ".join(x + _part(i) for x in _sites("", sites).split(" UNION ALL ")) for i, (_, sites, _, _) in enumerate(_SHAPES) if sites))
def locate_rust_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites by syntax: no spaces around operators, generics, closures, attributes of other items, macros, and a file that doesn't parse."""
    return locators.sites_of(locators.locate(_rust_shapes(spark, sf_dir), "rust")).select(*_SITE)


@query(" UNION ALL ".join(
    f"SELECT 'src/p' || p_partkey AS file, CAST({len(sites)} AS BIGINT) AS candidates, CAST({refused} AS BIGINT) AS refused, {not sites} AS failed, CAST({len(hidden.encode())} AS BIGINT) AS excluded, '{','.join(sorted({x[0] for x in sites}))}' AS operators FROM part{_part(i)}"
    for i, (_, sites, refused, hidden) in enumerate(_SHAPES)))
def locate_rust_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per file what was found, refused, excluded as test code, and which operators it has."""
    r = locators.report(locators.locate(_rust_shapes(spark, sf_dir), "rust"))
    return r.select("file", "candidates", "refused", F.col("error").isNotNull().alias("failed"), "excluded", F.array_join("operators", ",").alias("operators"))


_SPLIT = "regexp_extract_all({}, '[^\\n]*\\n|[^\\n]+')"
_SIGNED = "array_to_string(list_transform({}, lambda s: '{}' || s || CASE WHEN ends_with(s, chr(10)) THEN '' ELSE chr(10) || '\\ No newline at end of file' || chr(10) END), '')"
_ALIKE = "coalesce(list_position(list_transform(range(1, {n} + 1), lambda i: {a}[i] = {b}[i]), false), {n} + 1) - 1"


@query(f"""WITH e AS (SELECT doc_id, text, substr(text, 1, 2) || 'é' || chr(10) || substr(text, 3) AS edited FROM documents), l AS (SELECT doc_id, {_SPLIT.format("text")} AS x, {_SPLIT.format("edited")} AS y FROM e),
h AS (SELECT *, len(x) AS m, len(y) AS n, {_ALIKE.format(n="least(len(x), len(y))", a="x", b="y")} AS head FROM l), t AS (SELECT *, {_ALIKE.format(n="(least(m, n) - head)", a="list_reverse(x)", b="list_reverse(y)")} AS tail FROM h),
w AS (SELECT *, greatest(head - 3, 0) AS lo, least(tail, 3) AS after FROM t), p AS (SELECT *, m - tail + after - lo AS old, n - tail + after - lo AS new FROM w)
SELECT doc_id, sha256('--- a/a.txt' || chr(10) || '+++ b/a.txt' || chr(10) || '@@ -' || CASE WHEN old > 0 THEN lo + 1 ELSE lo END || ',' || old || ' +' || CASE WHEN new > 0 THEN lo + 1 ELSE lo END || ',' || new || ' @@' || chr(10)
 || {_SIGNED.format("x[lo + 1 : head]", " ")} || {_SIGNED.format("x[head + 1 : m - tail]", "-")} || {_SIGNED.format("y[head + 1 : n - tail]", "+")} || {_SIGNED.format("x[m - tail + 1 : m - tail + after]", " ")}) AS diff_sha, true AS applied, true AS reversed FROM p""")
def hunk_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A diff of each text and an edit of it, which leads there and back."""
    d = A.table(spark, sf_dir, "documents")
    d = d.withColumn("edited", F.concat(F.substring("text", 1, 2), F.lit("é\n"), F.col("text").substr(F.lit(3), F.length("text"))))
    d = d.withColumn("diff", patches.unified_hunk(F.lit("a.txt"), F.col("text"), F.col("edited")))
    there, back = patches.apply_patch(F.col("text"), F.col("diff")), patches.apply_patch(F.col("edited"), F.col("diff"), reverse=True)
    return d.select("doc_id", F.sha2("diff", 256).alias("diff_sha"), (there == F.col("edited")).alias("applied"), (back == F.col("text")).alias("reversed"))
