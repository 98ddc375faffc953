"""Secret scan by a trigram inverted index.

From each rule's regex a Boolean trigram query is derived: a conjunction of clauses, a clause being
alternatives, an alternative a set of trigrams that must all occur. The index has a posting (trigram, doc_id)
for every trigram of the rules that a text holds, in ASCII lower case. Intersecting the postings by document
gives the candidates of each rule; only there is the regex run, over the whole text. Rules without a
mandatory trigram are run on every text.

The vocabulary of the index is that of the rules, whose number doesn't grow with the data; each document is
combined before the shuffle, so a trigram that stands in every text makes no hot group.

Defined cases: null text is empty; repeated rows are scanned each; rows that share a doc_id share candidates,
which are verified per row; null doc_id is an id like others; extra columns are ignored.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bounded, let


class Rule(NamedTuple):
    kind: str
    pattern: str  # as Java reads it and Python's re too
    group: int = 0  # the group that least speaks of
    least: int = 0  # code points; matches with fewer are dropped


#: In the order in which kinds are listed. The first three are the fixed base kinds.
MOST_BROADCAST = 1_000_000  # documents whose texts are looked up
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s:@/]{1,64}:[^\s:@/]{6,64}@"),
)
MOST_STRINGS = 64  # of an exact set; larger sets say nothing


def _query(tree) -> tuple[set[str] | None, list[set[frozenset[str]]]]:
    """Of a parsed regex: the exact strings that it matches (None: too many to list), and clauses that each match
    satisfies."""
    clauses: list[set[frozenset[str]]] = []
    run: set[str] = {""}
    exact: set[str] | None = {""}

    def flush() -> None:
        nonlocal run
        alternatives = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
        if frozenset() not in alternatives:
            clauses.append(alternatives)
        run = {""}

    for op, arg in tree:
        found: set[str] | None = None
        inner: list[set[frozenset[str]]] = []
        if op is rc.LITERAL:
            found = {chr(arg).lower()}
        elif op is rc.IN and all(k is rc.LITERAL for k, _ in arg):
            found = {chr(c).lower() for _, c in arg}
        elif op is rc.SUBPATTERN:
            found, inner = _query(arg[3])
        elif op is rc.BRANCH:
            parts = [_query(x) for x in arg[1]]
            if all(p[0] is not None for p in parts):
                found = set().union(*(p[0] for p in parts))
            elif all(p[1] for p in parts):
                inner = [set().union(*(min(p[1], key=len) for p in parts))]
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            low, high, body = arg
            some, within = _query(body)
            if some is not None and high is not rc.MAXREPEAT and int(high) <= 8:
                found = set()
                for n in range(low, int(high) + 1):
                    found |= {"".join(x) for x in product(some, repeat=n)} if len(some) ** n <= MOST_STRINGS else {None}
                found = None if None in found else found
            if found is None and low:
                inner = within
        if found is not None and len(found) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in found}
        else:
            flush()
            clauses.extend(inner)
            exact = None
            if found is not None and len(found) <= MOST_STRINGS:
                run = set(found)
    if exact is not None:
        exact = run
    else:
        flush()
    return exact, clauses


def trigram_query(pattern: str) -> list[set[frozenset[str]]]:
    """Clauses (all hold), each of alternatives (one holds), each of trigrams (all occur). None: scan fully."""
    exact, clauses = _query(rp.parse(pattern))
    if exact is not None:
        alternatives = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in exact}
        clauses = [] if frozenset() in alternatives else [alternatives]
    return clauses


def vocabulary(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for clause in trigram_query(r.pattern) for a in clause for t in a})


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id), one per text and trigram that it holds."""
    low = F.array(ascii_lower(F.coalesce("text", F.lit(""))))
    # the text is lowered once: it's the element of a one-element array
    held = F.element_at(F.transform(low, lambda t: F.filter(F.array(*map(F.lit, trigrams)), lambda x: F.contains(t, x))), 1)
    return docs.select("doc_id", F.explode(held).alias("trigram")).select("trigram", "doc_id")


def candidates(postings: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): rules whose trigram queries the document's postings satisfy."""
    names = {t: f"t{i}" for i, t in enumerate(vocabulary(rules))}
    has = postings.groupBy("doc_id").agg(*[F.max(F.col("trigram") == t).alias(n) for t, n in names.items()])

    def holds(rule: Rule) -> Column:
        out = F.lit(True)
        for clause in trigram_query(rule.pattern):
            some = F.lit(False)
            for a in sorted(clause, key=sorted):
                every = F.lit(True)
                for t in sorted(a):
                    every = every & F.col(names[t])
                some = some | every
            out = out & some
        return out

    indexed = [r for r in rules if trigram_query(r.pattern)]
    kinds = F.filter(F.array(*[F.when(holds(r), F.lit(r.kind)) for r in indexed]), lambda k: k.isNotNull())
    return has.select("doc_id", kinds.alias("kinds")).where(F.size("kinds") > 0)


def find_spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, ord, end, kind), in code points, of a rule's leftmost non-overlapping matches in a text."""
    kind = "array<struct<start:int,ord:int,end:int,kind:string>>"

    def placed(found: Column, long: Column, between: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            start = a["at"] + F.length(F.get(between, i))
            end = start + F.length(F.get(found, i))
            one = F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(rule.kind).alias("kind"))
            return F.struct(end.alias("at"), F.when(F.length(F.get(long, i)) >= rule.least, F.array_append(a["out"], one)).otherwise(a["out"]).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), step)["out"]

    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    parts = F.struct(matches.alias("f"), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("g"), F.split(text, rule.pattern, -1).alias("b"))
    return F.when(F.rlike(text, F.lit(rule.pattern)), let(parts, lambda x: placed(x["f"], x["g"], x["b"]))).otherwise(F.array().cast(kind))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, found): per row of documents its spans as an array of (start, ord, end, kind) by start and kind."""
    # texts stay where they are while their candidates are few
    some = bounded(candidates(build_index(docs, vocabulary(rules)), rules).withColumnRenamed("doc_id", "_id"), MOST_BROADCAST)
    kind = "array<struct<start:int,ord:int,end:int,kind:string>>"
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(some, rows["doc_id"].eqNullSafe(some["_id"]), "left").drop("_id")
    spans = []
    for i, r in enumerate(rules):
        found = find_spans(F.col("text"), r, i)
        spans.append(F.when(F.array_contains("kinds", r.kind), found).otherwise(F.array().cast(kind)) if trigram_query(r.pattern) else found)
    return rows.select("doc_id", F.sort_array(F.concat(*spans)).alias("found"))


def digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    said = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = [r.kind for r in RULES[:3]]
    return scan(docs).select(
        "doc_id",
        *[F.size(F.filter("found", _is(k))).cast("bigint").alias(f"n_{k}") for k in base],
        F.sha2(said(F.filter("found", lambda s: s["ord"] < len(base))), 256).alias("base_sha256"),
        said(F.col("found")).alias("spans"),
    )


def _is(kind: str):
    return lambda s: s["kind"] == kind
