"""Text functions as column expressions: excerpts, failure focus, paths, patches, model replies."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the data contract.
PATCH_OPEN, PATCH_CLOSE = "<<<PATCH>>>", "<<<END>>>"
TAIL_CHARS = 60_001
#: What marks a failing line, and the notes beside an excerpt of an output.
FAILURE_MARKS = (
    "Traceback (most recent call last)", "AssertionError", "SyntaxError", "NameError", "TypeError", "ValueError", "KeyError", "AttributeError",
    "ImportError", "RuntimeError", "error(s)", "FAILED", "FAIL:", " FAIL ", "FAIL ", "  x  ", "✗",
)
OMITTED = ("… ", " earlier lines of passing output omitted …\n")
UNMARKED = ("(no recognised failure marker in this suite's output; showing the last                  ", " lines verbatim)\n")
BEFORE_MARK, AFTER_MARK, NO_MARK_LINES = 12, 40, 40


def quoted(text: str) -> str:
    """A regex that matches ``text`` itself."""
    return re.escape(text)


def lines_of(text: Column) -> Column:
    """Lines without a trailing empty one and without carriage returns."""
    t = F.regexp_replace(F.regexp_replace(text, r"\r\n", "\n"), r"\n\z", "")
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(t, "\n"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it: within a lambda it would run again for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def excerpt(text: Column, line: Column, radius: int) -> Column:
    """The lines within ``radius`` of ``line`` (from 1), each numbered and ended, with ``>`` at the line itself; clamped to
    the text."""
    number = lambda n: F.concat(F.repeat(F.lit(" "), F.greatest(5 - F.length(n), F.lit(0))), n)

    def shown(s: Column) -> Column:
        part = F.slice(s["rows"], s["lo"], F.greatest(F.least(F.size(s["rows"]), s["line"] + radius), s["lo"]) - s["lo"] + 1)
        return F.array_join(F.transform(part, lambda x, i: F.concat(F.when(i + s["lo"] == s["line"], ">").otherwise(" "), number((i + s["lo"]).cast("string")), F.lit(" | "), x, F.lit("\n"))), "")

    first = lambda s: F.least(F.greatest(F.lit(1), s["line"] - radius), F.size(s["rows"]))
    return let(F.struct(F.split(text, "\n").alias("rows"), line.alias("line")), lambda s: let(F.struct(s["rows"].alias("rows"), s["line"].alias("line"), first(s).alias("lo")), shown))


def focus_failure(output: Column) -> Column:
    """The window around the last line that holds a failure mark; without one, the last lines and a note that says so."""

    def around(s: Column) -> Column:
        rows, last = s["rows"], s["last"]
        lo, hi = F.greatest(last - BEFORE_MARK, F.lit(0)), F.least(last + AFTER_MARK, F.size(rows))
        near = F.concat(F.when(lo > 0, F.concat(F.lit(OMITTED[0]), lo.cast("string"), F.lit(OMITTED[1]))).otherwise(""), F.array_join(F.slice(rows, lo + 1, hi - lo), "\n"))
        first = F.greatest(F.size(rows) - NO_MARK_LINES, F.lit(0))
        plain = F.concat(F.lit(UNMARKED[0]), (F.size(rows) - first).cast("string"), F.lit(UNMARKED[1]), F.array_join(F.slice(rows, first + 1, NO_MARK_LINES), "\n"))
        return F.when(last.isNull(), plain).otherwise(near)

    def last_marked(rows: Column) -> Column:
        marked = F.filter(F.transform(rows, lambda x, i: F.when(_marked(x), i)), lambda i: i.isNotNull())
        return F.struct(rows.alias("rows"), F.try_element_at(marked, F.lit(-1)).alias("last"))

    return let(lines_of(output), lambda rows: let(last_marked(rows), around))


def _marked(line: Column) -> Column:
    out = F.lit(False)
    for m in FAILURE_MARKS:
        out = out | F.contains(line, F.lit(m))
    return out


def strip_worktree(text: Column, work: str, repo: str) -> Column:
    """Paths below the work folder lose it and the worker's own segment; the bare folder, and a worker's, become ``repo``."""
    work = work.rstrip("/")
    inside = F.regexp_replace(text, quoted(work) + "/[^/\\s]*/", "")
    return F.replace(F.regexp_replace(inside, quoted(work) + r"/[^/\s'\",:;)]*", repo), F.lit(work), F.lit(repo))


def tail_window(output: Column) -> Column:
    """The end of an output without trailing white space, at most ``TAIL_CHARS`` characters."""
    return F.right(F.regexp_replace(output, r"\s+$", ""), F.lit(TAIL_CHARS))


def extract_patch(reply: Column) -> tuple[Column, Column]:
    """(patch, error): the last closed block; errors are empty, unclosed and missing."""
    block = F.try_element_at(F.regexp_extract_all(reply, F.lit(f"(?s){PATCH_OPEN}(.*?){PATCH_CLOSE}"), F.lit(1)), F.lit(-1))
    body = F.regexp_replace(block, r"^\n+", "")
    empty = F.regexp_replace(body, r"\s+", "") == ""
    error = F.when(block.isNotNull() & empty, "empty").when(block.isNull() & F.contains(reply, F.lit(PATCH_OPEN)), "unclosed").when(block.isNull(), "missing")
    return F.when(~empty, body), error


def patched_files(diff: Column) -> Column:
    """Files that a diff names in its headers, each once, without a/ and b/ prefixes."""
    named = F.regexp_extract_all(diff, F.lit(r"(?m)^(?:\+\+\+ |--- (?=a/))([^\t\n]+)"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(named, lambda x: F.regexp_replace(F.trim(x), "^(?:[ab]/)+", "")), lambda x: (x != "/dev/null") & (x != "")))


def in_contract(files: Column, allowed: Column) -> Column:
    return F.size(F.filter(files, lambda f: f != allowed)) == 0


def completion(diff: Column) -> Column:
    return F.concat(F.lit(PATCH_OPEN + "\n"), diff, F.when(F.endswith(diff, F.lit("\n")), "").otherwise("\n"), F.lit(PATCH_CLOSE + "\n"))


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def clean_query(answer: Column) -> Column:
    """One query line of a chat answer. Backticks around the answer and around a line go, then a line's semicolons; the first line that
    starts with ``from`` wins, or else the first line."""
    ticks = lambda x: F.regexp_replace(_trimmed(x), "^`+|`+$", "")
    bare = F.transform(F.split(_trimmed(ticks(answer)), "\r?\n"), lambda x: _trimmed(F.regexp_replace(ticks(x), ";+$", "")))
    return F.coalesce(F.try_element_at(F.filter(bare, lambda x: F.rlike(x, F.lit("(?i)^from "))), F.lit(1)), F.element_at(bare, 1))


def strip_list_marker(line: Column) -> Column:
    return F.regexp_replace(line, r"^\s*(?:[-*•] |[0-9]+[.)] )", "")


def clean_prompts(text: Column, want: int) -> Column:
    """Up to ``want`` prompts of a list answer: no markers, quotes, short lines, headings or narration."""
    unquoted = lambda x: F.regexp_replace(F.regexp_replace(_trimmed(x), '^"+|"+$', ""), "^'+|'+$", "")
    bare = F.transform(F.split(text, "\n"), lambda x: _trimmed(unquoted(strip_list_marker(_trimmed(x)))))
    fine = F.filter(bare, lambda x: (F.octet_length(x) >= 4) & ~F.endswith(x, F.lit(":")) & ~F.rlike(x, F.lit("(?i)^(?:here are|sure|certainly)")))
    return F.slice(fine, 1, want)


def match_answers(text: Column, want: int) -> Column:
    """``want`` answers. A listed line counts by its number from 1 to ``want``, the last of equal numbers; other listed
    lines, and unlisted ones that start with ``from``, count by place, where exactly ``want`` of them came; else empty."""
    listed = r"^(?:[-*•] |[0-9]+[.)] )"
    rows = F.transform(F.split(text, "\n"), _trimmed)
    place = lambda x: F.regexp_extract(x, r"^([0-9]+)[.)] ", 1).try_cast("int")
    numbered = lambda x: F.coalesce(place(x).between(1, want), F.lit(False))
    answer = lambda x: clean_query(strip_list_marker(x))
    by_place = F.filter(rows, lambda x: ~numbered(x) & (F.rlike(x, F.lit(listed)) | F.rlike(x, F.lit("(?i)^from "))))
    own = lambda i: F.try_element_at(F.filter(rows, lambda x: numbered(x) & (place(x) == i)), F.lit(-1))
    other = lambda i: F.when(F.size(by_place) == want, F.try_element_at(by_place, i))
    return F.transform(F.sequence(F.lit(1), F.lit(want)), lambda i: F.coalesce(answer(F.coalesce(own(i), other(i))), F.lit("")))


def truncate_note(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("... ("), F.length(text).cast("string"), F.lit(" chars)"))).otherwise(text)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def fill(template: Column, **values: Column) -> Column:
    """{NAME} placeholders replaced."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def bump_int(literal: Column) -> Column:
    """A Rust integer literal plus one, of any length, suffix kept and underscores gone; null for floats and other bases."""
    digits = F.regexp_replace(F.regexp_replace(F.regexp_extract(literal, r"^([0-9][0-9_]*)(?:[iu](?:8|16|32|64|128|size))?$", 1), "_", ""), "^0+(?=.)", "")
    suffix = F.regexp_extract(literal, r"([iu](?:8|16|32|64|128|size))$", 1)
    head = F.regexp_replace(digits, "9+$", "")
    zeros = F.repeat(F.lit("0"), F.length(digits) - F.length(head))
    raised = F.concat(F.left(head, F.length(head) - 1), (F.right(head, F.lit(1)).try_cast("int") + 1).cast("string"))
    return F.when(digits != "", F.concat(F.when(head == "", "1").otherwise(raised), zeros, suffix))


def first_changed_line(diff: Column) -> Column:
    return F.greatest(F.lit(1), F.coalesce(F.regexp_extract(diff, r"(?m)^@@ -[^+\n]*\+([0-9]+)", 1).try_cast("int"), F.lit(1)))
