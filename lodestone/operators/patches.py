"""Unified diffs as columns: make one, apply one or take it back."""

from __future__ import annotations

import re
import sys
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

CONTEXT = 3


NO_NEWLINE = "\\ No newline at end of file\n"


def split(text: str) -> list[str]:
    """Lines with their newlines; the last may have none."""
    return re.findall(r"[^\n]*\n|[^\n]+", text)


def _shown(sign: str, line: str) -> str:
    return sign + (line if line.endswith("\n") else line + "\n" + NO_NEWLINE)


def make_hunk(path: str, a: str, b: str) -> str:
    """One hunk from the first to the last difference; empty for equal texts."""
    x, y = split(a), split(b)
    if x == y:
        return ""
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    lo, after = max(0, head - CONTEXT), min(tail, CONTEXT)
    old, new = x[lo : len(x) - tail + after], y[lo : len(y) - tail + after]
    body = [_shown(" ", s) for s in x[lo:head]] + [_shown("-", s) for s in x[head : len(x) - tail]] + [_shown("+", s) for s in y[head : len(y) - tail]]
    body += [_shown(" ", s) for s in x[len(x) - tail : len(x) - tail + after]]
    place = lambda part: f"{lo + 1 if part else lo},{len(part)}"
    return f"--- a/{path}\n+++ b/{path}\n@@ -{place(old)} +{place(new)} @@\n" + "".join(body)


def _body(text: str) -> list[tuple[str, str]]:
    """(sign, line) of a hunk."""
    out: list[tuple[str, str]] = []
    for s in split(text):
        if s[0] == "\\" and out:
            out[-1] = (out[-1][0], out[-1][1].removesuffix("\n"))
        elif s[0] in " -+":
            out.append((s[0], s[1:]))
    return out


def apply_patch_text(text: str, diff: str, reverse: bool = False) -> str | None:
    """The text after a diff, or before it with ``reverse``. A hunk goes where its lines stand, nearest to the place it names;
    None where they stand nowhere."""
    rows = apply_lines(split(text), diff, reverse)
    return None if rows is None else "".join(rows)


def _places(rows: list[str], old: list[str], at: int) -> Iterator[int]:
    """Where lines stand, from a place on: found by the first of them."""
    last = len(rows) - len(old)
    while at <= last:
        try:
            at = rows.index(old[0], at, last + 1)
        except ValueError:
            return
        if rows[at : at + len(old)] == old:
            yield at
        at += 1


def _hunks(diff: str, reverse: bool) -> list[tuple[int, list[str], list[str]]]:
    """(place named, lines that go, lines that come) of a diff's hunks, context among both."""
    parts, out = re.split(r"(?m)^@@ -(\d+)(?:,\d+)? \+(\d+)(?:,\d+)? @@.*\n", diff), []
    for k in range(1, len(parts) - 2, 3):
        start, body = int(parts[k + reverse]), _body(parts[k + 2])
        gone, come = ("+", "-") if reverse else ("-", "+")
        old = [s for sign, s in body if sign in (" ", gone)]
        out.append((start - 1 if old else start, old, [s for sign, s in body if sign in (" ", come)]))
    return out


def apply_lines(rows: list[str], diff: str, reverse: bool = False) -> list[str] | None:
    """As ``apply_patch_text``, on lines."""
    out, at = [], 0
    hunks = _hunks(diff, reverse)
    for named, old, new in hunks:
        fits = list(_places(rows, old, at)) if old else [named] * (at <= named <= len(rows))
        if not fits:
            return None
        place = min(fits, key=lambda p: abs(p - named))  # noqa: B023
        out += rows[at:place] + new
        at = place + len(old)
    return out + rows[at:] if hunks else None


class Text:
    """A text that many diffs are applied to: where a line stands is looked up, and what a diff leaves alone isn't copied.

    An edited text is a list of pieces: (from, to, None) of this text's lines, or (0, n, lines) of a diff's."""

    def __init__(self, text: str):
        self.rows = split(text)
        self.at: dict[str, list[int] | int] = {}
        for i, s in enumerate(self.rows):
            was = self.at.setdefault(s, i)
            if was is not i:
                if isinstance(was, list):
                    was.append(i)
                else:
                    self.at[s] = [was, i]

    def _standing(self, line: str, lo: int, hi: int) -> list[int]:
        found = self.at.get(line, ())
        found = [found] if isinstance(found, int) else found
        return found[bisect_left(found, lo) : bisect_left(found, hi)]

    def _count(self, line: str) -> int:
        found = self.at.get(line, ())
        return 1 if isinstance(found, int) else len(found)

    def _cut(self, pieces: list[tuple], lo: int, hi: int) -> list[tuple]:
        """The pieces of the lines from one place to another."""
        out, base = [], 0
        for a, b, own in pieces:
            x, y = max(lo - base, 0) + a, min(hi - base, b - a) + a
            if x < y:
                out.append((x, y, own))
            base += b - a
        return out

    def lines(self, pieces: list[tuple]) -> list[str]:
        return [s for a, b, own in pieces for s in (self.rows if own is None else own)[a:b]]

    def _places(self, pieces: list[tuple], old: list[str], at: int) -> list[int]:
        """Where lines stand, from a place on: found by the rarest of them."""
        j = min(range(len(old)), key=lambda i: self._count(old[i]))
        out, base, total = [], 0, sum(b - a for a, b, _ in pieces)
        for a, b, own in pieces:
            for k in self._standing(old[j], a, b) if own is None else (i for i in range(a, b) if own[i] == old[j]):
                p = base + k - a - j
                if at <= p <= total - len(old) and self.lines(self._cut(pieces, p, p + len(old))) == old:
                    out.append(p)
            base += b - a
        return out

    def apply(self, diff: str, reverse: bool = False, pieces: list[tuple] | None = None) -> list[tuple] | None:
        """As ``apply_lines``, on this text or on pieces of an edit of it."""
        if pieces is None:
            pieces = [(0, len(self.rows), None)]
        out, at, total = [], 0, sum(b - a for a, b, _ in pieces)
        hunks = _hunks(diff, reverse)
        for named, old, new in hunks:
            fits = self._places(pieces, old, at) if old else [named] * (at <= named <= total)
            if not fits:
                return None
            place = min(fits, key=lambda p: abs(p - named))  # noqa: B023
            out += [*self._cut(pieces, at, place), (0, len(new), new)]
            at = place + len(old)
        return out + self._cut(pieces, at, total) if hunks else None

    def fresh(self, pieces: list[tuple]) -> str:
        """The lines of an edited text that this text doesn't have anywhere."""
        new = [s for a, b, own in pieces if own is not None for s in own[a:b] if s not in self.at]
        return "".join(s if s.endswith("\n") or s is new[-1] else s + "\n" for s in new)


def unified_hunk(path: Column, a: Column, b: Column) -> Column:
    """By Arrow batches: as column functions over arrays of lines it took three times as long."""

    @pandas_udf("string")
    def run(p: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if u is None or v is None else make_hunk(t, u, v) for t, u, v in zip(p, x, y, strict=True)])

    return run(path, a, b)


def apply_patch(text: Column, diff: Column, reverse: bool = False) -> Column:
    @pandas_udf("string")
    def run(t: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else apply_patch_text(x, y, reverse) for x, y in zip(t, d, strict=True)])

    return run(text, diff)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
