"""Where operators and literals stand in Rust expressions: a recursive descent over tokens.

``<`` is a comparison where an operator is expected and a bracket of types elsewhere, ``&&`` and ``||`` are Boolean operators where an operator is
expected and references or closures elsewhere, whatever the spacing. An attribute belongs to the item behind it. Arguments of macros are
no syntax yet, and nothing in them counts. Precedence changes no site, so operands and operators are read in one row.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

from pyspark import cloudpickle

_TOKEN = re.compile(
    r"(?P<doc>///(?!/)[^\n]*|/\*\*(?![*/])(?=.))|(?P<gap>\s+|//[^\n]*)|(?P<comment>/\*)"
    r"|(?P<text>(?:br|cr|r)(?P<h>#*)\"(?:.*?)\"(?P=h)|[bc]?\"(?:\\.|[^\"\\])*\"|b?'(?:\\(?:u\{[^}]*\}|x..|.)|[^'\\])')|(?P<life>'[^\W\d]\w*)"
    r"|(?P<num>0[xob][0-9a-fA-F_]+\w*|[0-9][0-9_]*(?:\.[0-9][0-9_]*|\.(?![.\w]))?(?:[eE][+-]?[0-9_]+)?\w*)|(?P<word>(?:r#)?[^\W\d]\w*)"
    r"|(?P<punct>->|=>|::|\.\.=|\.\.\.|\.\.|==|!=|&&|\|\||[-+*/%^&|]=|[-+*/%^&|!=<>@.,;:#$?~(){}\[\]])",
    re.S,
)
_BINARY = ("<<=", ">>=", "<=", ">=", "<<", ">>", "<", ">", "..=", "...", "..", "&&", "||", "==", "!=", "+=", "-=", "*=", "/=", "%=", "^=", "&=", "|=", "=", "+", "-", "*", "/", "%", "^", "&", "|", "as")
_CLOSE = {"(": ")", "[": "]", "{": "}"}
_BLOCKS = {"if", "match", "while", "loop", "for", "unsafe", "{"}
_ENDS = {";", ",", ")", "]", "}", "=>", ""}
_BEFORE_ITEM = {"default", "async", "unsafe", "const", "auto", "safe"}


class ParseError(ValueError):
    pass


def _comment_end(text: str, at: int) -> int:
    depth = 0
    for m in re.compile(r"/\*|\*/").finditer(text, at):
        depth += 1 if m[0] == "/*" else -1
        if not depth:
            return m.end()
    raise ParseError("a comment has no end")


def tokens(text: str) -> list[tuple[str, str, int, int]]:
    """(kind, text, start, end) without white space and comments; doc comments stay, as they belong to items."""
    at, out = 0, []
    if text.startswith("#!") and not re.match(r"#!\s*\[", text):
        at = text.find("\n") if "\n" in text else len(text)
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ParseError(f"unexpected {text[at]!r}")
        kind, end = m.lastgroup if m["text"] is None else "text", m.end()
        if m["comment"] or m["doc"] and m["doc"].startswith("/*"):
            end = _comment_end(text, at)
        if kind not in ("gap", "comment"):
            out.append((kind, text[at:end], at, end))
        at = end
    return out


class Reader:
    """Reads a file and reports each operator and literal with ``found(kind, start, end, scope)``; kind is the operator's text, ``int`` or
    ``bool``. ``excluded`` holds the spans of modules and functions under a ``cfg`` that names test."""

    def __init__(self, text: str, found: Callable[[str, int, int, str], None]):
        self.text, self.all, self.i, self.found = text, tokens(text), 0, found
        self.scopes: list[str] = []
        self.excluded: list[tuple[int, int]] = []
        self.quiet = 0
        self.braced = -1  # behind a macro's closing brace, which ends a statement

    # tokens
    def at(self, k: int = 0) -> str:
        i = self.i + k
        return self.all[i][1] if i < len(self.all) else ""

    def kind(self, k: int = 0) -> str:
        i = self.i + k
        return self.all[i][0] if i < len(self.all) else ""

    def take(self, want: str | None = None) -> tuple[str, str, int, int]:
        if self.i >= len(self.all) or want and self.at() != want:
            near = self.all[self.i] if self.i < len(self.all) else ("", "the end", len(self.text), 0)
            raise ParseError(f"expected {want or 'more'}, found {near[1]} at character {near[2]}")
        self.i += 1
        return self.all[self.i - 1]

    def report(self, what: str, start: int, end: int) -> None:
        if not self.quiet:
            self.found(what, start, end, self.scopes[-1] if self.scopes else "")

    def literal(self) -> None:
        kind, text, start, end = self.take()
        if text in ("true", "false"):
            self.report("bool", start, end)
        elif kind == "num":
            if re.fullmatch(r"0[xob]\w+|[0-9][0-9_]*(?:[iu]\w*)?", text):
                self.report("int", start, end)

    def is_literal(self) -> bool:
        return self.kind() in ("num", "text") or self.at() in ("true", "false")

    # what isn't an expression: types, patterns, signatures
    def scan(self, *stops: str, types: bool = True) -> None:
        """Up to a stop outside of all brackets; literals count. Where ``types`` hold, < and > are brackets."""
        while self.at() not in stops:
            if self.at() in _CLOSE:
                self.group(types)
            elif types and self.at() == "<":
                self.angles()
            elif self.at() == "#":
                self.attributes()
            elif self.is_literal():
                self.literal()
            elif self.kind() == "word" and self.at(1) == "!" and self.at(2) in _CLOSE:
                self.take(), self.take(), self.skip()
            else:
                if not self.at() or self.at() in (")", "]", "}"):
                    raise ParseError(f"unexpected {self.at() or 'end'}")
                self.take()

    def group(self, types: bool = True) -> None:
        end = _CLOSE[self.take()[1]]
        self.scan(end, types=types)
        self.take(end)

    def angles(self) -> None:
        self.take("<")
        self.scan(">")
        self.take(">")

    def skip(self) -> None:
        """A balanced group, unread."""
        end = _CLOSE[self.take()[1]]
        while self.at() != end:
            if self.at() in _CLOSE:
                self.skip()
            elif self.at() in (")", "]", "}", ""):
                raise ParseError("brackets don't match")
            else:
                self.take()
        self.take(end)

    def cast_type(self) -> None:
        while self.at() in ("&", "&&", "*", "mut", "const", "dyn", "impl") or self.kind() == "life":
            self.take()
        if self.at() == "for":
            self.take(), self.angles()
        while self.at() in ("unsafe", "extern") or self.kind() == "text":
            self.take()
        if self.at() in ("(", "["):
            self.group()
        elif self.at() == "fn":
            self.take(), self.group()
            if self.at() == "->":
                self.take(), self.cast_type()
        elif self.at() in ("!", "_"):
            self.take()
        else:
            self.path(generic=True)

    def path(self, generic: bool = False) -> None:
        if self.at() == "<":
            self.angles()
        elif self.at() == "::":
            pass
        else:
            if self.kind() != "word":
                raise ParseError(f"unexpected {self.at() or 'end'}")
            self.take()
        while True:
            if self.at() == "::" and self.at(1) == "<":
                self.take(), self.angles()
            elif self.at() == "::":
                self.take()
                if self.kind() == "word":
                    self.take()
            elif generic and self.at() == "<":
                self.angles()
            else:
                return

    # attributes and items
    def attributes(self) -> tuple[int, bool]:
        """Takes attributes and doc comments: where they began, and whether one is a cfg that names test."""
        start, test = (self.all[self.i][2] if self.i < len(self.all) else len(self.text)), False
        while True:
            if self.kind() == "doc":
                self.take()
            elif self.at() == "#" and (self.at(1) == "[" or self.at(1) == "!" and self.at(2) == "["):
                self.take()
                if self.at() == "!":
                    self.take()
                first, named = self.all[self.i][3], self.at(1) == "cfg" and self.at(2) == "("
                self.skip()
                test = test or named and "test" in self.text[first : self.all[self.i - 1][2]]
            else:
                return start, test

    def file(self) -> None:
        while self.i < len(self.all):
            start, test = self.attributes()
            if self.i < len(self.all) and not self.item(start, test):
                raise ParseError(f"expected an item, found {self.at()}")

    def items(self, of: str) -> None:
        self.take("{")
        while self.at() != "}":
            start, test = self.attributes()
            if self.at() != "}" and not self.item(start, test, of):
                raise ParseError(f"expected an item, found {self.at() or 'end'}")
        self.take("}")

    def item(self, start: int, test: bool, of: str = "mod") -> bool:
        """Takes an item, if one stands here. Test code is read for its end, and nothing in it is reported."""
        begin, const = self.i, False
        if self.at() == "pub":
            self.take()
            if self.at() == "(" and self.at(1) in ("crate", "super", "self", "in"):
                self.skip()
        while self.at() in _BEFORE_ITEM or self.at() == "extern":
            const = self.at() == "const"
            if self.take()[1] == "extern" and self.kind() == "text":
                self.take()
        word = self.at()
        if word == "fn" and self.kind(1) == "word":
            name = self.at(1).removeprefix("r#")
            hidden = test and of in ("mod", "block")
            self.quiet += hidden
            if of != "trait":
                self.scopes.append(name)
            self.scan("{", ";")
            self.block() if self.at() == "{" else self.take(";")
            if of != "trait":
                self.scopes.pop()
            self.quiet -= hidden
            self.drop(hidden, start)
        elif word == "mod" and self.kind(1) == "word":
            self.quiet += test
            self.take(), self.take()
            self.items("mod") if self.at() == "{" else self.take(";")
            self.quiet -= test
            self.drop(test, start)
        elif word in ("impl", "trait") and (word == "impl" or self.kind(1) == "word"):
            self.scan("{", ";")
            self.items(word) if self.at() == "{" else self.take(";")
        elif word in ("struct", "union") and self.kind(1) == "word":
            self.scan("{", ";")
            self.group() if self.at() == "{" else self.take(";")
        elif word == "enum":
            self.scan("{")
            self.variants()
        elif word in ("use", "type") or word == "crate" and self.all[self.i - 1][1] == "extern":
            self.scan("=", ";")
            if self.at() == "=":
                self.take(), self.scan(";")
            self.take(";")
        elif (const and (self.kind() == "word" and word not in ("fn", "move", "async"))) or word == "static" and self.at(1) not in ("|", "||", "move"):
            self.scan("=", ";")
            if self.at() == "=":
                self.take(), self.expression()
            self.take(";")
        elif word == "{" and self.i > begin and any(t[1] == "extern" for t in self.all[begin : self.i]):
            self.items("extern")
        elif word == "macro_rules" and self.at(1) == "!":
            self.take(), self.take(), self.take()
            self.macro_end()
        elif of != "block" and self.i == begin and (self.kind() == "word" or word == "::"):
            self.path()
            self.take("!")
            self.macro_end()
        else:
            self.i = begin
            return False
        return True

    def drop(self, hidden: bool, start: int) -> None:
        if hidden and not self.quiet:
            self.excluded.append((start, self.all[self.i - 1][3]))

    def macro_end(self) -> None:
        braces = self.at() == "{"
        if self.at() not in _CLOSE:
            raise ParseError(f"unexpected {self.at() or 'end'}")
        self.skip()
        if not braces:
            self.take(";")

    def variants(self) -> None:
        self.take("{")
        while self.at() != "}":
            self.attributes()
            self.scan(",", "=", "}")
            if self.at() == "=":
                self.take(), self.expression()
            if self.at() != "}":
                self.take(",")
        self.take("}")

    # statements and expressions
    def block(self) -> None:
        self.take("{")
        while self.at() != "}":
            start, test = self.attributes()
            if self.at() == ";":
                self.take()
            elif self.at() == "}" or self.item(start, test, "block"):
                continue
            elif self.at() == "let":
                self.take()
                self.scan(":", "=", ";", types=False)
                if self.at() == ":":
                    self.take(), self.scan("=", ";")
                if self.at() == "=":
                    self.take(), self.expression()
                if self.at() == "else":
                    self.take(), self.block()
                self.take(";")
            else:
                ended = self.expression(early=True)
                if self.at() == ";":
                    self.take()
                elif self.at() != "}" and not ended and self.braced != self.i:
                    raise ParseError(f"expected ;, found {self.at() or 'end'}")
        self.take("}")

    def operator(self) -> str:
        """The binary operator that stands here, made of adjacent signs."""
        if self.at() in ("<", ">"):
            text, k = self.at(), 1
            while self.i + k < len(self.all) and self.all[self.i + k][2] == self.all[self.i + k - 1][3] and text + self.at(k) in _BINARY:
                text, k = text + self.at(k), k + 1
            return text
        return self.at() if self.at() in _BINARY else ""

    def expression(self, plain: bool = False, early: bool = False) -> bool:
        """Operands and operators in turn. ``plain``: a brace behind a path opens no struct. ``early``: a block at the start ends the
        expression, and the result says so."""
        if early and self.starts_block():
            self.operand(plain, bare=True)
            if self.at() not in (".", "?"):
                return True
            self.postfix(plain)
        else:
            self.operand(plain)
        while op := self.operator():
            start = self.take()[2]
            while self.all[self.i - 1][3] < start + len(op):
                self.take()
            self.report(op, start, start + len(op))
            if op == "as":
                self.cast_type()
                continue
            if op in ("..", "..=") and (self.at() in _ENDS or plain and self.at() == "{"):
                break
            self.operand(plain)
        return False

    def starts_block(self) -> bool:
        word = self.at()
        if self.kind() == "life":
            return self.at(1) == ":"
        return word in _BLOCKS and (word != "unsafe" or self.at(1) == "{") or word in ("const", "async", "try") and "{" in (self.at(1), self.at(2) if self.at(1) == "move" else "")

    def operand(self, plain: bool, bare: bool = False) -> None:
        self.attributes()
        while self.at() in ("-", "!", "*", "&", "&&"):
            if self.take()[1] in ("&", "&&"):
                if self.at() == "raw" and self.at(1) in ("const", "mut"):
                    self.take(), self.take()
                elif self.at() == "mut":
                    self.take()
        word = self.at()
        if self.is_literal():
            self.literal()
        elif self.starts_block():
            self.blocklike()
            if bare:
                return
        elif word in ("..", "..="):
            self.take()
            if self.at() not in _ENDS and not (plain and self.at() == "{"):
                self.operand(plain)
            return
        elif word in ("return", "break", "continue", "yield"):
            self.take()
            if self.kind() == "life":
                self.take()
            if word != "continue" and self.at() not in _ENDS and not (plain and self.at() == "{"):
                self.expression(plain)
            return
        elif word == "let":
            self.take()
            self.scan("=", types=False)
            self.take("=")
            self.operand(plain)
            return
        elif word in ("|", "||") or word in ("move", "static", "async", "for") and self.at(1) in ("|", "||", "move", "async", "<"):
            while self.at() not in ("|", "||"):
                self.angles() if self.at() == "<" else self.take()
            if self.take()[1] == "|":
                self.scan("|")
                self.take("|")
            if self.at() == "->":
                self.take(), self.scan("{")
                self.block()
            else:
                self.expression(plain)
            return
        elif word == "(" or word == "[":
            self.listed()
        elif word == "<" or word == "::" or self.kind() == "word":
            self.path()
            if self.at() == "!" and self.at(1) in _CLOSE:
                braces = self.take() and self.at() == "{"
                self.skip()
                self.braced = self.i if braces else self.braced
            elif self.at() == "{" and not plain:
                self.fields()
        else:
            raise ParseError(f"expected an expression, found {word or 'the end'}")
        self.postfix(plain)

    def postfix(self, plain: bool) -> None:
        while True:
            if self.at() == ".":
                self.take()
                self.take()
                if self.at() == "::":
                    self.take(), self.angles()
            elif self.at() in ("(", "["):
                self.listed()
            elif self.at() == "?":
                self.take()
            else:
                return

    def listed(self) -> None:
        """Expressions in brackets, with commas or a semicolon between."""
        end = _CLOSE[self.take()[1]]
        while self.at() != end:
            self.attributes()
            self.expression()
            if self.at() != end:
                if self.at() not in (",", ";"):
                    raise ParseError(f"expected {end}, found {self.at() or 'the end'}")
                self.take()
        self.take(end)

    def fields(self) -> None:
        self.take("{")
        while self.at() != "}":
            self.attributes()
            if self.at() == "..":
                self.take()
                if self.at() != "}":
                    self.expression()
                break
            self.take()
            if self.at() == ":":
                self.take(), self.expression()
            if self.at() != "}":
                self.take(",")
        self.take("}")

    def blocklike(self) -> None:
        if self.kind() == "life":
            self.take(), self.take(":")
        word = self.at()
        if word == "{":
            self.block()
        elif word in ("unsafe", "const", "async", "try", "loop"):
            self.take()
            if self.at() == "move":
                self.take()
            self.block()
        elif word == "while":
            self.take(), self.expression(plain=True), self.block()
        elif word == "for":
            self.take(), self.scan("in", types=False)
            self.take("in"), self.expression(plain=True), self.block()
        elif word == "if":
            self.take(), self.expression(plain=True), self.block()
            if self.at() == "else":
                self.take()
                self.blocklike() if self.at() == "if" else self.block()
        elif word == "match":
            self.take(), self.expression(plain=True), self.take("{")
            while self.at() != "}":
                self.attributes()
                if self.at() == "}":
                    break
                self.scan("=>", "if", types=False)
                if self.at() == "if":
                    self.take(), self.expression()
                self.take("=>")
                ended = self.expression(early=True)
                if self.at() == ",":
                    self.take()
                elif self.at() != "}" and not ended:
                    raise ParseError(f"expected a comma, found {self.at() or 'the end'}")
            self.take("}")
        else:
            raise ParseError(f"expected a block, found {word or 'the end'}")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
