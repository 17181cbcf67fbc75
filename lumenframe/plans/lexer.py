"""A small SQL lexer: enough to rewrite text without touching strings and comments."""

from __future__ import annotations

import re
from dataclasses import dataclass

_TOKEN = re.compile(
    r"""(?s)(?P<space>\s+|--[^\n]*|/\*.*?\*/)|(?P<string>'(?:[^']|'')*')|(?P<name>"(?:[^"]|"")*"|`(?:[^`]|``)*`|[^\W\d]\w*)"""
    r"""|(?P<param>\$\w+|\?)|(?P<number>\d+(?:\.\d*)?(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?)|(?P<op>::|<=|>=|<>|!=|\|\||->>|->|=>|:=|\*\*|//|.)"""
)


@dataclass(frozen=True)
class Token:
    kind: str  # space, string, name, param, number or op
    text: str

    @property
    def word(self) -> str:
        """Upper-cased text of a bare word, else the text."""
        return self.text.upper() if self.kind == "name" and self.text[0] not in "\"`" else self.text


def tokens(sql: str) -> list[Token]:
    return [Token(m.lastgroup or "op", m[0]) for m in _TOKEN.finditer(sql)]


def text(parts: list[Token]) -> str:
    return "".join(t.text for t in parts)


def solid(parts: list[Token]) -> list[Token]:
    """Without white space and comments."""
    return [t for t in parts if t.kind != "space"]


def split_top(parts: list[Token], on: str) -> list[list[Token]]:
    """Pieces between tokens ``on`` that stand outside parentheses and brackets."""
    out: list[list[Token]] = [[]]
    depth = 0
    for t in parts:
        if t.kind == "op" and t.text in "([{":
            depth += 1
        elif t.kind == "op" and t.text in ")]}":
            depth -= 1
        if depth == 0 and t.word == on:
            out.append([])
        else:
            out[-1].append(t)
    return out


def statements(sql: str) -> list[str]:
    """The statements of a script, without empty ones."""
    return [s for piece in split_top(tokens(sql), ";") if solid(piece) and (s := text(piece).strip())]


def find_top(parts: list[Token], *words: str, start: int = 0) -> int:
    """Index of the first of these bare words outside parentheses, or -1."""
    depth = 0
    for i, t in enumerate(parts):
        if t.kind == "op" and t.text in "([{":
            depth += 1
        elif t.kind == "op" and t.text in ")]}":
            depth -= 1
        elif depth == 0 and i >= start and t.kind == "name" and t.word in words:
            return i
    return -1
