"""Name-value pairs of source code and configuration, read once from left to right.

Strings, comments, brackets and operators are told apart by a lexer that never goes back: every character is consumed
once, so the time is proportional to the text. What it reads as an assignment: ``name = value``, ``name: value``, ``name := value``,
``name => value``, with a type between name and ``=``, quoted and bracketed keys, attributes of tags, ``#define``,
several names and values side by side, and indented blocks after ``name: |``. A value is a literal, a name, a call with
literals or names in it, a list, or several of these put together by ``+`` or by standing side by side.

Comments hold no assignments: ``#`` and ``--`` after white space, ``//`` except in a URL, ``/* */``. Strings hold none
either. A name belongs to the innermost function or class that it is assigned in.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# What the lexer stops at: strings, comments, assignments, ends of lines, braces.
_MARK = re.compile(r"""\"\"\"|'''|["'`]|/\*|//|\#|--(?=[ \t\r\n]|$)|:=|=>|==+|!=|<=|>=|::|=|:(?!//)|\r\n|[\r\n{}]""")
_ASSIGNS = {"=", ":", ":=", "=>"}
_BARE = re.compile(r"""[^\s"'`;,#(){}\[\]=:&|<>]+(?:={1,2}(?=[\s,;&"')\]}]|$))?""")
_WORD = re.compile(r"[A-Za-z_$][\w$]*(?:[.-][\w$]+)*", re.ASCII)
_KEY = re.compile(r"[A-Za-z_$][\w$.-]*", re.ASCII)
_PREFIX = re.compile(r"[rbfuRBFU]{1,2}(?=[\"'])")
_DEFINE = re.compile(r"#define[ \t]+([A-Za-z_]\w*)[ \t]+", re.ASCII)
_OPENS = re.compile(
    r"[ \t]*(?:(?:pub|public|private|protected|static|async|export|default)[ \t]+)*(def|function|func|fn|sub|class)\b[ \t]*([\w$]*)"
)
_CHAINS = re.compile(r"=(?![=>])|:(?![/:=])")
_BLANKS = re.compile(r"[ \t]*")
_WHITE = re.compile(r"\s*")
# Calls whose first argument names a setting and is no value.
_GETTERS = {"get", "getenv", "getproperty", "env"}


@dataclass
class Part:
    """A literal (span of its content) or a name."""

    start: int
    end: int
    name: str = ""


@dataclass
class Assignment:
    """A target in its scope, and the parts of its value; ``joined`` if they are put together to one text."""

    scope: int
    name: str
    parts: list[Part] = field(default_factory=list)
    joined: bool = False


class Reader:
    """The assignments of one text, in order, and the scopes they stand in."""

    def __init__(self, text: str):
        self.text, self.size = text, len(text)
        self.found: list[Assignment] = []
        self.outer: list[int] = [-1]  # the scope around each scope; 0 is the text
        self.classes: dict[str, int] = {}
        self.open: list[tuple[int, int, int]] = []  # scope, indentation and braces where it began
        self.braces = 0
        self.indent = 0  # of the line that is read
        self.never: set[str] = set()  # closing marks that do not come again
        self.unclosed: dict[str, int] = {}  # by quote, up to where no string was found to end
        self._read()

    # Strings and comments

    def _close(self, mark: str, at: int) -> int:
        """Where ``mark`` comes next, -1 if it does not; a mark that does not come is looked for once."""
        if mark in self.never:
            return -1
        found = self.text.find(mark, at)
        if found < 0:
            self.never.add(mark)
        return found

    def _string(self, at: int) -> tuple[int, int, int] | None:
        """Start and end of a string's content and the place after it; None if it does not end (on its line)."""
        text = self.text
        if (mark := text[at : at + 3]) in ('"""', "'''"):
            end = self._close(mark, at + 3)
            return None if end < 0 else (at + 3, end, end + 3)
        quote, k = text[at], at + 1
        if at < self.unclosed.get(quote, 0):
            return None
        stops = _STOPS[quote]
        while found := stops.search(text, k):
            k = found.start()
            if text[k] == "\\":
                k += 2
            elif text[k] == quote:
                return at + 1, k, k + 1
            else:
                self.unclosed[quote] = k
                return None
        self.unclosed[quote] = self.size
        return None

    def _after_line(self, at: int) -> int:
        found = _LINE_END.search(self.text, at)
        return found.start() if found else self.size

    # The text

    def _read(self) -> None:
        text, at, gap = self.text, 0, 0  # ``gap``: end of what was read last
        key: tuple[int, int] | None = None  # a string that may turn out to be a key
        at = gap = self._new_line(0)
        while mark := _MARK.search(text, at):
            what, start, at = mark[0], mark.start(), mark.end()
            if what[0] in "\"'`":
                if string := self._string(start):
                    key, at = string[:2], string[2]
                    gap = at
            elif what == "/*":
                end = self._close("*/", at)
                at = gap = self.size if end < 0 else end + 2
            elif what == "//":
                if not start or text[start - 1] != ":":
                    at = gap = self._after_line(at)
            elif what == "#" or what == "--":
                if what == "#" and (define := _DEFINE.match(text, start)):
                    at = gap = self._values([define[1]], define.end())
                elif start == 0 or text[start - 1].isspace():
                    at = gap = self._after_line(at)
            elif what in _ASSIGNS:
                names = self._targets(gap, start, key)
                key, gap = None, at
                if names:
                    at = gap = self._values(names, at, annotated=what == ":")
            elif what == "{":
                self.braces, gap = self.braces + 1, at
            elif what == "}":
                self.braces, gap = max(0, self.braces - 1), at
            elif what[0] in "\r\n":
                at = gap = self._new_line(at)
                key = None
            else:
                gap = at

    def _new_line(self, at: int) -> int:
        """Open and close scopes by the line that begins at ``at``."""
        text = self.text
        inner = _BLANKS.match(text, at).end()
        if inner >= self.size or text[inner] in "\r\n":
            return at
        indent = self.indent = inner - at
        while self.open and indent <= self.open[-1][1] and self.braces <= self.open[-1][2] and text[inner] != "{":
            self.open.pop()
        opened = _OPENS.match(text, at)
        if opened:
            self.outer.append(self._scope())
            scope = len(self.outer) - 1
            if opened[1] == "class" and opened[2]:
                self.classes[opened[2]] = scope
            self.open.append((scope, indent, self.braces))
        return at

    def _scope(self) -> int:
        return self.open[-1][0] if self.open else 0

    def _targets(self, gap: int, op: int, key: tuple[int, int] | None) -> list[str]:
        """Names that stand before an operator: several side by side, one, or a quoted key."""
        before = self.text[gap:op]
        bare = before.strip(" \t")
        if not bare or bare == "]":
            return [self.text[key[0] : key[1]]] if key and key[1] > key[0] and "\n" not in self.text[key[0] : key[1]] else []
        pieces = [p.strip(" \t") for p in bare.split(",")]
        if len(pieces) > 1 and all(_KEY.fullmatch(p) for p in pieces):
            return pieces
        last = bare.rpartition(" ")[2].rpartition("\t")[2].rstrip("]?")
        k = len(last)
        while k and (last[k - 1] in "_$.-" or (last[k - 1].isascii() and last[k - 1].isalnum())):
            k -= 1
        found = _KEY.search(last, k)
        return [found[0].rstrip(".-")] if found else []

    # Values

    def _values(self, names: list[str], at: int, annotated: bool = False) -> int:
        """Read what is assigned to ``names``; returns the place after it."""
        text, scope = self.text, self._scope()
        while True:
            made = []
            for k, name in enumerate(names):
                one = Assignment(scope, name)
                at = self._value(one, at)
                made.append(one)
                after = _BLANKS.match(text, at).end()
                if k + 1 == len(names) or text[after : after + 1] != ",":
                    break
                at = after + 1
            if len(made) < len(names):  # fewer values than names: they belong to the last one
                for one in made:
                    one.name = names[-1]
            mark = _CHAINS.match(text, after)
            if len(made) == 1 and mark and len(one.parts) == 1 and one.parts[0].name and not one.joined:
                at = mark.end()
                if not (annotated and mark[0] == "="):  # else a type stood between name and value
                    self.found.append(one)
                    names = [one.parts[0].name]
                annotated = mark[0] == ":"
                continue
            self.found += [one for one in made if one.parts]
            return at

    def _value(self, out: Assignment, at: int) -> int:
        """Read one value into ``out``: elements, put together or side by side in brackets."""
        text, depth = self.text, 0
        skip: list[bool | None] = []  # per open bracket: whether an argument is left out; None for a bracket around a value
        while True:
            at = (_WHITE if depth or out.joined else _BLANKS).match(text, at).end()
            if at >= self.size:
                return at
            c = text[at]
            if prefix := _PREFIX.match(text, at):
                at, c = prefix.end(), text[prefix.end()]
            if c in "\"'`":
                string = self._string(at)
                if not string:
                    return at if depth else self._after_line(at)
                if not (skip and skip[-1]):
                    out.parts.append(Part(string[0], string[1]))
                    out.parts += [Part(0, 0, n) for n in _braced(text[string[0] : string[1]])] if prefix else []
                at = string[2]
            elif c in "([":
                depth, at = depth + 1, at + 1
                skip.append(None if c == "(" else False)
                continue
            elif c in "|>" and not out.parts and not depth:
                return self._block(out, at)
            elif bare := _BARE.match(text, at):
                end = bare.end()
                if (cut := text.find("//", at, end)) >= 0:
                    end = cut
                word = _WORD.fullmatch(text, at, end)
                if word and end < self.size and text[end] == "(":
                    skip.append(word[0].replace("-", ".").rpartition(".")[2].lower() in _GETTERS)
                    depth, at = depth + 1, end + 1
                    continue
                if depth and word and end < self.size and text[_BLANKS.match(text, end).end() : end + 1].startswith("="):
                    return at  # a named argument is an assignment of its own
                if end > at and not (skip and skip[-1]):
                    out.parts += self._bare(at, end, bool(word))
                if end == at:
                    return at
                at = end
            elif not depth:
                return at
            # After an element
            while True:
                there = (_WHITE if depth else _BLANKS).match(text, at).end()
                c = text[there : there + 1]
                if depth and c and c in ")]":
                    depth, at = depth - 1, there + 1
                    skip.pop()
                    continue
                break
            if c == "+" or (c and c in "\"'" and out.parts and not out.parts[-1].name and text[at - 1 : at] in ('"', "'")):
                out.joined = out.joined or all(s is None for s in skip)
                at = there + (c == "+")
            elif depth and c == ",":
                at = there + 1
                skip[-1] = False if skip[-1] else skip[-1]
            elif depth and c and c not in "{};\"'`" and not text.startswith(("//", "/*"), there):
                at = there + 1 if not _BARE.match(text, there) and c not in "([" else there
            elif depth and c and c in "\"'`":
                at = there
            else:
                return at

    def _bare(self, start: int, end: int, word: bool) -> list[Part]:
        """An unquoted value: a name, names with plus signs between them, or a literal."""
        text = self.text
        if word:
            return [Part(start, end, text[start:end])]
        pieces = text[start:end].split("+")
        if len(pieces) > 1 and all(_WORD.fullmatch(p) for p in pieces):
            return [Part(start, end)] + [Part(0, 0, p) for p in pieces]
        return [Part(start, end)]

    def _block(self, out: Assignment, at: int) -> int:
        """Lines below ``name: |`` that are indented further than the line it stands in."""
        text = self.text
        at = self._after_line(at)
        while at < self.size:
            begin = at + (2 if text.startswith("\r\n", at) else 1)
            inner = _BLANKS.match(text, begin).end()
            end = self._after_line(begin)
            if inner < end and inner - begin <= self.indent:
                break
            if inner < end:
                out.parts.append(Part(inner, end))
            at = end
        return at


def _braced(content: str) -> list[str]:
    """Names in braces of a string."""
    return re.findall(r"\{([A-Za-z_][\w.]*)\}", content)


_STOPS = {q: re.compile(rf"[\\{q}]" if q == "`" else rf"[\\{q}\r\n]") for q in "\"'`"}
_LINE_END = re.compile(r"[\r\n]")
