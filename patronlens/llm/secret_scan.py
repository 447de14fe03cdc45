"""Secrets in texts: three plain patterns, and literals that flow into names of secrets.

The plain patterns are applied as they stand. Beside them, a text is read as source code or configuration
(:mod:`patronlens.llm.lexing`): assignments become pairs of a name and a literal or another name. Names follow each other
(``k = "..."``, later ``password = k``), in whatever order they stand and each in its scope, so the first literal counts as a
value of ``password`` too. Literals that are put together are judged as one text. A literal is scored by the most
sensitive name it reaches and by how much it looks like a secret; those above ``THRESHOLD`` are reported as kind
``literal`` with the span of their content.

Defined cases: null text counts as empty and has no spans. Positions are code points, the end exclusive. Spans are
ordered by start, then by kind in the order of ``KINDS``. Comments and the insides of strings hold no pairs. A literal may span
lines in triple quotes and back-ticks only. The time is proportional to the text, whatever it holds. Other columns, null or
repeated ids and repeated rows pass unchanged.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.common import fresh, quoted
from patronlens.llm.lexing import Assignment, Reader

KINDS = ("assign", "access", "hex", "literal")
BASE = KINDS[:3]

# The plain patterns and the least sizes of their matches.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is one match of [0-9a-f]+
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# How much a word in a name says that its value is secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "auth": 0.7, "authorization": 0.8, "signature": 0.5,
    "key": 0.5, "salt": 0.6, "dsn": 0.6, "cookie": 0.5, "session": 0.4, "pin": 0.5, "cert": 0.4,
}
PAIRS = {("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("signing", "key"), ("client", "secret")}
HARMLESS = {"example", "changeme", "placeholder", "dummy", "none", "null", "true", "false", "undefined", "xxxx", "todo"}
THRESHOLD = 0.45
# Names that stand for names, and so on, up to this depth when literals are put together.
MOST_NESTED = 200
# Characters up to which those of a text put together are counted exactly; beyond, their shares stay the same.
MOST_COUNTED = 1_000_000
_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def name_weight(name: str) -> float:
    """How sensitive a name is, from 0 to 1."""
    words = [w.lower() for w in _CAMEL.findall(name)]
    if any(p in PAIRS for p in zip(words, words[1:])):
        return 1.0
    return max((SENSITIVE.get(w, SENSITIVE.get(w.removesuffix("s"), 0.0)) for w in words), default=0.0)


@dataclass
class Look:
    """What counts in a literal, or in several put together: size, letters, kinds of letters, and whether it is harmless."""

    size: int
    counts: Counter[str]
    harmless: bool

    def strength(self) -> float:
        """How much it looks like a secret, from 0 to 1: long, varied, without blanks, no placeholder."""
        if self.harmless or self.size < 8 or len({c.lower() for c in self.counts}) <= 3:
            return 0.0
        entropy = -sum(c / self.size * math.log2(c / self.size) for c in self.counts.values())
        kinds = sum(any(map(f, self.counts)) for f in (str.islower, str.isupper, str.isdigit))
        kinds += not all(map(str.isalnum, self.counts))
        return min(1.0, entropy / 3.5) * min(1.0, self.size / 16) * (0.5 + 0.5 * min(1.0, kinds - 1))


def look(value: str) -> Look:
    low = value.lower()
    harmless = "${" in value or "{{" in value or value.startswith("<") or low in HARMLESS or "example" in low or "changeme" in low
    counts = Counter(value)
    return Look(len(value), counts, harmless or any(map(str.isspace, counts)))


def literal_strength(value: str) -> float:
    """How much a literal looks like a secret, from 0 to 1."""
    return look(value).strength()


class Flow:
    """Which literals and names flow into which names of a text. A name is known with the scope it belongs to."""

    def __init__(self, text: str):
        self.text, self.reader = text, Reader(text)
        self.assigned: dict[tuple[int, str], list[Assignment]] = {}
        self.anywhere: dict[str, tuple[int, str]] = {}
        for one in self.reader.found:
            self.assigned.setdefault((one.scope, one.name), []).append(one)
            self.anywhere.setdefault(one.name, (one.scope, one.name))
        self.literals: list[tuple[tuple[int, str], int, int]] = []
        self.references: list[tuple[tuple[int, str], tuple[int, str]]] = []
        for one in self.reader.found:
            own = (one.scope, one.name)
            for part in one.parts:
                known = self._known(one.scope, part.name) if part.name else None
                if known:
                    if known != own:
                        self.references.append((own, known))
                elif part.end > part.start:
                    self.literals.append((own, part.start, part.end))

    def _known(self, scope: int, name: str) -> tuple[int, str] | None:
        """The assigned name that ``name`` stands for in a scope."""
        head, _, last = name.rpartition(".")
        at = scope
        while at >= 0:
            if (at, name) in self.assigned:
                return at, name
            at = self.reader.outer[at]
        if not head:
            return None
        owner = self.reader.classes.get(head.rpartition(".")[2])
        if owner is not None and (owner, last) in self.assigned:
            return owner, last
        if name in self.anywhere:  # an attribute that another method sets
            return self.anywhere[name]
        return self._known(scope, last)

    def joined_look(self, one: Assignment, path: frozenset[int] = frozenset()) -> Look:
        """Of all that is put together in an assignment; a name stands for what was assigned to it last."""
        total = Look(0, Counter(), False)
        for part in one.parts:
            known = self._known(one.scope, part.name) if part.name else None
            if known:
                source = self.assigned[known][-1]
                if id(source) in self._looks:
                    more = self._looks[id(source)]
                elif id(source) in path or len(path) > MOST_NESTED:
                    continue
                else:
                    more = self._looks[id(source)] = self.joined_look(source, path | {id(source)})
            elif part.end > part.start:
                more = look(self.text[part.start : part.end])
            else:
                continue
            counts = total.counts + more.counts
            if total.size + more.size > MOST_COUNTED:  # names may double what they stand for again and again
                counts = Counter({c: (n + 1) // 2 for c, n in counts.items()})
            total = Look(counts.total(), counts, total.harmless or more.harmless)
        return total

    def spans(self) -> set[tuple[int, int]]:
        """Literals that are values of sensitive names."""
        weight = reached_weight(self.references, {own for own, _, _ in self.literals} | {k for r in self.references for k in r})
        found = set()
        for own, start, end in self.literals:
            if weight[own] and weight[own] * literal_strength(self.text[start:end]) >= THRESHOLD:
                found.add((start, end))
        self._looks: dict[int, Look] = {}
        todo = []
        for one in self.reader.found:
            own = (one.scope, one.name)
            if one.joined and weight.get(own) and weight[own] * self.joined_look(one).strength() >= THRESHOLD:
                todo.append(one)
        seen: set[int] = set()
        while todo:  # everything that is put together there
            one = todo.pop()
            if id(one) in seen:
                continue
            seen.add(id(one))
            for part in one.parts:
                known = self._known(one.scope, part.name) if part.name else None
                if known:
                    todo.append(self.assigned[known][-1])
                elif part.end > part.start:
                    found.add((part.start, part.end))
        return found


def _shown(key: tuple[int, str]) -> str:
    return key[1] if key[0] == 0 else f"{key[1]}@{key[0]}"


def pairs(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, str]]]:
    """(name, start, end) for each literal and (name, other name) for each reference; names of inner scopes carry its number.

    A bare word is a reference if something is assigned to that name where it stands, else a literal.
    """
    flow = Flow(text)
    return [(_shown(k), a, b) for k, a, b in flow.literals], [(_shown(a), _shown(b)) for a, b in flow.references]


def reached_weight(references: list[tuple], names: set) -> dict:
    """Weight of the most sensitive name that each name's value reaches."""
    weight = {k: name_weight(k[1]) for k in names}
    into: dict = {}
    for target, source in references:
        into.setdefault(target, []).append(source)
    # Names in falling order of weight: each one is settled when it is first met.
    done: set = set()
    for start in sorted(weight, key=lambda k: (-weight[k], k)):
        todo = [start]
        while todo:
            key = todo.pop()
            if key in done:
                continue
            done.add(key)
            weight[key] = max(weight.get(key, 0.0), weight[start])
            todo += into.get(key, ())
    return weight


def literal_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of literals that are values of sensitive names."""
    if "=" not in text and ":" not in text and "#define" not in text:
        return []
    return [("literal", a, b) for a, b in sorted(Flow(text).spans())]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three plain patterns, leftmost and non-overlapping per kind."""
    found = []
    low = text.lower()  # only asked whether a word occurs at all
    if any(w in low for w in _WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text in order."""
    return sorted(base_spans(text) + literal_spans(text), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPAN = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end)."""
    (out,) = fresh(docs, out)
    names, at = [*docs.columns, out], docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(value.as_py() or "") for value in batch.column(at)]
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in row] for row in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, _ARROW)], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, SPAN)]))


def _joined(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: counts of the plain kinds, the digest of their spans, and all spans."""
    narrow = docs.select(F.col(quoted(key)).alias("id"), F.col(quoted(text)).alias("text"))
    found = scan(narrow, "text", "found").drop("text")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias(key),
        *[count(k) for k in BASE],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        count("literal"),
    )
