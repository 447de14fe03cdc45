"""Encoding of texts piece by piece, with each distinct piece encoded once.

Byte-level BPE never merges across the start of a word, and a blank between two visible characters always starts one. So
a text may be cut before each such blank: the ids of the text are the ids of its pieces in order. Pieces repeat far more
often than texts do, which makes a bounded memo of them much cheaper than encoding every text afresh.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

# Bytes of one of a memo's two halves, those of an entry beside its characters and ids (objects and their place in a
# table), the longest entry worth remembering, and the text handled at a time.
MEMO_BYTES = 36_000_000
ENTRY_BYTES = 150
MEMO_CHARS = 32
STEP_CHARS = 1_000_000
# Bytes of a column of texts whose distinct pieces are found at a time.
STEP_BYTES = 4_000_000

# Fixed value: the word pattern of byte-level vocabularies.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Python's white space covers that of the tokenizer, so a blank that passes here is between visible characters.
_BESIDE_SPACE = re.compile(r"\s | \s|\0")
_BETWEEN_WORDS = re.compile(r"(?<=[^\s\0]) (?=[^\s\0])")
# White space other than the blank and the line feed, found faster one by one than by a pattern.
_RARE_ASCII = tuple("\t\r\x0b\x0c\x1c\x1d\x1e\x1f\0")
_RARE = ("\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")
# The same for UTF-8: bytes other than ASCII white space, and the white space of two or three bytes as numbers.
_VISIBLE = np.ones(256, bool)
_VISIBLE[[ord(c) for c in (" ", "\n", *_RARE_ASCII)]] = False
_WIDE_SPACES = np.array([int.from_bytes(c.encode(), "big") for c in _RARE], np.int32)


def _plain(text: str) -> bool:
    """Whether every blank is known to be between visible characters."""
    if "  " in text or " \n" in text or "\n " in text or any(c in text for c in _RARE_ASCII):
        return False
    return text.isascii() or not any(c in text for c in _RARE)


def pieces(text: str) -> list[str]:
    """``text`` cut before every blank between two visible characters."""
    if _plain(text) or not _BESIDE_SPACE.search(text):
        return text.replace(" ", "\0 ").split("\0")
    if "\0" in text:
        return [text]
    return _BETWEEN_WORDS.sub("\0 ", text).split("\0")


class Memo:
    """Bounded memory of packed ids in two halves.

    What is in use moves to the young half; when that is full it becomes the old one, and what was left there is forgotten.
    So frequent entries stay. A half holds ``room`` bytes and what one run of texts adds.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], room: int):
        self.encode, self.room, self.size = encode, room, 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        """Start a new young half if this one is full."""
        if self.size > self.room:
            self.old, self.young, self.size = self.young, {}, 0

    def learn(self, wanted: set[str]) -> None:
        """Put everything wanted into the young half."""
        new = wanted.difference(self.young)
        for entry in new & self.old.keys():
            self.young[entry] = self.old.pop(entry)
        order = list(new.difference(self.young))
        self.young.update(zip(order, self.encode(order), strict=True))
        self.size += sum(map(len, new)) + sum(map(len, map(self.young.__getitem__, new))) + ENTRY_BYTES * len(new)
        self.long = [e for e in order if len(e) > MEMO_CHARS]

    def forget_long(self) -> None:
        for entry in self.long:
            self.size -= len(entry) + len(self.young.pop(entry)) + ENTRY_BYTES


class PieceCutter:
    """Cuts pieces into words. ``added`` are the strings that stand for one id wherever they occur."""

    def __init__(self, added: dict[str, int]):
        self.word = regex.compile(WORD_PATTERN)
        self.added = {a: np.array([i], "<u4").tobytes() for a, i in added.items()}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")

    def _parts(self, piece: str, special: bool) -> list[str]:
        """Words and added tokens of a piece. No word equals an added token: those are cut out first."""
        if not special:
            # A blank and Latin letters are one word, the most frequent kind of piece.
            if piece[1:].isalpha() and piece[0] == " " and (piece.isascii() or max(piece) < "\u0250"):
                return [piece]
            return self.word.findall(piece)
        out: list[str] = []
        for part in self.special.split(piece):
            out += [part] if part in self.added else self.word.findall(part)
        return out


class TextEncoder(PieceCutter):
    """Ids of texts from the packed ids of their words, given by ``encode_words``; pieces and words are remembered."""

    def __init__(self, encode_words: Callable[[list[str]], list[bytes]], added: dict[str, int], room: int = MEMO_BYTES):
        super().__init__(added)
        self.words = Memo(encode_words, room)
        self.pieces = Memo(self._encode_pieces, room)

    def _encode_pieces(self, new: list[str]) -> list[bytes]:
        together = "\0".join(new)
        special = any(a in together for a in self.added)
        parts = [self._parts(p, special) for p in new]
        wanted = set(chain.from_iterable(parts)).difference(self.added)
        self.words.turn()
        self.words.learn(wanted)
        look = (self.words.young | self.added if special else self.words.young).__getitem__
        out = [look(p[0]) if len(p) == 1 else b"".join(map(look, p)) for p in parts]
        self.words.forget_long()
        return out

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` one after the other, and the number of ids of each text."""
        # Nothing here holds cycles, and millions of short lists would set the collector off again and again.
        gc.disable()
        try:
            return self._texts(texts)
        finally:
            gc.enable()

    def _texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        self.pieces.turn()
        cut = [pieces(t) for t in texts]
        found = [list(map(self.pieces.young.get, c)) for c in cut]
        holes: list[tuple[int, int]] = []
        for k, ids in enumerate(found):
            at = -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                holes.append((k, at))
        self.pieces.learn({cut[k][at] for k, at in holes})
        look = self.pieces.young
        for k, at in holes:
            found[k][at] = look[cut[k][at]]
        self.pieces.forget_long()
        joined = list(map(b"".join, found))
        counts = np.fromiter((len(j) // 4 for j in joined), np.int64, len(joined))
        return np.frombuffer(b"".join(joined), "<u4"), counts


def cut_column(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts start in their UTF-8 bytes, and the end; ``starts`` says so of the texts.

    A blank between two visible characters starts a piece, and so does every text that is not empty.
    """
    size = len(data)
    blanks = np.flatnonzero(data[1:-1] == 32) + 1
    before, after = data[blanks - 1], data[blanks + 1]
    blanks = blanks[_VISIBLE[before] & _VISIBLE[after]]
    near = blanks[(data[blanks - 1] > 127) | (data[blanks + 1] > 127)]
    # At the ends of the bytes this may take other characters for white space, and not cut beside them.
    a, b, c, _, d, e, f = (data[np.clip(near + k, 0, size - 1)].astype(np.int32) for k in range(-3, 4))
    spaces = [np.isin(x, _WIDE_SPACES) for x in (b << 8 | c, a << 16 | b << 8 | c, d << 8 | e, d << 16 | e << 8 | f)]
    cuts = np.zeros(size + 1, bool)
    cuts[blanks] = True
    cuts[near[np.logical_or.reduce(spaces)]] = False
    cuts[starts[starts > 0] - 1] = False  # a blank that ends a text
    cuts[starts] = True
    return np.flatnonzero(cuts)


class ColumnEncoder(PieceCutter):
    """Ids of an Arrow column of texts; ``encode_word`` gives the packed ids of a word.

    Arrow finds the distinct pieces of a run of texts and lays out their ids for all occurrences, so that Python sees a
    piece once a run, and ``encode_word`` a word once as long as it is remembered. Words and pieces share one memory in
    two halves, see ``Memo``: a word by itself has the ids that it has in a piece.
    """

    def __init__(self, encode_word: Callable[[str], bytes], added: dict[str, int], room: int = MEMO_BYTES):
        super().__init__(added)
        self.encode_word, self.room, self.size = encode_word, room, 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def column(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Runs of rows of about ``STEP_BYTES``: the first row, all ids, and the number of ids of each row; null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        row = 0
        while row < len(texts):
            stop = max(row + 1, int(np.searchsorted(starts, starts[row] + STEP_BYTES, "right")) - 1)
            stop = min(stop, len(texts))
            yield row, *self._run(texts.buffers()[2], starts[row : stop + 1])
            row = stop

    def _run(self, data: pa.Buffer | None, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, size = int(starts[0]), int(starts[-1] - starts[0])
        if not size:
            return np.zeros(0, "<u4"), np.zeros(len(starts) - 1, np.int64)
        data, starts = data.slice(first, size), starts - first
        cuts = cut_column(np.frombuffer(data, np.uint8), starts)
        coded = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), data).dictionary_encode()
        # Nothing here holds cycles, and many short lists would set the collector off again and again.
        gc.disable()
        try:
            known = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        finally:
            gc.enable()
        placed = pa.array(known, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(placed.buffers()[1], np.int64)[: len(placed) + 1] // 4
        flat = np.frombuffer(placed.buffers()[2] or b"", "<u4", int(ends[-1]))
        return flat, np.diff(ends[np.searchsorted(cuts, starts)])

    def _ids(self, distinct: list[str]) -> list[bytes]:
        """Packed ids of pieces, each once."""
        if self.size > self.room:
            self.old, self.young, self.size = self.young, {}, 0
        known = list(map(self.young.get, distinct))
        missing = [k for k, ids in enumerate(known) if ids is None]
        wanted = [distinct[k] for k in missing]
        found = dict(zip(wanted, map(self.old.get, wanted), strict=True))
        new = [piece for piece, ids in found.items() if ids is None]
        together = "\0".join(new)
        special = any(a in together for a in self.added)
        for piece in new:
            parts = self._parts(piece, special)
            ids = [self._word(part, found) for part in parts]
            found[piece] = ids[0] if len(ids) == 1 else b"".join(ids)
        for k in missing:
            known[k] = found[distinct[k]]
        short = {entry: ids for entry, ids in found.items() if len(entry) <= MEMO_CHARS}
        self.young.update(short)
        self.size += sum(map(len, short)) + sum(map(len, short.values())) + ENTRY_BYTES * len(short)
        return known

    def _word(self, word: str, found: dict[str, bytes | None]) -> bytes:
        """Packed ids of a word or an added token; new ones are put into ``found``."""
        ids = found.get(word)
        if ids is None:
            ids = self.young.get(word)
        if ids is None:
            ids = self.old.get(word) if word not in self.added else self.added[word]
            found[word] = ids = self.encode_word(word) if ids is None else ids
        return ids


def refuse_unknown(spec: dict) -> None:
    """Raise unless a file of the tokenizers library is plain byte-level BPE, for which texts may be cut."""
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    flags = ("single_word", "lstrip", "rstrip", "normalized")
    if (
        spec["normalizer"]
        or any(token[f] for token in spec["added_tokens"] for f in flags)
        or model["type"] != "BPE"
        or model.get("ignore_merges")
        or model.get("byte_fallback")
        or split.get("type") != "ByteLevel"
        or split["add_prefix_space"]
        or not split["use_regex"]
    ):
        raise ValueError("not a plain byte-level BPE vocabulary")


def steps(texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``STEP_CHARS`` characters, with the row they start at; null is empty text."""
    start, held, size = 0, [], 0
    for row, value in enumerate(texts):
        text = value.as_py() or ""
        if held and size + len(text) > STEP_CHARS:
            yield start, held
            start, held, size = row, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def id_lists(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Arrow lists of 32-bit ids."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
