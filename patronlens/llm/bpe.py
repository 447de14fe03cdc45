"""Byte-level BPE by speculation and verification.

Longest-match tokens are proposed for every new word, which is cheap but not always what the merges would give. A row of
tokens is what the merges give exactly if each token is (its own merges rebuild it) and no merge ever crosses a border
between two neighbours. Whether one crosses depends on the two tokens alone, so all borders of a batch are tested at
once in numpy, on the distinct pairs. Only words with a failing border are merged step by step.

The border test goes back in time. A merge's rank is its time, as every merge joins parts that were made earlier (checked
when the vocabulary is read). At the border stand the right edge of the left token and the left edge of the right one;
undoing the younger of both again and again visits all pairs that ever stood side by side. A merge crosses if the pair
has a rank before the left part is used up, and not after the right part is: among equal ranks the leftmost goes first.

Defined cases: null text counts as empty, which has no ids. Strings of the vocabulary's added tokens in a text become
their ids, as in the tokenizers library. Ids outside the vocabulary raise when decoded. Rows keep their other columns.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.chunks import TextEncoder, id_lists, refuse_unknown, steps
from patronlens.llm.common import fresh
from patronlens.llm.memos import take_over

NEVER = 2**30
# Words of up to so many bytes are handled together as rows of one matrix, longer ones by themselves.
ROW_BYTES = (8, 16, 32, 64)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if it is visible, else the next one from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tables of a byte-level BPE file of the tokenizers library."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        refuse_unknown(spec)
        letters = byte_letters()
        self.size = 1 + max([*model["vocab"].values(), *(a["id"] for a in spec["added_tokens"])])
        self.bytes_of: list[bytes | None] = [None] * self.size
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for token, i in model["vocab"].items():
            if token not in self.added:
                self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.born = np.full(self.size, -1, np.int64)
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        keys = []
        for time, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            x, y, z = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            if self.born[z] >= 0 or time <= max(self.born[x], self.born[y]):
                raise ValueError("merges are not in the order of their parts")
            self.left[z], self.right[z], self.born[z] = x, y, time
            self.rank[x, y] = time, z
            keys.append(x * self.size + y)
        order = np.argsort(keys)
        self.pair_keys = np.concatenate([np.array(keys, np.int64)[order], [-1]])
        self.pair_times = np.concatenate([np.arange(len(keys))[order], [NEVER]])
        self.made_at = np.nonzero(self.born >= 0)[0][np.argsort(self.born[self.born >= 0])]
        self.single = {self.bytes_of[i]: i for i in range(self.size) if self.bytes_of[i] is not None and self.born[i] < 0}
        self.single_ids = np.array([self.single[bytes([b])] for b in range(256)], np.int64)
        made = self.made_at
        whole = np.ones(self.size, bool)
        whole[made] = self.apart(self.left[made], self.right[made], self.born[made])
        for i in made:
            whole[i] &= whole[self.left[i]] and whole[self.right[i]]
        self.proposed = {
            self.bytes_of[i]: i
            for i in range(self.size)
            if self.bytes_of[i] is not None and whole[i] and i not in self.added.values()
        }
        self.longest = max(map(len, self.proposed))
        self._plant()
        self.texts = TextEncoder(self.encode_words, self.added)

    def time_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``NEVER`` if there is none."""
        key = a * self.size + b
        at = np.searchsorted(self.pair_keys[:-1], key)
        return np.where(self.pair_keys[at] == key, self.pair_times[at], NEVER)

    def apart(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the border of each pair of tokens before time ``until``."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        left_ends = np.full(len(a), NEVER) if until is None else until.astype(np.int64)
        right_ends = left_ends.copy()
        fine, todo = np.ones(len(a), bool), np.arange(len(a))
        while len(todo):
            time = self.time_of(a, b)
            crossed = (time < left_ends) & (time <= right_ends)
            fine[todo[crossed]] = False
            undo_left = self.born[a] > self.born[b]
            going = ~crossed & (undo_left | (self.born[b] >= 0))
            todo, undo_left = todo[going], undo_left[going]
            a, b, left_ends, right_ends = a[going], b[going], left_ends[going], right_ends[going]
            left_ends = np.where(undo_left, self.born[a], left_ends)
            right_ends = np.where(undo_left, right_ends, self.born[b])
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return fine

    def propose(self, word: bytes) -> list[int]:
        """Longest match after longest match."""
        out, at, end, known = [], 0, len(word), self.proposed
        while at < end:
            to = min(end, at + self.longest)
            while (token := known.get(word[at:to])) is None:
                to -= 1
            out.append(token)
            at = to
        return out

    def merge(self, word: bytes) -> list[int]:
        """The merges themselves, earliest first and leftmost among equals, in n log n steps."""
        ids = [self.single[word[i : i + 1]] for i in range(len(word))]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids) and (found := self.rank.get((ids[i], ids[j]))):
                heapq.heappush(queue, (found[0], i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i] if ids[i] == a else len(ids)
            if j >= len(ids) or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = self.rank[a, b][1], -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [i for i in ids if i >= 0]

    def _plant(self) -> None:
        """The proposed tokens as a tree: steps from (node, byte) to a node, and the token that ends at a node."""
        steps: dict[int, int] = {}
        ends = {}
        for token, i in self.proposed.items():
            node = 0
            for byte in token:
                node = steps.setdefault(node * 256 + byte, len(steps) + 1)
            ends[node] = i
        keys = np.fromiter(steps.keys(), np.int64, len(steps))
        order = np.argsort(keys)
        self.step_keys = np.concatenate([keys[order], [-1]])
        self.step_to = np.concatenate([np.fromiter(steps.values(), np.int64, len(steps))[order], [-1]])
        self.token_at = np.full(len(steps) + 1, -1, np.int64)
        self.token_at[list(ends.keys())] = list(ends.values())

    def propose_rows(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``propose`` for all rows of a byte matrix at once: matrix of tokens, -1 where a row has no more."""
        out = np.full(rows.shape, -1, np.int64)
        todo = np.arange(len(rows))
        at, node, count, found, found_end = (np.zeros(len(rows), np.int64) for _ in range(5))
        last = rows.shape[1] - 1
        while len(todo):
            key = node[todo] * 256 + rows[todo, np.minimum(at[todo], last)]
            place = np.searchsorted(self.step_keys[:-1], key)
            goes = (self.step_keys[place] == key) & (at[todo] < sizes[todo])
            on = todo[goes]
            node[on] = self.step_to[place[goes]]
            at[on] += 1
            token = self.token_at[node[on]]
            hit = on[token >= 0]
            found[hit], found_end[hit] = token[token >= 0], at[hit]
            stuck = todo[~goes]
            out[stuck, count[stuck]] = found[stuck]
            count[stuck] += 1
            at[stuck], node[stuck] = found_end[stuck], 0
            todo = np.concatenate([on, stuck[at[stuck] < sizes[stuck]]])
        return out

    def merge_rows(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``merge`` for all rows of a byte matrix at once: in each round, the earliest merge of every row."""
        width = rows.shape[1]
        ids = self.single_ids[rows]
        column = np.arange(width)
        times = np.full(rows.shape, NEVER, np.int64)
        times[:, :-1] = self.time_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        times[column + 1 >= sizes[:, None]] = NEVER
        ids[column >= sizes[:, None]] = -1
        after, before = np.tile(column + 1, (len(rows), 1)), np.tile(column - 1, (len(rows), 1))
        todo = np.arange(len(rows))
        while len(todo):
            i = times[todo].argmin(axis=1)
            time = times[todo, i]
            going = time < NEVER
            todo, i, time = todo[going], i[going], time[going]
            j = after[todo, i]
            made, then = self.made_at[time], after[todo, j]
            ids[todo, i], ids[todo, j] = made, -1
            times[todo, j], times[todo, i] = NEVER, NEVER
            after[todo, i] = then
            more = then < sizes[todo]
            r, k = todo[more], then[more]
            before[r, k] = i[more]
            times[r, i[more]] = self.time_of(made[more], ids[r, k])
            ahead = before[todo, i]
            more = ahead >= 0
            r, k = todo[more], ahead[more]
            times[r, k] = self.time_of(ids[r, k], made[more])
        return ids

    def encode_rows(self, raw: list[bytes], width: int) -> list[bytes]:
        """Packed ids of words of ``width`` bytes at most: proposed, tested at every border, merged where a test fails."""
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        rows = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in raw), np.uint8).reshape(len(raw), width)
        ids = self.propose_rows(rows, sizes)
        a, b = ids[:, :-1], ids[:, 1:]
        owner, column = np.nonzero(b >= 0)
        pairs, which = np.unique(a[owner, column] * self.size + b[owner, column], return_inverse=True)
        fine = self.apart(pairs // self.size, pairs % self.size)[which]
        wrong = np.unique(owner[~fine])
        if len(wrong):
            ids[wrong] = self.merge_rows(rows[wrong], sizes[wrong])
        ends = 4 * np.cumsum((ids >= 0).sum(axis=1))
        packed = ids[ids >= 0].astype("<u4").tobytes()
        return [packed[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def encode_long(self, word: bytes) -> bytes:
        """The same for one word of any length."""
        ids = np.array(self.propose(word), np.int64)
        if not self.apart(ids[:-1], ids[1:]).all():
            ids = np.array(self.merge(word), np.int64)
        return ids.astype("<u4").tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        out, least = [b""] * len(raw), 0
        for width in ROW_BYTES:
            some = np.nonzero((sizes > least) & (sizes <= width))[0].tolist()
            if some:
                for k, ids in zip(some, self.encode_rows([raw[k] for k in some], width), strict=True):
                    out[k] = ids
            least = width
        for k in np.nonzero(sizes > least)[0].tolist():
            out[k] = self.encode_long(raw[k])
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.texts.texts(texts)

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """Text of each row of ids; bytes that are no UTF-8 become replacement characters."""
        ends = np.cumsum(counts)
        look = self.bytes_of.__getitem__
        return [
            b"".join(map(look, flat[end - n : end].tolist())).decode("utf-8", "replace")
            for end, n in zip(ends, counts, strict=True)
        ]


_READ: dict[int, Vocabulary] = {}


def vocabulary(content: str) -> Vocabulary:
    """Tables of a vocabulary, built once in a Python worker."""
    take_over("bpe", _READ.clear)
    key = zlib.crc32(content.encode())
    if key not in _READ:
        _READ.clear()
        _READ[key] = Vocabulary(content)
    return _READ[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _with(batch: pa.RecordBatch, row: int, size: int, extra: list[pa.Array], schema: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.slice(row, size).columns, *extra], schema)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of ids. ``tokenizer`` is read on the driver; it has the size of a vocabulary."""
    (ids,) = fresh(docs, ids)
    names, at = [*docs.columns, ids], docs.columns.index(text)
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(content.value)
        for batch in batches:
            for row, texts in steps(batch.column(at)):
                yield _with(batch, row, len(texts), [id_lists(*vocab.encode(texts))], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of its column of ids; a null list gives empty text."""
    (text,) = fresh(docs, text)
    names, at = [*docs.columns, text], docs.columns.index(ids)
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(content.value)
        for batch in batches:
            rows = [np.array(v.as_py() or [], np.int64) for v in batch.column(at)]
            counts = np.fromiter(map(len, rows), np.int64, len(rows))
            texts = vocab.decode(np.concatenate([np.zeros(0, np.int64), *rows]), counts)
            yield _with(batch, 0, len(rows), [pa.array(texts, pa.string())], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(text, T.StringType())]))


def encode_and_decode(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``ids`` and, made from these ids alone, ``decoded``: both in one Python pass."""
    keep = docs.columns if keep is None else keep
    ids, decoded = fresh(docs.select(*keep), "ids", "decoded")
    names, kept = [*keep, ids, decoded], [docs.columns.index(c) for c in keep]
    at = docs.columns.index(text)
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer))
    fields = [docs.schema.fields[i] for i in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(content.value)
        for batch in batches:
            for row, texts in steps(batch.column(at)):
                flat, counts = vocab.encode(texts)
                extra = [id_lists(flat, counts), pa.array(vocab.decode(flat, counts), pa.string())]
                part = batch.slice(row, len(texts))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), *extra], names)

    kinds = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]
    return docs.mapInArrow(run, T.StructType([*fields, *kinds]))


def digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256."""
    both = encode_and_decode(docs.select(key, text), tokenizer, text, [key])
    ids, decoded = both.columns[1:]
    return both.select(
        key,
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )
