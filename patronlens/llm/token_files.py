"""Token ids in files of fixed-width bits, in ascending order of the documents' ids.

A file holds whole documents and about ``FILE_IDS`` ids (one document more at most). All numbers are little-endian:

====================  =================================================================================
header                8 bytes ``PLTOKBIT``, then 64-bit: version, bits, ids per block, blocks, ids, documents
block offsets         64-bit, one per block and the end, in bytes from the start of the first block
document keys         64-bit ids, then one byte each that is 1 for a null id
document offsets      64-bit, one per document and the end, in ids
blocks                ids in ``bits`` bits each, lowest bit first; every block but the last is full
====================  =================================================================================

``bits`` is the least number that holds every id of the vocabulary. A block starts on a byte, so any range of ids is
found from the offsets and unpacked by numpy without a loop over ids. Files go to the shared folder under names that
depend on the partition alone and appear there by a rename; a task that runs again writes the same file once more. The
stored list of files names the finished ones only.

Defined cases: null text counts as empty; every document gets the end id, so none has zero ids. Null ids come first;
rows with one id are ordered by their texts. Repeated rows are kept. An empty table gives an empty list of files.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronlens.llm.bpe import byte_letters
from patronlens.llm.chunks import ColumnEncoder, refuse_unknown
from patronlens.llm.common import quoted, text_of
from patronlens.llm.memos import take_over
from patronlens.sources.staging import new_path, stage

MAGIC = b"PLTOKBIT"
HEADER = struct.Struct("<8s6q")
BLOCK_IDS = 65_536
FILE_IDS = 8_000_000
END_ID = 2
# Bytes of one half of what a worker remembers of pieces and words.
MEMO_BYTES = 108_000_000


def width_of(vocabulary: int) -> int:
    """Least number of bits for ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits of each id, lowest first; the last byte is filled up with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(each[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of ``data``."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    filled = np.zeros((count, 32), np.uint8)
    filled[:, :bits] = each
    return np.packbits(filled, axis=1, bitorder="little").view("<u4").ravel()


def file_bytes(keys: list[int | None], counts: np.ndarray, ids: np.ndarray, bits: int) -> Iterator[bytes]:
    """The parts of one file in order."""
    blocks = [pack(ids[i : i + BLOCK_IDS], bits) for i in range(0, len(ids), BLOCK_IDS)]
    yield HEADER.pack(MAGIC, 1, bits, BLOCK_IDS, len(blocks), len(ids), len(keys))
    yield np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<i8").tobytes()
    yield np.array([0 if k is None else k for k in keys], "<i8").tobytes()
    yield bytes(k is None for k in keys)
    yield np.concatenate([[0], np.cumsum(counts)]).astype("<i8").tobytes()
    yield from blocks


class TokenFile:
    """One file, opened for random access."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self.source = system.open_input_file(path)
        magic, version, self.bits, self.block, blocks, self.n_ids, docs = HEADER.unpack(self._read(0, HEADER.size))
        if magic != MAGIC or version != 1:
            raise ValueError(f"{uri} holds no token ids")
        at = HEADER.size
        self.blocks = np.frombuffer(self._read(at, 8 * (blocks + 1)), "<i8")
        at += 8 * (blocks + 1)
        self.keys = np.frombuffer(self._read(at, 8 * docs), "<i8")
        self.null_keys = np.frombuffer(self._read(at + 8 * docs, docs), np.uint8)
        at += 9 * docs
        self.starts = np.frombuffer(self._read(at, 8 * (docs + 1)), "<i8")
        self.first = at + 8 * (docs + 1)

    def _read(self, at: int, size: int) -> bytes:
        return self.source.read_at(size, at)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``; only the blocks they lie in are read."""
        if stop <= start:
            return np.zeros(0, "<u4")
        low, high = start // self.block, (stop - 1) // self.block + 1
        data = self._read(self.first + int(self.blocks[low]), int(self.blocks[high] - self.blocks[low]))
        got = unpack(data, self.bits, min(high * self.block, self.n_ids) - low * self.block)
        return got[start - low * self.block : stop - low * self.block]

    def document(self, row: int) -> np.ndarray:
        return self.ids(int(self.starts[row]), int(self.starts[row + 1]))

    def close(self) -> None:
        self.source.close()


_TOKENIZERS: dict[int, tuple[ColumnEncoder, int]] = {}


def _tokenizer(content: str) -> tuple[ColumnEncoder, int]:
    """The library's tokenizer behind a memo of words, and its vocabulary's size; once in a Python worker."""
    take_over("token files", _TOKENIZERS.clear)
    key = zlib.crc32(content.encode())
    if key not in _TOKENIZERS:
        spec = json.loads(content)
        refuse_unknown(spec)
        tokenizer = Tokenizer.from_str(content)
        merge = tokenizer.model.tokenize
        letters = "".join(sorted(byte_letters(), key=byte_letters().get))

        def encode(word: str) -> bytes:
            # Words are cut already; what the library does before its model is to write bytes as letters.
            return array("I", [t.id for t in merge(charmap_decode(word.encode(), "strict", letters)[0])]).tobytes()

        _TOKENIZERS.clear()
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        _TOKENIZERS[key] = ColumnEncoder(encode, added, MEMO_BYTES), tokenizer.get_vocab_size(with_added_tokens=True)
    return _TOKENIZERS[key]


def write_token_files(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID, folder: str | None = None
) -> DataFrame:
    """Encode and write all documents; one row per file: uri, part, number, n_docs, n_ids, base (ids in all files before)."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "token-files")
    with open(tokenizer, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        memo, size = _tokenizer(content.value)
        bits = max(width_of(size), width_of(end_id + 1))
        system, path = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        system.create_dir(path, recursive=True)
        number, held = 0, 0
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def write() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:04d}.ids"
            draft = f"{path}/.{name}.{uuid.uuid4().hex}"
            with system.open_output_stream(draft) as out:
                for data in file_bytes(keys, np.concatenate(counts), np.concatenate(ids), bits):
                    out.write(data)
            system.move(draft, f"{path}/{name}")
            row = {"uri": f"{folder}/{name}", "part": part, "number": number, "n_docs": len(keys), "n_ids": held}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            names = batch.column(0)
            for row, flat, sizes in memo.column(batch.column(1)):
                ends = np.cumsum(sizes)
                flat = np.insert(flat, ends, end_id)  # after the last id of each document
                sizes = sizes + 1
                ends = ends + np.arange(1, len(ends) + 1)
                start = 0
                while start < len(sizes):
                    begin = int(ends[start - 1]) if start else 0
                    # As many documents as reach the size of a file.
                    stop = min(len(sizes), int(np.searchsorted(ends, begin + FILE_IDS - held)) + 1)
                    keys += names.slice(row + start, stop - start).to_pylist()
                    ids.append(flat[begin : int(ends[stop - 1])])
                    counts.append(sizes[start:stop])
                    held += int(ends[stop - 1]) - begin
                    start = stop
                    if held >= FILE_IDS:
                        yield write()
                        number, held, keys, ids, counts = number + 1, 0, [], [], []
        if keys:
            yield write()

    rows = docs.select(F.col(quoted(key)).cast("long").alias("key"), text_of(docs, text).alias("text"))
    # Equal rows may go to any of the partitions their id touches: their order does not show.
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("spread", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key", "tie", "spread").sortWithinPartitions("key", "tie")
    schema = "uri string, part long, number long, n_docs long, n_ids long"
    files = stage(ordered.select("key", "text").mapInArrow(run, schema), "token-list")
    # One row per file of millions of ids.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(files: DataFrame) -> DataFrame:
    """Per document of the listed files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = TokenFile(uri)
                n = np.diff(file.starts)
                crc = np.zeros(len(n), np.int64)
                row = 0
                while row < len(n):  # as many documents at a time as fit into a number of blocks
                    begin = int(file.starts[row])
                    stop = int(np.searchsorted(file.starts, begin + 16 * file.block, "right")) - 1
                    stop = max(row + 1, min(stop, len(n)))
                    data = memoryview(file.ids(begin, int(file.starts[stop])).tobytes())
                    for k in range(row, stop):
                        crc[k] = zlib.crc32(data[4 * (file.starts[k] - begin) : 4 * (file.starts[k + 1] - begin)])
                    row = stop
                keys = pa.array(file.keys, pa.int64(), mask=file.null_keys.astype(bool))
                columns = [keys, pa.array(base + file.starts[:-1]), pa.array(n), pa.array(crc)]
                file.close()
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = files.select("uri", "base").repartition(parts, "uri")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_one(files: DataFrame, doc_id: int) -> list[list[int]]:
    """Ids of one document, from its own blocks alone; one list per row with that id. Opens files on the driver."""
    out = []
    for row in files.select("uri").toLocalIterator():
        file = TokenFile(row.uri)
        for k in np.nonzero((file.keys == doc_id) & (file.null_keys == 0))[0]:
            out.append(file.document(int(k)).tolist())
        file.close()
    return out
