"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf. Leaves of one group, in the order of their keys, are the bottom of a tree; of each two consecutive nodes
(the last one may stand alone) the digest is a node of the level above, until one is left. These roots, in the order of
the groups' names, make a last tree in the same way, whose root stands for the dataset.

A node's label is (leaves up to its end, level). Labels ascend from children to parents, so a sweep through a tree in
the order of labels finds the digests of a node's children already sent to it: they wait in a queue ordered by the
receiver's label. With these labels one node per level waits at most. The sweep hands each child its sibling's digest. A
second sweep goes back from the highest label to the lowest: a node receives the proof of its parent, puts its own
sibling before it, and sends the result to its children, until the proofs arrive at the leaves.

The queue is external: trees are cut into subtrees of ``2 ** BLOCK_BITS`` nodes at the bottom. A subtree is swept in one
task, its messages wait in a heap; what leaves it (its root's digest on the way up, the proof of its root on the way
down) is a row for the next round, and Spark's shuffle delivers the rows in the order of labels, on disk where
they do not fit. Rounds are as many as the height over ``BLOCK_BITS``: three for 10^10 rows. Stored rows are a leaf or a node each.

Defined cases: a null value counts as ``-``, so null and empty differ. Null keys come first; rows with one key are ordered
by their leaves, and equal rows have equal leaves, so their order changes nothing. A group of one row has its leaf as
its root; with one group that root is the dataset's. An empty table gives an empty manifest, without a root. Columns
that are not listed as fields are not covered. Any column may have any name.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import quoted
from patronlens.llm.numbering import numbered
from patronlens.sources.staging import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 12
# Where a proof's step stands: no sibling, a sibling after the node, one before it.
ALONE, AFTER, BEFORE = 0, 1, 2
# Rows of a sweep at one place come in this order.
ROOT, START, NODE, LEAF = range(4)
_TOP = 2**62
_TOP_LEVEL = 99
_DIGEST = 32


def encoded(value: Column) -> Column:
    """Number of UTF-8 bytes, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """Digest of a row's values as hex text."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def join_digests(*parts: bytes) -> bytes:
    """Digest of digests, both as hex text."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def label(n: int, level: int, index: int) -> tuple[int, int]:
    """Place of a node in the sweep of a tree of ``n`` leaves: after all it covers, before what covers it."""
    return min((index + 1) << level, n), level


def height_of(n: int, bits: int) -> int:
    """Levels above the bottom of a subtree of a tree of ``n`` leaves."""
    return min(bits, (n - 1).bit_length())


class Upward:
    """Sweep of one subtree in the order of labels; leaves are given one after the other."""

    def __init__(self, n: int, bits: int = BLOCK_BITS):
        self.n, self.top = n, height_of(n, bits)
        self.queue: list[tuple[tuple[int, int], int, int, bytes]] = []  # receiver's label, sender's level and index, digest
        self.steps: list[tuple[int, int, int, bytes]] = []  # end, level, step and sibling of nodes whose parents were swept
        self.root = b""

    def leaf(self, index: int, digest: bytes) -> None:
        self._send(0, index, digest)
        while self.queue and self.queue[0][0][0] <= index + 1:  # all inner nodes that end here
            self._inner()

    def _send(self, level: int, index: int, digest: bytes) -> None:
        if level == self.top:
            self.root = digest
        else:
            heapq.heappush(self.queue, (label(self.n, level + 1, index >> 1), level, index, digest))

    def _inner(self) -> None:
        receiver, level, index, left = heapq.heappop(self.queue)
        if self.queue and self.queue[0][0] == receiver:
            right = heapq.heappop(self.queue)[3]
            self._step(level, index, AFTER, right)
            self._step(level, index + 1, BEFORE, left)
            self._send(level + 1, index >> 1, join_digests(left, right))
        else:
            self._step(level, index, ALONE, b"")
            self._send(level + 1, index >> 1, join_digests(left))

    def _step(self, level: int, index: int, step: int, sibling: bytes) -> None:
        self.steps.append((*label(self.n, level, index), step, sibling))


# A proof as a chain: the step beside a node, the sibling there, the rest of the way up, and all siblings in a row.
Proof = tuple[int, bytes, "Proof", bytes] | None


def longer(step: int, sibling: bytes, rest: Proof) -> Proof:
    return step, sibling, rest, sibling + (rest[3] if rest else b"")


def packed(proof: Proof) -> bytes:
    """One byte for each step, and the sibling's 32 bytes if it has one."""
    out = []
    while proof:
        out.append(bytes([proof[0]]) + bytes.fromhex(proof[1].decode()))
        proof = proof[2]
    return b"".join(out)


def unpacked(data: bytes) -> Proof:
    steps, at = [], 0
    while at < len(data):
        size = _DIGEST if data[at] != ALONE else 0
        steps.append((data[at], data[at + 1 : at + 1 + size].hex().encode()))
        at += 1 + size
    proof: Proof = None
    for step, sibling in reversed(steps):
        proof = longer(step, sibling, proof)
    return proof


def folded(digest: bytes, proof: Proof) -> bytes:
    """The root that follows from a leaf's digest and its proof."""
    while proof:
        step, sibling, proof, _ = proof
        parts = {ALONE: (digest,), AFTER: (digest, sibling), BEFORE: (sibling, digest)}[step]
        digest = join_digests(*parts)
    return digest


class Downward:
    """Sweep of one subtree against the order of labels; gives the proof of each leaf when it is reached."""

    def __init__(self, n: int, block: int, proof: Proof, bits: int = BLOCK_BITS):
        self.n = n
        self.queue: list[tuple[int, int, Proof]] = []  # receiver's label and the proof of its parent
        self.last = proof  # of the leaf reached last
        if top := height_of(n, bits):
            self._send(top, block << (bits - top), proof)

    def _send(self, level: int, index: int, proof: Proof) -> None:
        for child in (2 * index, 2 * index + 1):
            if child << (level - 1) < self.n:
                end, at = label(self.n, level - 1, child)
                heapq.heappush(self.queue, (-end, -at, proof))

    def node(self, end: int, level: int, step: int, sibling: bytes) -> None:
        self.last = longer(step, sibling, heapq.heappop(self.queue)[2])
        if level:
            self._send(level, (end - 1) >> level, self.last)


_UP = "tree string, block long, n long, end long, level int, kind int, step int, sibling binary, root binary"


def _round_up(base: DataFrame, bits: int) -> DataFrame:
    """Stored: for every subtree its root, and step and sibling of each node below the root.

    ``base``: tree, pos, n, digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sweep = None, None

        def done() -> pa.RecordBatch:
            tree, block = at
            rows = [(end, level, NODE, step, bytes.fromhex(sibling.decode()), None) for end, level, step, sibling in sweep.steps]
            rows.append((_TOP, _TOP_LEVEL, ROOT, None, None, bytes.fromhex(sweep.root.decode())))
            size = len(rows)
            end, level, kind, step, sibling, root = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([tree] * size, pa.string()), pa.array([block] * size, pa.int64()), pa.array([sweep.n] * size, pa.int64()),
                    pa.array(end, pa.int64()), pa.array(level, pa.int32()), pa.array(kind, pa.int32()), pa.array(step, pa.int32()),
                    pa.array(sibling, pa.binary()), pa.array(root, pa.binary()),
                ],
                [part.split()[0] for part in _UP.split(", ")],
            )

        for batch in batches:
            for tree, block, pos, n, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (tree, block) != at:
                    if sweep:
                        yield done()
                    at, sweep = (tree, block), Upward(n, bits)
                sweep.leaf(pos, digest.hex().encode())
        if sweep:
            yield done()

    rows = base.select("tree", F.shiftright("pos", bits).alias("block"), "pos", "n", "digest")
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    return stage(rows.mapInArrow(run, _UP), "merkle-up")


def build(base: DataFrame, bits: int = BLOCK_BITS) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of the upward sweep, and (tree, digest) of each tree's root. ``base``: tree, pos, n, digest."""
    most = base.agg(F.max("n")).first()[0]
    rounds: list[DataFrame] = []
    while most:
        rounds.append(_round_up(base, bits))
        roots = rounds[-1].where(F.col("kind") == ROOT)
        size = F.shiftright(F.col("n") + (2**bits - 1), bits)
        base = roots.select("tree", F.col("block").alias("pos"), size.alias("n"), F.col("root").alias("digest"))
        if most <= 2**bits:
            break
        most = -(-most >> bits)
    return rounds, base.select("tree", "digest")


def _round_down(up: DataFrame, starts: DataFrame, leaves: DataFrame | None, bits: int) -> DataFrame:
    """One round of the downward sweep.

    ``starts``: tree, block, proof, top. Without ``leaves`` the result is the same for the blocks of the round below; with
    them (tree, pos, key, leaf, claimed) it is key, leaf, top, proof, proof_sha256 and folded_root of each.
    """
    spare = {"end": "long", "level": "int", "step": "int", "sibling": "binary", "n": "long", "proof": "binary", "top": "binary"}
    order = ["tree", "block", "kind", *spare]
    inside = [up.drop("root"), starts.withColumns({"kind": F.lit(START), "end": F.lit(_TOP), "level": F.lit(_TOP_LEVEL)})]
    if leaves is not None:
        block = F.shiftright("pos", bits).alias("block")
        told = leaves.select("tree", block, F.lit(LEAF).alias("kind"), (F.col("pos") + 1).alias("end"), F.lit(0).alias("level"), "key", "leaf", "claimed")
        kind = leaves.schema["key"].dataType.simpleString()
        spare |= {"key": kind, "leaf": "binary", "claimed": "binary"}
        inside.append(told)
        result = f"key {kind}, leaf string, top string, proof binary, proof_sha256 string, folded_root string"
    else:
        result = "tree string, block long, proof binary, top binary"
    order = ["tree", "block", "kind", *spare]
    rows = None
    for part in inside:
        part = part.withColumns({c: F.lit(None).cast(t) for c, t in spare.items() if c not in part.columns}).select(*order)
        rows = part if rows is None else rows.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, top, sweep = 0, b"", None
        for batch in batches:
            out: list[tuple] = []
            for tree, block, kind, end, level, step, sibling, size, proof, above, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == ROOT:
                    n = size
                elif kind == START:
                    top, sweep = above, Downward(n, block, unpacked(proof), bits)
                    if n == 1 and not has_leaves:
                        out.append((tree, 0, packed(sweep.last), top))
                elif kind == NODE:
                    sweep.node(end, level, step, sibling.hex().encode())
                    if level == 0 and not has_leaves:
                        out.append((tree, end - 1, packed(sweep.last), top))
                else:
                    key, leaf_, claimed = rest
                    chain = sweep.last
                    siblings = hashlib.sha256(chain[3] if chain else b"").hexdigest()
                    fold = folded((claimed or leaf_).hex().encode(), chain).decode()
                    out.append((key, leaf_.hex(), top.hex(), packed(chain), siblings, fold))
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds(batch), strict=True)], names)

    names = [part.split()[0] for part in result.split(", ")]
    has_leaves = leaves is not None

    def kinds(batch: pa.RecordBatch) -> list[pa.DataType]:
        if has_leaves:
            return [batch.schema.field("key").type, pa.string(), pa.string(), pa.binary(), pa.string(), pa.string()]
        return [pa.string(), pa.int64(), pa.binary(), pa.binary()]

    sorts = ["tree", "block", F.desc("end"), F.desc("level"), "kind"]
    return rows.repartition("tree", "block").sortWithinPartitions(*sorts).mapInArrow(run, result)


def deliver(rounds: list[DataFrame], starts: DataFrame, leaves: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Proofs of all leaves, by the rounds of the upward sweep in reverse."""
    for up in reversed(rounds[1:]):
        starts = stage(_round_down(up, starts, None, bits), "merkle-down")
    return _round_down(rounds[0], starts, leaves, bits)


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS,
    claimed: dict[str, Column] | None = None, bits: int = BLOCK_BITS,
) -> tuple[DataFrame, str | None]:
    """One row per document and the root of the dataset, None for an empty table.

    The rows: key, leaf, subroot (of the group's tree), proof (packed), proof_sha256 (digest of the proof's siblings in
    order), folded_root (from the leaf and its proof). ``claimed`` are other values of fields: where these make another
    leaf, it is folded in place of the true one.
    """
    own = leaf([F.col(quoted(f)) for f in fields])
    other = leaf([(claimed or {}).get(f, F.col(quoted(f))) for f in fields])
    name = F.col(quoted(group)).cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("s"), name), F.lit("n")).alias("tree"),  # null before all names
        F.col(quoted(key)).alias("key"),
        F.unhex(own).alias("leaf"),
        (F.unhex(other) if claimed else F.lit(None).cast("binary")).alias("claimed"),
    )
    leaves = numbered(rows.withColumn("claimed", F.when(F.col("claimed") != F.col("leaf"), F.col("claimed"))), ["key", "leaf"], "tree")
    rounds, roots = build(leaves.select("tree", "pos", "n", F.col("leaf").alias("digest")), bits)
    if not rounds:
        empty = docs.sparkSession.createDataFrame([], f"key {rows.schema['key'].dataType.simpleString()}, leaf string, subroot string, proof binary, proof_sha256 string, folded_root string")
        return empty, None
    tops = numbered(roots, ["tree"]).withColumns({"key": F.col("tree"), "tree": F.lit("")})
    top_rounds, top_root = build(tops.select("tree", "pos", "n", "digest"), bits)
    root = bytes(top_root.first()["digest"])
    nothing = F.unhex(F.lit(""))
    start = top_root.select("tree", F.lit(0).cast("long").alias("block"), nothing.alias("proof"), F.col("digest").alias("top"))
    tops = tops.select("tree", "pos", "key", F.col("digest").alias("leaf"), F.lit(None).cast("binary").alias("claimed"))
    told = deliver(top_rounds, start, tops, bits)
    starts = told.select(F.col("key").alias("tree"), F.lit(0).cast("long").alias("block"), "proof", F.unhex("leaf").alias("top"))
    found = deliver(rounds, stage(starts, "merkle-starts"), leaves.select("tree", "pos", "key", "leaf", "claimed"), bits)
    return found.withColumnRenamed("top", "subroot"), root.hex()


def report(docs: DataFrame, tampered: Column | None = None, bits: int = BLOCK_BITS) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Where ``tampered`` holds, one is added
    to ``n_chars`` before the leaf is folded."""
    claimed = None if tampered is None else {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    rows, root = manifest(docs, claimed=claimed, bits=bits)
    return rows.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
    )
