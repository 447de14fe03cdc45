"""Near-duplicate vectors by range search on a robust-pruned flat graph.

1. Equal vectors form one class, which takes part once. Vectors that are null or zero, or hold null or non-finite
   components, take no part.
2. Centroids are fitted on a bounded sample. Every class is a member of the shards of its ``OVERLAP`` nearest centroids; a
   shard of more than ``BLOCK`` members is cut into blocks by hash.
3. Each block builds a graph: the nearest members of each one, thinned by robust pruning (a neighbour goes if a nearer
   neighbour is closer to it by the factor ``ALPHA``), with the reverse links, thinned again. A class's lists from its
   shards are united.
4. Every class searches the blocks of its ``probes`` nearest centroids: greedily from the block's medoids with a beam,
   then on from every vector in range until no new one is found. Pairs are verified in double precision. A pair that meets
   in several shards counts once if any of them found it: each sends what it found as bits, which are united.
5. Sampled classes are compared with all others by brute force, ``AUDIT`` of them and more until ``AUDIT_LINKED`` have links,
   or the sample ends. A class's recall is the share of its linked classes that were found. Recall is the mean over classes
   with links, or that over those outside the largest component, if it is less. If it is below ``TARGET``, the search is
   repeated with twice the probes and beam, with all shards probed up to ``MOST_BEAM``, at last by products of whole blocks.

Groups are bounded: a task holds one block and one chunk of queries. Links are counted and reduced to spanning links in
the task, never listed for all pairs; those to be united take a bit for each pair. The sample, and with it the number of
shards, is bounded (``SAMPLE`` rows, ``SAMPLE_BYTES``, ``MAX_SHARDS``); beyond that, shards have more blocks.

Defined cases: vectors of different lengths are never linked, each length is searched by itself. The class id of a row is the
smallest id it reaches by links, nulls last. Repeated rows are copies of each other, one stays. Rows that take no part have
no links and stay. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import quoted
from patronlens.llm.components import components, spread
from patronlens.sources.staging import stage

COSINE = 0.9
SAMPLE = 20_000
SAMPLE_BYTES = 32_000_000
SHARD = 2_000
MAX_SHARDS = 1_000
OVERLAP = 2
PROBES = 4
BLOCK = 4_000
QUERIES = 4_000
DEGREE = 24
NEAREST = 64
ALPHA = 1.2
BEAM = 24
MOST_BEAM = 192
WIDE = 4
STARTS = 8
# From vectors this near the search goes on, beyond the range itself.
EXPAND = 0.85
AUDIT = 512
AUDIT_LINKED = 200
TARGET = 0.97


def packed(vectors: DataFrame, key: str, embedding: str) -> DataFrame:
    """Stored: id, row, dims (0 for vectors that take no part), digest, unit (packed doubles of length one)."""
    rows = vectors.select(F.col(quoted(key)).alias("id"), F.col(quoted(embedding)).cast("array<double>").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, digests, units = [], [], []
            for value in batch.column(1):
                raw = value.values.to_numpy(zero_copy_only=False).astype("<f8") if value.is_valid else np.zeros(0)
                raw = raw + 0.0  # one zero
                top = np.abs(raw).max() if len(raw) and np.isfinite(raw).all() else 0.0
                scaled = raw / top if top > 0 else raw
                dims.append(len(raw) if top > 0 else 0)
                digests.append(xxhash.xxh3_128_digest(raw.tobytes()))
                units.append((scaled / np.sqrt(scaled @ scaled)).tobytes() if top > 0 else b"")
            columns = [batch.column(0), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(units, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "dims", "digest", "unit"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, dims int, digest binary, unit binary")
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "vectors")


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dims)


def centroids(sample: np.ndarray, count: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(seed)
    centers = sample[rng.choice(len(sample), count, replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, sample)
        empty = np.bincount(nearest, minlength=count) == 0
        sums[empty] = sample[rng.choice(len(sample), int(empty.sum()))]
        centers = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-30)
    return centers


def assign(classes: DataFrame, centers: np.ndarray, probes: int) -> DataFrame:
    """``rep, n, unit`` with the shards a class is a member of, and those it searches, nearest first."""
    dims = centers.shape[1]
    shared = classes.sparkSession.sparkContext.broadcast(centers)  # at most MAX_SHARDS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.argsort(-(matrix(batch.column(2), dims) @ shared.value.T), axis=1, kind="stable")
            both = [pa.array(near[:, :k].astype(np.int32).tolist(), pa.list_(pa.int32())) for k in (OVERLAP, probes)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *both], ["rep", "n", "unit", "members", "probes"])

    return classes.select("rep", "n", "unit").mapInArrow(
        run, "rep long, n long, unit binary, members array<int>, probes array<int>"
    )


def thinned(vectors: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Robust pruning of each row of candidates (nearest first, -1 for none) down to ``DEGREE``."""
    out = np.full((len(near), DEGREE), -1, np.int64)
    for low in range(0, len(near), 256):
        rows = near[low : low + 256]
        own = vectors[low : low + 256]
        candidates = vectors[rows]
        gap = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ncd,nd->nc", candidates, own)))
        alive = rows >= 0
        for k in range(DEGREE):
            first = alive.argmax(axis=1)
            some = np.nonzero(alive.any(axis=1))[0]
            if not len(some):
                break
            pick = first[some]
            out[low + some, k] = rows[some, pick]
            between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ncd,nd->nc", candidates[some], candidates[some, pick])))
            alive[some] &= ALPHA * between > gap[some]
            alive[some, pick] = False
    return out


def build(vectors: np.ndarray) -> np.ndarray:
    """Neighbours of each member of a block, -1 where there are fewer than ``DEGREE``."""
    size = len(vectors)
    if size < 2:
        return np.full((size, DEGREE), -1, np.int64)
    width = min(NEAREST, size - 1)
    near = np.empty((size, width), np.int64)
    for low in range(0, size, 512):
        close = vectors[low : low + 512] @ vectors.T
        close[np.arange(len(close)), np.arange(low, low + len(close))] = -2
        part = np.argpartition(-close, width - 1, axis=1)[:, :width]
        order = np.argsort(-np.take_along_axis(close, part, axis=1), axis=1, kind="stable")
        near[low : low + 512] = np.take_along_axis(part, order, axis=1)
    graph = thinned(vectors, near)
    # With the reverse links, nearest first, thinned once more.
    a, k = np.nonzero(graph >= 0)
    b = graph[a, k]
    ends = np.unique(np.concatenate([a * size + b, b * size + a]))
    a, b = ends // size, ends % size
    close = np.einsum("nd,nd->n", vectors[a], vectors[b])
    order = np.lexsort((-close, a))
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    both = np.full((size, NEAREST), -1, np.int64)
    inside = place < NEAREST
    both[a[inside], place[inside]] = b[inside]
    return thinned(vectors, both)


def starts(vectors: np.ndarray) -> np.ndarray:
    """The medoid, and medoids of the parts that are farthest from those before."""
    first = int((vectors @ vectors.mean(axis=0)).argmax())
    out, closest = [first], vectors @ vectors[first]
    while len(out) < min(STARTS, len(vectors)):
        out.append(int(closest.argmin()))
        closest = np.maximum(closest, vectors @ vectors[out[-1]])
    return np.array(out)


def search(vectors: np.ndarray, graph: np.ndarray, queries: np.ndarray, cosine: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, member) of ``cosine`` or more that greedy search with range expansion finds."""
    found: list[np.ndarray] = []
    seeds = starts(vectors)
    for low in range(0, len(queries), 256):
        own = queries[low : low + 256]
        hits = _search_some(vectors, graph, own, seeds, cosine, beam)
        found.append(np.stack([hits[0] + low, hits[1]]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    # Verified as a product of unit vectors in double precision, all at once.
    sure = np.einsum("nd,nd->n", queries[pairs[0]], vectors[pairs[1]]) >= cosine
    return pairs[0][sure], pairs[1][sure]


def _search_some(vectors, graph, own, seeds, cosine, beam) -> tuple[np.ndarray, np.ndarray]:
    size, many = len(vectors), len(own)
    single, ours = vectors.astype(np.float32), own.astype(np.float32)
    seen, done = np.zeros(many * size, bool), np.zeros(many * size, bool)
    row = np.repeat(np.arange(many), len(seeds))
    node = np.tile(seeds, many)
    close = np.einsum("nd,nd->n", ours[row], single[node])
    seen[row * size + node] = True
    held_row, held_node, held_close = row, node, close  # the beam of each query
    all_row, all_node, all_close = [row], [node], [close]

    def visit(r: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """New neighbours of the given nodes, per query."""
        done[r * size + n] = True
        to = graph[n]
        flat = (r[:, None] * size + to)[to >= 0]
        flat = np.unique(flat[~seen[flat]])
        seen[flat] = True
        r, n = flat // size, flat % size
        c = np.einsum("nd,nd->n", ours[r], single[n])
        all_row.append(r), all_node.append(n), all_close.append(c)
        return r, n, c

    while True:
        order = np.lexsort((-held_close, held_row))
        held_row, held_node, held_close = held_row[order], held_node[order], held_close[order]
        inside = np.arange(len(held_row)) - np.searchsorted(held_row, held_row) < beam
        held_row, held_node, held_close = held_row[inside], held_node[inside], held_close[inside]
        fresh_ = ~done[held_row * size + held_node]
        r, n = held_row[fresh_], held_node[fresh_]
        first = np.arange(len(r)) - np.searchsorted(r, r) < WIDE
        if not len(r):
            break
        new = visit(r[first], n[first])
        held_row, held_node, held_close = (np.concatenate(x) for x in zip((held_row, held_node, held_close), new))
    r, n, c = (np.concatenate(x) for x in (all_row, all_node, all_close))
    while True:
        go = (c >= min(EXPAND, cosine)) & ~done[r * size + n]
        if not go.any():
            break
        r, n, c = visit(r[go], n[go])
    r, n, c = (np.concatenate(x) for x in (all_row, all_node, all_close))
    near = c >= cosine - 1e-4  # single precision; verified afterwards
    return r[near], n[near]


def products(vectors: np.ndarray, queries: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (query, member) of ``cosine`` or more."""
    found = [np.nonzero(queries[low : low + 256] @ vectors.T >= cosine) for low in range(0, len(queries), 256)]
    return np.concatenate([q + 256 * k for k, (q, _) in enumerate(found)]), np.concatenate([m for _, m in found])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table per group of rows with equal keys; rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(max(0, batch.num_rows - 1), bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        edges = [0, *(np.nonzero(change)[0] + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            if stop == start:
                continue
            now = tuple(c[start] for c in columns)
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def member_rows(assigned: DataFrame, shards: DataFrame) -> DataFrame:
    """Members of every block: shard, block, rep, n, unit, members. ``shards`` has a row per shard, so it is broadcast."""
    rows = assigned.select("rep", "n", "unit", "members", F.explode("members").alias("shard")).join(F.broadcast(shards), "shard")
    return rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))


def build_graph(members: DataFrame, dims: int) -> DataFrame:
    """Stored: rep, neighbours (of all its shards)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["shard", "block"]):
            rep = table.column("rep").to_numpy()
            graph = build(matrix(table.column("unit"), dims))
            lists = [rep[g[g >= 0]].tolist() for g in graph]
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(lists, pa.list_(pa.int64()))], ["rep", "neighbours"])

    rows = members.select("shard", "block", "rep", "unit").repartition("shard", "block").sortWithinPartitions("shard", "block", "rep")
    lists = rows.mapInArrow(run, "rep long, neighbours array<long>")
    return stage(lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")), "graph")


LINKS = pa.schema([(name, pa.int64()) for name in ("a", "b", "links", "partners")])
# What a block found of the pairs that meet in other blocks too: a row of bits per asking class, a bit per member.
FOUND = pa.schema(
    [("cell", pa.string()), ("asks", pa.list_(pa.int64())), ("weights", pa.list_(pa.int64())), ("bits", pa.binary())]
)


def search_blocks(
    assigned: DataFrame, members: DataFrame, graph: DataFrame, shards: DataFrame, dims: int, cosine: float, beam: int | None
) -> DataFrame:
    """Stored: a, b (of one component), links (rows), partners (classes): of each searching class, in any number of rows.

    Without a beam, whole blocks are compared, every member in its nearest shard; all shards must be probed.
    """
    if beam is None:
        nodes = members.where(F.col("members")[0] == F.col("shard")).withColumn("members", F.slice("members", 1, 1))
        nodes = nodes.withColumn("neighbours", F.lit(None).cast("array<long>"))
    else:
        nodes = members.join(graph, "rep")
    nodes = nodes.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    nodes = nodes.withColumns({"kind": F.lit(0), "shards": F.col("members"), "hash": F.xxhash64("rep")})
    asks = assigned.select("rep", "n", "unit", "probes", F.explode("probes").alias("shard")).join(F.broadcast(shards), "shard")
    asks = asks.withColumn("hash", F.xxhash64("rep", F.lit(1)))
    asks = asks.withColumn("chunk", F.pmod("hash", F.col("chunks")).cast("int"))
    asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asks = asks.withColumns({"kind": F.lit(1), "shards": F.col("probes"), "neighbours": F.lit(None).cast("array<long>")})
    columns = ["shard", "block", "chunk", "kind", "rep", "n", "unit", "shards", "neighbours", "hash"]
    parts = {r.shard: (r.blocks, r.chunks) for r in shards.collect()}  # at most MAX_SHARDS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["shard", "block", "chunk"]):
            links, found = _block_links(table, dims, cosine, beam, parts)
            for some in (links, found):
                size = len(some[0])
                each = {name: pa.array(c, t) for (name, t), c in zip(_typed(LINKS if some is links else FOUND), some)}
                yield pa.RecordBatch.from_arrays(
                    [each[name] if name in each else pa.nulls(size, t) for name, t in _typed([*LINKS, *FOUND])],
                    [*LINKS.names, *FOUND.names],
                )

    keys = ["shard", "block", "chunk"]
    rows = nodes.select(columns).unionByName(asks.select(columns)).repartition(*keys).sortWithinPartitions(*keys, "kind", "rep")
    schema = "a long, b long, links long, partners long, cell string, asks array<long>, weights array<long>, bits binary"
    rows = stage(rows.mapInArrow(run, schema), "block-links")
    once = rows.where(F.col("cell").isNull()).select(LINKS.names)
    return stage(once.unionByName(united(rows.where(F.col("cell").isNotNull()).select(FOUND.names))), "vector-links")


def _typed(fields) -> list[tuple[str, pa.DataType]]:
    return [(f.name, f.type) for f in fields]


def united(found: DataFrame) -> DataFrame:
    """a, b (the same), links, partners: of pairs that several blocks may have found, each counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["cell"]):
            weights = table.column("weights")[0].values.to_numpy()
            asks = [a.values.to_numpy() for a in table.column("asks")]
            names = np.unique(np.concatenate(asks))
            seen = np.zeros((len(names), len(weights)), bool)
            for own, bits in zip(asks, table.column("bits")):
                rows = np.frombuffer(bits.as_buffer(), np.uint8).reshape(len(own), -1)
                seen[np.searchsorted(names, own)] |= np.unpackbits(rows, axis=1, count=len(weights)).view(bool)
            columns = (names, names, seen @ weights, seen.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=LINKS)

    return found.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long, links long, partners long")


def roots_of(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``size`` items reaches over the pairs (a, b)."""
    root = np.arange(size)
    while len(a):
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _block_links(table: pa.Table, dims: int, cosine: float, beam: int | None, parts: dict[int, tuple[int, int]]) -> tuple[list, list]:
    """Columns of ``LINKS``, with pairs that meet here only, and of ``FOUND``, with those that meet in other shards too."""
    kind = table.column("kind").to_numpy()
    split = int((kind == 0).sum())
    if split == 0 or split == len(kind):
        return [[]] * 4, [[]] * 4
    rep, n, unit = table.column("rep").to_numpy(), table.column("n").to_numpy(), matrix(table.column("unit"), dims)
    if beam is None:
        asks, nodes = products(unit[:split], unit[split:], cosine)
    else:
        lists = table.column("neighbours").slice(0, split).to_pylist()
        width = max(1, max(map(len, lists)))
        graph = np.full((split, width), -1, np.int64)
        for k, neighbours in enumerate(lists):
            ids = np.array(neighbours, np.int64)
            place = np.minimum(np.searchsorted(rep[:split], ids), split - 1)
            place = place[rep[place] == ids]  # those of other shards are reached there
            graph[k, : len(place)] = place
        asks, nodes = search(unit[:split], graph, unit[split:], cosine, beam)
    other = rep[split + asks] != rep[nodes]
    asks, nodes = asks[other], nodes[other]
    own = np.unique(rep, return_inverse=True)
    a, b = own[1][split + asks], own[1][nodes]
    roots = roots_of(len(own[0]), a, b)
    touched = np.union1d(a, b)
    # Shards that both meet in.
    held = np.array(table.column("shards").slice(0, split).to_pylist())
    names, place = np.unique(held, return_inverse=True)
    place = place.reshape(held.shape)
    probed = np.array(table.column("shards").slice(split).to_pylist())
    column = np.minimum(np.searchsorted(names, probed), len(names) - 1)
    row, k = np.nonzero(names[column] == probed)
    asked = np.zeros((len(probed), len(names)), bool)
    asked[row, column[row, k]] = True
    meet = sum(asked[asks, place[nodes, j]].astype(np.int64) for j in range(held.shape[1]))
    once = meet == 1
    links = np.bincount(a[once], n[nodes[once]], len(own[0])).astype(np.int64)
    hashes = table.column("hash").to_numpy()
    found = _bits(asks[~once], nodes[~once], rep, n[:split], held, hashes[:split], hashes[split:], parts)
    partners = np.bincount(a[once], minlength=len(own[0]))
    return [own[0][touched], own[0][roots[touched]], links[touched], partners[touched]], found


def _bits(asks, nodes, rep, n, held, node_hash, ask_hash, parts) -> list:
    """Columns of ``FOUND``. A cell is the members that lie in the same block of each of their shards, and a chunk of
    classes that ask, so every block that holds some of a cell holds all of it, in the same order."""
    out: list[list] = [[], [], [], []]
    if not len(asks):
        return out
    shards = np.sort(held, axis=1)
    blocks = np.array([[parts[s][0] for s in row] for row in shards.tolist()])
    cells, cell = np.unique(np.hstack([shards, node_hash[:, None] % blocks]), axis=0, return_inverse=True)
    cell = cell.reshape(-1)
    chunks = np.array([parts[s][1] for s in cells[:, 0].tolist()])
    chunk = ask_hash[asks] % chunks[cell[nodes]]
    order = np.lexsort((chunk, cell[nodes]))
    asks, nodes, chunk = asks[order], nodes[order], chunk[order]
    at = cell[nodes]
    edges = np.nonzero(np.diff(at, prepend=-1) | np.diff(chunk, prepend=-1))[0].tolist()
    for start, stop in zip(edges, [*edges[1:], len(at)]):
        inside = np.nonzero(cell == at[start])[0]
        own, row = np.unique(asks[start:stop], return_inverse=True)
        bits = np.zeros((len(own), len(inside)), bool)
        bits[row, np.searchsorted(inside, nodes[start:stop])] = True
        out[0].append(",".join(map(str, [*cells[at[start]].tolist(), int(chunk[start])])))
        out[1].append(rep[len(n) + own])
        out[2].append(n[inside])
        out[3].append(np.packbits(bits, axis=1).tobytes())
    return out


def true_links(classes: DataFrame, audited: list, dims: int, cosine: float) -> DataFrame:
    """By brute force, the number of other classes that the audited ones (part of the sample) are linked with: rep, truth."""
    shared = classes.sparkSession.sparkContext.broadcast(
        (np.array([r.rep for r in audited]), np.frombuffer(b"".join(r.unit for r in audited), "<f8").reshape(-1, dims))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reps, units = shared.value
        total = np.zeros(len(reps), np.int64)
        for batch in batches:
            rep, unit = batch.column(0).to_numpy(), matrix(batch.column(1), dims)
            for low in range(0, len(reps), AUDIT):
                some = slice(low, low + AUDIT)
                total[some] += ((unit @ units[some].T >= cosine) & (rep[:, None] != reps[None, some])).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(total)], ["rep", "links"])

    each = classes.select("rep", "unit").mapInArrow(run, "rep long, links long")
    return stage(each.groupBy("rep").agg(F.sum("links").alias("truth")), "audit")


def audited_recall(truth: DataFrame, links: DataFrame) -> tuple[int, float | None, int, float | None]:
    """Audited classes with links and their mean recall, and the same for those outside the largest component."""
    found = links.groupBy(F.col("a").alias("rep")).agg(F.sum("partners").alias("found"), F.min("b").alias("root"))
    largest = found.groupBy("root").agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("m"), "root").first()
    seen = truth.where(F.col("truth") > 0).join(found, "rep", "left")
    recall = F.least(F.coalesce("found", F.lit(0)) / F.col("truth"), F.lit(1.0))
    outside = F.coalesce(F.col("root") != F.lit(largest.root if largest else None).cast("long"), F.lit(True))
    return tuple(
        seen.agg(F.count(F.lit(1)), F.avg(recall), F.count(F.when(outside, 1)), F.avg(F.when(outside, recall))).first()
    )


def links_of_length(classes: DataFrame, dims: int, cosine: float, probes: int) -> tuple[DataFrame, float | None]:
    """Links among vectors of one length, b being the root of a's component, and the audited recall."""
    most = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * dims)))
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(most).select("rep", "unit").collect()
    total = classes.count()
    points = np.frombuffer(b"".join(r.unit for r in sample), "<f8").reshape(-1, dims)
    count = max(1, min(MAX_SHARDS, len(points) // 4, math.ceil(total / SHARD)))
    centers = centroids(points, count)
    done = min(AUDIT, len(sample))
    truth = true_links(classes, sample[:done], dims, cosine)
    graph, beam = None, BEAM
    while True:
        assigned = stage(assign(classes, centers, probes), "assigned")
        held = assigned.select(F.explode("members").alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("m"))
        asked = assigned.select(F.explode("probes").alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("q"))
        shards = held.join(asked, "shard").select(
            "shard", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("q") / QUERIES).cast("int").alias("chunks")
        )
        shards = stage(shards, "shards")
        members = member_rows(assigned, shards)
        graph = build_graph(members, dims) if graph is None else graph
        links = search_blocks(assigned, members, graph, shards, dims, cosine, beam)
        counts = links.groupBy("a").agg(F.sum("links").alias("links"), F.sum("partners").alias("partners"))
        roots = components(links).select(F.col("node").alias("a"), "root")
        links = counts.join(roots, "a", "left").select("a", F.coalesce("root", "a").alias("b"), "links", "partners")
        links = stage(links, "rooted-links")
        while True:
            linked, all_, apart, outside = audited_recall(truth, links)
            if apart >= AUDIT_LINKED or done == len(sample):
                break
            more = sample[done : 2 * done]
            truth, done = truth.unionByName(true_links(classes, more, dims, cosine)), done + len(more)
        # Null if no class of the sample has links; with all classes in the sample there are none then.
        recall = min((r for r in (all_, outside) if r is not None), default=1.0 if done == total else None)
        if recall is None or recall >= TARGET or beam is None:
            return links, recall
        if probes < count:
            probes, beam = min(2 * probes, count), 2 * beam
        else:
            beam = 2 * beam if 2 * beam <= MOST_BEAM else None


def report(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, probes: int = PROBES) -> DataFrame:
    """Per vector: key, n_links, component_id, kept, audited_recall (of its length's search; null if it took
    no part, or no sampled vector has links)."""
    rows = packed(vectors, key, embedding)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    classes = rows.where(F.col("dims") > 0).groupBy("dims", "digest").agg(
        F.min("row").alias("rep"), F.count(F.lit(1)).alias("n"), F.min(order).alias("first"), F.first("unit").alias("unit")
    )
    classes = stage(classes, "vector-classes")
    out = rows.where(F.col("dims") == 0).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"),
        F.lit(None).cast("double").alias("audited_recall"),
    )
    # One length in all tables seen; a length is a property of the model that made the vectors.
    for dims in sorted(r.dims for r in classes.select("dims").distinct().toLocalIterator()):
        own = classes.where(F.col("dims") == dims)
        links, recall = links_of_length(own, dims, cosine, probes)
        part = spread(rows.where(F.col("dims") == dims).select("row", "id", "digest"), own, links)
        out = out.unionByName(
            part.select("id", "n_links", F.col("class_id").alias("component_id"), "kept", F.lit(recall).cast("double").alias("audited_recall"))
        )
    return out.withColumnRenamed("id", key)
