"""Similarity self-join on word shingles by chosen paths.

Documents are sets of five-word shingles; two are linked if the Jaccard similarity of their sets is ``THRESHOLD`` or more.
Equal sets form one class, which takes part once. The join splits the classes again and again on sampled shared tokens:

* A class is embedded as ``SLOTS`` minhashes, so that two classes agree in a slot with a probability of their similarity.
* A run starts with all classes on one path. Each path chooses one slot, or two with a probability of a quarter, by a
  hash of itself; a class goes on along (path, slot, its minhash there), that is, with those that share the token. The
  mean number of branches, 1.25, is one over the threshold, so similar pairs stay together on some path while others part.
* A path with one class ends, one with up to ``LEAF`` is compared by brute force, a larger one is split again.
* What is still large after ``MAX_DEPTH`` splits is a group of near copies, which no token parts. It is cut into blocks
  of ``BLOCK``, and pairs of blocks are compared, each in a task of its own: links are counted, not listed.
* Such a group comes back in every run. The largest of a class's large paths is its home, where it meets all others of the
  same home; on other large paths their blocks are not compared again. So a group costs its square once, not once a run.
* Runs repeat until a pair at the threshold is found with probability ``RECALL`` even on the deepest path of this table;
  the probability follows from the branching, so it does not depend on the data.

Comparing has two steps. Sketches of the minhashes find the members of a path that may have a partner; only these are
then joined with their exact sets. A pair that meets on several paths is handled at its home, if both have the same one,
and else on the smallest path that both have.

Defined cases: words are parted by white space and compared in lower case. A text of fewer than five words is one shingle
of all its words; a text without words (null, empty) is linked with nothing. Repeated rows are documents of their own and
copies of each other. The class id of a document is the smallest id it reaches by links, nulls last. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronlens.llm.chunks import steps
from patronlens.llm.common import fresh, quoted, same_columns, text_of
from patronlens.llm.components import join_hot, local_roots, spread
from patronlens.llm.memos import give_back, take_over
from patronlens.sources.staging import discard, stage

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
SLOTS = 64
LEAF = 200
MAX_DEPTH = 4
BLOCK = 400
SECOND_BRANCH = 0.25
# Share of a path's classes from which a path that it split into is not split again.
SHRINKS = 0.8
# Share of equal slots from which a pair is compared exactly: six standard errors below the threshold.
SKETCH_LEAST = 0.5
MEMO_WORDS = 300_000
# Texts without words: nothing but what parts words.
_WORDLESS = r"^[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*\z"
# Up to so many classes with a possible partner (24 bytes each) are broadcast to the scan of the texts; beyond that, texts
# are shuffled to them.
WANTED_ROWS = 500_000

_rng = np.random.default_rng(97)
_FACTORS = (_rng.integers(1, 2**63, SLOTS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, SLOTS, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Shingle sets of texts; each distinct word of a task is hashed once."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """Sorted distinct 64-bit shingles of each text."""
        take_over("shingles", self.known.clear)
        split = [t.lower().split() for t in texts]
        wanted: set[str] = set().union(*split)
        if len(self.known) + len(wanted) > MEMO_WORDS:
            self.known.clear()
        for word in wanted - self.known.keys():
            self.known[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        look = self.known.__getitem__
        out = []
        for words in split:
            hashed = np.fromiter(map(look, words), np.uint64, len(words))
            size = max(1, len(words) - SHINGLE + 1) if words else 0
            total = np.zeros(size, np.uint64)
            for k in range(min(SHINGLE, len(words))):
                total = (total ^ hashed[k : k + size]) * _STEP
                total ^= total >> np.uint64(32)
            out.append(np.unique(total))
        if len(self.known) > MEMO_WORDS:
            self.known.clear()
        return out

    def forget(self) -> None:
        """At the end of a task: while its worker is idle, the executor needs the memory for the next steps."""
        self.known.clear()
        give_back()


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """``SLOTS`` minhashes of 32 bits."""
    least = np.full(SLOTS, 2**32 - 1, np.uint32)
    for at in range(0, len(shingles), 8192):
        part = shingles[at : at + 8192]
        mixed = (part[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]) >> np.uint64(32)
        least = np.minimum(least, mixed.min(axis=1).astype(np.uint32))
    return least


_SHINGLES = Shingles()


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Stored: id, mark (hash of the text), row, digest of the set, size, minhashes. One row per document."""
    rows = docs.select(
        F.col(quoted(key)).alias("id"), F.xxhash64(text_of(docs, text)).alias("mark"), text_of(docs, text).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in steps(batch.column(2)):
                sets = _SHINGLES.sets(texts)
                flat = np.concatenate([minhashes(s) for s in sets]).view(np.int32)
                ends = np.arange(0, SLOTS * len(sets) + 1, SLOTS, dtype=np.int32)
                same = batch.slice(row, len(texts))
                columns = [
                    same.column(0),
                    same.column(1),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "digest", "size", "minhash"])
        _SHINGLES.forget()

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, mark long, digest binary, size long, minhash array<int>")
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "signatures")


def set_classes(signed: DataFrame) -> DataFrame:
    """Stored: one row per distinct set: rep (its first row), digest, n, first id, minhashes."""
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    groups = signed.where(F.col("size") > 0).groupBy("digest").agg(
        F.min("row").alias("rep"), F.count(F.lit(1)).alias("n"), F.min(order).alias("first"), F.first("minhash").alias("minhash")
    )
    return stage(groups, "set-classes")


def survival(depth: int, similarity: float = THRESHOLD) -> float:
    """Probability that a pair is together on some path of one run after ``depth`` splits."""
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - SECOND_BRANCH) * (1 - similarity * p) - SECOND_BRANCH * (1 - similarity * p) ** 2
    return p


def runs_needed(depth: int, recall: float = RECALL) -> int:
    """Runs until a pair at the threshold is missed with a probability of ``1 - recall`` at most. All runs draw from the
    same minhashes, so they are independent only given how many of these agree."""
    chances = []
    for k in range(SLOTS + 1):
        share = math.comb(SLOTS, k) * THRESHOLD**k * (1 - THRESHOLD) ** (SLOTS - k)
        chances.append((share, 1 - survival(max(1, depth), k / SLOTS)))
    runs = 1
    while sum(share * missed**runs for share, missed in chances) > 1 - recall:
        runs += 1
    return runs


def _first_paths(classes: DataFrame, runs: range) -> DataFrame:
    """The first split of some runs: rep, path."""
    paths = []
    for run in runs:
        random_ = random.Random(run)
        for slot in random_.sample(range(SLOTS), 2 if random_.random() < SECOND_BRANCH else 1):
            paths.append(F.xxhash64(F.lit(run), F.lit(slot), F.col("minhash")[slot]))
    return classes.select("rep", F.explode(F.array(*paths)).alias("path"))


def _next_paths(large: DataFrame, classes: DataFrame) -> DataFrame:
    """One more split of the classes on large paths: rep, path, and the classes there were before the split."""
    slot = F.pmod(F.xxhash64("path", F.lit("slot")), F.lit(SLOTS)).cast("int")
    other = F.pmod(F.xxhash64("path", F.lit("other")), F.lit(SLOTS - 1)).cast("int")
    other = F.pmod(slot + 1 + other, F.lit(SLOTS))
    second = F.pmod(F.xxhash64("path", F.lit("second")), F.lit(1000)) < int(1000 * SECOND_BRANCH)
    rows = large.select("rep", "path", F.col("m").alias("was")).join(classes.select("rep", "minhash"), "rep")
    one = F.xxhash64("path", slot, F.get("minhash", slot))
    two = F.xxhash64("path", other, F.get("minhash", other))
    return rows.select("rep", "was", F.explode(F.when(second, F.array(one, two)).otherwise(F.array(one))).alias("path"))


def _counted(paths: DataFrame, name: str) -> DataFrame:
    """Stored paths with ``m``, the number of classes on each; those of one class are left out."""
    paths = stage(paths, f"{name}-paths")
    total = paths.count()
    sizes = stage(paths.groupBy("path").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1), f"{name}-sizes")
    counted = stage(join_hot(paths, sizes, "path", "m", total), name)
    discard(paths, sizes)
    return counted


def leaf_paths(classes: DataFrame, recall: float = RECALL) -> DataFrame:
    """Paths to compare: rep, path, m."""
    leaves, deepest, done = None, 1, 0
    while done < (needed := runs_needed(deepest, recall)):
        level, depth = _counted(_first_paths(classes, range(done, needed)), "split"), 1
        done = needed
        while True:
            # What a split hardly makes smaller is a group of like sets: more splits would lose links and spare no work.
            splits = F.col("m") > LEAF
            if depth > 1:
                splits &= F.col("m") < SHRINKS * F.col("was")
            large, ended = level.where(splits), level.select("rep", "path", "m")
            if depth == MAX_DEPTH or not large.take(1):
                leaves = ended if leaves is None else leaves.unionByName(ended)
                break
            small = level.where(~splits).select("rep", "path", "m")
            leaves = small if leaves is None else leaves.unionByName(small)
            level, depth = _counted(_next_paths(large, classes), "split"), depth + 1
        deepest = max(deepest, depth)
    return leaves


def class_paths(leaves: DataFrame) -> DataFrame:
    """Stored, per class: rep, paths, home (the largest of its paths of more than ``LEAF`` classes, null without one)."""
    home = F.max(F.when(F.col("m") > LEAF, F.struct("m", "path")))["path"]
    # A class is on a bounded number of paths: runs times branches.
    return stage(leaves.groupBy("rep").agg(F.collect_set("path").alias("paths"), home.alias("home")), "class-paths")


def in_blocks(leaves: DataFrame, known: DataFrame) -> DataFrame:
    """Groups to compare: path, one, two (blocks), block, rep. A path of up to ``LEAF`` classes is one block.

    On a larger one, ``BLOCK`` classes or more of another home are a side of their own, whose blocks meet all blocks but
    each other. All other classes are the path's own side, whose blocks meet all.
    """
    zero = F.lit(0)
    small = leaves.where(F.col("m") <= LEAF).select("path", zero.alias("one"), zero.alias("two"), zero.alias("block"), "rep")
    large = leaves.where(F.col("m") > LEAF).join(known.select("rep", "home"), "rep")
    homes = large.groupBy("path", "home").agg(F.count(F.lit(1)).alias("n"))
    own = (F.col("home") == F.col("path")) | (F.col("n") < BLOCK)
    homes = homes.withColumn("side", F.when(own, F.col("path")).otherwise(F.col("home")))
    # A path has a side for each ``BLOCK`` of its classes at most.
    sides = homes.groupBy("path", "side").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    before = Window.partitionBy("path").orderBy("side").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("blocks").over(Window.partitionBy("path")).cast("int")
    sides = sides.select("path", "side", "blocks", F.coalesce(F.sum("blocks").over(before), zero).cast("int").alias("start"), total.alias("total"))
    sides = stage(homes.select("path", "home", "side").join(sides, ["path", "side"]), "sides")
    rows = large.join(sides, ["path", "home"])
    rows = rows.withColumn("block", F.col("start") + F.pmod(F.xxhash64("rep", "path"), F.col("blocks")).cast("int"))
    meets = F.filter(
        F.sequence(zero, F.col("total") - 1),
        lambda b: (F.col("side") == F.col("path")) | (b < F.col("start")) | (b >= F.col("start") + F.col("blocks")),
    )
    rows = rows.withColumn("other", F.explode(meets))
    return small.unionByName(
        rows.select("path", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "rep")
    )


def grouped(df: DataFrame) -> DataFrame:
    """Rows of a group next to each other in one task."""
    return df.repartition("path", "one", "two").sortWithinPartitions("path", "one", "two", "rep")


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups, several small ones at a time; a group may span batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            held.append(part)
            size += part.num_rows
            if size < 4096:
                continue
            table = pa.Table.from_batches(held)
            starts = _starts(table)
            if len(starts) > 2:  # the last group may go on
                yield table.slice(0, starts[-2])
                rest = table.slice(starts[-2])
                held, size = rest.combine_chunks().to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _starts(table: pa.Table) -> list[int]:
    """First rows of the groups of a table, and its end."""
    keys = [table.column(c).to_numpy() for c in ("path", "one", "two")]
    change = np.zeros(table.num_rows - 1, bool) if table.num_rows else np.zeros(0, bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return [0, *(np.nonzero(change)[0] + 1).tolist(), table.num_rows]


def _candidates(
    sketch: np.ndarray, block: np.ndarray, one: int, two: int, path: int, paths: list[set[int]], homes: list[int | None]
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group (rows a < b) whose sketches allow a link and that are handled on this group's path."""
    if one == two:
        a, b = np.triu_indices(len(sketch), 1)
    else:
        left, right = np.nonzero(block == one)[0], np.nonzero(block == two)[0]
        a, b = np.repeat(left, len(right)), np.tile(right, len(left))
    # Classes without a home have numbers of their own.
    named = {h: k for k, h in enumerate({h for h in homes if h is not None})}
    home = np.array([len(homes) + k if h is None else named[h] for k, h in enumerate(homes)], np.int64)
    here = named.get(path, -1)
    open_ = (home[a] != home[b]) | (home[a] == here)
    a, b = a[open_], b[open_]
    least = math.ceil(SKETCH_LEAST * SLOTS)
    near = np.concatenate(
        [np.zeros(0, bool), *((sketch[a[k : k + 8192]] == sketch[b[k : k + 8192]]).sum(axis=1) >= least for k in range(0, len(a), 8192))]
    )
    a, b = a[near], b[near]
    first = (home[i] == home[j] or min(paths[i] & paths[j]) == path for i, j in zip(a.tolist(), b.tolist()))
    first = np.fromiter(first, bool, len(a))
    return a[first], b[first]


def _unpacked(table: pa.Table) -> Iterator[tuple[int, int, tuple]]:
    """For each group of two rows or more: start, stop, and what ``_candidates`` takes."""
    starts = _starts(table)
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, SLOTS)
    path, one, two, block = (table.column(c).to_numpy() for c in ("path", "one", "two", "block"))
    paths, homes = table.column("paths").to_pylist(), table.column("home").to_pylist()
    for start, stop in zip(starts, starts[1:]):
        if stop - start > 1:
            sets = [set(p) for p in paths[start:stop]]
            blocks = block[start:stop], int(one[start]), int(two[start])
            yield start, stop, (sketch[start:stop], *blocks, int(path[start]), sets, homes[start:stop])


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a group that may have a partner there."""
    for batch in groups(batches):
        keep = np.zeros(batch.num_rows, bool)
        for start, _, here in _unpacked(batch):
            a, b = _candidates(*here)
            keep[start + a] = True
            keep[start + b] = True
        table = batch.filter(pa.array(keep))
        yield from table.combine_chunks().to_batches()


def _linked(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs have a similarity of ``threshold`` or more."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    # Pairs whose sizes rule a link out need no comparison.
    may = np.minimum(sizes[a], sizes[b]) >= threshold * np.maximum(sizes[a], sizes[b])
    out = np.zeros(len(a), bool)
    if not may.any():
        return out
    values, which = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    often = np.bincount(which, minlength=len(values)) > 1  # a shingle of one member is shared with nobody
    column = np.cumsum(often) - 1
    owner, which = owner[often[which]], column[which[often[which]]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = max(256, 4_000_000 // len(sets))
    for low in range(0, int(often.sum()), width):
        x, y = np.searchsorted(which, [low, low + width])
        matrix = np.zeros((len(sets), min(width, int(often.sum()) - low)), np.float32)
        matrix[owner[x:y], which[x:y] - low] = 1
        common += matrix @ matrix.T
    inside = common[a, b].astype(np.float64)
    union = sizes[a] + sizes[b] - inside
    return may & (inside >= threshold * union - 1e-9)


def _counts(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Per group: the number of documents each class is linked with, and links that span the same components."""
    for table in groups(batches):
        rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
        sets = [np.frombuffer(s, "<u8") for s in table.column("shingles").to_pylist()]
        out: list[tuple[int, int, int]] = []
        for start, stop, here in _unpacked(table):
            a, b = _candidates(*here)
            linked = _linked(sets[start:stop], a, b, threshold) if len(a) else np.zeros(0, bool)
            a, b = a[linked], b[linked]
            own, weight = rep[start:stop], n[start:stop]
            links = np.bincount(a, weight[b], stop - start) + np.bincount(b, weight[a], stop - start)
            roots = local_roots(stop - start, a.tolist(), b.tolist())
            for k in np.nonzero(links)[0]:
                out.append((int(own[k]), int(own[roots[k]]), int(links[k])))
        columns = list(zip(*out)) if out else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "links"])


def class_links(docs: DataFrame, classes: DataFrame, signed: DataFrame, text: str, key: str, threshold: float, recall: float) -> DataFrame:
    """Stored: a (a class), b (the root of a in one group), links (documents of other classes that a has links with there)."""
    leaves = leaf_paths(classes, recall)
    known = class_paths(leaves)
    low = F.transform("minhash", lambda m: F.substring(F.lpad(F.hex(m), 8, "0"), -4, 4))
    sketch = F.unhex(F.array_join(low, ""))
    narrow = classes.select("rep", "n", sketch.alias("sketch")).join(known, "rep")
    rows = in_blocks(leaves, known).join(narrow, "rep")
    rows = rows.select("path", "one", "two", "block", "rep", "n", "sketch", "paths", "home")
    schema = rows.schema
    found = stage(grouped(rows).mapInArrow(_promising, schema), "promising")
    wanted = found.select("rep").distinct().join(signed.select(F.col("row").alias("rep"), "id", "mark"), "rep")
    wanted = stage(wanted, "wanted")
    sets = stage(shingle_sets(docs, wanted, text, key), "shingle-sets")
    discard(known, wanted)
    ready = grouped(found.join(sets, "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counts(batches, threshold)

    links = stage(ready.mapInArrow(run, "a long, b long, links long"), "class-links")
    discard(found, sets)
    return links


def shingle_sets(docs: DataFrame, wanted: DataFrame, text: str, key: str) -> DataFrame:
    """rep, shingles (packed) of the wanted documents. Stored ``wanted`` is broadcast only if its counted size allows it."""
    wanted = F.broadcast(wanted) if wanted.count() <= WANTED_ROWS else wanted
    rows = docs.select(
        F.col(quoted(key)).alias("id2"), F.xxhash64(text_of(docs, text)).alias("mark2"), text_of(docs, text).alias("text")
    )
    rows = rows.join(wanted, F.col("id").eqNullSafe(F.col("id2")) & (F.col("mark") == F.col("mark2"))).select("rep", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in steps(batch.column(1)):
                sets = pa.array([s.tobytes() for s in _SHINGLES.sets(texts)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.slice(row, len(texts)).column(0), sets], ["rep", "shingles"])
        _SHINGLES.forget()

    # Repeated rows give the same set more than once.
    return rows.mapInArrow(run, "rep long, shingles binary").dropDuplicates(["rep"])


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL
) -> tuple[DataFrame, DataFrame]:
    """Stored signatures, and per row: row, id, class_id, n_links, kept (one row of each class)."""
    signed = signatures(docs, key, text)
    classes = set_classes(signed)
    links = class_links(docs, classes, signed, text, key, threshold, recall)
    rows = signed.select("row", "id", "digest", "size")
    full = spread(rows.where(F.col("size") > 0), classes, links)
    empty = rows.where(F.col("size") == 0).select(
        "row", "id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept")
    )
    return signed, full.unionByName(empty)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """Per document: key, class_id, n_links (documents linked directly), kept (one document of each class)."""
    _, out = similar_groups(docs, key, text, **parameters)
    return out.select(F.col("id").alias(key), "class_id", "n_links", "kept")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """One document of each class, columns unchanged.

    Rows that repeat id and text are reduced to one where they are read; texts without words all stay and are dealt out
    one by one. So neither a hot id nor the empty text sends its rows to one task.
    """
    signed, out = similar_groups(docs, key, text, **parameters)
    pair, found = fresh(docs, "llm_pair", "llm_found")
    own = signed.where(F.col("size") > 0).select("row", "mark")
    # Equal texts are of one class, so a pair of id and text is kept once at most. Structs are equal where both hold null.
    same = F.struct("id", "mark", F.lit(-1).cast("long").alias("spot"))
    kept = stage(out.where("kept").join(own, "row").select(same.alias(pair), F.lit(True).alias(found)), "kept")
    wordless = text_of(docs, text).rlike(_WORDLESS)
    spot = F.when(wordless, F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("long"))
    mark = F.xxhash64(text_of(docs, text))
    marked = docs.withColumn(pair, F.struct(F.col(quoted(key)).alias("id"), mark.alias("mark"), spot.alias("spot")))
    left = marked.dropDuplicates([pair]).join(kept, pair, "left")
    return same_columns(left.where(F.col(found) | (F.col(f"{pair}.spot") >= 0)), docs.columns)
