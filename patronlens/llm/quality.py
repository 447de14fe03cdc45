"""Quality scores by supervised subword embeddings.

A document is the average of learned vectors: one for each word, one for each group of 3 to 5 characters inside a word
with its borders marked, and one for each word that stands again at most three words later. Words and groups share a
table of ``BUCKETS`` hashed rows. A softmax over two classes reads the average. Vectors and output are trained together
by plain stochastic gradient descent in numpy.

The fit uses a bounded sample of labelled rows: ``SAMPLE_ROWS`` rows in the order of a hash of their ids, and of these as
many as have ``SAMPLE_FEATURES`` distinct features in total. Features are counted by Spark tasks; only those of the
sample come to the driver. Scoring reads every whole text: as averaging and the output layer are linear, each bucket
contributes one number, so a document's score is a mean of such numbers.

Defined cases: null text counts as empty; an empty text is the zero vector and gets the score of the output's offsets.
Rows without a usable label (null, or not 0 or 1) are no training rows. Without labelled rows of both classes all scores
are the only class seen, 1 if there is none. Repeated rows and null ids are scored like any other row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.chunks import steps
from patronlens.llm.common import fresh, quoted, same_columns, text_of
from patronlens.llm.memos import take_over
from patronlens.sources.staging import stage

SAMPLE_ROWS = 4_000
SAMPLE_FEATURES = 8_000_000
BUCKET_BITS = 17
BUCKETS = 2**BUCKET_BITS
GROUPS = (3, 4, 5)
LAGS = (1, 2, 3)
DIMENSIONS = 16
EPOCHS = 8
RATE = 2.0
# Words that one Python worker remembers.
MEMO_WORDS = 400_000

_STEP = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashed: np.ndarray, salt: int) -> np.ndarray:
    mixed = (hashed ^ np.uint64(salt)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _MIX) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


# Buckets of "the same word again".
AGAIN = [int(_bucket(np.array([lag], np.uint64), 1000 + lag)[0]) for lag in LAGS]


def word_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words one after the other, and how many each word has. Words of like length share a matrix."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    counts = 1 + sum(np.maximum(sizes - n + 1, 0) for n in GROUPS)
    flat = np.empty(int(counts.sum()), np.int64)
    starts = np.cumsum(counts) - counts
    classes = np.ceil(np.log2(np.maximum(sizes, 4))).astype(np.int64)
    for c in np.unique(classes):
        mine = np.nonzero(classes == c)[0]
        width = 2 ** int(c)
        raw = "".join(f"<{words[i]}>".ljust(width, "\0") for i in mine.tolist())
        letters = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(mine), width).astype(np.uint64)
        length = sizes[mine]
        whole = np.zeros(len(mine), np.uint64)
        for k in range(width):
            whole = np.where(k < length, (whole ^ letters[:, k]) * _STEP, whole)
        flat[starts[mine]] = _bucket(whole, 1)
        at = starts[mine] + 1
        for n in GROUPS:
            if width < n:
                continue
            hashed = np.zeros((len(mine), width - n + 1), np.uint64)
            for k in range(n):
                hashed = (hashed ^ letters[:, k : k + width - n + 1]) * _STEP
            have = np.arange(width - n + 1) < (length - n + 1)[:, None]
            place = at[:, None] + np.arange(width - n + 1)
            flat[place[have]] = _bucket(hashed[have], n)
            at = at + np.maximum(length - n + 1, 0)
    return flat, counts


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    different, each, times = np.unique(np.array(words, object), return_inverse=True, return_counts=True)
    flat, counts = word_buckets(different.tolist())
    weights = [np.repeat(times, counts)]
    buckets = [flat]
    for lag, bucket in zip(LAGS, AGAIN, strict=True):
        buckets.append(np.array([bucket]))
        weights.append(np.array([int((each[lag:] == each[:-lag]).sum())]))
    total = np.bincount(np.concatenate(buckets), np.concatenate(weights), BUCKETS)
    found = np.nonzero(total)[0]
    return found, total[found].astype(np.int64)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 5) -> tuple[np.ndarray, float]:
    """Gradient descent over (buckets, counts, label); gives each bucket's share in the score, and the offset."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((2, DIMENSIONS), np.float32)
    offset = np.zeros(2, np.float32)
    ready = [r for r in rows if len(r[0])]
    done, steps_ = 0, max(1, EPOCHS * len(ready))
    for _ in range(EPOCHS):
        for k in rng.permutation(len(ready)):
            buckets, counts, label = ready[k]
            weights = (counts / counts.sum()).astype(np.float32)
            rate = np.float32(RATE * (1 - done / steps_))
            done += 1
            own = vectors[buckets]
            average = weights @ own
            logits = output @ average + offset
            odds = np.exp(logits - logits.max())
            slope = odds / odds.sum()
            slope[label] -= 1
            back = slope @ output
            output -= rate * np.outer(slope, average)
            offset -= np.float32(0.1) * rate * slope
            # A bucket moves by its share in the average; the root lets long texts learn as fast as short ones.
            vectors[buckets] = own - (rate * weights * len(buckets) ** 0.5)[:, None] * back[None, :]
    return (vectors @ (output[1] - output[0])).astype(np.float64), float(offset[1] - offset[0])


class Scorer:
    """Scores texts with the trained numbers, each distinct word hashed once."""

    def __init__(self, shares: np.ndarray, offset: float):
        self.shares, self.offset = shares, offset
        self.again = shares[AGAIN]
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.sums, self.counts = np.zeros(0), np.zeros(0, np.int64)

    def texts(self, texts: list[str]) -> np.ndarray:
        split = [t.split() for t in texts]
        wanted: set[str] = set().union(*split)
        if len(self.index) + len(wanted) > MEMO_WORDS:
            self._forget()
        new = list(wanted - self.index.keys())
        if new:
            flat, counts = word_buckets(new)
            sums = np.add.reduceat(self.shares[flat], np.cumsum(counts) - counts)
            self.index |= zip(new, range(len(self.sums), len(self.sums) + len(new)), strict=True)
            self.sums, self.counts = np.concatenate([self.sums, sums]), np.concatenate([self.counts, counts])
        look, out = self.index.__getitem__, np.empty(len(texts))
        for k, words in enumerate(split):
            at = np.fromiter(map(look, words), np.int64, len(words))
            total, n = float(self.sums[at].sum()), int(self.counts[at].sum())
            for lag, share in zip(LAGS, self.again, strict=True):
                same = int((at[lag:] == at[:-lag]).sum())
                total, n = total + same * share, n + same
            out[k] = total / max(n, 1) + self.offset
        if len(self.index) > MEMO_WORDS:
            self._forget()
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


_SCORERS: dict[int, Scorer] = {}


def _scorer(packed: bytes, offset: float) -> Scorer:
    take_over("quality", _SCORERS.clear)
    key = zlib.crc32(packed)
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(np.frombuffer(packed, "<f8"), offset)
    return _SCORERS[key]


def held_out(key: Column) -> Column:
    """Rows that the fit must not learn from."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, sample_features: int = SAMPLE_FEATURES,
) -> tuple[np.ndarray, float]:
    """Shares and offset, from labelled rows that are not held out.

    An id counts once: with the smaller label if it has both, and with one of its texts.
    """
    chosen = labels.select(F.col(quoted(key)).alias("id"), F.col(quoted(label)).cast("int").alias("label"))
    chosen = chosen.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    chosen = chosen.groupBy("id").agg(F.min("label").alias("label"))
    # At most sample_rows rows, so they may be broadcast.
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows))
    texts = docs.select(F.col(quoted(key)).alias("id"), text_of(docs, text).alias("text")).join(chosen, "id")
    texts = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in steps(batch.column(1)):
                found = [features(t) for t in part]
                same = batch.slice(row, len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        same.column(0),
                        same.column(2),
                        pa.array([len(b) for b, _ in found], pa.int64()),
                        pa.array([b.astype("<u4").tobytes() for b, _ in found], pa.binary()),
                        pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary()),
                    ],
                    ["id", "label", "size", "buckets", "counts"],
                )

    schema = "id {}, label int, size long, buckets binary, counts binary".format(texts.schema["id"].dataType.simpleString())
    counted = stage(texts.select("id", "text", "label").mapInArrow(run, schema), "quality-sample")
    order = Window.orderBy(F.xxhash64("id"), "id", "label", "size")
    within = counted.withColumn("rank", F.row_number().over(order)).withColumn(
        "total", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    within = within.where((F.col("total") <= sample_features) & (F.col("rank") <= sample_rows))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:  # the counts stay where Arrow put them
            for label, buckets, counts in zip(*batch.columns, strict=True):
                read = (np.frombuffer(v.as_buffer(), "<u4") for v in (buckets, counts))
                rows.append((*read, label.as_py()))
        seen = {y for _, _, y in rows}
        if len(seen) == 2:
            shares, offset = train(rows)
        else:
            shares, offset = np.zeros(BUCKETS), -50.0 if seen == {0} else 50.0
        yield pa.RecordBatch.from_arrays([pa.array([shares.astype("<f8").tobytes()]), pa.array([offset])], ["shares", "offset"])

    # One task holds the sample, whose size is bounded; only the numbers it learned come to the driver.
    ordered = within.coalesce(1).sortWithinPartitions("rank").select("label", "buckets", "counts")
    learned = ordered.mapInArrow(learn, "shares binary, offset double").first()
    if learned is None:
        return np.zeros(BUCKETS), 50.0
    return np.frombuffer(learned["shares"], "<f8"), learned["offset"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1."""
    (out,) = fresh(docs, out)
    names, at = [*docs.columns, out], docs.columns.index(text)
    packed = docs.sparkSession.sparkContext.broadcast((model[0].astype("<f8").tobytes(), model[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(*packed.value)
        for batch in batches:
            for row, part in steps(batch.column(at)):
                scores = pa.array(scorer.texts(part), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.slice(row, len(part)).columns, scores], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, held_out, score, predicted."""
    narrow = docs.select(F.col(quoted(key)).alias("id"), F.col(quoted(text)).alias("text"))
    scored = score(narrow, fit(docs, labels, key, text), "text", "score")
    return scored.select(
        F.col("id").alias(key), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with a score of 0.5 or more, columns unchanged."""
    (name,) = fresh(docs, "llm_score")
    return same_columns(score(docs, fit(docs, labels, key, text), text, name).where(F.col(name) >= 0.5), docs.columns)
