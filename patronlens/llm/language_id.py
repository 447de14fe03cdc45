"""Language of texts by compression.

Each language has a raw-content dictionary: excerpts of its texts, one after the other, without any training. A text is
compressed by zstandard once with each dictionary; the language whose dictionary makes it smallest is the answer. A size in
bits is a code length, so ``score`` is the share of the best language among ``2 ** -bits``. ``margin`` is how much smaller
the best size is than the second best, as a share of that one; below ``MARGIN`` the answer is ``rejected``.

Letters alone count: texts are lower-cased and everything that is no letter becomes one blank, in dictionaries and texts
alike. Whole texts are compressed in blocks of ``BLOCK_BYTES``, each by itself, since later parts of a long text would find
their matches in the text and no longer in the dictionary. Excerpts are short, so that a passage which many documents
share in another language is no long match.

The dictionaries are a bounded sample: of each language ``SAMPLE_ROWS`` distinct texts in the order of a hash, of each of them
``PIECES`` excerpts of ``PIECE_CHARS`` characters at most, and of these ``DICTIONARY_BYTES``. The ``MAX_LANGUAGES`` languages
with the most texts are learned. Texts are counted by sketches and thinned out by a hash before any of them moves, and
copies are reduced to one where they are read, so neither a frequent language nor a frequent text meets in one task.

Defined cases: null texts and texts without a letter are ``und`` with a score of 0 and are rejected; ties go to the
language with more texts, then to the lesser name. With one learned language every text with a letter gets it, with score
and margin 1; with none every text is ``und``. Rows with a null language or null id are not learned from, but are
predicted like any other. Repeated rows are predicted row by row. An empty table gives an empty result. Columns of any name
are carried along.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm.chunks import steps
from patronlens.llm.common import fresh, quoted, same_columns
from patronlens.llm.memos import take_over

UNKNOWN = "und"
MAX_LANGUAGES = 128
SAMPLE_ROWS = 2048
PIECES = 16
PIECE_CHARS = 64
DICTIONARY_BYTES = 131_072
BLOCK_BYTES = 4096
LEVEL = 6
LEAST_MATCH = 4
MARGIN = 0.01
_THIN = 2**40

_NO_LETTERS = re.compile(r"[\W\d_]+")

Model = list[tuple[str, bytes]]


def letters(text: str) -> str:
    """Lower-case letters of a text, everything between them as one blank."""
    return _NO_LETTERS.sub(" ", text.lower())


def held_out(key: Column) -> Column:
    """Rows that the dictionaries must not contain."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def _excerpts(text: Column) -> Column:
    """Up to ``PIECES`` excerpts at even distances."""
    size = F.length(text)
    count = F.greatest(F.lit(1), F.least(F.lit(PIECES), F.floor(size / PIECE_CHARS).cast("int")))
    starts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.floor(i * size / count).cast("int") + 1)
    return F.transform(starts, lambda at: F.substr(text, at, F.lit(PIECE_CHARS)))


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """The dictionary of one language: first excerpts of all sampled texts, then their second ones, and so on."""
    rows = rows.sort_values("mark").head(SAMPLE_ROWS)
    pieces = [[letters(p).strip().encode() for p in row] for row in rows["pieces"]]
    held, size = [], 0
    for k in range(max(map(len, pieces))):
        for row in pieces:
            if k < len(row) and row[k] and size < DICTIONARY_BYTES:
                held.append(row[k])
                size += len(row[k]) + 1
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "content": [b" ".join(held)[:DICTIONARY_BYTES]]})


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Dictionaries of the languages in order of their numbers of texts, from rows that are not held out."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(quoted(key)).alias("id"), F.col(quoted(text)).alias("text"), F.col(quoted(lang)).cast("string").alias("lang")
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    counted = rows.groupBy("lang").agg(F.approx_count_distinct("mark").alias("n"))
    known = [(r.lang, r.n) for r in counted.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()]
    if not known:
        return []
    # Twice as many texts as wanted are let through, as their number is an estimate.
    shares = spark.createDataFrame([(x, min(1.0, 2 * SAMPLE_ROWS / max(n, 1))) for x, n in known], "lang string, share double")
    place = F.pmod(F.xxhash64("mark", F.lit(11)), F.lit(_THIN)) / _THIN
    thinned = rows.join(F.broadcast(shares), "lang").where(place < F.col("share"))
    sample = thinned.select("lang", "mark", _excerpts(F.col("text")).alias("pieces")).groupBy("lang", "mark").agg(
        F.min("pieces").alias("pieces")
    )
    found = sample.groupBy("lang").applyInPandas(_fill, "lang string, content binary").collect()
    contents = {r.lang: bytes(r.content) for r in found}
    return [(x, contents[x]) for x, _ in known if contents.get(x)]


class Sizer:
    """Sizes of texts under each dictionary."""

    def __init__(self, model: Model):
        self.names = [name for name, _ in model]
        self.coders = []
        for _, content in model:
            settings = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, min_match=LEAST_MATCH, dict_size=len(content), source_size=BLOCK_BYTES,
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=settings)
            self.coders.append(zstandard.ZstdCompressor(dict_data=known, compression_params=settings))

    def sizes(self, plain: str) -> list[int]:
        """Compressed bytes of ``plain`` under each dictionary, all blocks together."""
        data = memoryview(plain.encode())
        blocks = [data[at : at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.coders]

    def best(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin."""
        plain = letters(text or "")
        if not self.names or not any(map(str.isalpha, plain)):
            return UNKNOWN, 0.0, 0.0
        if len(self.names) == 1:
            return self.names[0], 1.0, 1.0
        sizes = np.array(self.sizes(plain), np.float64)
        first = int(sizes.argmin())  # the first among equals
        low, second = np.partition(sizes, 1)[:2]
        return self.names[first], float(1 / np.exp2(-8 * np.minimum(sizes - low, 100)).sum()), float(1 - low / second)


_SIZERS: dict[int, Sizer] = {}


def _sizer(model: Model) -> Sizer:
    take_over("language", _SIZERS.clear)
    key = zlib.crc32(repr(model).encode())
    if key not in _SIZERS:
        _SIZERS.clear()
        _SIZERS[key] = Sizer(model)
    return _SIZERS[key]


def identify(docs: DataFrame, model: Model, text: str = "text", margin: float = MARGIN) -> tuple[DataFrame, list[str]]:
    """``docs`` with four more columns and their names: the language with the smallest size, its score, its margin, and
    whether the margin is too narrow to rely on it."""
    added = fresh(docs, "language", "score", "margin", "rejected")
    names, at = [*docs.columns, *added], docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = _sizer(sent.value)
        for batch in batches:
            for row, texts in steps(batch.column(at)):
                found = [sizer.best(t) for t in texts]
                language, score, gap = zip(*found, strict=True)
                narrow = [x == UNKNOWN or g < margin for x, _, g in found]
                extra = [pa.array(language, pa.string()), pa.array(score, pa.float64()), pa.array(gap, pa.float64()), pa.array(narrow)]
                yield pa.RecordBatch.from_arrays([*batch.slice(row, len(texts)).columns, *extra], names)

    kinds = (T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType())
    fields = [T.StructField(name, kind) for name, kind in zip(added, kinds, strict=True)]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields])), added


def keep_language(docs: DataFrame, model: Model, wanted: list[str], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """Documents in one of the ``wanted`` languages whose margin is wide enough, columns unchanged."""
    found, (language, _, _, rejected) = identify(docs, model, text, margin)
    return same_columns(found.where(F.col(language).isin(wanted) & ~F.col(rejected)), docs.columns)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: key, held_out, lang_pred, score, margin, rejected."""
    narrow = docs.select(F.col(quoted(key)).alias("id"), F.col(quoted(text)).alias("text"))
    found, (language, score, margin, rejected) = identify(narrow, learn(docs, key, text, lang))
    return found.select(
        F.col("id").alias(key), held_out(F.col("id")).alias("held_out"), F.col(language).alias("lang_pred"), score, margin, rejected
    )
