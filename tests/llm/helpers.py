"""Rows that every operator must bear, and plain versions to compare with."""

from __future__ import annotations

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LONG = "lorem ipsum dolor " * 20_000
ODD_TEXTS = [None, "", " ", "\n\n", "a", "one two three", LONG, "x" * 50_000, "é漢字😀 <|endoftext|> end", "a\tb\r\nc  d"]
# Names that the operators use inside.
CLASHES = ["digest", "row", "keep", "size", "id", "llm_digest", "ids", "spans", "score", "copies", "m_copies", "path", "rep", "text_"]


def documents(spark, rows):
    """A table of documents from (doc_id, text[, lang, source])."""
    full = [(*r, *("en", "src1")[len(r) - 2 :], len(r[1] or "")) if len(r) < 5 else r for r in rows]
    return spark.createDataFrame([tuple(r) for r in full], DOCS)


def odd_documents(spark):
    """Null and repeated ids, null, empty and very long texts, repeated rows."""
    rows = [(k, t, "en", "src1") for k, t in enumerate(ODD_TEXTS)]
    rows += [(None, "a", "en", None), (None, "a", None, "src2"), (3, "\n\n", "en", "src1"), (4, "other", None, None)]
    return documents(spark, rows)


def with_clashes(df):
    """``df`` with columns named like those the operators make."""
    for name in CLASHES:
        if name not in df.columns:
            df = df.selectExpr("*", f"'kept' AS `{name}`")
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
