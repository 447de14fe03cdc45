"""Exact duplicates with a heavy-hitter split, in DataFrame operations only.

Texts are equal when they are identical after every run of white space became one blank. Digests that fill a noticeable
share of the table would send their rows to one task, so they take another road:

1. A Misra-Gries summary (Spark's ``approx_top_k``: counters that are decremented together when the summary is full) is
   kept per map task and merged in two steps. It can miss no digest above about ``1 / HEAVY_ITEMS`` of the rows.
2. Its candidates are counted exactly. Those with two rows or more are winners: at most ``HEAVY_ITEMS`` rows, so they are
   broadcast, and rows of a winner are settled where they are read.
3. The other digests are shuffled as usual. No such group is larger than the share above.

Defined cases: null text counts as empty; all empty texts are one group. The smallest ``doc_id`` of a group stays, nulls
last. Rows that repeat with the same id and text are copies too, and one of them stays. An empty table gives an empty
result. Columns of any name are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.llm.common import fresh, quoted, same_columns, text_of
from patronlens.sources.staging import stage

# Counters of one Misra-Gries summary; also the bound of the broadcast.
HEAVY_ITEMS = 1024
# Tasks that merge the summaries of all map tasks before the last one merges theirs.
MERGE_TASKS = 64

# Runs of white space other than a single blank: replacing these alone leaves most texts as they are.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """``text`` with each run of white space as one blank."""
    return F.regexp_replace(text, _RUNS, " ")


def text_digest(df: DataFrame, text: str = "text") -> Column:
    """Lowercase SHA-256 of the normalised text."""
    return F.sha2(normalised(text_of(df, text)), 256)


def heavy_candidates(digests: DataFrame, items: int = HEAVY_ITEMS) -> DataFrame:
    """Column ``digest``: everything a Misra-Gries summary of the rows holds, ``items`` rows at most."""
    per_task = digests.groupBy((F.spark_partition_id() % MERGE_TASKS).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(digest, {items})").alias("summary")
    )
    # A key that is 0 for every part: without one, a task without rows would add a summary that cannot be merged.
    merged = per_task.groupBy(F.floor(F.col("part") / MERGE_TASKS)).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(summary), {items})").alias("top")
    )
    return merged.select(F.explode("top").alias("t")).select(F.col("t.item").alias("digest"))


def heavy_winners(digests: DataFrame, items: int = HEAVY_ITEMS) -> DataFrame:
    """Verified heavy digests: ``digest``, ``keep`` (the row that stays), ``size``. ``items`` rows at most."""
    candidates = F.broadcast(heavy_candidates(digests, items))
    counted = digests.join(candidates, "digest").groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("keep"), F.count(F.lit(1)).alias("size")
    )
    return stage(counted.where(F.col("size") > 1), "heavy-digests")


def stored_digests(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``digest`` and a row number that stays the same because it is stored."""
    narrow = docs.select(F.col(quoted(key)).alias("id"), text_digest(docs, text).alias("digest"))
    return stage(narrow.withColumn("row", F.monotonically_increasing_id()), "digests")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", items: int = HEAVY_ITEMS) -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256."""
    digests = stored_digests(docs, key, text)
    marked = digests.join(F.broadcast(heavy_winners(digests, items)), "digest", "left")
    heavy = marked.where(F.col("size").isNotNull()).select(
        "id", F.col("keep.id").alias("keep_id"), "size", (F.col("row") == F.col("keep.row")).alias("kept"), "digest"
    )
    group = Window.partitionBy("digest")
    first = group.orderBy(F.col("id").asc_nulls_last(), "row")
    light = marked.where(F.col("size").isNull()).select(
        "id",
        F.min("id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("size"),
        (F.row_number().over(first) == 1).alias("kept"),
        "digest",
    )
    return heavy.unionByName(light).select(
        F.col("id").alias(key), "keep_id", F.col("size").alias("group_size"), "kept", F.col("digest").alias("text_sha256")
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", items: int = HEAVY_ITEMS) -> DataFrame:
    """The document of each group that stays, all columns unchanged.

    Texts are shuffled once, and of a heavy group only its winner is. Rows that repeat the winner's id as well are reduced
    where they are read, one row a task.
    """
    winners = heavy_winners(stored_digests(docs, key, text), items)
    digest, keep, best = fresh(docs, "llm_digest", "llm_keep", "llm_best")
    won = winners.select(F.col("digest").alias(digest), F.struct(F.col("keep.id").alias("id")).alias(keep))
    marked = docs.withColumn(digest, text_digest(docs, text)).join(F.broadcast(won), digest, "left")
    left = marked.where(F.col(keep).isNull() | F.col(quoted(key)).eqNullSafe(F.col(f"{keep}.id")))
    own = F.struct(*[F.col(quoted(c)) for c in docs.columns])
    order = F.struct(F.col(quoted(key)).isNull(), F.col(quoted(key)))
    return left.groupBy(digest).agg(F.min_by(own, order).alias(best)).select(f"{best}.*")
