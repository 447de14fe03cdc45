"""Removal of lines that many sites share, in DataFrame operations only.

A line is boilerplate when it occurs on ``MIN_SITES`` distinct sites or more. The number of sites of each line is first
estimated: a HyperLogLog sketch of the site per line digest, built in the map tasks and merged by the aggregate, so a line
on a third of all rows costs one sketch per task. Lines whose estimate lies clearly above the threshold are boilerplate,
those clearly below are not, and the ones in between get an exact distinct count over their own occurrences only.

Defined cases: lines are compared without blanks, tabs and carriage returns at their ends; empty lines are no
boilerplate and stay. Null text counts as empty text and comes back as empty text. A null site is one site of its own.
Null or repeated ids and repeated rows are kept as they are: what goes depends on the text alone. An empty table gives an
empty result. Columns of any name are carried along; the result has the two counts under fresh names if needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import fresh, quoted, text_of
from patronlens.sources.staging import stage

MIN_SITES = 5
# 2^12 registers: a relative standard error of 1.6 %.
LOG_REGISTERS = 12
# An estimate within so many standard errors of the threshold, and one site at least, is not trusted.
DOUBT = 4.0


def line_key(line: Column) -> Column:
    """128 bits that stand for a line; null for an empty one."""
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.unhex(F.md5(bare)))


def doubtful(min_sites: int, log_registers: int = LOG_REGISTERS, doubt: float = DOUBT) -> tuple[int, int]:
    """Lowest and highest estimate that call for an exact count."""
    margin = max(1, math.ceil(min_sites * doubt * 1.04 / math.sqrt(2**log_registers)))
    return max(1, min_sites - margin), min_sites + margin


def line_sites(docs: DataFrame, text: str, site: str) -> DataFrame:
    """One row per line: ``line`` (its key) and ``site``."""
    where = F.coalesce(F.xxhash64(F.col(quoted(site)).cast("string")), F.lit(0))
    where = F.when(F.col(quoted(site)).isNull(), F.lit(-1)).otherwise(where)
    lines = docs.select(F.explode(F.split(text_of(docs, text), "\n")).alias("raw"), where.alias("site"))
    return lines.select(line_key(F.col("raw")).alias("line"), "site").where(F.col("line").isNotNull())


def boilerplate_lines(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """Column ``line``: keys of all lines on ``min_sites`` distinct sites or more."""
    lines = line_sites(docs, text, site)
    low, high = doubtful(min_sites)
    spread = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("sites")
    )
    spread = stage(spread.where(F.col("sites") >= low), "line-spread")
    near = stage(spread.where(F.col("sites") <= high).select("line"), "near-lines")
    exact = lines.join(near, "line", "left_semi").distinct().groupBy("line").agg(F.count(F.lit(1)).alias("sites"))
    sure = spread.where(F.col("sites") > high).select("line")
    return stage(sure.unionByName(exact.where(F.col("sites") >= min_sites).select("line")), "boilerplate")


def drop_boilerplate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """Every document without its boilerplate lines, with ``n_lines`` and ``n_removed``."""
    found = boilerplate_lines(docs, text, site, min_sites)
    gone, n_lines, n_removed, mark, lines = fresh(docs, "llm_gone", "n_lines", "n_removed", "llm_mark", "llm_lines")
    marked = docs.withColumn(mark, F.xxhash64(text_of(docs, text)))
    # What goes from a text is a set of its own lines, so it is no larger than the text.
    pairs = marked.select(
        F.col(quoted(key)).alias("id"), F.col(mark).alias("mark"), F.explode(F.split(text_of(docs, text), "\n")).alias("raw")
    ).select("id", "mark", line_key(F.col("raw")).alias("line"))
    hits = pairs.join(found, "line", "left_semi").groupBy("id", "mark").agg(F.collect_set("line").alias("gone"))
    # Stored, so that Spark knows their size: few hits are broadcast and texts stay where they are.
    hits = stage(hits.select(F.col("id").alias(f"{mark}_id"), F.col("mark").alias(f"{mark}_mark"), F.col("gone").alias(gone)), "line-hits")
    joined = marked.join(
        hits,
        F.col(quoted(key)).eqNullSafe(F.col(f"{mark}_id")) & (F.col(mark) == F.col(f"{mark}_mark")),
        "left",
    ).withColumn(lines, F.split(text_of(docs, text), "\n"))
    stays = F.filter(
        lines, lambda line: F.coalesce(~F.array_contains(F.col(gone), line_key(line)), F.lit(True))
    )
    kept = F.when(F.col(gone).isNull(), F.col(lines)).otherwise(stays)
    out = joined.withColumn(n_lines, F.size(lines).cast("long"))
    out = out.withColumn(lines, kept).withColumn(n_removed, F.col(n_lines) - F.size(lines))
    columns = [F.array_join(lines, "\n").alias(c) if c == text else F.col(quoted(c)) for c in docs.columns]
    return out.select(*columns, n_lines, n_removed)
