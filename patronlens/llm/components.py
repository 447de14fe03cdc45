"""Connected components of links, by alternating large and small stars.

Each round hangs every node on the smallest node it knows of, first its larger neighbours, then its smaller ones, until
nothing changes; the number of rounds grows with the logarithm of the longest chain. Every round is two aggregates and two
joins, and its links are written to the shared folder, so lineage stays short and no link passes the driver; tables of the
round before are deleted then. The smallest
neighbours are stored before they are joined: Spark then broadcasts them if their size allows it, and otherwise splits the
links of a node with very many of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.sources.staging import discard, stage

# Keys with more than one row in so many are joined by broadcast; there are no more than that of them.
HOT_SHARE = 1000


def _same(before: DataFrame, after: DataFrame) -> bool:
    """Whether two tables of distinct links hold the same ones."""
    return before.count() == after.count() and not after.join(before, ["u", "v"], "left_anti").take(1)


def _star(links: DataFrame, everything: bool) -> DataFrame:
    """Stored links that hang the neighbours of each node on its smallest one: larger neighbours only, or all if links
    point down."""
    if everything:
        least = stage(links.groupBy("u").agg(F.min("v").alias("least")), "least")
        moved = links.join(least, "u").where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        hung = stage(moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct(), "links")
        discard(least)
        return hung
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("least")), "least")
    larger = both.where(F.col("v") > F.col("u")).join(least, "u")
    hung = stage(larger.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct(), "links")
    discard(least)
    return hung


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of a link but the roots themselves; a root is the smallest node of its component.

    Links of a node with itself and links with null are ignored.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNull().alias("x"), F.col(b).isNull().alias("y"))
    links = stage(ends.where(~F.col("x") & ~F.col("y") & (F.col("u") != F.col("v"))).select("u", "v").distinct(), "links")
    while True:
        before, half = links, _star(links, False)
        links = _star(half, True)
        done = _same(before, links)
        discard(before, half)
        if done:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def join_hot(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Join of ``left`` with a row per key. Keys of more than ``total / HOT_SHARE`` rows are broadcast, so their rows
    stay where they are; there are at most ``HOT_SHARE`` such keys, as ``weight`` is the number of their rows in ``left``."""
    hot = F.col(weight) * HOT_SHARE > F.lit(total)
    few = right.where(hot)
    names = few.select(F.col(key))
    warm = left.join(F.broadcast(few), key)
    cold = left.join(F.broadcast(names), key, "left_anti").join(right.where(~hot), key)
    return warm.unionByName(cold)


def spread(rows: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """Per row (row, id, digest): row, id, class_id, n_links, kept.

    ``classes``: digest, rep (a row), n (rows of the class), first (struct of no_id, id, row). ``links``: a and b (classes
    of one component), links (rows of other classes that rows of a are linked with), any number of them per class.
    """
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(links).select(F.col("node").alias("rep"), "root")
    joined = classes.select("digest", "rep", "n", "first").join(counts, "rep", "left").join(roots, "rep", "left")
    joined = stage(joined.withColumn("root", F.coalesce("root", "rep")), "class-roots")
    leads = stage(joined.groupBy("root").agg(F.min("first").alias("lead"), F.count(F.lit(1)).alias("m")), "leads")
    led = stage(join_hot(joined, leads, "root", "m", joined.count()), "class-leads")
    led = led.select("digest", "n", "lead", F.coalesce("links", F.lit(0)).alias("links"))
    return join_hot(rows, led, "digest", "n", rows.count()).select(
        "row",
        "id",
        F.col("lead.id").alias("class_id"),
        (F.col("links") + F.col("n") - 1).alias("n_links"),
        (F.col("row") == F.col("lead.row")).alias("kept"),
    )


def local_roots(size: int, a, b) -> list[int]:
    """Smallest index that each of ``size`` items reaches over the pairs (a, b), in one task."""
    root = list(range(size))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(a, b):
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
    return [find(i) for i in range(size)]
