"""Ranking quality and class reports of a scored table.

All operators take the label and score columns by name. Scores are first reduced
to one row per distinct score; running sums over these rows are taken slice by
slice of a global sort and joined with the totals of the earlier slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.operators.ranking import cuts_passed, first_rows_spec, ordered_rows, rank_cuts, slice_of, slice_starts
from patronlens.operators.splits import share_of

CLASSES = ("positives", "negatives")


def score_counts(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Churned and retained rows per distinct score."""
    churned = F.col(label) == 1
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(churned).alias("positives"), F.count_if(~churned).alias("negatives")
    )


def cumulative_counts(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score, the churned and retained rows strictly below it."""
    ordered = ordered_rows(score_counts(scored, label, score), ["score"], "score_counts")
    ordered = ordered.withColumn("slice", slice_of(F.col("position")))
    starts = F.broadcast(slice_starts(ordered, *CLASSES))
    earlier = Window.partitionBy("slice").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    within = {c: F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in CLASSES}
    running = ordered.withColumns({f"{c}_within": column for c, column in within.items()}).join(starts, "slice")
    return running.select(
        "score",
        *CLASSES,
        *[(F.col(f"{c}_before") + F.col(f"{c}_within")).alias(f"{c}_below") for c in CLASSES],
        *[f"{c}_total" for c in CLASSES],
    )


def ranking_metrics(scored: DataFrame, label: str, score: str) -> DataFrame:
    """AUROC and KS in one row.

    AUROC counts tied pairs half and is null if a class is missing. KS is the
    largest distance between the shares of churned and of retained rows at or
    above a score, and zero if a class is missing.
    """
    pairs = F.col("positives").cast("double") * (F.col("negatives_below") + F.col("negatives") / F.lit(2.0))
    distance = F.abs(
        F.try_divide(F.col("positives_below"), F.col("positives_total"))
        - F.try_divide(F.col("negatives_below"), F.col("negatives_total"))
    )
    positives, negatives = (F.max(f"{c}_total").cast("double") for c in CLASSES)
    return cumulative_counts(scored, label, score).agg(
        F.try_divide(F.sum(pairs), positives * negatives).alias("auroc"),
        F.coalesce(F.max(distance), F.lit(0.0)).alias("ks"),
    )


def auroc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve, exact with ties."""
    return ranking_metrics(scored, label, score).select("auroc")


def ks_statistic(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Kolmogorov-Smirnov distance between the classes' scores."""
    return ranking_metrics(scored, label, score).select("ks")


def grouped_auroc(counts: DataFrame, group: str) -> DataFrame:
    """``group`` and exact ``auroc`` from rows of group, score, positives and negatives, a row per group and score.

    One global sort serves all groups: rows below are counted from the start of the table, and what lies before a group
    is taken off its sum afterwards. Sums are whole numbers. Null without both classes.
    """
    whole = "decimal(38,0)"
    ordered = ordered_rows(counts, [group, "score"], "group_scores").withColumn("slice", slice_of(F.col("position")))
    starts = F.broadcast(slice_starts(ordered, "negatives").select("slice", "negatives_before"))
    earlier = Window.partitionBy("slice").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    within = ordered.withColumn("within", F.coalesce(F.sum("negatives").over(earlier), F.lit(0))).join(starts, "slice")
    below = (F.col("negatives_before") + F.col("within")).cast(whole)
    twice = F.col("positives").cast("decimal(18,0)") * (below * F.lit(2) + F.col("negatives")).cast("decimal(20,0)")
    found = within.groupBy(group).agg(
        F.sum(twice.cast(whole)).alias("pairs"), F.min(below).alias("start"),
        F.sum("positives").cast("double").alias("p"), F.sum("negatives").cast("double").alias("n"),
        F.sum("positives").cast("decimal(18,0)").alias("rows"),
    )
    own = (F.col("pairs") - (F.col("rows") * F.col("start").cast("decimal(20,0)") * F.lit(2)).cast(whole)).cast("double")
    return found.select(group, F.try_divide(own, F.lit(2.0) * F.col("p") * F.col("n")).alias("auroc"))


def precision_at_top(scored: DataFrame, label: str, score: str, key: str, share: float = 0.1) -> DataFrame:
    """Share of churned rows among the highest scores, ties going to lower keys.

    ``scored`` is read more than once and should be stored.
    """
    spec = first_rows_spec("top", -F.col(score), lambda n: share_of(n, share))
    cuts = rank_cuts(scored, key, [spec])["top"]
    top = scored.where(cuts_passed(spec, key, cuts) == 0)
    return top.agg(F.count("*").alias("top_rows"), F.avg(F.col(label).cast("double")).alias("precision"))


def predicted_class(score: str, threshold: float = 0.5) -> Column:
    """Class 1 above the threshold."""
    return (F.col(score) > F.lit(threshold)).cast("int")


def classification_report(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and means.

    The confusion counts come from one aggregate; everything else is arithmetic
    on that one row. A class neither present nor predicted is left out, and a
    division by zero gives zero.
    """
    actual, predicted = F.col(label), predicted_class(score)
    counts = scored.agg(
        *[
            F.count_if((actual == a) & (predicted == p)).alias(f"n{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    entries = []
    for c in (0, 1):
        hit, missed, wrong = F.col(f"n{c}{c}"), F.col(f"n{c}{1 - c}"), F.col(f"n{1 - c}{c}")
        entries.append(
            F.struct(
                F.lit(str(c)).alias("name"),
                ratio(hit, hit + wrong).alias("precision"),
                ratio(hit, hit + missed).alias("recall"),
                ratio(F.lit(2) * hit, F.lit(2) * hit + wrong + missed).alias("f1"),
                (hit + missed).alias("support"),
                (hit + missed + wrong > 0).alias("present"),
            )
        )
    classes = counts.select("*", F.filter(F.array(*entries), lambda e: e["present"]).alias("classes"))
    total = F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11")
    accuracy = ratio(F.col("n00") + F.col("n11"), total)

    def mean(measure: str, weighted: bool) -> Column:
        def add(sum_: Column, e: Column) -> Column:
            return sum_ + (e[measure] * e["support"] if weighted else e[measure])

        summed = F.aggregate("classes", F.lit(0.0), add)
        return ratio(summed, total if weighted else F.size("classes"))

    def line(name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            total.alias("support"),
            F.lit(True).alias("present"),
        )

    measures = ("precision", "recall", "f1")
    summary = F.array(
        line("accuracy", accuracy, accuracy, accuracy),
        line("macro avg", *[mean(m, False) for m in measures]),
        line("weighted avg", *[mean(m, True) for m in measures]),
    )
    return classes.select(F.inline(F.concat("classes", summary))).drop("present")
