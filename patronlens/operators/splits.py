"""Train/test splits, fixed by keys and hashes and free of random draws."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.config import RunConfig
from patronlens.operators.ranking import cuts_passed, first_rows_spec, rank_cuts
from patronlens.schemas import FEATURES
from patronlens.sources.staging import stage

KEY = "customer_id"
LABEL = "churn_label"


def model_rows(features: DataFrame) -> DataFrame:
    """Rows with no null or NaN in the model's inputs or the label."""
    return features.na.drop(subset=[*FEATURES, LABEL])


def share_of(rows: int, share: float) -> int:
    """A share of a row count, rounded down, but at least one row."""
    return max(1, int(rows * share))


def split_hash(key: Column, seed: int) -> Column:
    """52 hash bits of key and seed, exact in a double."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")


def stratified_test_counts(counts: dict[int, int], share: float) -> dict[int, int]:
    """Test rows per class, so that both parts keep the class shares.

    The test part is rounded up as a whole; the train part is dealt out to the
    classes in proportion, the largest remainders getting the rows left over.
    """
    total = sum(counts.values())
    test = math.ceil(total * share)
    train = total - test
    if min(counts.values()) < 2:
        raise ValueError("every class needs at least two rows to be split")
    if min(test, train) < len(counts):
        raise ValueError(f"{total} rows are too few to split {len(counts)} classes")
    exact = {label: train * n / total for label, n in counts.items()}
    dealt = {label: math.floor(e) for label, e in exact.items()}
    by_remainder = sorted(counts, key=lambda label: (dealt[label] - exact[label], label))
    for label in by_remainder[: train - sum(dealt.values())]:
        dealt[label] += 1
    return {label: counts[label] - dealt[label] for label in counts}


def stratified_split(rows: DataFrame, cfg: RunConfig, share: float | None = None, flag: str = "is_test") -> DataFrame:
    """Flag an exact, class-balanced test part; ``rows`` should be stored.

    Within each class the rows with the lowest hash are taken. The last of them
    is found exactly over a narrow stored table of hashes; the flag is then a
    comparison with it, so neither the classes nor the table are sorted.
    """
    share = cfg.test_share if share is None else share
    hash_bits, label, key = split_hash(F.col(KEY), cfg.seed), F.col(LABEL), F.col(KEY)
    hashes = stage(rows.select(KEY, LABEL, hash_bits.alias("hash")), "split_hashes")
    counts = {r[LABEL]: r["count"] for r in hashes.groupBy(LABEL).count().collect()}
    wanted = {c: k for c, k in stratified_test_counts(counts, share).items() if k > 0}
    specs = [
        first_rows_spec(f"class_{c}", F.col("hash"), lambda n, k=k: k, label == F.lit(c)) for c, k in wanted.items()
    ]
    cuts = rank_cuts(hashes, KEY, specs)
    chosen = F.lit(False)
    for c in wanted:
        last_hash, last_key = cuts[f"class_{c}"].cuts[0]
        within = (hash_bits < F.lit(last_hash)) | ((hash_bits == F.lit(last_hash)) & (key <= F.lit(last_key)))
        chosen = F.when(label == F.lit(c), within).otherwise(chosen)
    return rows.withColumn(flag, chosen)


def time_split(rows: DataFrame, cfg: RunConfig, flag: str = "is_time_test") -> DataFrame:
    """Flag the most recently active share of the customers as the test part."""
    spec = first_rows_spec("recency", F.col("recency"), lambda n: share_of(n, cfg.test_share))
    cuts = rank_cuts(rows, KEY, [spec])["recency"]
    return rows.withColumn(flag, cuts_passed(spec, KEY, cuts) == 0)


def class_weight(train: DataFrame) -> DataFrame:
    """Retained per churned row: the weight that balances the classes."""
    label = F.col(LABEL)
    return train.agg(
        F.sum(F.lit(1) - label).alias("negatives"), F.sum(label).alias("positives")
    ).withColumn("scale_pos_weight", F.try_divide(F.col("negatives"), F.col("positives")))
