"""URL decisions: fixed rules first, gradient-boosted trees on lexical features for the rest.

URLs that a rule decides are the labelled ones. Block rates of host and path suffixes are counted over all of them; a
bounded sample is used to fit Spark's own gradient-boosted trees and for nothing else. It holds ``SAMPLE_ROWS`` distinct
URLs at most, those of each label with the lowest hash, so the same ones on any layout; a label gets half of the sample, or
what the other one leaves, and its URLs are weighted so that both have their shares of all distinct URLs. Features are columns: lengths, depth, digit ratio, entropy of the characters,
numbers of parameters, and the counted rates. Tables of rates are broadcast up to ``RATE_ROWS`` suffixes, counted before;
of larger ones only suffixes with many rows are, and the rest is shuffled.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule, and is judged by the trees like any
other. With labels of one kind only, every url without a rule gets that kind, with none of them ``allow``. Repeated rows
and null ids are kept. An empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import quoted
from patronlens.llm.components import join_hot
from patronlens.sources.staging import stage

# Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
SAMPLE_ROWS = 20_000
SAMPLE_PARTS = 4
TREES, DEPTH = 20, 4
RATE_ROWS = 100_000
# Weight of the overall rate in the rate of a suffix.
PRIOR_ROWS = 10.0
LETTERS = string.ascii_lowercase + string.digits + "./-_?=&%:#"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty where there is no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(url, pattern, 2)


def first_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does."""
    rule = verdict = None
    for kind, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, name + start) if rule is None else rule.when(fits, name + start)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def occurrences(text: Column, letter: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))


def lexical(urls: DataFrame) -> tuple[DataFrame, list[str]]:
    """``urls`` (url, host, path) with lexical features and the suffixes whose rates are counted."""
    low = F.lower(F.coalesce("url", F.lit("")))
    size = F.length("url_low")
    query = F.regexp_extract("url_low", r"(?s)\?([^#]*)", 1)
    out = urls.withColumn("url_low", low)
    counts = {c: F.greatest(occurrences(F.col("url_low"), c), F.lit(0)) for c in LETTERS}
    shares = [c / F.greatest(size, F.lit(1)) for c in counts.values()]
    entropy = sum((F.when(s > 0, -s * F.log2(s)).otherwise(0.0) for s in shares), F.lit(0.0))
    digits = sum((counts[d] for d in string.digits), F.lit(0))
    features = {
        "size": size,
        "host_size": F.length("host"),
        "path_size": F.length("path"),
        "depth": occurrences(F.col("path"), "/"),
        "labels": occurrences(F.col("host"), "."),
        "digit_ratio": digits / F.greatest(size, F.lit(1)),
        "path_digits": F.length(F.regexp_replace("path", r"[^0-9]", "")),
        "entropy": entropy,
        "parameters": F.when(query != "", occurrences(query, "&") + 1).otherwise(0),
        "hyphens": counts["-"] + counts["_"],
        "secure": F.col("url_low").startswith("https").cast("int"),
        "fragment": F.col("url_low").contains("#").cast("int"),
    }
    out = out.withColumns({f"f_{k}": v.cast("double") for k, v in features.items()})
    suffixes = {
        "s_top": F.substring_index("host", ".", -1),
        "s_site": F.substring_index("host", ".", -2),
        "s_folder": F.regexp_extract("path", r"^/([^/]*)", 1),
        "s_ending": F.regexp_extract("path", r"\.([A-Za-z0-9]{1,5})$", 1),
    }
    return out.withColumns(suffixes), list(suffixes)


class UrlModel:
    """Counted suffix rates and fitted trees. ``rates`` has a row per suffix of the ``total`` urls, with its number of them."""

    def __init__(self, rates: dict[str, DataFrame], total: int, base: float, trees, features: list[str]):
        self.rates, self.total, self.base, self.trees, self.features = rates, total, base, trees, features
        self.small = {suffix: table.count() <= RATE_ROWS for suffix, table in rates.items()}

    def with_rates(self, urls: DataFrame) -> DataFrame:
        for suffix, table in self.rates.items():
            if self.small[suffix]:
                urls = urls.join(F.broadcast(table.drop("m")), suffix)
            else:  # stored, as it reads the urls twice
                urls = stage(join_hot(urls, table, suffix, "m", self.total).drop("m"), "url-rated")
        return urls

    def block_probability(self, urls: DataFrame) -> DataFrame:
        """``urls`` with ``p_block``."""
        if self.trees is None:
            return urls.withColumn("p_block", F.lit(1.0 if self.base > 0.5 else 0.0))
        ready = VectorAssembler(inputCols=self.features, outputCol="f_all").transform(self.with_rates(urls))
        return self.trees.transform(ready).withColumn("p_block", vector_to_array("probability")[1])


def suffix_counts(urls: DataFrame) -> tuple[DataFrame, list[str]]:
    """Stored: kind, suffix, m (urls), total (labelled ones), blocked."""
    rows, suffixes = lexical(urls)
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("kind"), F.col(s).alias("suffix")) for s in suffixes]))
    rows = rows.select(each.alias("each"), "verdict").select("each.*", "verdict")
    counts = rows.groupBy("kind", "suffix").agg(
        F.count(F.lit(1)).alias("m"), F.count("verdict").alias("total"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked")
    )
    return stage(counts, "url-suffixes"), suffixes


def tree_sample(urls: DataFrame, sample_rows: int) -> DataFrame:
    """url, host, path, label, weight of distinct labelled urls of both labels, which the table has."""
    labelled = stage(urls.where(F.col("verdict").isNotNull()).select("url", "verdict").distinct(), "url-labels")
    sizes = {r.verdict: r["count"] for r in labelled.groupBy("verdict").count().collect()}
    chosen = None
    for verdict, size in sorted(sizes.items()):
        room = max(1, sample_rows // 2, sample_rows - (sum(sizes.values()) - size))
        weight = size / min(size, room) * min(1.0, sample_rows / sum(sizes.values()))
        part = labelled.where(F.col("verdict") == verdict).orderBy(F.xxhash64("url"), "url").limit(room)
        part = part.select("url", F.lit(float(verdict == "block")).alias("label"), F.lit(weight).alias("weight"))
        chosen = part if chosen is None else chosen.unionByName(part)
    host, path = host_and_path(F.col("url"))
    return chosen.withColumns({"host": host, "path": path})


def fit(urls: DataFrame, sample_rows: int = SAMPLE_ROWS) -> UrlModel:
    """Rates and trees from ``url, host, path, verdict`` (null if no rule decides). Trees see ``sample_rows`` urls at most."""
    counts, suffixes = suffix_counts(urls)
    every, total, blocked = counts.where(F.col("kind") == suffixes[0]).agg(F.sum("m"), F.sum("total"), F.sum("blocked")).first()
    base = blocked / total if total else 0.0
    if not total or not 0 < blocked < total:
        return UrlModel({}, 0, base, None, [])
    rate = (F.col("blocked") + base * PRIOR_ROWS) / (F.col("total") + PRIOR_ROWS)
    rates = {
        suffix: counts.where(F.col("kind") == suffix).select(F.col("suffix").alias(suffix), "m", rate.alias(f"f_{suffix}"))
        for suffix in suffixes
    }
    model = UrlModel(rates, every, base, None, [])
    ready = model.with_rates(stage(lexical(tree_sample(urls, sample_rows))[0], "url-sample"))
    model.features = [c for c in ready.columns if c.startswith("f_")]
    ready = VectorAssembler(inputCols=model.features, outputCol="f_all").transform(ready)
    trees = GBTClassifier(featuresCol="f_all", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=11)
    # Every level of every tree is a job or two with a task per partition: the bounded sample lies in a few of them, whatever
    # the number that a session deals rows into. Rows in one order, so that the same sample gives the same trees.
    ready = ready.select("f_all", "label", "weight", "url").repartitionByRange(SAMPLE_PARTS, "url")
    ready = ready.coalesce(SAMPLE_PARTS).sortWithinPartitions("url")
    model.trees = trees.fit(ready.select("f_all", "label", "weight"))
    return model


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per page: key, host, path, rule, verdict, p_block (of the trees, whoever decides)."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col(quoted(key)).alias("id"), F.col(quoted(url)).alias("url"))
    urls = urls.withColumns({"host": host, "path": path})
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    urls = urls.withColumns({"rule": rule, "verdict": verdict})
    model = fit(urls.select("url", "host", "path", "verdict"), sample_rows)
    scored = model.block_probability(lexical(urls)[0])
    decided = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return scored.select(
        F.col("id").alias(key), "host", "path", "rule", F.coalesce("verdict", decided).alias("verdict"), "p_block"
    )
