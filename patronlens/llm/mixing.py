"""Mixing documents to target weights down a tree of domain, language and source.

A token budget enters at the root and is divided among children by their weights, level by level. What a child cannot
take (its documents times ``max_epochs``) goes to its siblings first, since a parent's share is divided among its children
before anything else; only what no child can take is missing at the parent, and goes to the parent's siblings. The division is
closed: children in order of capacity per weight are filled up one after the other until the rest can take its share.

With ``min_epochs`` every leaf first gets that many whole epochs, and only what the budget holds beyond that is divided.

Each leaf then reads whole epochs of its documents and a prefix of one more. An epoch's order is a hash of seed, epoch and
id. The prefix is found without ordering a leaf: tokens are summed per slice of the hash, running sums of at most
``SLICES`` rows per leaf give the slice where the prefix ends. Rows of that slice with the same id, tokens and text are
counted as one, and one range sort of these, all leaves together, gives the row where the prefix ends: an id, or its lack, that
fills a slice is spread by the hash of the text. Texts are compared with that row where they are read.

Everything is column arithmetic on whole numbers. Shares are rounded down, so a node may lose a token per child. Budget
times weight must stay below 2^63.

Defined cases: null text has no tokens; null names of the tree are the empty name. A leaf or node of weight 0 gets
nothing. A leaf without tokens gets ``min_epochs``. Documents without tokens go along with whole epochs, and in a prefix with the
place their hash gives them. Repeated rows and equal or null ids are counted and chosen row by row. An empty table gives
an empty result. Columns of any name are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.llm.common import fresh, quoted, same_columns, text_of
from patronlens.sources.staging import stage

SLICES = 4096
_HASH_BITS = 60

# Production parameters: weights per level (others 1), the share of all tokens that is drawn, and the most epochs of a leaf.
DOMAINS = {"crawl": 33, "forum": 30, "reference": 37}
LANGUAGES = {"en": 55, "de": 18, "fr": 16, "es": 11}
SOURCES: dict[str, int] = {}
BUDGET_PERCENT = 100
MAX_EPOCHS = 4
SEED = 17


def default_domain(source: Column) -> Column:
    """The domain of a source: one large crawl, nine forums, reference works."""
    return F.when(source == "src0", "crawl").when(source.rlike(r"^src[1-9]$"), "forum").otherwise("reference")


def words(text: Column) -> Column:
    """Number of words between white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def epoch_hash(seed: int, epoch: Column, key: Column) -> Column:
    """60 bits of the place of a document in an epoch."""
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, _HASH_BITS // 4), 16, 10).cast("long")


def weight_of(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for value, weight in weights.items():
        out = F.when(name == value, weight).otherwise(out)
    return out.cast("long")


def divide(nodes: DataFrame, parents: list[str], name: str, have: str, room: str, weight: str, out: str) -> DataFrame:
    """``out``: the part of each node in its parent's ``have``, by ``weight``, at most ``room``."""
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ratio = F.when(F.col(weight) > 0, F.col(room) / F.col(weight)).otherwise(F.lit(float("inf")))
    earlier = family.orderBy(ratio, name).rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumns(
        {
            "d_taken": F.coalesce(F.sum(room).over(earlier), F.lit(0)),
            "d_left": F.sum(weight).over(family) - F.coalesce(F.sum(weight).over(earlier), F.lit(0)),
        }
    )
    full = (F.col(weight) > 0) & (F.col(room) * F.col("d_left") <= (F.col(have) - F.col("d_taken")) * F.col(weight))
    nodes = nodes.withColumn("d_full", full)
    nodes = nodes.withColumns(
        {
            "d_gone": F.sum(F.when(F.col("d_full"), F.col(room)).otherwise(0)).over(family),
            "d_open": F.sum(F.when(F.col("d_full"), 0).otherwise(F.col(weight))).over(family),
        }
    )
    share = F.expr(f"(({have} - d_gone) * {weight}) div d_open")
    part = F.when(F.col(weight) == 0, 0).when(F.col("d_full"), F.col(room)).otherwise(share)
    return nodes.withColumn(out, part.cast("long")).drop("d_taken", "d_left", "d_full", "d_gone", "d_open")


def leaf_budgets(
    leaves: DataFrame, weights: tuple[dict[str, int], ...], percent: int, max_epochs: int, min_epochs: int = 0
) -> DataFrame:
    """``domain, lang, source, tokens`` with ``budget`` per leaf."""
    w0, w1, w2 = (weight_of(F.col(c), w) for c, w in zip(("domain", "lang", "source"), weights, strict=True))
    leaves = leaves.withColumns({"w2": w2, "c2": F.col("tokens") * (max_epochs - min_epochs)})
    leaves = leaves.withColumn("c2", F.when(F.col("w2") > 0, F.col("c2")).otherwise(0))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("c2").alias("c1"), F.sum("tokens").alias("t1"))
    langs = langs.withColumn("w1", w1)
    langs = langs.withColumn("c1", F.when(F.col("w1") > 0, F.col("c1")).otherwise(0))
    tops = langs.groupBy("domain").agg(F.sum("c1").alias("c0"), F.sum("t1").alias("t0")).withColumn("w0", w0)
    tops = tops.withColumn("c0", F.when(F.col("w0") > 0, F.col("c0")).otherwise(0))
    # One row per domain.
    tops = tops.withColumn("b", F.sum("t0").over(Window.partitionBy(F.lit(0))))
    tops = divide(tops.withColumn("b", F.greatest(F.expr(f"b * {percent} div 100 - b * {min_epochs}"), F.lit(0))), [], "domain", "b", "c0", "w0", "b0")
    langs = divide(langs.join(tops.select("domain", "b0"), "domain"), ["domain"], "lang", "b0", "c1", "w1", "b1")
    leaves = leaves.join(langs.select("domain", "lang", "b1"), ["domain", "lang"])
    leaves = divide(leaves, ["domain", "lang"], "source", "b1", "c2", "w2", "budget")
    whole = F.col("budget") + F.col("tokens") * min_epochs
    return leaves.select("domain", "lang", "source", "tokens", whole.alias("budget"))


def plan(
    rows: DataFrame, weights: tuple[dict[str, int], ...], percent: int, max_epochs: int, min_epochs: int, seed: int
) -> DataFrame:
    """Per leaf: whole epochs, and the row where the prefix ends: ``cut`` (its place, key, tokens, mark), null without a
    prefix, and ``more``, how many of the rows equal to it are still chosen.

    ``rows``: key, domain, lang, source, tokens, mark (hash of the text). Read three times, so it should be stored.
    """
    leaf = ["domain", "lang", "source"]
    budgets = leaf_budgets(rows.groupBy(*leaf).agg(F.sum("tokens").alias("tokens")), weights, percent, max_epochs, min_epochs)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(min_epochs)
    rest = F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0)
    budgets = stage(budgets.withColumns({"epochs": whole.cast("long"), "prefix": rest.cast("long")}), "leaf-budgets")
    # A stored table of a row per leaf: Spark broadcasts it if its known size allows that, and splits hot leaves if not.
    placed = rows.join(budgets.where(F.col("prefix") > 0).drop("tokens", "budget"), leaf)
    placed = placed.withColumn("place", epoch_hash(seed, F.col("epochs"), F.col("key")))
    placed = placed.withColumn("slice", F.shiftright("place", _HASH_BITS - 12))
    sliced = placed.groupBy(*leaf, "prefix", "slice").agg(F.sum("tokens").alias("size"))
    before = Window.partitionBy(*leaf).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sliced = sliced.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    cut = sliced.where((F.col("start") <= F.col("prefix")) & (F.col("start") + F.col("size") > F.col("prefix")))
    cut = stage(cut.groupBy(*leaf).agg(F.min("slice").alias("slice"), F.min("start").alias("start")), "leaf-slices")
    ends = prefix_ends(placed.join(cut, [*leaf, "slice"]), leaf)
    return stage(budgets.join(ends, leaf, "left"), "leaf-plan").select(*leaf, "budget", "epochs", "cut", "more")


def prefix_ends(rows: DataFrame, leaf: list[str]) -> DataFrame:
    """Per leaf: ``cut`` and ``more``, from the rows of the slice where its prefix ends and the tokens before it (start)."""
    order = ["place", "key", "tokens", "mark"]
    like = rows.groupBy(*leaf, "prefix", "start", *order).agg(F.count(F.lit(1)).alias("n"))
    like = like.withColumn("size", F.col("tokens") * F.col("n"))
    # One range sort; places are stored, so that both passes below agree on them.
    like = stage(like.orderBy(*leaf, *order).withColumn("spot", F.monotonically_increasing_id()), "prefix-rows")
    like = like.withColumn("part", F.shiftright("spot", 33))
    # One row per leaf and partition that it lies in.
    whole = like.groupBy(*leaf, "part").agg(F.sum("size").alias("size"))
    before = Window.partitionBy(*leaf).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = whole.select(*leaf, "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("part", *leaf).orderBy("spot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    like = like.withColumn("own", F.sum("size").over(within)).join(ahead, [*leaf, "part"])
    like = like.withColumn("done", F.col("start") + F.col("ahead") + F.col("own") - F.col("size"))
    over = like.where((F.col("done") <= F.col("prefix")) & (F.col("done") + F.col("size") > F.col("prefix")))
    return over.select(*leaf, F.struct(*order).alias("cut"), F.expr("(prefix - done) div tokens").alias("more"))


def with_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    domain: Column | None = None, weights: tuple[dict[str, int], ...] = (DOMAINS, LANGUAGES, SOURCES),
    percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, min_epochs: int = 0, seed: int = SEED,
) -> tuple[DataFrame, dict[str, str]]:
    """All documents with the tree's names, tokens and how often each is chosen; and the names of these columns.

    Texts are not shuffled, but for rows that are all equal to the one where a leaf's prefix ends, if it takes some of them.
    """
    names = dict(zip(("domain", "lang", "source", "tokens", "copies"), fresh(docs, "m_domain", "m_lang", "m_source", "m_tokens", "m_copies"), strict=True))
    domain = default_domain(F.col(quoted(source))) if domain is None else domain
    levels = {"domain": domain, "lang": F.col(quoted(lang)), "source": F.col(quoted(source))}
    added = {names[k]: F.coalesce(v.cast("string"), F.lit("")) for k, v in levels.items()}
    wide = docs.withColumns(added | {names["tokens"]: words(text_of(docs, text))})
    mark = F.xxhash64(text_of(docs, text))
    narrow = wide.select(
        F.col(quoted(key)).alias("key"),
        *[F.col(names[c]).alias(c) for c in ("domain", "lang", "source", "tokens")],
        mark.alias("mark"),
    )
    leaves = plan(stage(narrow, "mix-rows"), weights, percent, max_epochs, min_epochs, seed)
    some = leaves.where(F.col("more") > 0).take(1)
    leaf = [names[c] for c in ("domain", "lang", "source")]
    own, cut, more, epochs = fresh(wide, "m_own", "m_cut", "m_more", "m_epochs")
    leaves = leaves.select("domain", "lang", "source", "cut", "more", "epochs").toDF(*leaf, cut, more, epochs)
    wide = wide.join(leaves, leaf, "left")
    place = epoch_hash(seed, F.col(epochs), F.col(quoted(key)))
    wide = wide.withColumn(
        own, F.struct(place.alias("place"), F.col(quoted(key)).alias("key"), F.col(names["tokens"]).alias("tokens"), mark.alias("mark"))
    )
    # Structs compare field by field, null first, as they were sorted. Without a row that goes over the prefix there is none.
    earlier = F.coalesce(F.col(own) < F.col(cut), F.lit(False))
    columns = [*docs.columns, *names.values()]
    plain = wide.withColumn(names["copies"], F.col(epochs) + earlier.cast("long"))
    if not some:
        return same_columns(plain, columns), names
    at_cut = F.coalesce((F.col(own) == F.col(cut)) & (F.col(more) > 0), F.lit(False))
    equal = same_columns(wide.where(at_cut), [*docs.columns, *leaf, names["tokens"], more, epochs])
    ended = first_of_equal(equal, leaf, more, epochs, names["copies"])
    return same_columns(plain.where(~at_cut), columns).unionByName(same_columns(ended, columns)), names


def first_of_equal(equal: DataFrame, leaf: list[str], more: str, epochs: str, copies: str) -> DataFrame:
    """Rows that are equal within each leaf, with ``copies``: ``more`` rows of a leaf get one above ``epochs``."""
    spot, part, number, size, ahead = fresh(equal, "m_spot", "m_part", "m_number", "m_size", "m_ahead")
    # Where a row lies in the files numbers it, so only its leaf's rows of one partition meet in a task.
    rows = stage(equal.withColumn(spot, F.monotonically_increasing_id()), "equal-rows")
    rows = rows.withColumn(part, F.shiftright(spot, 33))
    whole = rows.groupBy(*leaf, part).agg(F.count(F.lit(1)).alias(size))
    before = Window.partitionBy(*leaf).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(*leaf, part, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(ahead))
    rows = rows.withColumn(number, F.row_number().over(Window.partitionBy(part, *leaf).orderBy(spot)))
    rows = rows.join(whole, [*leaf, part])
    taken = F.col(ahead) + F.col(number) <= F.col(more)
    return rows.withColumn(copies, F.col(epochs) + taken.cast("long"))


def report(docs: DataFrame, key: str = "doc_id", **parameters) -> DataFrame:
    """Per document: key, domain, lang, source, n_tokens, copies (how often it is chosen)."""
    out, names = with_copies(docs, key=key, **parameters)
    return out.select(
        F.col(quoted(key)).alias(key),
        *[F.col(names[c]).alias(c) for c in ("domain", "lang", "source")],
        F.col(names["tokens"]).alias("n_tokens"),
        F.col(names["copies"]).alias("copies"),
    )


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """The chosen documents, columns unchanged; one row per time a document is chosen."""
    out, names = with_copies(docs, **parameters)
    (each,) = fresh(out, "m_each")
    chosen = out.where(F.col(names["copies"]) > 0)
    chosen = chosen.withColumn(each, F.explode(F.sequence(F.lit(1), F.col(names["copies"]))))
    return same_columns(chosen, docs.columns)
