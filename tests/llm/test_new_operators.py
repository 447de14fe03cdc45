"""Language by compression, the Merkle manifest, and whitening, against plain versions."""

from __future__ import annotations

import hashlib
import heapq
import zlib

import numpy as np
import pytest
from helpers import ODD_TEXTS, documents, odd_documents, rows_of, with_clashes
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm import language_id, merkle, numbering, whitening
from patronlens.llm.numbering import numbered
from patronlens.sources.staging import stage

SF_DIR = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- numbering


def test_rows_are_numbered_in_order_with_one_value_on_a_third_of_them(spark):
    rows = [("s" if k % 2 else "n", 7 if k % 3 == 0 else k) for k in range(3000)]
    df = numbered(spark.createDataFrame(rows, "g string, k long").repartition(7), ["k"], "g")
    got = df.collect()
    for group in ("s", "n"):
        mine = sorted((r.pos, r.k) for r in got if r.g == group)
        assert [p for p, _ in mine] == list(range(1500)) and {r.n for r in got if r.g == group} == {1500}
        assert [k for _, k in mine] == sorted(k for g, k in rows if g == group)


def test_hot_values_are_spread_over_partitions(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(numbering, "stage", lambda df, name: stored.append(stage(df, name)) or stored[-1])
    numbered(spark.createDataFrame([("n", 1)] * 4000, "g string, k long").repartition(8), ["k"], "g")
    slices = stored[0].groupBy(F.shiftright("spot", 33)).count().collect()
    assert max(r["count"] for r in slices) < 1500


# ---------------------------------------------------------------- language


def plain_best(model, text):
    """The language without the operator's classes."""
    import re

    import zstandard

    kept = re.sub(r"[\W\d_]+", " ", (text or "").lower())
    if not any(c.isalpha() for c in kept):
        return "und"
    data, sizes = kept.encode(), []
    for name, content in model:
        settings = zstandard.ZstdCompressionParameters.from_level(
            6, min_match=4, dict_size=len(content), source_size=4096, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        coder = zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=settings
        )
        sizes.append((sum(len(coder.compress(data[at : at + 4096])) for at in range(0, len(data), 4096)), len(sizes), name))
    return min(sizes)[2]


def test_held_out_documents_get_their_language(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language_id.report(docs).collect()
    assert len(got) == len(truth)
    out = [r for r in got if r.held_out]
    assert {r.doc_id for r in out} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.97 * len(out)
    sure = [r for r in out if not r.rejected]
    assert sum(r.lang_pred == truth[r.doc_id] for r in sure) >= 0.975 * len(sure) and len(sure) > 0.9 * len(out)
    assert all(0 <= r.score <= 1 and 0 <= r.margin <= 1 for r in got)


def test_sizes_are_those_of_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.learn(docs)
    assert [name for name, _ in model][0] == "en" and len(model) == 4
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.lang_pred for r in language_id.report(docs).collect()} == {i: plain_best(model, t) for i, t in texts.items()}


def test_held_out_rows_and_labels_do_not_show(spark):
    """Another language or text on held-out rows changes no prediction of others."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = language_id.held_out(F.col("doc_id"))
    changed = docs.withColumns({"lang": F.when(out, "xx").otherwise(F.col("lang")), "source": F.lit("none")})
    assert rows_of(language_id.report(docs)) == rows_of(language_id.report(changed))


def test_frequent_texts_do_not_fill_a_dictionary(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang in ('en', 'de')")
    copies = documents(spark, [(10_000 + k, "nur dieser eine Text immer wieder", "en", "s") for k in range(300)])
    model = dict(language_id.learn(docs.unionByName(copies.select(docs.columns))))
    assert 1 <= model["en"].count(b"nur dieser eine text") <= 1


def test_odd_documents_have_a_language_or_none(spark):
    docs = with_clashes(odd_documents(spark))
    got = language_id.report(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id != 3}
    for k, text in enumerate(ODD_TEXTS):
        if k not in (3, 4):
            has = any(c.isalpha() for c in text or "")
            assert (by_id[k].lang_pred == "und") is (not has) and (by_id[k].score > 0) is has
    assert not [r for r in got if r.doc_id is None and r.held_out]
    empty = docs.where("doc_id = -5")
    assert language_id.report(empty).collect() == [] and language_id.learn(empty) == []
    model = language_id.learn(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    kept = language_id.keep_language(docs, model, ["en", "de", "fr", "es"])
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_digits_and_fractions_are_no_letters(spark):
    docs = documents(spark, [(1, "½ 12 ²"), (2, "½ ab"), (4, "the words of a text"), (5, "other words")])
    found = {r.doc_id: r.lang_pred for r in language_id.report(docs).collect()}
    assert found[1] == "und" and found[2] == "en"


# ---------------------------------------------------------------- manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, n_chars):
    values = (row.doc_id, row.source, row.lang, n_chars, row.text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(leaves):
    """Root, and (siblings before, siblings after) per level of each leaf."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(at):
            other = i ^ 1
            paths[k].append(("", "") if other >= len(level) else ((level[other], "") if other < i else ("", level[other])))
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def plain_manifest(rows, changed):
    trees = {}
    for r in rows:
        trees.setdefault(r.lang, []).append(r)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for name in names:
        mine = sorted(trees[name], key=lambda r: (r.doc_id is not None, r.doc_id or 0, plain_leaf(r, r.n_chars)))
        built[name] = mine, *plain_tree([plain_leaf(r, r.n_chars) for r in mine])
    root, tops = plain_tree([built[name][1] for name in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        mine, subroot, paths = built[name]
        for r, path in zip(mine, paths, strict=True):
            n = r.n_chars + 1 if r.n_chars is not None and changed(r.doc_id) else r.n_chars
            fold = plain_leaf(r, n)
            for before, after in path + top:
                fold = h(before, fold, after)
            leaf = plain_leaf(r, r.n_chars)
            out.append((r.doc_id, leaf, subroot, root, h(*[x + y for x, y in path + top]), fold, fold == root))
    return sorted(out, key=str)


def by_seven(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 0


def tampered():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))



@pytest.mark.parametrize("bits", [1, 2, 12])
def test_manifest_equals_a_plain_tree(spark, bits):
    """Blocks of two and four leaves take many rounds in both directions."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 90")
    more = documents(spark, [(500, "alone", "it", "s"), (501, None, None, None), (501, None, None, None), (None, "x", "en", "s")])
    docs = docs.unionByName(more.select(docs.columns))
    got = merkle.report(docs, tampered(), bits)
    assert rows_of(got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) == plain_manifest(docs.collect(), by_seven)


def test_only_changed_rows_fail(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = merkle.report(docs, tampered()).collect()
    assert {r.doc_id for r in got if not r.verified} == {r.doc_id for r in docs.where("n_chars is not null").collect() if by_seven(r.doc_id)}
    assert all(r.verified for r in merkle.report(docs).collect())


def test_proofs_can_be_checked_on_their_own(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows, root = merkle.manifest(docs)
    for r in rows.collect():
        assert merkle.folded(r.leaf.encode(), merkle.unpacked(bytes(r.proof))).decode() == root
        assert merkle.packed(merkle.unpacked(bytes(r.proof))) == bytes(r.proof)


def test_odd_documents_are_leaves(spark):
    docs = with_clashes(odd_documents(spark))
    got = merkle.report(docs, tampered())
    plain = plain_manifest(docs.collect(), by_seven)
    assert rows_of(got) == plain
    assert merkle.report(docs.where("doc_id = -5"), tampered()).collect() == []
    one = docs.where("doc_id = 5")
    (row,) = merkle.report(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == h("")


def test_few_messages_wait_in_a_sweep():
    n, most = 4096, 0
    sweep = merkle.Upward(n)
    for k in range(n):
        sweep.leaf(k, h(str(k)).encode())
        most = max(most, len(sweep.queue))
    assert most <= 13 and len(sweep.steps) == 2 * n - 2
    down = merkle.Downward(n, 0, None)
    for end, level, step, sibling in heapq.nlargest(len(sweep.steps), sweep.steps, key=lambda s: s[:2]):
        down.node(end, level, step, sibling)
        most = max(most, len(down.queue))
        if level == 0:
            assert merkle.folded(h(str(end - 1)).encode(), down.last) == sweep.root
    assert most <= 13 and not down.queue


# ---------------------------------------------------------------- whitening

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("at", T.StringType())])


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "k") for i, v in rows], VECTORS)


def plain_whitening(values, most=32):
    x = np.floor(64 * np.asarray(values, np.float32).astype(np.float64)) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    covariance = centred.T @ centred / n
    e, directions = np.linalg.eigh(covariance)
    order = [k for k in np.argsort(e)[::-1][:most] if e[k] > 1e-12 * e.max()]
    return centred @ directions[:, order] / np.sqrt(e[order]), e[order] / e.sum(), [sum(int(v) ** 2 for v in r) for r in n * x - total]


def check_whitening(got, ids, values, most=32):
    z, shares, deviation = plain_whitening(values, most)
    rows = {(r.vec_id, r.component): r for r in got}
    assert len(rows) == len(got) == z.size
    for k, i in enumerate(ids):
        for c in range(z.shape[1]):
            r = rows[i, c + 1]
            assert abs(abs(r.whitened) - abs(z[k, c])) < 1e-9 and abs(r.explained - shares[c]) < 1e-9
            assert r.n == len(ids) and r.deviation == deviation[k] and r.identity_error < 1e-9


def test_whitened_rows_equal_numpy(spark, monkeypatch):
    """Blocks of 16 rows, so that the products have many."""
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 16 * 8 * 40)
    rng = np.random.default_rng(3)
    values = (rng.normal(size=(300, 40)) @ rng.normal(size=(40, 40))).astype(np.float32)
    got = whitening.report(vectors(spark, list(enumerate(values))).repartition(5)).collect()
    check_whitening(got, list(range(300)), values)
    signs = {}
    for r in got:
        signs.setdefault(r.component, []).append(np.sign(r.whitened * plain_whitening(values)[0][r.vec_id, r.component - 1]) if r.vec_id < 5 else None)
    assert all(len({s for s in v if s is not None}) == 1 for v in signs.values())


def test_odd_vectors_are_dropped(spark):
    rng = np.random.default_rng(4)
    good = [(k, v) for k, v in enumerate(rng.normal(size=(30, 5)).astype(np.float32))]
    good += [(3, good[4][1]), (40, np.zeros(5, np.float32))]
    bad = [(50, None), (51, []), (52, [1.0, None, 0, 0, 0]), (53, [float("nan"), 0, 0, 0, 0]), (54, [0, float("inf"), 0, 0, 0]), (55, [1.0, 2.0])]
    got = whitening.report(vectors(spark, good + bad)).collect()
    assert {r.vec_id for r in got} == {k for k, _ in good} and len(got) == 5 * len(good)
    once = whitening.report(vectors(spark, good[:30])).collect()
    check_whitening(once, list(range(30)), [v for _, v in good[:30]])


def test_components_without_variance_have_no_rows(spark):
    rng = np.random.default_rng(5)
    values = np.column_stack([rng.normal(size=50) * 8, np.full(50, 0.25), rng.normal(size=50) * 8]).astype(np.float32)
    check_whitening(whitening.report(vectors(spark, list(enumerate(values)))).collect(), list(range(50)), values)
    assert whitening.report(vectors(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.report(vectors(spark, [(k, [1.0, 2.0]) for k in range(9)])).collect() == []
    empty = whitening.report(vectors(spark, []))
    assert empty.collect() == [] and empty.columns == whitening.report(vectors(spark, [(1, [1.0])])).columns


def test_large_deviations_are_exact_or_null(spark):
    rows = [(k, [(-1.0) ** k * 2.0**e, 0.5 * k]) for k, e in enumerate([0, 20, 22, 25, 25, 40])]
    got = {r.vec_id: r.deviation for r in whitening.report(vectors(spark, rows)).collect()}
    x = np.array([[int(np.floor(64 * np.float32(v))) + 1_000_000 for v in r] for _, r in rows], object)
    total = x.sum(axis=0)
    exact = [sum(int(v) ** 2 for v in len(rows) * r - total) for r in x]
    assert got == {k: v if v < 2**63 else None for k, v in enumerate(exact)} and None in got.values()
