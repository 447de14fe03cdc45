"""Quality scores, mixtures and vector links against held-out labels and plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import documents, odd_documents, rows_of, with_clashes
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.llm import mixing, quality, vector_graph


def junk(rnd):
    word = f"w{rnd.randint(0, 10**6)}"
    return rnd.choice([" ".join([word] * 40), " | ".join(f"{word}{k}" for k in range(30)), " ".join(f"{word}!!" for _ in range(30))])


def labelled(spark, n=600):
    rnd = random.Random(1)
    rows, labels = [], []
    for k in range(n):
        good = rnd.random() < 0.7
        text = " ".join(f"{rnd.choice('abcdef')}{rnd.choice(['tion', 'ing', 'er'])}{rnd.randint(0, 99)}" for _ in range(50))
        rows.append((k, text if good else junk(rnd)))
        labels.append((k, int(good), 0))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    got = quality.report(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)
    kept = {r.doc_id for r in quality.keep_good(docs, labels).collect()}
    assert kept == {r.doc_id for r in got if r.score >= 0.5}


def test_held_out_labels_are_not_used(spark):
    docs, labels = labelled(spark, 300)
    hidden = F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    assert rows_of(quality.report(docs, labels)) == rows_of(quality.report(docs, labels.withColumn("quality", hidden)))


def plain_features(text):
    """Buckets of a text, one word and one group of letters after the other."""
    out = defaultdict(int)
    words = text.split()
    for word in words:
        flat, _ = quality.word_buckets([word])
        for bucket in flat:
            out[int(bucket)] += 1
    for lag, bucket in zip(quality.LAGS, quality.AGAIN):
        if same := sum(a == b for a, b in zip(words, words[lag:])):
            out[bucket] += same
    return dict(out)


def test_features_and_scores_agree_with_a_plain_sum():
    rng = np.random.default_rng(0)
    shares = rng.normal(size=quality.BUCKETS)
    texts = ["", "a", "the the the cat", "é😀 " * 50, "x" * 3000 + " y", "A | B | A | B\nlong-word,with.marks"]
    scorer = quality.Scorer(shares, 0.25)
    for text, score in zip(texts, scorer.texts(texts)):
        found, counts = quality.features(text)
        assert dict(zip(found.tolist(), counts.tolist())) == plain_features(text)
        mean = (shares[found] * counts).sum() / max(1, counts.sum())
        assert math.isclose(score, 1 / (1 + math.exp(-(mean + 0.25))), rel_tol=1e-9)
    words = [len(w) + 2 for w in texts[-1].split()]
    assert sum(1 + sum(max(0, n - g + 1) for g in quality.GROUPS) for n in words) <= quality.features(texts[-1])[1].sum()


def test_words_do_not_depend_on_their_neighbours():
    words = ["a", "tion", "xyz" * 30, "é", "word"]
    flat, counts = quality.word_buckets(words)
    alone = [quality.word_buckets([w])[0].tolist() for w in words]
    ends = np.cumsum(counts)
    assert [flat[e - n : e].tolist() for e, n in zip(ends, counts)] == alone


def test_quality_of_odd_rows(spark):
    odd = with_clashes(odd_documents(spark))
    labels = spark.createDataFrame([(0, 1), (2, 0), (3, None), (5, 7), (None, 1), (6, 0), (2, 0)], "doc_id long, quality int")
    out = quality.report(odd, labels)
    assert out.count() == odd.count() and out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    kept = quality.keep_good(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert quality.report(odd.limit(0), labels).count() == 0


def test_sample_bounds(spark):
    docs, labels = labelled(spark, 200)
    few, many = quality.fit(docs, labels, sample_rows=20), quality.fit(docs, labels)
    assert np.count_nonzero(few[0]) and not np.array_equal(few[0], many[0])
    none = quality.fit(docs, labels, sample_features=0)
    assert none[1] == 50.0 and not none[0].any()


def plain_divide(have, children):
    """Fill the children one after the other: name -> (room, weight)."""
    out, open_ = {}, {c: rw for c, rw in children.items() if rw[1] > 0}
    left = have
    while True:
        total = sum(w for _, w in open_.values())
        full = [c for c, (room, w) in open_.items() if room * total <= left * w]
        if not full:
            return {c: out.get(c, left * children[c][1] // total if c in open_ else 0) for c in children}
        for c in full:
            out[c] = open_.pop(c)[0]
        left = have - sum(out.values())
        if not open_:
            return {c: out.get(c, 0) for c in children}


def plain_mix(rows, weights, percent, max_epochs, min_epochs, seed):
    leaves = defaultdict(list)
    for doc_id, domain, lang, source, tokens in rows:
        leaves[domain, lang, source].append((doc_id, tokens))
    size = {leaf: sum(t for _, t in docs) for leaf, docs in leaves.items()}
    weight = [lambda n, w=w: w.get(n, 1) for w in weights]
    room2 = {k: v * (max_epochs - min_epochs) if weight[2](k[2]) else 0 for k, v in size.items()}
    room1, room0 = defaultdict(int), defaultdict(int)
    for k, v in room2.items():
        room1[k[:2]] += v if weight[1](k[1]) else 0
    for k, v in room1.items():
        room0[k[0]] += v if weight[0](k[0]) else 0
    all_ = sum(size.values())
    b0 = plain_divide(max(0, all_ * percent // 100 - all_ * min_epochs), {d: (r, weight[0](d)) for d, r in room0.items()})
    b1, b2 = {}, {}
    for d in room0:
        b1 |= plain_divide(b0[d], {k: (r, weight[1](k[1])) for k, r in room1.items() if k[0] == d})
    for k in room1:
        b2 |= plain_divide(b1[k], {leaf: (r, weight[2](leaf[2])) for leaf, r in room2.items() if leaf[:2] == k})
    out = []
    for leaf, docs in leaves.items():
        budget = b2[leaf] + min_epochs * size[leaf]
        epochs, prefix = divmod(budget, size[leaf]) if size[leaf] else (min_epochs, 0)

        def place(doc_id, epochs=epochs):
            return hashlib.md5(f"{seed}:{epochs}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:15]

        running = 0
        for doc_id, tokens in sorted(docs, key=lambda d: (place(d[0]), -1 if d[0] is None else d[0], d[1])):
            running += tokens
            out.append((doc_id, *leaf, tokens, epochs + (prefix > 0 and running <= prefix)))
    return sorted(out, key=str)


@pytest.mark.parametrize("percent, max_epochs, min_epochs", [(100, 4, 0), (30, 1, 0), (300, 2, 0), (1000, 3, 0), (125, 4, 1), (0, 4, 0)])
def test_mixture_equals_plain_python(spark, percent, max_epochs, min_epochs):
    rnd = random.Random(percent)
    rows = []
    for k in range(600):
        source = rnd.choice(["src0"] * 5 + [f"src{i}" for i in range(14)])
        text = " ".join(["w"] * rnd.randint(0, 30))
        rows.append((k, text, rnd.choice(["en", "en", "de", "fr", "xx"]), source))
    weights = ({"crawl": 2, "forum": 5, "reference": 3}, {"en": 6, "xx": 0}, {"src3": 4, "src5": 0})
    df = documents(spark, rows).repartition(5)
    parameters = {"weights": weights, "percent": percent, "max_epochs": max_epochs, "min_epochs": min_epochs, "seed": 9}

    def domain(s):
        return "crawl" if s == "src0" else "forum" if len(s) == 4 else "reference"

    want = plain_mix([(k, domain(s), la, s, len(t.split())) for k, t, la, s in rows], weights, percent, max_epochs, min_epochs, 9)
    got = rows_of(mixing.report(df, **parameters))
    assert got == want
    chosen = mixing.mix(df, **parameters)
    assert chosen.columns == df.columns and chosen.count() == sum(r[-1] for r in want)


@pytest.mark.parametrize("percent, max_epochs, min_epochs", [(30, 1, 0), (55, 1, 0), (125, 4, 1), (160, 4, 0)])
def test_mixture_when_one_id_and_no_id_hold_most_rows(spark, monkeypatch, percent, max_epochs, min_epochs):
    rnd = random.Random(percent)
    rows = [(None, " ".join(["w"] * rnd.randint(0, 30)) + f" n{k}", "en", "src1") for k in range(600)]
    rows += [(5, "the same words", "en", "src1")] * 500 + [(5, "the same words", "en", "src2")] * 50
    rows += [(k, " ".join(["w"] * rnd.randint(0, 9)), "en", rnd.choice(["src1", "src2"])) for k in range(10, 200)]
    df = documents(spark, rows).repartition(5)
    parameters = {"weights": ({}, {}, {"src2": 2}), "percent": percent, "max_epochs": max_epochs, "min_epochs": min_epochs, "seed": 4}
    plain = [(k, "forum", la, s, len(t.split())) for k, t, la, s in rows]
    stored, stage = {}, mixing.stage
    monkeypatch.setattr(mixing, "stage", lambda part, name: stored.setdefault(name, stage(part, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(mixing.report(df, **parameters)) == plain_mix(plain, *parameters.values())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # Rows of no id share a place, yet no task sorts more than its part of them.
    sorted_rows = stored["prefix-rows"].groupBy(F.input_file_name()).count().collect()
    most = max((r["count"] for r in sorted_rows), default=0)
    assert most <= 600 // 3


def test_equal_rows_are_taken_as_far_as_the_prefix_goes(spark):
    df = documents(spark, [(5, "the same words", "en", "src1")] * 100).repartition(7)
    got = [r.copies for r in mixing.report(df, percent=50, max_epochs=1).collect()]
    assert sorted(got) == [0] * 50 + [1] * 50
    assert mixing.mix(with_clashes(df), percent=130).count() == 130


def test_quality_learns_once_from_an_id(spark, monkeypatch):
    rows = [(3, f"copy {k} of this text") for k in range(900)] + [(k, f"text {k} is good or bad") for k in range(10, 400)]
    labels = [(k, k % 2) for k in range(10, 400)] + [(3, 1)] * 500 + [(3, 0)]
    stored, stage = {}, quality.stage
    monkeypatch.setattr(quality, "stage", lambda part, name: stored.setdefault(name, stage(part, name)))
    docs, table = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    quality.fit(docs, table, sample_rows=300)
    sample = stored["quality-sample"].collect()
    ids = [r.id for r in sample]
    assert len(ids) == len(set(ids)) and 0 < len(ids) <= 300
    everything = {}
    monkeypatch.setattr(quality, "stage", lambda part, name: everything.setdefault(name, stage(part, name)))
    quality.fit(docs, table)
    found = [r.label for r in everything["quality-sample"].collect() if r.id == 3]
    assert found == ([] if zlib.crc32(b"3") % 3 == 1 else [0])


def test_mixture_of_odd_rows(spark):
    odd = with_clashes(odd_documents(spark))
    out = mixing.mix(odd, percent=100, min_epochs=1)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert mixing.report(odd).count() == odd.count()
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.report(odd.limit(0)).count() == 0


def vectors(spark, rows):
    kind = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], kind)


def plain_links(rows, cosine=0.9):
    units = {}
    for i, v in rows:
        if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v):
            u = np.array(v, np.float32).astype(float)
            units[i] = u / np.linalg.norm(u)
    links, root = dict.fromkeys([i for i, _ in rows], 0), {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = sorted(units)
    for a in keys:
        for b in keys:
            if b < a and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return links, {i: find(i) for i in root}


def clustered(n, seed=2, dims=24):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(n // 12, dims))
    out = [centers[rng.integers(len(centers))] + rng.normal(size=dims) * rng.choice([0.05, 0.25]) for _ in range(n)]
    return [(k, v.tolist()) for k, v in enumerate(out)]


@pytest.mark.parametrize("shard, block, queries", [(2000, 4000, 4000), (150, 60, 50)])
def test_vector_links_against_brute_force(spark, monkeypatch, shard, block, queries):
    for name, value in (("SHARD", shard), ("BLOCK", block), ("QUERIES", queries)):
        monkeypatch.setattr(vector_graph, name, value)
    rows = clustered(900) + [(1000 + k, [1.0] * 24) for k in range(40)]
    links, root = plain_links(rows)
    got = {r.vec_id: r for r in vector_graph.report(vectors(spark, rows)).collect()}
    found = sum(min(r.n_links, links[i]) for i, r in got.items())
    assert found >= 0.97 * sum(links.values()) and all(r.n_links <= links[i] for i, r in got.items())
    assert next(iter(got.values())).audited_recall >= 0.97
    assert sum(got[i].component_id == root[i] for i in got) >= 0.97 * len(rows)
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert all(got[1000 + k].n_links >= 39 for k in range(40))


def test_graph_reaches_every_member():
    rows = np.array([v for _, v in clustered(500)])
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    graph = vector_graph.build(units)
    seen, todo = set(), vector_graph.starts(units).tolist()
    while todo:
        if (k := todo.pop()) not in seen:
            seen.add(k)
            todo += [j for j in graph[k].tolist() if j >= 0]
    assert len(seen) >= 0.98 * len(units) and (graph >= 0).sum(axis=1).max() <= vector_graph.DEGREE


def test_link_that_only_the_second_shared_shard_finds(spark):
    # The asking class 99 probes shards 0 and 1. Vector 50 lies in both; only in shard 1 does a link (from 0) lead to it.
    def near(k):
        return np.eye(24)[0] + 0.1 * np.eye(24)[k]

    units = {0: near(20), 1: near(21), 50: near(22), 99: near(23)} | {k: np.eye(24)[k] for k in range(2, 16)}
    units = {k: (v / np.linalg.norm(v)).astype("<f8").tobytes() for k, v in units.items()}
    n = {0: 1, 1: 5, 50: 7}
    held = {0: [1, 2], 1: [0, 1], 50: [1, 0], 99: [3, 2]} | {k: [0, 1] for k in range(2, 16)}
    rows = [(k, n.get(k, 1), units[k], held[k], [0, 1] if k == 99 else [3, 2]) for k in units]
    assigned = spark.createDataFrame(rows, "rep long, n long, unit binary, members array<int>, probes array<int>")
    shards = spark.createDataFrame([(s, 1, 1) for s in range(4)], "shard int, blocks int, chunks int")
    graph = spark.createDataFrame([(k, [50] if k == 0 else []) for k in units], "rep long, neighbours array<long>")
    members = vector_graph.member_rows(assigned, shards)
    found = vector_graph.search_blocks(assigned, members, graph, shards, 24, 0.9, 24).collect()
    # Class 1 is found in both shards and counted once.
    assert sum(r.links for r in found if r.a == 99) == 1 + 5 + 7
    assert {r.a for r in found if r.b == 0} >= {50, 99}


def test_recall_of_small_groups_beside_a_large_one(spark, monkeypatch):
    # A beam of one finds the large group, which has nearly all links, and misses pairs.
    monkeypatch.setattr(vector_graph, "BEAM", 1)
    rng = np.random.default_rng(5)
    center, pairs = rng.normal(size=24), rng.normal(size=(200, 24))
    rows = [(k, (center + 0.1 * rng.normal(size=24)).tolist()) for k in range(400)]
    rows += [(1000 + 2 * k + j, (p + 0.1 * rng.normal(size=24)).tolist()) for k, p in enumerate(pairs) for j in (0, 1)]
    links, _ = plain_links(rows)
    got = {r.vec_id: r for r in vector_graph.report(vectors(spark, rows)).collect()}
    small = [i for i in got if i >= 1000 and links[i]]
    assert len(small) >= 380
    assert sum(min(got[i].n_links, links[i]) / links[i] for i in small) >= 0.97 * len(small)
    assert all(r.n_links <= links[i] and r.audited_recall >= 0.97 for i, r in got.items())


def test_products_of_whole_blocks_find_all(spark, monkeypatch):
    for name, value in (("SHARD", 150), ("BLOCK", 60), ("QUERIES", 50), ("MOST_BEAM", 0), ("TARGET", 1.1)):
        monkeypatch.setattr(vector_graph, name, value)
    rows = clustered(300)
    links, root = plain_links(rows)
    got = {r.vec_id: r for r in vector_graph.report(vectors(spark, rows)).collect()}
    assert all((r.n_links, r.component_id, r.audited_recall) == (links[i], root[i], 1.0) for i, r in got.items())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, 2.0]), (7, [1.0, 2.0]),
           (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (10, [1.0, 2.0, 0.1]), (None, [1.0, 2.0]), (6, [1.0, 2.0]), (11, [-1.0, -2.0]),
           (12, [1e-30, 2e-30]), (13, [-0.0, 1.0]), (14, [0.0, 1.0])]
    df = vectors(spark, odd).withColumn("unit", F.lit("x")).withColumn("row", F.lit(1))
    got = vector_graph.report(df).collect()
    assert len(got) == len(odd)
    by_id = {r.vec_id: r for r in got}
    for i in range(6):
        assert (by_id[i].n_links, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    same = [r for r in got if r.vec_id in (6, 7, 8, 12, None)]
    assert {r.component_id for r in same} == {6} and {r.n_links for r in same} >= {5} and sum(r.kept for r in same) == 1
    assert by_id[9].component_id == 9 == by_id[10].component_id and by_id[11].n_links == 0
    assert vector_graph.report(df.limit(0)).count() == 0
