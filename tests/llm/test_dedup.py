"""Exact copies, line removal and similar texts against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents, odd_documents, rows_of, with_clashes
from pyspark.sql import functions as F

from patronlens.llm import components, exact_dedup, line_dedup, set_join


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    return groups


@pytest.mark.parametrize("items", [8, 1024])
def test_exact_groups_equal_plain_python(spark, items):
    rnd = random.Random(3)
    rows = [(k, rnd.choice(["hot  text", "hot text", "hot\ttext"])) for k in range(500)]
    rows += [(k, f"text {rnd.randint(0, 300)}") for k in range(500, 1500)] + [(1500, None), (1501, "")]
    rnd.shuffle(rows)
    df = documents(spark, rows).repartition(13)
    got = {r.doc_id: r for r in exact_dedup.exact_groups(df, items=items).collect()}
    assert len(got) == len(rows)
    for text, ids in plain_groups(rows).items():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (min(ids), len(ids), i == min(ids))
            assert got[i].text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    left = exact_dedup.drop_copies(df, items=items)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(min(ids) for ids in plain_groups(rows).values())


def test_heavy_text_is_found_and_its_rows_are_settled_where_they_are_read(spark):
    df = documents(spark, [(k, "same" if k % 3 else f"t{k}") for k in range(3000)]).repartition(7)
    digests = exact_dedup.stored_digests(df, "doc_id", "text")
    winners = exact_dedup.heavy_winners(digests, 64).collect()
    assert [w["size"] for w in winners] == [2000]
    plan = plan_of(exact_dedup.exact_groups(df))
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


def test_summaries_merge_when_most_tasks_have_no_rows(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = documents(spark, [(1, "a"), (2, "a"), (3, "b")])
        assert exact_dedup.exact_groups(df).where("kept").count() == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_exact_dedup_of_odd_rows(spark):
    odd = with_clashes(odd_documents(spark))
    out = exact_dedup.exact_groups(odd)
    assert out.count() == odd.count()
    groups = plain_groups([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    assert out.where("kept").count() == len(groups)
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns and left.count() == len(groups)
    assert exact_dedup.drop_copies(odd.limit(0)).count() == 0
    assert exact_dedup.exact_groups(odd.limit(0)).count() == 0


def test_copies_with_one_id_are_reduced_where_they_are_read(spark):
    rows = [(7, "hot text")] * 2000 + [(None, "hot  text")] * 1000 + [(None, "no id")] * 1500 + [(k, f"t{k}") for k in range(100, 400)]
    df = with_clashes(documents(spark, rows)).repartition(9)
    left = exact_dedup.drop_copies(df)
    plan = plan_of(left)
    assert "partial_min_by" in plan and "Window" not in plan and "Python" not in plan
    assert left.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert got == sorted([(7, "hot text"), (None, "no id"), *((k, f"t{k}") for k in range(100, 400))], key=str)


def test_one_document_stays_of_a_hot_id_and_all_without_words(spark):
    long = "one two three four five six seven eight"
    rows = [(7, long)] * 1500 + [(None, long + " nine")] * 700 + [(None, None)] * 900 + [(7, " ")] * 60 + [(8, "else")]
    df = documents(spark, rows).repartition(9)
    left = set_join.keep_one(df)
    assert "partial_first" in plan_of(left)
    got = Counter((r.doc_id, r.text) for r in left.collect())
    assert got == {(7, long): 1, (None, None): 900, (7, " "): 60, (8, "else"): 1}


def test_texts_without_words_are_those_that_python_splits_into_none(spark):
    marks = [c for c in range(0x11000) if not 0xD800 <= c < 0xE000] + [0x1F600, 0xE0020]
    df = spark.createDataFrame([(c, chr(c)) for c in marks], "code long, text string")
    got = {r.code for r in df.where(F.col("text").rlike(set_join._WORDLESS)).collect()}
    assert got == {c for c in marks if not chr(c).split()}
    odd = spark.createDataFrame([("",), ("\n",), (" \t\n",), ("\na",), ("a\n",)], "text string")
    assert odd.where(F.col("text").rlike(set_join._WORDLESS)).count() == 3


def plain_lines(rows, min_sites):
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if bare := line.strip(" \t\r"):
                sites[bare].add(site)
    common = {line for line, s in sites.items() if len(s) >= min_sites}
    out = []
    for doc_id, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if line.strip(" \t\r") not in common]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_sites", [2, 5, 60])
def test_boilerplate_lines_equal_plain_python(spark, min_sites):
    rnd = random.Random(min_sites)
    rows = []
    for k in range(400):
        lines = [rnd.choice([f"line {rnd.randint(0, 40)}", f"rare {k}", "", " \t", "everywhere ", "everywhere"]) for _ in range(6)]
        rows.append((k, "\n".join(lines), rnd.choice([None, *(f"s{i}" for i in range(80))])))
    df = documents(spark, [(k, t, "en", s) for k, t, s in rows])
    out = line_dedup.drop_boilerplate(df, min_sites=min_sites)
    assert rows_of(out.select("doc_id", "text", "n_lines", "n_removed")) == plain_lines(rows, min_sites)
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)


def test_band_of_doubt_is_counted_exactly():
    assert line_dedup.doubtful(5) == (4, 6)
    low, high = line_dedup.doubtful(1000)
    assert low < 940 and high > 1060


def test_line_dedup_of_odd_rows(spark):
    odd = with_clashes(odd_documents(spark)).withColumn("n_lines", F.lit(7))
    out = line_dedup.drop_boilerplate(odd, min_sites=2)
    assert out.columns == [*odd.columns, "n_lines_", "n_removed"] and out.count() == odd.count()
    assert {r.text for r in out.where("doc_id IS NULL").collect()} == {""}  # on two sites: null and src2
    assert line_dedup.drop_boilerplate(odd.limit(0)).count() == 0


def plain_similar(rows, threshold=0.8):
    sets = {}
    for k, (_, text) in enumerate(rows):
        words = (text or "").lower().split()
        sets[k] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = dict.fromkeys(sets, 0)
    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return links, {k: find(k) for k in sets}


def variants(rnd, base, count, edits):
    for _ in range(count):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(len(words))] = f"new{rnd.randint(0, 10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("leaf, block, depth", [(200, 400, 4), (6, 8, 2)])
def test_similar_groups_equal_brute_force(spark, monkeypatch, leaf, block, depth):
    monkeypatch.setattr(set_join, "LEAF", leaf)
    monkeypatch.setattr(set_join, "BLOCK", block)
    monkeypatch.setattr(set_join, "MAX_DEPTH", depth)
    rnd = random.Random(8)
    texts = []
    for group in range(12):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(30, 120))]
        texts += variants(rnd, base, 60 if group == 0 else rnd.randint(1, 9), 4)
    texts += ["short text", "short text", "Short  TEXT", "", None]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    links, root = plain_similar(rows)
    got = {r.doc_id: r for r in set_join.report(documents(spark, rows)).collect()}
    assert {k: r.n_links for k, r in got.items()} == links
    assert {k: r.class_id for k, r in got.items()} == root
    assert {k for k, r in got.items() if r.kept} == set(root.values())


def test_a_group_that_comes_back_is_compared_once(spark, monkeypatch):
    monkeypatch.setattr(set_join, "LEAF", 6)
    monkeypatch.setattr(set_join, "BLOCK", 8)
    rnd = random.Random(5)
    members = {1: range(80), **{path: rnd.sample(range(84), 60) for path in range(2, 22)}, 30: [1, 2, 90], 31: range(85, 93)}
    rows = [(rep, path, len(reps)) for path, reps in members.items() for rep in reps]
    leaves = spark.createDataFrame(rows, "rep long, path long, m long")
    known = {r.rep: r for r in set_join.class_paths(leaves).collect()}
    assert all(known[rep].home == 1 for rep in range(80)) and known[85].home == 31
    groups = defaultdict(list)
    for r in set_join.in_blocks(leaves, set_join.class_paths(leaves)).collect():
        groups[r.path, r.one, r.two].append((r.rep, r.block))
    met = defaultdict(int)
    for (path, one, two), found in groups.items():
        reps, blocks = zip(*found)
        alike = np.zeros((len(reps), set_join.SLOTS), np.uint16)
        paths, homes = [set(known[r].paths) for r in reps], [known[r].home for r in reps]
        for a, b in zip(*set_join._candidates(alike, np.array(blocks), one, two, path, paths, homes)):
            met[frozenset((reps[a], reps[b]))] += 1
    assert met == {frozenset((a, b)): 1 for reps in members.values() for a in reps for b in reps if a != b}
    # 80 classes in ten blocks, once; twenty more times each of them meets a few others at most.
    assert sum(map(len, groups.values())) < 80 * 10 + 20 * (60 + 4 * 8) + 100


def test_idle_workers_remember_no_words():
    shingles = set_join.Shingles()
    shingles.sets(["a b c", "d e f g h i"])
    assert shingles.known
    shingles.forget()
    assert not shingles.known


def test_runs_follow_from_the_depth():
    assert abs(set_join.survival(1) - 0.84) < 1e-12
    assert set_join.runs_needed(1) < set_join.runs_needed(4)
    assert (1 - set_join.survival(4)) ** set_join.runs_needed(4) <= 1 - set_join.RECALL


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_runs_cover_pairs_with_few_equal_minhashes(depth):
    agree = np.random.default_rng(1).binomial(set_join.SLOTS, set_join.THRESHOLD, 400_000) / set_join.SLOTS
    missed = [(1 - set_join.survival(depth, a)) ** set_join.runs_needed(depth) for a in np.unique(agree)]
    shares = np.unique(agree, return_counts=True)[1] / len(agree)
    assert shares @ missed <= 1.1 * (1 - set_join.RECALL)


def test_set_join_of_odd_rows(spark):
    odd = with_clashes(odd_documents(spark))
    out = set_join.report(odd)
    assert out.count() == odd.count()
    left = set_join.keep_one(odd)
    assert left.columns == odd.columns
    # "a" three times, twice without an id; texts without words are never linked.
    assert left.where("text = 'a'").count() == 1 and left.where(r"btrim(coalesce(text, ''), ' \n') = ''").count() == 5
    assert left.count() == out.where("kept").count()
    assert set_join.keep_one(odd.limit(0)).count() == 0 and set_join.report(odd.limit(0)).count() == 0


def test_components_of_a_long_chain_a_star_and_loops(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(500 + k, 400) for k in range(30)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {k: 100 for k in range(101, 141)} | {500 + k: 400 for k in range(30)}
    assert components.components(df.limit(0)).count() == 0
