"""The pipeline and the registered queries on the given tables."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from compare import compare, driver, duck
from tokenizers import Tokenizer

import corpus_pipeline
from patronlens.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, duck(SF_DIR), SF_DIR, name) == ""


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(driver.queries())


def test_every_stage_keeps_what_it_should(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    tables = {"documents": docs}
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF_DIR)
        docs = tables[name] = spark.createDataFrame(docs.collect(), docs.schema)
    good = {r.doc_id for r in tables["quality"].collect()}
    assert all(i in good for i, q in labels.items() if q == 1) and not any(i in good for i, q in labels.items() if q == 0)

    texts = {}
    for r in tables["quality"].orderBy("doc_id").collect():
        texts.setdefault(" ".join(r.text.replace("\n", " ").split(" ")), r.doc_id)
    assert {r.doc_id for r in tables["exact_dedup"].collect()} == set(texts.values())

    kept = {}
    for r in tables["exact_dedup"].orderBy("doc_id").collect():
        words = r.text.lower().split()
        kept[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    root = {i: i for i in kept}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in kept:
        for b in kept:
            if b < a and len(kept[a] & kept[b]) >= 0.8 * len(kept[a] | kept[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    near = [r.doc_id for r in tables["near_dedup"].collect()]
    assert sorted(near) == sorted({find(i) for i in kept})

    mixed = [r.doc_id for r in tables["mixture"].collect()]
    assert set(mixed) == set(near) and len(near) < len(mixed) <= 1.3 * len(near) + 20
    assert all(tables[n].columns == tables["documents"].columns for n in ("quality", "exact_dedup", "near_dedup", "mixture"))

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text_of = {r.doc_id: r.text for r in tables["documents"].collect()}
    out = tables["bpe"].collect()
    assert sorted(r.doc_id for r in out) == sorted(mixed)
    for r in out:
        ids = tokenizer.encode(text_of[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(text_of[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, np.array(ids))).encode()).hexdigest()


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100
