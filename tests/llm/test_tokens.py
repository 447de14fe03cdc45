"""Encoding, decoding and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import LONG, ODD_TEXTS, documents, odd_documents, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronlens.llm import bpe, chunks, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(bpe.read_vocabulary(PATH))


def same_as_library(vocab, texts):
    flat, counts = vocab.encode(texts)
    ends = np.cumsum(counts)
    want = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [flat[end - n : end].tolist() for end, n in zip(ends, counts)] == want
    assert vocab.decode(flat, counts) == LIBRARY.decode_batch(want, skip_special_tokens=False)


def test_odd_texts(vocab):
    same_as_library(vocab, [t or "" for t in ODD_TEXTS])


def test_every_letter(vocab):
    same_as_library(vocab, [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}  x" for c in range(1, 0x3000)])


def test_repeated_letters_and_spaces(vocab):
    same_as_library(vocab, ["a" * n for n in range(90)] + ["ab" * n + "a" for n in range(40)] + ["-" * 300, "\n" * 90, " " * 70 + "x"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(vocab, texts):
    same_as_library(vocab, texts)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="theraionsg '\n\t.,12<|endoftext|>", max_size=80), max_size=6))
def test_text_like_words(vocab, texts):
    same_as_library(vocab, texts)


def test_borders_agree_with_merging(vocab):
    rnd = random.Random(4)
    tokens = rnd.sample(list(vocab.proposed.values()), 1500)
    a, b = np.array(tokens[:-1]), np.array(tokens[1:])
    apart = vocab.apart(a, b)
    merged = [vocab.merge(vocab.bytes_of[x] + vocab.bytes_of[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert apart.tolist() == merged and 0 < sum(merged) < len(merged)


def test_rows_and_single_words_merge_alike(vocab):
    rnd = random.Random(5)
    words = [bytes(rnd.choices(b"theraionsgd", k=rnd.randint(1, 16))) for _ in range(400)]
    rows = np.frombuffer(b"".join(w.ljust(16, b"\0") for w in words), np.uint8).reshape(-1, 16)
    ids = vocab.merge_rows(rows, np.array([len(w) for w in words]))
    assert [r[r >= 0].tolist() for r in ids] == [vocab.merge(w) for w in words]


def test_memo_forgets_but_stays_right(vocab, monkeypatch):
    monkeypatch.setattr(vocab.texts.pieces, "room", 500)
    monkeypatch.setattr(vocab.texts.words, "room", 500)
    for n in range(6):
        same_as_library(vocab, [f"word{n} and some other word {k}" for k in range(4)] + ["w" * 60])


def test_encode_and_decode_tables(spark):
    odd = with_clashes(odd_documents(spark))
    ids = bpe.encode(odd, PATH)
    assert ids.columns == [*odd.columns, "ids_"] and ids.count() == odd.count()
    back = bpe.decode(ids.select("text", F.col("ids_").alias("ids")), PATH)
    assert back.where("coalesce(text, '') <> decoded").count() == 0
    got = bpe.digests(odd, PATH)
    assert got.count() == odd.count()
    row = got.where("doc_id = 6").first()
    want = LIBRARY.encode(LONG, add_special_tokens=False).ids
    assert row.n_tokens == len(want)
    assert row.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    assert bpe.digests(odd.limit(0), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.data())
def test_packing_round_trip(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=50)), "<u4")
    packed = token_files.pack(ids, bits)
    assert len(packed) == (len(ids) * bits + 7) // 8
    assert token_files.unpack(packed, bits, len(ids)).tolist() == ids.tolist()


def test_widths():
    assert [token_files.width_of(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def library_rows(rows, end_id=2):
    out, at = [], 0
    for doc_id, text in rows:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_files_hold_all_documents_in_order(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(k * 3, " ".join(rnd.choices(["the", "there", "\n", "and,", "é"], k=rnd.randint(0, 60)))) for k in range(300)]
    df = documents(spark, rnd.sample(rows, len(rows))).repartition(5)
    files = token_files.write_token_files(df, PATH)
    got = [tuple(r) for r in token_files.read_documents(files).orderBy("doc_id").collect()]
    assert got == library_rows(rows)
    one = token_files.read_one(files, 33)
    assert one == [[*LIBRARY.encode(rows[11][1], add_special_tokens=False).ids, 2]]


def test_random_access_reads_any_range(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 16)
    ids = np.arange(1000, dtype="<u4") * 7 % 5000
    for bits in (13, 16):
        path = tmp_path / f"{bits}.ids"
        path.write_bytes(b"".join(token_files.file_bytes([5, None, 9], np.array([400, 0, 600]), ids, bits)))
        file = token_files.TokenFile(f"file://{path}")
        assert file.document(2).tolist() == ids[400:].tolist() and file.document(1).tolist() == []
        for a, b in ((0, 1000), (15, 17), (16, 32), (999, 1000), (5, 5)):
            assert file.ids(a, b).tolist() == ids[a:b].tolist()
        file.close()


def test_token_files_of_odd_rows(spark):
    odd = with_clashes(odd_documents(spark))
    out = token_files.read_documents(token_files.write_token_files(odd, PATH)).orderBy("start").collect()
    assert len(out) == odd.count()
    ids = [r.doc_id for r in out]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))  # null ids first
    starts = np.cumsum([0, *(r.n_tokens for r in out)])[:-1].tolist()
    assert [r.start for r in out] == starts
    want = {i: n for i, _, n, _ in library_rows([(k, t) for k, t in enumerate(ODD_TEXTS)])}
    assert all(want[r.doc_id] == r.n_tokens for r in out if r.doc_id not in (None, 4))
    empty = token_files.write_token_files(odd.limit(0), PATH)
    assert empty.count() == 0 and token_files.read_documents(empty).count() == 0


@pytest.fixture
def column():
    """A new encoder of columns, with the library's model behind it."""
    token_files._TOKENIZERS.clear()
    with open(PATH, encoding="utf-8") as file:
        yield token_files._tokenizer(file.read())[0]
    token_files._TOKENIZERS.clear()


def column_as_library(column, texts, array=None):
    runs = list(column.column(pa.array(texts, pa.string()) if array is None else array))
    assert [row for row, _, _ in runs] == np.cumsum([0, *(len(sizes) for _, _, sizes in runs)])[:-1].tolist()
    got = [ids.tolist() for _, flat, sizes in runs for ids in np.split(flat, np.cumsum(sizes))[:-1]]
    assert got == [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_column_sees_a_piece_once_a_run(column, monkeypatch):
    asked, merged = [], []
    ids, merge = column._ids, column.encode_word
    monkeypatch.setattr(column, "_ids", lambda distinct: asked.append(len(distinct)) or ids(distinct))
    monkeypatch.setattr(column, "encode_word", lambda word: merged.append(word) or merge(word))
    rnd = random.Random(7)
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(["first", *rnd.choices(words, k=500)]) for _ in range(200)]
    column_as_library(column, texts)
    assert asked == [41]
    assert len(merged) == len(set(merged)) <= 1 + 2 * 40  # "first", " w" and numbers
    column_as_library(column, texts)
    assert asked == [41, 41] and len(merged) <= 1 + 2 * 40


def test_column_of_odd_texts(column):
    column_as_library(column, ODD_TEXTS)
    column_as_library(column, [*ODD_TEXTS, "<|endoftext|>", " <|endoftext|> a <|endoftext|>"], None)
    array = pa.array(["left out", *ODD_TEXTS, "left out"], pa.large_string())
    column_as_library(column, ODD_TEXTS[2:], array.slice(3, len(ODD_TEXTS) - 2))
    for texts in ([], [None], ["", None, ""], ["a"], [" "], ["a ", " b", " ", "c"], ["a", "", " b"]):
        column_as_library(column, texts)


def test_column_with_every_letter(column):
    letters = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    column_as_library(column, [f"a{c}b {c} {c}{c}  x{c} {c}y" for c in letters])


def test_column_in_many_runs_that_forgets(column, monkeypatch):
    monkeypatch.setattr(chunks, "STEP_BYTES", 60)
    monkeypatch.setattr(column, "room", 400)
    texts = [f"word{n % 7} and some other word {k}, 漢字 é{n}" * (k % 4) for n in range(20) for k in range(5)]
    column_as_library(column, texts + ["w" * 90, "-" * 90 + " x"] * 2)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="a b é\u00a0\u3000\u2009\u2028\u1680\u0085漢“😀\t\n\0.,1'<|endoftext|>", max_size=40), max_size=6))
def test_column_of_any_white_space(texts):
    with open(PATH, encoding="utf-8") as file:
        column_as_library(token_files._tokenizer(file.read())[0], texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=6))
def test_column_of_any_text(texts):
    with open(PATH, encoding="utf-8") as file:
        column_as_library(token_files._tokenizer(file.read())[0], texts)


def test_cuts_are_those_of_pieces():
    texts = ["one two  three", "é ü 漢 字\u3000 x", "a\u00a0 b « c » d", "", " e", "f\n g “h i”", "“ ”"]
    data = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, data)])
    cuts = chunks.cut_column(np.frombuffer(b"".join(data), np.uint8), starts)
    want = [piece for t in texts for piece in chunks.pieces(t) if piece]
    assert [b"".join(data)[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:])] == want
