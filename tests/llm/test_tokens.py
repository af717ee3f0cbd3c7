"""Tokenizer against the public library, language model against its definition."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import bpe, language_model, queries

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, "a" * 5000, "<|endoftext|>x <|endoftext|>", "  \n\n  x\t\ty '''s don't 12 3", "ü" * 700 + "aaaaa" * 90, "hello" * 800,
         "\U0001f600 　x", "word " * 20000, "tab\t end \r\n", " lead", "trail ", " nbsp  x", "x" * 70000 + " y", "a\x1cb"]


def library(texts):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    out = []
    for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False):
        text = t.decode(e.ids, skip_special_tokens=False)
        out.append((len(e.ids), hashlib.sha256(",".join(map(str, e.ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_same_ids_as_the_library(spark):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("bpe_n", F.lit("clash"))
    got = {r.doc_id: (r.bpe_n, r.bpe_ids_sha256, r.bpe_text_sha256)
           for r in bpe.tokenize(df, queries.tokenizer_path(), digest_only=True).collect()}
    assert [got[i] for i in range(len(texts))] == library(texts)


def test_round_trip_and_empty_table(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in bpe.tokenize(df, queries.tokenizer_path()).collect():
        assert r.bpe_text == (r.text or "") and r.bpe_n == len(r.bpe_ids)
    assert bpe.tokenize(df.limit(0), queries.tokenizer_path()).count() == 0


def test_streaming_transducer_equals_merging_at_once():
    b = bpe.load(queries.tokenizer_path())
    rng = np.random.default_rng(1)
    assert b.lookahead > 0
    for _ in range(6):
        raw = bytes(rng.choice(list(b"ethaions r"), 3000).tolist())
        assert list(b.stream([raw[:700], raw[700:]])) == b.merge([int(b.byte_id[x]) for x in raw])
    pieces = [bytes(rng.choice(list(b"aeths"), n).tolist()) for n in rng.integers(1, 30, 300)] + [b"aaaaaaa", b"a"]
    ids, ends = b.merge_many(pieces)
    starts = [0, *ends[:-1].tolist()]
    assert [ids[a:e].tolist() for a, e in zip(starts, ends.tolist())] == [b.merge([int(b.byte_id[x]) for x in p]) for p in pieces]


def test_decoder_replaces_broken_utf8():
    b = bpe.load(queries.tokenizer_path())
    assert b.decode([int(b.byte_id[0xC3])]) == "�"
    assert b.decode([int(b.byte_id[0xC3]), int(b.byte_id[0xA9])]) == "é"


def test_language_model_base_score_and_gain(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    rows += [(5000, None), (5001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in language_model.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1).collect()}
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    count = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    total, distinct = sum(count.values()), len(count)
    for i, t in tokens.items():
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(count[w] > 0 for w in t), total)
        assert abs(r.base_score - base) < 1e-6 * abs(base) + 1e-9
    for side in (True, False):
        base, own = (sum(getattr(r, c) for r in got.values() if r.held_out == side) for c in ("base_score", "score"))
        assert own > base


def test_language_model_tail_join_beyond_the_head(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    cond = F.col("doc_id") % 3 != 0
    full = {r.doc_id: r for r in language_model.score(df, cond).collect()}
    head = language_model.HEAD
    language_model.HEAD = 100
    try:
        for r in language_model.score(df, cond).collect():
            o = full[r.doc_id]
            assert r.n_known == o.n_known and abs(r.base_score - o.base_score) < 1e-6 and abs(r.score - o.score) < 1e-2 * abs(o.score)
    finally:
        language_model.HEAD = head


def test_class_model_is_normalised():
    rng = np.random.default_rng(0)
    code = np.unique(rng.integers(0, language_model.CLASSES ** 3, 5000))
    table = language_model.LogBilinear.fit(code, rng.integers(1, 50, len(code)).astype(float), steps=5).table()
    assert table.shape == (language_model.CLASSES ** 2, language_model.CLASSES)
    assert np.allclose((10.0 ** table.astype(float)).sum(1), 1, atol=1e-4)


def test_language_model_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert language_model.score(df.limit(0), F.lit(True)).count() == 0
    r = language_model.score(df, F.lit(False)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0)


def test_tokens_of_very_long_texts_do_not_depend_on_the_pieces():
    text = " ".join(f"Word{i % 977}" for i in range(3000)).encode()
    piece = language_model._PIECE
    whole = language_model.tokens([b"x y", text, b""])
    language_model._PIECE = 100
    try:
        parts = language_model.tokens([b"x y", text, b""])
    finally:
        language_model._PIECE = piece
    assert all((a == b).all() for a, b in zip(whole, parts))
