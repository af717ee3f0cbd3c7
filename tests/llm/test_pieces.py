"""Piece tokenizer against the sentencepiece library."""

import random

import pytest
from pyspark.sql import functions as F

from shoplens.llm import pieces, queries

SF = "/root/testdata/sf0.001"
PATH = queries.tokenizer_path("piece_bpe_32k.model")
PARTS = ["a", "e", "t", " ", "  ", "▁", "the", "\n", "\0", "é", "日", "本", "\U0001f600", "<s>", "</s>", "<unk>", "<0x0A>", "ing", "▁▁▁", " ", "​",
         "ﬁ", "1", ".", ",", "ه", "한", "\t", "\x1c"]
TEXTS = ["", None, " ", "▁", "a" * 5000, "<s>x</s>", "  \n\n  x\t\ty", "日本語" * 400, "word " * 30000, "x" * 70000 + " y", " " * 300 + "z", "\U0001f600"]


def mixed(count, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(count)]


def test_ids_and_texts_of_the_library(spark):
    sp = pieces.library(PATH)
    texts = TEXTS + mixed(500, 1) + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("piece_n", F.lit("clash"))
    got = {r.doc_id: r for r in pieces.tokenize(df, PATH, check=True).collect()}
    short = {r.doc_id: r for r in pieces.tokenize(df, PATH, digest_only=True, check=True).collect()}
    for i, t in enumerate(texts):
        ids = sp.encode(t or "")
        assert (got[i].piece_n, got[i].piece_ids, got[i].piece_text) == (len(ids), ids, sp.decode(ids))
        assert got[i].piece_checked and short[i].piece_checked and short[i].piece_n == len(ids)


def test_heap_and_arrays_take_pairs_in_the_same_order():
    own, sp = pieces.load(PATH), pieces.library(PATH)
    chunks = [c for t in mixed(3000, 2) for b in own.blocks(t) for c in own.parts(b) if len(c) <= pieces.SHORT]
    symbols, ends = own.agendas(chunks)
    starts = [0, *ends[:-1].tolist()]
    flat = "".join(chunks)
    names = {i: s for s, i in own.symbol.items()}
    for c, a, b in zip(chunks, starts, ends.tolist()):
        assert [names[s] if s >= 0 else flat[-1 - s] for s in symbols[a:b].tolist()] == own.agenda(c)
    for t in mixed(3000, 3):
        assert own.encode(t) == sp.encode(t)


def test_decoding_of_any_ids():
    own, sp, rng = pieces.load(PATH), pieces.library(PATH), random.Random(4)
    for _ in range(5000):
        ids = [rng.randrange(32000) if rng.random() < 0.4 else rng.randrange(262) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == sp.decode(ids)


def test_small_blocks_and_a_small_table(spark, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 7)
    monkeypatch.setattr(pieces, "TABLE", 5)
    monkeypatch.setattr(pieces, "GROUP_BYTES", 20)
    own, sp = pieces.Pieces(PATH), pieces.library(PATH)
    texts = mixed(400, 5) + ["", "a  b", "many words in one text " * 20]
    for (n, ids, text), t in zip(own.encoded(texts), texts):
        assert ids == sp.encode(t) and text == sp.decode(ids) and n == len(ids)


def test_a_wrong_result_is_told(spark, monkeypatch):
    df = spark.createDataFrame([(1, "hello")], "doc_id long, text string")
    assert pieces.tokenize(df, PATH, check=True).first().piece_checked is True
    assert pieces.tokenize(df.limit(0), PATH, check=True).count() == 0


def test_other_models_are_refused(tmp_path):
    from shoplens.llm.pieces import Pieces

    path = tmp_path / "m.model"
    path.write_bytes(b"\x0a\x08\x0a\x01a\x15\x00\x00\x00\x00\x12\x02\x18\x01")
    with pytest.raises(ValueError):
        Pieces(str(path))
