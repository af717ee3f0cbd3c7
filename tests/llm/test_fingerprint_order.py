"""The next document by id for ids of any kind, and the likeness against exact sets."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import fingerprint
from shoplens.llm.common import words


def edited(text, following):
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


@pytest.mark.parametrize("kind, ids", [
    ("long", [5, 3, 9, 10**15, 4, 7]), ("string", ["b", "a", "source-x/0001", "source-x/0002", "z", "ä"]),
    ("long", [3, 3, 3, 8, 2, 2]), ("date", None)])
def test_next_document_of_any_id(spark, kind, ids):
    texts = ["one two three four five six", "", None, "alpha beta gamma delta epsilon zeta eta", "x y z", "é " * 9]
    if ids is None:
        df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").select(F.date_add(F.lit("2024-01-01"), F.col("n")).alias("doc_id"), "text")
    else:
        df = spark.createDataFrame(list(zip(ids, texts)), f"doc_id {kind}, text string")
    got = fingerprint.edited_fingerprints(df).collect()
    rows = sorted([(r.doc_id, r.text or "") for r in df.collect()], key=lambda r: r[0], reverse=True)
    assert len(got) == len(rows)
    if ids is None or len(set(ids)) == len(ids):
        want = {i: hashlib.sha256(edited(t, rows[(k + 1) % len(rows)][1]).encode()).hexdigest() for k, (i, t) in enumerate(rows)}
        assert {r.doc_id: r.edited_sha256 for r in got} == want
    else:
        # one order of the rows of an id: each text is followed once, and a group by the next smaller id's
        allowed = {hashlib.sha256(edited(t, u).encode()).hexdigest() for _, t in rows for _, u in rows}
        assert {r.edited_sha256 for r in got} <= allowed


def test_null_ids_and_one_id_for_a_third_of_the_rows(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(list("abcdefgh"), rng.integers(0, 30))) + f" {i}" for i in range(300)]
    ids = [None if i % 3 == 0 else 7 if i % 3 == 1 else i * 10**9 for i in range(300)]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5)
    paired = fingerprint.next_by_id(df, "doc_id", ["text"]).collect()
    follows = {r.text: r.next_text for r in paired}
    assert len(follows) == 300 and sorted(follows.values()) == sorted(texts)
    place = dict(zip(texts, ids))
    chain, at = [], max((i for i in ids if i is not None))
    text = texts[ids.index(at)]
    for _ in range(300):                            # one ring through all rows, ids falling and nulls last
        chain.append(place[text])
        text = follows[text]
    assert chain == sorted([i for i in ids if i is not None], reverse=True) + [None] * 100
    assert fingerprint.edited_fingerprints(df.limit(0)).count() == 0
    one = fingerprint.edited_fingerprints(df.limit(1)).first()
    assert one.near_next == 1.0


def test_likeness_estimates_the_similarity_of_long_texts(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 6000)]
    rows = []
    for k, share in enumerate((0.0, 0.02, 0.1, 0.5)):
        own = list(base)
        for at in rng.integers(0, len(own), int(share * len(own))):
            own[at] = f"x{k}_{at}"
        rows.append((k, " ".join(own)))
    sets = [{tuple(words(t)[i:i + 5]) for i in range(len(words(t)) - 4)} for _, t in rows]
    got = {r.doc_id: r.sketch for r in fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k in range(4):
        exact = len(sets[0] & sets[k]) / len(sets[0] | sets[k])
        a, b = set(got[0]), set(got[k])
        assert abs(len(a & b) / len(a | b) - exact) < 0.06       # some 750 hashes of a text of 6,000 words
        assert abs(len(a) / len(sets[0]) - 1 / 8) < 0.02
