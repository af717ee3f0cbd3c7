"""The pipeline on the smallest tables, against its operators' definitions."""

import hashlib

import pytest

import corpus_pipeline as cp
from shoplens.llm import bpe, queries
from tests.llm.test_dedup import brute_groups, brute_spans
from tests.llm.test_native import brute_hits

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names = docs.columns
    stages = dict(cp.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "suffix_dedup", "decontaminate", "bpe"]
    clean = stages["toxicity"](spark, docs, SF).cache()
    assert clean.columns == names and 0.7 * docs.count() < clean.count() <= docs.count()
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    one = stages["near_dedup"](spark, clean, SF).cache()
    assert one.columns == names and {r.doc_id for r in one.collect()} == {i for i, (_, c) in brute_groups(rows).items() if i == c}
    rows = [(r.doc_id, r.text) for r in one.collect()]
    cut = stages["suffix_dedup"](spark, one, SF).cache()
    want = brute_spans([t.encode() for _, t in rows], 200)
    got = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == names and len(got) == len(rows)
    for (i, _), (_, removed, _, digest) in zip(rows, want):
        if "�" not in got[i].text:
            assert hashlib.sha256(got[i].text.encode()).hexdigest() == digest
        assert got[i].n_chars == len(got[i].text) or not removed
    rows = [(r.doc_id, r.text) for r in cut.collect()]
    kept = stages["decontaminate"](spark, cut, SF).cache()
    assert kept.columns == names and {r.doc_id for r in kept.collect()} == {x[0] for x in brute_hits(rows, bench) if not x[5]}
    texts = {r.doc_id: r.text for r in kept.collect()}
    b = bpe.load(queries.tokenizer_path())
    for r in stages["bpe"](spark, kept, SF).collect():
        ids = b.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


@pytest.mark.parametrize("step", [s for _, s in cp.STAGES])
def test_stage_edges(spark, step):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    docs = spark.createDataFrame([(1, None, None, None, None, "e"), (2, "", "en", "s", 0, None), (2, "", "en", "s", 0, None), (None, "x y", "en", "s", 3, "e"),
                                  (4, "word " * 60_000, "en", "s", 300_000, "e")], schema)
    out = step(spark, docs, SF)
    got = out.collect()
    assert len(got) >= 3 and len(got) <= 5
    assert step(spark, docs.limit(0), SF).count() == 0
    if step is not cp.encode:
        assert out.columns == docs.columns
