"""What must not matter: the order of rows, missing ids, the folder that a job starts in; pages that never close a tag."""

import subprocess
import sys
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import bpe, html_text, queries, suffix, toxicity

SF = "/root/testdata/sf0.001"


def test_toxicity_model_does_not_depend_on_the_order_of_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    twice = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 5000))      # copies under other ids and labels
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    labels = labels.unionByName(labels.select((F.col("doc_id") + 5000).alias("doc_id"), (1 - F.col("toxic")).alias("toxic")))
    got = []
    for rows in (twice, twice.repartition(7, F.rand(1)).orderBy(F.rand(3))):
        model = toxicity.train(rows, labels)
        got.append({r.doc_id: r.toxicity for r in toxicity.score(twice, model).collect()})
    assert got[0] == got[1]


def test_suffix_removal_without_ids(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += texts[:40] + [None, "", None]
    whole = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    none = whole.select(F.lit(None).cast("long").alias("doc_id"), "text")
    cols = ["repeat_bytes", "repeat_removed", "repeat_spans", "repeat_sha256"]
    sides = [sorted(tuple(r) for r in suffix.remove_repeats(d, digest=True).select(*cols).collect()) for d in (whole, none)]
    assert sides[0] == sides[1] and any(r[1] for r in sides[0])


@pytest.mark.parametrize("bad", ["<a " * 300_000, "<script " * 100_000, "<a '>' " * 100_000, "<a \"'" * 200_000, "<a '<a \"<a " * 100_000,
                                 "<div class='x" * 80_000 + ">", "<" * 1_000_000])
def test_pages_that_close_nothing_are_scanned_once(bad):
    start = time.perf_counter()
    html_text.extract(bad, {})
    assert time.perf_counter() - start < 10


def test_tags_equal_a_plain_reading():
    rng = np.random.default_rng(5)
    parts = ["<a ", "'", '"', ">", "x", "</b>", "<p>", "<!--", "-->", "<br/>", "<script>", "</script>", "<", "=", " "]
    for _ in range(3000):
        page = "".join(rng.choice(parts, rng.integers(0, 14)))
        for a, b, name, attributes in html_text.tags(page):
            assert 0 <= a < b <= len(page) and page[a] == "<"
            if name and name not in html_text.RAW:
                body, quote = page[a + 1:b - 1], ""
                for c in body:                       # every '>' before the end stands in quotes
                    if quote:
                        quote = "" if c == quote else quote
                    elif c in "'\"":
                        quote = c
                    else:
                        assert c != ">"
                assert not quote and page[b - 1] == ">" and body.endswith(attributes)


def test_names_within_the_article():
    weights: dict = {}
    words = " ".join(["word"] * 40)
    cases = {
        f"<article><div class='post-header'><h1>The long title of it</h1>{words}</div></article>": "The long title of it\n" + words,
        f"<article><p>{words}</p><h2 id='search-trees'>Search trees here</h2><p>{words}</p></article>": f"{words}\nSearch trees here\n{words}",
        f"<article><p>{words}</p><p class='notice-board'>{words}</p></article>": f"{words}\n{words}",
        f"<main><div class='content-form'><p>{words}</p></div></main>": words,
        f"<article><p>{words}</p><div class='ad-slot big'>buy now</div><p>{words}</p></article>": f"{words}\n{words}",
        f"<p>{words} foo<img src=x>bar</p>": f"{words} foobar",
    }
    for page, text in cases.items():
        assert html_text.extract(page, weights) == text


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {shared!r})
         .config("spark.executorEnv.PYTHONPATH", "").getOrCreate())
from shoplens.llm import bpe, html_text, minhash, periodic, pieces, queries, suffix
df = spark.createDataFrame([(1, "a b c d e f g " * 3), (2, "x")], "doc_id long, text string")
assert bpe.tokenize(df, queries.tokenizer_path()).count() == 2
assert len(pieces.tokenize(df, queries.tokenizer_path("piece_bpe_32k.model")).collect()) == 2
assert len(html_text.main_text(df, {{}}, "text").collect()) == 2
assert len(minhash.near_duplicates(df).collect()) == 2
assert len(suffix.remove_repeats(df).collect()) == 2
assert len(periodic.collapse_runs(df).collect()) == 2
print("all there")
"""


def test_operators_called_first_from_another_folder(tmp_path):
    import os

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    (tmp_path / "shared").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1",
                                                                      "SPARK_SCALA_VERSION": "2.13"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root, shared=str(tmp_path / "shared")).replace("local-cluster[1,1,1024]", "local[1]")],
                          cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all there" in done.stdout, done.stderr[-2000:]


def test_bpe_in_small_blocks(monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 9)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 30)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 4)
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    own = bpe.Bpe(queries.tokenizer_path())
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(["ab ", "the", "  ", "\n", "<|endoftext|>", "é", " x", "1 2", "'s"], rng.integers(0, 20))) for _ in range(300)]
    for (n, ids, text), e in zip(own.encoded(texts), t.encode_batch(texts, add_special_tokens=False)):
        assert ids == e.ids and n == len(ids) and text == t.decode(e.ids, skip_special_tokens=False)
