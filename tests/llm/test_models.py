"""Classifiers by held-out accuracy, page text against a plain reading of the pages."""

import html
import re

import numpy as np
import pytest

from shoplens.llm import html_text, quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def auc(y, score):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    pos = y == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("name, label, least", [("op5_toxicity", "toxic", 0.9), ("op7_quality", "quality", 0.97)])
def test_held_out_rows(spark, name, label, least):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all() and set(got.predicted) <= {0, 1}
    m = got[got.held_out].merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert auc(m[label].to_numpy(), m.score.to_numpy()) >= least
    assert (m.predicted == m[label]).mean() >= 0.95


@pytest.mark.parametrize("module", [toxicity, quality])
def test_models_without_labels_and_odd_rows(spark, module):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "you idiot " * 3000, "z")], "doc_id long, text string, score string")
    out = "toxicity" if module is toxicity else "quality_score"
    label = "toxic" if module is toxicity else "quality"
    none = spark.createDataFrame([(2, None)], f"doc_id long, {label} int")
    got = module.score(docs, module.train(docs, none)).collect()
    assert len(got) == 4 and {r[out] for r in got} == {0.0} and sorted(r.score for r in got) == ["x", "y", "y", "z"]
    one = spark.createDataFrame([(1, 1), (2, 1), (2, 1)], f"doc_id long, {label} int")
    assert {r[out] for r in module.score(docs, module.train(docs, one)).collect()} <= {0.0, 1.0}
    assert module.score(docs.limit(0), module.train(docs.limit(0), none.limit(0))).count() == 0


def test_trees_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((toxicity.Trees.fit(x, y).margin(x) > 0) == (y > 0)).mean() > 0.97
    at, value = toxicity.isotonic(x[:, 0], y)
    assert (np.diff(at) > 0).all() and (np.diff(value) > 0).all()


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    size = quality.WORDS + quality.DENSE
    m = quality.Model(0.5, 0.1, rng.normal(size=size), rng.normal(size=(size, 3)), 0, 1)
    x = np.zeros((1, size))
    at = [3, 50, 700]
    x[0, at] = [0.5, -1.0, 2.0]
    pairs = sum(m.v[a] @ m.v[b] * x[0, a] * x[0, b] for k, a in enumerate(at) for b in at[k + 1:])
    assert abs(m.margin(x)[0] - (0.1 + x[0] @ m.w + pairs)) < 1e-9


def test_page_text_of_the_driver_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas().set_index("page_id")
    for r in queries.QUERIES["op6_html_text"](spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages.html[r.page_id], re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


PAGE = """<!doctype html><html><head><title>T</title><script>if (a < b) {}</script></head><body><header><h2>Site name here</h2></header>
<nav><ul><li><a href=/>Home page</a><li><a href=/x>Other</a></ul></nav><div class="cookie-notice">We use cookies, accept all of them</div>
<article><h1>A  headline</h1><p>First &eacute; para&shy;graph of <b>the text</b> has
words &lt;tags&gt;.<p>Second one<br>goes on.<div class="ad">Buy this now</div><ul><li>point one of a list that has enough words to count</ul>
<form><label>Mail</label><button>Send</button></form></article>
<aside>Related things to read</aside><section id="comments"><p>I like it very much indeed</p></section><footer>&copy; somebody</footer>"""


def test_page_text_of_a_hard_page():
    assert html_text.extract(PAGE, {}) == "A headline\nFirst é para­graph of the text has words <tags>.\nSecond one goes on.\npoint one of a list that has enough words to count"


def test_page_text_edges(spark):
    assert [html_text.extract(x, {}) for x in (None, "", "<p></p>", "a < b", "<p>x<p>y", "<script>x", "<!-- <p>no</p> ")] == ["", "", "", "a < b", "x\ny", "", ""]
    assert html_text.extract("<p>" + "word " * 100_000 + "</p>", {}).count(" ") == 99_999
    df = spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None, "<p>one two three four</p>")], "page_id long, url string, html string")
    assert html_text.learn(df) == {}
    assert sorted(r.main_text for r in html_text.main_text(df, {}).collect()) == ["", "", "one two three four"]
    assert html_text.main_text(df.limit(0), html_text.learn(df.limit(0))).count() == 0


def test_text_beyond_a_box_in_mid_article_is_kept():
    def words(n, stem):
        return " ".join(f"{stem}{i}" for i in range(n))

    box = f'<div class="advert"><p>{words(12, "buy")}</p></div>'
    long, end, lead = words(60, "w"), words(10, "end"), words(6, "lead")
    menu, foot = f"<nav>{words(9, 'menu')}</nav>", f"<footer>{words(8, 'foot')}</footer>"
    table = "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr></table>"
    page = "<body>{}<div class='post'>{}</div><div>other box</div>{}</body>"
    weights = {"p": 2.0, "out": -3.0, "<div": -1.0, "</div": -1.0}
    for inner, want in ((f"<p>{long}</p>{box}<p>{end}</p>", f"{long}\n{end}"), (f"<p>{lead}</p>{box}<p>{long}</p>", f"{lead}\n{long}"),
                        (f"<p>{long}</p>{table}", f"{long}\na\nb\nc\nd")):
        assert html_text.extract(page.format(menu, inner, foot), weights) == want
