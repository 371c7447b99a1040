import html
import re

import numpy as np
import pytest

from servicerank.llm import html_extract as h


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return h.train(pages)


def text_of(model, source):
    page = h.parse(source)
    return h.main_text(page, model.marginals(h.Forest([page]))[0])


def test_articles_of_given_pages(pages, model):
    got = {r.page_id: r for r in h.extract(pages, model).collect()}
    right = 0
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        article = re.sub(r"</?(p|br|h1)>", " ", article)
        wanted = " ".join(html.unescape(re.sub(r"<[^>]*>", "", article)).split())
        right += got[r.page_id].text == wanted
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
    assert right >= 0.98 * len(got)


def test_held_out_layouts(pages, model):
    sentences = [s + "." for r in pages.limit(40).collect() for s in re.sub(r"<[^>]*>", " ", r.html).split(".") if len(s) > 20]
    sources = h.labelled_pages([html.escape(s) for s in sentences], 200, seed=99)
    parsed = [h.parse(s) for s in sources]
    forest = h.Forest(parsed)
    content, _ = model.marginals(forest)
    labels = np.concatenate([p.label for p in parsed])
    text = forest.kind == 0
    right = (content[text] >= 0.5) == (labels[text] == 1)
    assert (right * forest.length[text]).sum() >= 0.97 * forest.length[text].sum()


def test_parts_that_are_not_the_article(model):
    body = "".join(f"<p>The river rose again in the night, and nobody in the village slept, part {i}.</p>" for i in range(6))
    page = (
        "<html><head><title>T</title><script>var x='<p>no</p>';</script></head><body><header class=site-header><a href=/>Home</a></header>"
        "<nav><ul><li><a href=/a>One</a></li></ul></nav><div class=cookie-notice>We use cookies. <button>Fine</button></div>"
        f"<article><h1>Floods &amp; rain</h1>{body}</article><div class=ad>Buy this now.</div>"
        "<form class=search><label>Search</label><input></form><aside class=sidebar><h3>More</h3><a href=/b>Two</a></aside>"
        "<section id=comments><div class=comment><p>I was there too, it was a bad night.</p></div></section>"
        "<footer>&copy; 2024 All rights reserved.</footer></body></html>"
    )
    want = "Floods & rain " + " ".join(f"The river rose again in the night, and nobody in the village slept, part {i}." for i in range(6))
    assert text_of(model, page) == want


def test_markup_is_tolerated(model):
    assert text_of(model, "") == ""
    inline = h.parse("<article><p>a <b>b</b>c&nbsp;&lt;d&#33;<p>e<br>f <!-- x --><script>no</script></article>")
    assert h.main_text(inline, np.ones(len(inline.parent))) == "a bc <d! e f"
    for source in ("<", "a < b", "<p", "</p></div>", "<div>" * 3000 + "x", "<!-- open", "<script>x", "<a b='>'>q</a>", "<li>1<li>2<td>3<tr>4"):
        page = h.parse(source)
        assert len(page.parent) == len(page.text) and isinstance(text_of(model, source), str)


def test_marginals_equal_enumeration(model):
    page = h.parse("<body><div class=menu><a href=x>link</a></div><p>Some text.</p></body>")
    forest = h.Forest([page])
    n = len(page.parent)
    unary = np.bincount(forest.node_of, model.weights[forest.feature], n)
    total, sums = 0.0, np.zeros(n)
    for labels in np.ndindex(*(2,) * n):
        energy = sum(unary[i] for i in range(n) if labels[i])
        energy += sum(model.pairs[forest.edge[i], labels[forest.parent[i]], labels[i]] for i in range(n) if forest.parent[i] >= 0)
        total += np.exp(energy)
        sums += np.exp(energy) * np.array(labels)
    assert np.allclose(model.marginals(forest)[0], sums / total)


def test_table_cases(spark, model):
    schema = "page_id long, url string, html string, text string, kind int"
    rows = [(1, "u", None, "x", 1), (2, None, "", "x", 1), (3, "v", "plain", "x", 1), (3, "v", "plain", "x", 1), (4, "w", "<p>" + "word " * 50_000, "x", 1)]
    got = h.extract(spark.createDataFrame(rows, schema), model).collect()
    assert [(r.page_id, r.url) for r in got] == [(r[0], r[1]) for r in rows]
    assert got[0].text == got[1].text == "" and got[2] == got[3]
    assert h.extract(spark.createDataFrame([], schema), model).collect() == []
    assert h.train(spark.createDataFrame([], schema)).weights.shape == (h.FEATURES,)
