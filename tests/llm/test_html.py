import re

import numpy as np
import pytest

from coppice.llm.html_blocks import blocks
from coppice.llm.html_extract import BATCH_BLOCKS, Inputs, Labeller, extract_text, train, training_pages


@pytest.fixture(scope="module")
def model():
    return train()


def texts(html):
    return [b.text for b in blocks(html)]


def test_blocks():
    assert texts("<p>a<b>b</b> &amp; c&nbsp;d<p>e<br>f</p>g") == ["ab & c d", "e f", "g"]
    assert texts("<title>t</title><style>p{}</style><script>var x='</p><p>no'</script><!-- <p>no</p> --><p>yes") == ["yes"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("1 < 2 and <p") == ["1 < 2 and"] or texts("1 < 2 and <p")[0].startswith("1 < 2")
    assert texts("") == texts("<div></div>") == texts("<!DOCTYPE html><?xml?>") == []
    assert texts("<![CDATA[raw]]>&#65;&#x42;&copy") == ["rawAB©"]
    found = blocks("<div class='a b-1' id=\"Main\"><nav><a href='/x'>link</a> no</nav></div>")
    assert found[0].path == ("div", ".a", ".b", ".main", "nav") or "nav" in found[0].path
    assert found[0].link_chars == 4


def test_open_head_svg_and_math_end():
    head = "<html><head><title>x</title><meta charset=utf-8><script>s</script><noscript><img src=a></noscript>"
    for rest in ("<body><p>a</p><p>b</p></body></html>", "<p>a<p>b", "</head><body><p>a</p>b", "a<p>b"):
        assert texts(head + rest) == ["a", "b"]
    assert texts("<head><template><div>no</div></template><link rel=x><head><p>a") == ["a"]
    assert blocks(head + "<body><p>a")[0].path == blocks(head + "</head><body><p>a")[0].path == ("html", "body", "p")
    assert texts("<div><svg><path d=''><text>no</text><p>a</p>b</div>") == ["a", "b"] == texts("<math><mi>x</mi><div>a</div>b")
    assert texts("<svg><g><foreignObject><div>no</div></foreignObject><text>no</text></svg><p>a") == ["a"]


def test_gradients():
    pages = training_pages(4, 3)
    model = Labeller(1)
    x, y = Inputs([p for p, _ in pages]), np.concatenate([y for _, y in pages])
    loss = lambda: model.gradients(x, y)[0]
    _, grads = model.gradients(x, y)
    r = np.random.default_rng(0)
    for name, g in grads.items():
        flat = np.argsort(-np.abs(g).ravel())[: 5]
        for k in [*flat, r.integers(g.size)]:
            at, eps = np.unravel_index(k, g.shape), 1e-5
            old = model.p[name][at]
            model.p[name][at] = old + eps
            up = loss()
            model.p[name][at] = old - eps
            down = loss()
            model.p[name][at] = old
            assert (up - down) / (2 * eps) == pytest.approx(g[at], rel=1e-3, abs=1e-8), name


def test_held_out_accuracy(model):
    pages = training_pages(150, 77)
    got = model.probabilities([p for p, _ in pages])
    right = np.concatenate([(g >= 0.5) == y for g, (_, y) in zip(got, pages)])
    assert right.mean() > 0.99
    alone = [model.probabilities([p])[0] for p, _ in pages[:10]]
    assert all(np.allclose(a, b) for a, b in zip(alone, got))


def test_query_equals_the_articles(spark, sf, model):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r.page_id: "\n".join(b.text for b in blocks(r.html or "") if "article" in b.path) for r in pages.collect()}
    rows = extract_text(pages, model=model).collect()
    assert sum(r.text == want[r.page_id] for r in rows) >= 0.98 * len(want)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_parts_that_are_no_article(spark, model):
    para = "This is a longer paragraph of the story, with enough words to be read as prose by anyone. "
    html = f"""<html><body><div class="cookie-consent"><p>This site uses cookies.</p><button>OK</button></div>
    <header class="site-header"><a href="/">The Daily</a></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
    <article><h1>A headline</h1><p>{para}</p><p>Second. {para * 2}</p><aside class="related"><h3>Read also</h3><a href="/x">Other story</a></aside>
    <p>Third. {para}</p><form class="newsletter"><label>Your email</label><input><button>Subscribe</button></form></article>
    <section id="comments" class="comments"><h3>2 comments</h3><div class="comment"><p>I agree with this, great post. {para}</p></div></section>
    <footer><p>© 2024 all rights reserved</p></footer></body></html>"""
    got = extract_text(spark.createDataFrame([(1, html)], "page_id long, html string"), model=model).first()
    want = ["A headline", para.strip(), f"Second. {(para * 2).strip()}", f"Third. {para.strip()}"]
    assert got.text == "\n".join(want) and got.n_blocks > 10


def test_odd_pages(spark, model):
    long = "<article>" + "".join(f"<p>Paragraph {i} of a very long page, as prose.</p>" for i in range(3000)) + "</article>"
    rows = [(1, None, "u"), (2, "", "u"), (3, "no markup at all", None), (None, "<p>", "u"), (4, long, "u"), (4, long, "u"), (5, "<<<>>><a <b", "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, url string").selectExpr("*", "'x' AS text", "7 AS n_chars", "1 AS size")
    got = extract_text(df, model=model).collect()
    assert len(got) == 7 and got[0].asDict().keys() == {"page_id", "url", "size", "text", "n_chars", "n_blocks"}
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == by[None].text == ""
    assert by[4].n_blocks == 3000 and by[4].text.count("\n") >= 2900
    assert extract_text(df.limit(0), model=model).collect() == []
    assert BATCH_BLOCKS > 3000 and re.match("Paragraph", by[4].text)
