"""Pages with known article text, malformed markup, and the site style tree."""

import duckdb
from pyspark.sql import functions as F

from replylens.llm import html_extract

PAGES = "page_id long, url string, html string"


def text_of(source):
    return html_extract.Page(source).kept()


def test_article_without_furniture():
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var a="</p><article>no";</script></head>
    <body><header><h1>Site</h1></header><nav><ul><li><a href="/">menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
    <main><article><header><h1>A&nbsp;title &amp; more</h1></header><p>One <b>bo</b>ld   word<br>next<p>Two &lt;tags&gt; &#233;&#x1F600;
    <aside>side</aside><div class="ad">Buy</div><ul><li>first<li>second</ul><form><label>Mail</label><input value=x></form>
    <section id="comments"><article class="comment">I disagree</article></section></article></main>
    <div class="sidebar">more</div><footer>&copy; site</footer><script>x</script></body></html>"""
    assert text_of(page) == "A title & more One bold word next Two <tags> é😀 first second"


def test_awkward_markup():
    assert text_of("") == text_of("<html><body></body></html>") == text_of("<!-- only a comment") == ""
    assert text_of("plain text & more < 5 > 3") == "plain text & more < 5 > 3"
    assert text_of("<article><p>open <b>bold<p>next</article><footer>f") == "open bold next"
    assert text_of("<article><p>cut off <a href='x") == "cut off"
    assert text_of("<article><p title='a > b' data-x=\"<p>\">x</p></article>") == "x"
    assert text_of("<nav><a>menu</a><article><p>nav was not closed</article>") == "nav was not closed"
    assert text_of("<article>a<!-- <p>no</p> -->b<![CDATA[no]]>c<?php no ?>d</article>") == "abcd"
    assert text_of("<p>one</p>two<div>three<span>four</span></div>") == "one two threefour"
    assert text_of("<ARTICLE><P CLASS=x>Upper</P></ARTICLE>") == "Upper"
    assert text_of("<article><table><tr><td>a<td>b<tr><td>c</table><pre>x\n  y</pre></article>") == "a b c x y"
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 10) == "deep"
    assert text_of("<article>" + "<p>word " * 20000 + "</article>").count("word") == 20000
    assert text_of("</p></div></article>x") == "x"


def test_given_pages(spark):
    path = "/root/testdata/sf0.01/pages.parquet"
    got = {r.page_id: r for r in html_extract.extract_text(spark.read.parquet(path)).collect()}
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{path}'").fetchall()
    assert len(got) == len(pages)
    import html
    import re

    for page_id, url, source in pages:
        article = re.search(r"<article>(.*?)</article>", source, re.DOTALL)[1]
        blocks = re.sub(r"</?(b|i|em|strong|a|span)\b[^>]*>", "", article)
        plain = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", blocks)).split())
        assert (got[page_id].url, got[page_id].text, got[page_id].n_chars) == (url, plain, len(plain))


def site(n=8):
    """Pages without an article element: two blocks that all pages have, one of their own, one varied element."""
    return [
        (i, f"https://Site.example/{i}", f"<div class=top>All our offers</div><div class=body><p>Story {i} told once</p>"
         f"<p>{'Same line in two' if i < 2 else f'Line {i}'}</p></div><div class=end>Imprint of the site</div>")
        for i in range(n)
    ]


def test_site_style_tree(spark):
    rows = site() + [(100, "http://other.example/", "<div class=top>All our offers</div><p>Alone</p>"), (101, None, None), (102, "x", "")]
    rows += [(0, *site()[0][1:])]
    df = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("clash")).withColumn("host", F.lit(1))
    out = html_extract.extract_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = {r.page_id: r.text for r in out.collect()}
    assert out.count() == len(rows)
    assert got[5] == "Story 5 told once Line 5"
    assert got[0] == "Story 0 told once Same line in two"
    assert got[100] == "All our offers Alone" and got[101] == got[102] == ""
    assert html_extract.extract_text(df.limit(0)).count() == 0


def test_importance(spark):
    rows = spark.createDataFrame(site(), PAGES)
    scores = {(r.number, r.page): r for r in html_extract.importances(html_extract.tree_rows(rows)).collect()}
    assert len(scores) == 8 * 4
    assert all(r.novel == 0.0 for (n, _), r in scores.items() if n in (0, 3))
    assert all(r.novel == 1.0 for (n, _), r in scores.items() if n == 1)


def test_passages_in_articles_stay(spark):
    rows = [(i, "http://h/", "<nav>m</nav><article><p>Repeated everywhere</p></article>") for i in range(9)]
    got = html_extract.extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert [r.text for r in got] == ["Repeated everywhere"] * 9


def test_hosts():
    assert [html_extract.host_of(u) for u in ("HTTP://A.b:80/x", "//c/", None, "", "rel/x", "https://q?x")] == ["a.b:80", "c", "", "", "", "q"]
