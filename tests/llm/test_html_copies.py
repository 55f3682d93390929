"""Copies, names and recurring links: what the style tree and the markup rules may take."""

from replylens.llm import html_extract

PAGES = "page_id long, url string, html string"


def texts(spark, rows):
    out = html_extract.extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert len(out) == len(rows)
    return {r.page_id: r.text for r in out}


def plain_page(text, extra=""):
    return f"<html>{extra}<div class=top>All our offers</div><div class=body><p>{text}</p><p>More of {text}</p></div></html>"


def test_copies_keep_their_text(spark):
    rows = [(i, None, "<p>Told twice</p><p>and again</p>") for i in range(2)]
    # A host made mostly of copies, some with other scripts and comments.
    rows += [(10 + i, "http://copies/", plain_page("the copied story", f"<script>track({i % 3})</script><!-- {i % 2} -->")) for i in range(30)]
    rows += [(50 + i, "http://copies/", plain_page(f"story {i}")) for i in range(3)]
    got = texts(spark, rows)
    assert got[0] == got[1] == "Told twice and again"
    assert {got[10 + i] for i in range(30)} == {"the copied story More of the copied story"}
    assert [got[50 + i] for i in range(3)] == [f"story {i} More of story {i}" for i in range(3)]


def text_of(source):
    return html_extract.Page(source).kept()


def test_names_do_not_take_article_text():
    for source in (
        '<article><h2 id="related-work">Kept</h2></article>', '<article><h1 class="article-header">Kept</h1></article>',
        '<article><section id="form-validation"><p>Kept</p></section></article>', '<article><p class="notice">Kept</p></article>',
        '<article><p><span class="hljs-comment">Kept</span></p></article>', '<article><div data-id="ad-12">Kept</div></article>',
        '<article><div title="x class=ad">Kept</div></article>', '<main><div class="menu">Kept</div></main>',
        '<main><section id="comments">Kept</section></main>', '<article class="comment-policy">Kept</article>',
        '<div id="form-validation"><h2 class="header">Kept</h2></div>', '<div class="with-sidebar"><p id="search">Kept</p></div>',
    ):
        assert text_of(source) == "Kept", source
    for name in ("ad", "ad ad-12", "top-ad", "comments", "shareSharing"):
        assert text_of(f'<article><p>Kept</p><div class="{name}">Gone</div></article>') == "Kept", name
    for name in ("cookie-notice", "site-header", "sidebar", "navMenu"):
        assert text_of(f'<p>Kept</p><div id="{name}">Gone</div>') == "Kept", name


def test_the_tree_confirms_names_in_articles(spark):
    page = '<article><div class="notice"><p>{}</p></div><p>Story {}</p></article>'
    rows = [(i, "http://same/", page.format("Read our terms", i)) for i in range(6)]
    rows += [(10 + i, "http://own/", page.format(f"Mind step {i}", i)) for i in range(6)]
    got = texts(spark, rows)
    assert [got[i] for i in range(6)] == [f"Story {i}" for i in range(6)]
    assert [got[10 + i] for i in range(6)] == [f"Mind step {i} Story {i}" for i in range(6)]


def test_recurring_links_in_articles_go(spark):
    menu = '<div class="x1"><ul><li><a href="/a">All topics</a></li><li><a href="/b">Archive</a></li></ul></div>'
    page = '<main><h1><a href="#">Guide</a></h1>{}<p>Story {} with a <a href="/c">link</a></p><p>Free to share</p><p><a href="/{}">Source {}</a></p></main>'
    rows = [(i, "http://site/", page.format(menu, i, i, i)) for i in range(8)]
    # On two pages, or on a few of many, a line of links is no menu.
    rows += [(10 + i, "http://two/", page.format(menu, i, i, i)) for i in range(2)]
    rows += [(20 + i, "http://few/", page.format("<p><a>Official site</a></p>" if i < 4 else "", i, i, i)) for i in range(20)]
    got = texts(spark, rows)
    assert [got[i] for i in range(8)] == [f"Guide Story {i} with a link Free to share Source {i}" for i in range(8)]
    assert [got[10 + i] for i in range(2)] == [f"Guide All topics Archive Story {i} with a link Free to share Source {i}" for i in range(2)]
    assert all(("Official site" in got[20 + i]) == (i < 4) for i in range(20))
