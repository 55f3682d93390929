"""The merged tree of a site against a plain recursive version, and what its branches take from pages."""

import math
import random

import pytest

from replylens.llm import html_extract
from replylens.llm.html_extract import GAMMA, RECUR_PAGES

PAGES = "page_id long, url string, html string"


def random_page(rng):
    """(tag, class, children); a text is ("", words, link target or None)."""

    def branch(depth):
        if depth == 0 or rng.random() < 0.3:
            link = rng.choice(["/a", "/b", f"/{rng.randrange(99)}"]) if rng.random() < 0.5 else None
            words = " ".join(rng.choice(["home", "news", "about", str(rng.randrange(50))]) for _ in range(rng.randrange(1, 4)))
            return (rng.choice(["p", "li"]), "", [("", words, link)])
        return (rng.choice(["div", "ul", "section"]), rng.choice("xyz"), [branch(depth - 1) for _ in range(rng.randrange(0, 4))])

    return ("div", "top", [branch(3) for _ in range(rng.randrange(1, 4))])


def render(node):
    if not node[0]:
        return node[1] if node[2] is None else f'<a href="{node[2]}">{node[1]}</a>'
    return f'<{node[0]} class="{node[1]}">' + "".join(map(render, node[2])) + f"</{node[0]}>"


def label(node):
    return f"{node[0]}.{node[1]}" if node[1] else node[0]


def features(text):
    return {("text", text[1])} if text[2] is None else {("word", w) for w in text[1].split()} | {("href", text[2])}


def style(node):
    return tuple(label(c) if c[0] else "#text" for c in node[2])


def has_text(node):
    return not node[0] or any(map(has_text, node[2]))


def plain_importances(pages):
    """Per page the importances of texts in order and of branches with text, parents first."""
    roots = [("root", "", [page]) for page in pages]
    found = {}

    def visit(node, path, page):
        for kind in [style(node)] if node[0] else features(node):
            found.setdefault(path, {}).setdefault(kind, set()).add(page)
        for child in node[2] if node[0] else ():
            if has_text(child):
                visit(child, path + (label(child) if child[0] else "#text",), page)

    for i, root in enumerate(roots):
        if has_text(root):
            visit(root, (), i)

    def score(node, path, leaves, branches):
        pages_with = len(set().union(*found[path].values()))
        sizes = [len(s) for s in found[path].values()]
        if not node[0]:
            novel = [1.0 if pages_with < RECUR_PAGES else 1 - math.log(len(found[path][f])) / math.log(pages_with) for f in features(node)]
            leaves.append(sum(novel) / len(novel))
            return leaves[-1]
        branches.append(None)
        place, total = len(branches) - 1, sum(sizes)
        entropy = 1.0 if pages_with < RECUR_PAGES else -sum(n / total * math.log(n / total) for n in sizes) / math.log(total)
        below = [score(c, path + (label(c) if c[0] else "#text",), leaves, branches) for c in node[2] if has_text(c)]
        passed = GAMMA ** len(sizes)
        branches[place] = (1 - passed) * entropy + passed * sum(below) / len(below)
        return branches[place]

    results = []
    for root in roots:
        leaves, branches = [], []
        if has_text(root):
            score(root, (), leaves, branches)
        results.append((leaves, branches))
    return results


def test_importances_equal_a_plain_recursion(spark):
    rng = random.Random(7)
    pages = [random_page(rng) for _ in range(40)]
    sources = [render(p) for p in pages]
    pages = [p for i, p in enumerate(pages) if sources[i] not in sources[:i]]
    # Copies of every page change nothing.
    rows = [(i, "http://site/", render(p)) for i, p in enumerate(pages)] * 3
    scores = {bytes(r.page): r.scores for r in html_extract.page_scores(spark.createDataFrame(rows, PAGES)).collect()}
    compared = 0
    for page, (leaves, branches) in zip(pages, plain_importances(pages), strict=True):
        source = render(page)
        found = scores.get(html_extract.digest_of(source), [])
        parsed = html_extract.Page(source)
        assert len(parsed.leaves) == len(leaves)
        if leaves:
            got_leaves, got_branches = parsed.importances([(s.number, s.flags, s.value, s.share) for s in found])
            assert [v for v, _ in got_leaves] == pytest.approx(leaves)
            assert [v for v, b in zip(got_branches, parsed.branches, strict=True) if b.filled] == pytest.approx(branches)
            compared += len(branches)
    assert compared > 200


def texts(spark, rows, **options):
    out = html_extract.extract_text(spark.createDataFrame(rows, PAGES), **options).collect()
    assert len(out) == len(rows)
    return {r.page_id: r.text for r in out}


def test_a_low_branch_goes_as_a_whole(spark):
    """The menu has a link of its own on each page, which no score of single blocks would take."""
    menu = '<div class="m"><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/t">Topics</a></li><li><a href="/u{0}">User{0}</a></li></ul></div>'
    page = menu + '<div class="t"><p>Story {0} told</p><p><a href="/s{0}">Source{0}</a></p></div>'
    got = texts(spark, [(i, "http://site/", page.format(i)) for i in range(9)])
    assert got == {i: f"Story {i} told Source{i}" for i in range(9)}


def test_important_prose_keeps_its_branch(spark):
    page = '<div class="m"><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/t">Topics</a></li></ul><p>Story {0}</p></div>'
    assert texts(spark, [(i, "http://site/", page.format(i)) for i in range(9)]) == {i: f"Story {i}" for i in range(9)}


def test_nothing_loses_all_text(spark):
    rows = [(0, "http://a/", '<body><div id="form"><p>The form of the sonnet.</p></div></body>')]
    rows += [(1 + i, "http://b/", f"<!-- {i} --><div><p>Always the same</p><p class=x{i}></p></div>") for i in range(5)]
    rows += [(10 + i, url, f"<p>Same words</p><p>and {i}</p>") for i in range(6) for url in [("", None, "rel/x")[i % 3]]]
    got = texts(spark, rows)
    assert got[0] == "The form of the sonnet."
    assert {got[1 + i] for i in range(5)} == {"Always the same"}
    assert [got[10 + i] for i in range(6)] == [f"Same words and {i}" for i in range(6)]


def test_markup_off(spark):
    """Without markup rules the tree alone tells the menu, the notice and the footer of a site from its stories."""
    page = (
        '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav><article><h1>Story {0}</h1><p>Told on day {0}</p>'
        "</article><div class=cookie>We use cookies</div><footer>Imprint of the site</footer>"
    )
    got = texts(spark, [(i, "http://site/", page.format(i)) for i in range(9)], markup=False)
    assert got == {i: f"Story {i} Told on day {i}" for i in range(9)}
