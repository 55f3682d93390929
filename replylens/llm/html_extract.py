"""Main text of web pages by site style trees.

The DOMs of the pages of a host are merged into a tree. A branch is a block element, known by its path of
tags and classes; its style is the sequence of its children. A leaf is a block of text. Features of a
leaf are its whole text, or, if it is mostly links, its words and link targets, because menus choose from
the same few on every page. Over the pages of a host that have a branch or leaf,

    importance of a leaf          mean over its features of 1 - ln(pages with it) / ln(pages)
    presentation of a branch      entropy of its styles, in units of ln(pages)
    importance of a branch        (1 - GAMMA^styles) * presentation + GAMMA^styles * mean of its children

so what a site repeats on its pages is unimportant, and what one page has alone is important; what fewer
than `RECUR_PAGES` pages have is important. The last line is taken bottom-up on each page, for the style
that the branch has there, from the figures of the merged tree. Pages of a host with the same tree are
copies and count as one page.

From each page, the highest branches below `LEAST` go as a whole, unless they hold prose (a leaf that is not
mostly links) that is important; leaves below `LEAST` go by themselves. What would remove all text of a
page removes nothing.

Markup that says what a branch is overrules the numbers: menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts and the like go, and where a page has an article or main element, its
blocks stay, however often a passage is repeated, and others go. Names count on containers only, never on
headings, paragraphs or inline elements, and only if all words of a class or id tell the same
(`cookie-notice`, but not `form-validation`). Names that would take all text of a page count for nothing
there. In an article or main element ids say nothing, and a class removes a branch by itself only if it is
one of `CERTAIN`; branches of the other names go where the tree finds them unimportant, too.

In an article or main element the tree also takes branches without such a name that are mostly links, such
as menus, linked adverts and sidebars: they go if they are unimportant and their features are on half of the
pages, on average. Headings and prose stay, because a passage that articles repeat cannot be told from
their text. `markup=False` leaves everything but scripts, styles and the like to the tree.

The pages are parsed twice, once for the tree and once for the text, which costs less than moving texts.
A page's tree is one row of hashes; figures are sent back only to pages where the tree may remove something.
Counts combine before they are shuffled, so a host with a third of all pages is no task of its own.

Text: character references decoded, white space inside a block turned into one space, blocks joined
by one space. Defined cases: null html and pages without content give an empty text; pages without a
host (null, empty or relative url) have no tree, only markup; unclosed, crossed and cut-off elements are closed where HTML would; repeated rows
give repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replylens.session import cut_lineage

GAMMA, LEAST = 0.9, 0.4
RECUR_PAGES = 3
# What the tree may do with a block: nothing, remove it if it is low, or only if it recurs on most pages, too.
CLOSED, OPEN, RECURRING = 0, 1, 2
# Flags of a page's node: a branch's style (else a leaf's feature), the first of its path, the first of its kind there.
STYLE, FIRST_PATH, FIRST_FEATURE = 1, 2, 4

# How HTML elements behave, and words that tell what a branch is.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
NOT_TEXT = RAW | frozenset("head svg math canvas audio video object select option button input datalist map".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog".split()) | NOT_TEXT
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead footer comment comments disqus replies respond share sharing social related "
    "recommended login signup search pagination pager toolbar widget skip form".split()
)
# Names that remove a branch of an article without the tree, and words that only place a name.
CERTAIN = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies gdpr sidebar nav navbar "
    "breadcrumb breadcrumbs comment comments disqus replies share sharing newsletter pagination pager".split()
)
PLACES = frozenset("site top bottom left right global".split())
ARTICLE_NOISE = frozenset("comment comments reply ad sponsored".split())
NAMED = frozenset("div section ul ol li dl table tr td details center header hgroup figure fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - {"br", "body", "html"}
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
TAG = re.compile(
    r"<(?:!--(?:.*?-->|.*)|[!?][^>]*>?|(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>|[^>]*>?))",
    re.DOTALL,
)
# Whole attributes, so that neither the end of a name nor the inside of a value is taken for one.
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
NAME_PARTS = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")


def tells(name: str, words: frozenset) -> bool:
    """Whether a class or id consists of `words`, and words that place them."""
    parts = {part.lower() for part in NAME_PARTS.split(name) if part}
    return not parts.isdisjoint(words) and parts <= words | PLACES


def short_hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class Branch:
    """A block element of the style tree."""

    __slots__ = ("label", "path", "parent", "labels", "filled")

    def __init__(self, label: str, parent: Branch | None):
        self.label, self.parent = label, parent
        self.path = 0
        self.labels: list[str] = []
        self.filled = False

    def style(self) -> int:
        return short_hash(f"{self.path} > " + " ".join(self.labels))


class Element:
    """An open element of a page; inline elements belong to the branch around them."""

    __slots__ = ("tag", "noise", "main", "doubtful", "linked", "heading", "branch")

    def __init__(self, tag, noise, main, doubtful, branch, parent):
        self.tag, self.noise, self.main, self.doubtful, self.branch = tag, noise, main, doubtful, branch
        self.linked = tag == "a" or (parent is not None and parent.linked)
        self.heading = tag in HEADINGS or (parent is not None and parent.heading)


class Leaf:
    """A block of text and what the tree may do with it."""

    __slots__ = ("branch", "main", "text", "targets", "links", "may")

    def __init__(self, owner: Element, text: str, links: bool, targets: list):
        self.branch, self.main, self.text, self.links, self.targets = owner.branch, owner.main, text, links, targets
        # Without an article or main element all blocks are the tree's.
        self.may = OPEN if owner.doubtful else RECURRING if links and not owner.heading else CLOSED

    def features(self) -> set:
        return {*self.text.split(), *(f"href {t}" for t in self.targets)} if self.links else {f"text {self.text}"}


class Page:
    """Leaves of a page in order and its branches, parents first. Noise is left out."""

    def __init__(self, source: str, markup: bool = True):
        self.source, self.markup = source, markup
        self.named = False  # whether a name removed something
        self.start()
        if self.named and not self.leaves:
            self.start(names=False)

    def start(self, names: bool = True):
        self.names = names
        self.leaves: list[Leaf] = []
        root = Branch("", None)
        self.branches = [root]
        self.stack = [Element("", False, False, False, root, None)]
        self.places: dict[str, list[int]] = {}  # of the open elements of a tag on the stack
        self.text: list[str] = []
        self.targets: list[str] = []
        self.linked = 0
        self.owner = self.stack[0]
        self.parse()
        has_main = any(leaf.main for leaf in self.leaves)
        for leaf in self.leaves:
            if not has_main:
                leaf.may = OPEN
            elif not leaf.main:
                leaf.may = CLOSED

    def parse(self):
        source, at, end = self.source, 0, len(self.source)
        while at < end:
            tag = TAG.search(source, at)
            self.add_text(source[at : tag.start() if tag else end])
            if not tag:
                break
            at = tag.end()
            name = tag[2]
            if not name:
                continue
            name = name.lower()
            if tag[1]:
                self.close(name)
            else:
                self.open(name, tag[3])
                if name in RAW and not tag[3].endswith("/>"):
                    closing = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(source, at)
                    at = closing.start() if closing else end
        self.flush()

    def add_text(self, text: str):
        if text and not self.stack[-1].noise:
            if not self.text:
                self.owner = self.stack[-1]
            self.text.append(entities.unescape(text) if "&" in text else text)
            if self.stack[-1].linked:
                self.linked += sum(map(len, self.text[-1].split()))

    def flush(self):
        """End the current block."""
        words, linked, targets = "".join(self.text).split(), self.linked, self.targets
        self.text, self.linked, self.targets = [], 0, []
        if words:
            self.leaves.append(Leaf(self.owner, " ".join(words), 2 * linked > sum(map(len, words)), targets))
            branch = self.owner.branch
            branch.labels.append("#text")
            while branch and not branch.filled:
                branch.filled, branch = True, branch.parent

    def open(self, tag: str, rest: str):
        if tag in BLOCK:
            self.flush()
        if tag in ("article", "main"):
            self.close("nav")
        if tag in CLOSES_P:
            self.close("p", within=("table", "td", "th", "li", "article", "section", "div", "blockquote", "body"))
        if tag in SIBLINGS:
            for sibling in SIBLINGS[tag]:
                self.close(sibling, within=HOLDS[tag])
        parent = self.stack[-1]
        classes, ids, role, is_body, target = self.names_of(rest)
        label = ".".join([tag, *classes, *ids])
        if tag in BLOCK:
            parent.branch.labels.append(label)
        if tag in VOID:
            return
        noise = parent.noise or tag in (BOILERPLATE if self.markup else NOT_TEXT)
        doubtful = parent.doubtful
        main = False
        if self.markup:
            noise = noise or role in ROLES or (tag == "header" and not parent.main)
            named = False
            if noise or not self.names:
                pass
            elif tag == "article":
                named = any(tells(name, ARTICLE_NOISE) for name in classes + ids)
            elif tag in NAMED and parent.main:
                named = any(tells(name, CERTAIN) for name in classes)
                doubtful = doubtful or any(tells(name, NAMES) for name in classes)
            elif tag in NAMED:
                named = any(tells(name, NAMES) for name in classes + ids)
            self.named = self.named or named
            noise = noise or named
            main = not noise and (parent.main or tag in ("article", "main") or role in ("main", "article") or is_body)
        branch = parent.branch
        if tag in BLOCK and not noise:
            branch = Branch(label, branch)
            self.branches.append(branch)
        if tag == "a" and target and not noise:
            self.targets.append(target)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(Element(tag, noise, main, doubtful, branch, parent))

    def names_of(self, rest: str):
        classes, ids, role, is_body, target = [], [], "", False, ""
        if "=" in rest:
            for m in ATTRIBUTE.finditer(rest):
                value = m[2] or m[3] or m[4] or ""
                kind = m[1].lower()
                if kind == "role":
                    role = value.strip().lower()
                elif kind == "itemprop":
                    is_body = value.strip() == "articleBody"
                elif kind == "class":
                    classes += value.split()
                elif kind == "id":
                    ids += value.split()
                elif kind == "href":
                    target = value.strip()
        return classes, ids, role, is_body, target

    def close(self, tag: str, within=()):
        """Close the nearest open `tag` and what is open in it; a tag in `within` stops the search."""
        open_ = self.places.get(tag)
        if not open_ or any(self.places.get(w) and self.places[w][-1] > open_[-1] for w in within):
            return
        at = open_[-1]
        if tag in BLOCK or any(e.tag in BLOCK for e in self.stack[at:]):
            self.flush()
        for element in self.stack[at:]:
            self.places[element.tag].pop()
        del self.stack[at:]

    def tree_rows(self):
        """(number, path, feature, flags) of the leaves' features; see the flags above."""
        self._hash_paths()
        # Leaves have a path of their own below their branch.
        return self._flagged(
            ((i, leaf.branch.path ^ 1, short_hash(f)) for i, leaf in enumerate(self.leaves) for f in sorted(leaf.features())), 0
        )

    def branch_rows(self):
        """The same of the styles of the branches that hold text."""
        self._hash_paths()
        return self._flagged(((i, b.path, b.style()) for i, b in enumerate(self.branches) if b.filled), STYLE)

    def _hash_paths(self):
        """Paths are running hashes, so that depth costs nothing. Only the merged tree needs them."""
        for branch in self.branches[1:]:
            if branch.filled and not branch.path:
                branch.path = short_hash(f"{branch.parent.path}/{branch.label}")

    @staticmethod
    def _flagged(nodes, flags: int):
        seen = set()
        for number, path, feature in nodes:
            first = (path not in seen) * FIRST_PATH + ((path, feature) not in seen) * FIRST_FEATURE
            seen |= {path, (path, feature)}
            yield number, path, feature, flags + first

    def importances(self, scores) -> tuple[list, list]:
        """Importances of the leaves and of the branches, from (number, flags, value, share) of the merged tree."""
        leaves = [[0.0, 0.0, 0] for _ in self.leaves]
        own = [(1.0, 0.0)] * len(self.branches)
        for number, flags, value, share in scores:
            if flags & STYLE:
                own[number] = (value, share)
            else:
                leaf = leaves[number]
                leaf[0], leaf[1], leaf[2] = leaf[0] + value, leaf[1] + share, leaf[2] + 1
        leaves = [(value / n, share / n) if n else (1.0, 0.0) for value, share, n in leaves]
        below: dict[int, list] = {}  # of a branch: sum and number of its children's importances
        places = {id(branch): i for i, branch in enumerate(self.branches)}

        def add(branch, importance):
            total = below.setdefault(places[id(branch)], [0.0, 0])
            total[0], total[1] = total[0] + importance, total[1] + 1

        for leaf, (importance, _) in zip(self.leaves, leaves, strict=True):
            add(leaf.branch, importance)
        branches = [1.0] * len(self.branches)
        for i in range(len(self.branches) - 1, -1, -1):
            if i in below:
                value, share = own[i]
                branches[i] = value + share * below[i][0] / below[i][1]
                if self.branches[i].parent:
                    add(self.branches[i].parent, branches[i])
        return leaves, branches

    def low(self, scores, least: float) -> set:
        """Numbers of the leaves that go, with the highest unimportant branch above them or by themselves."""
        leaves, branches = self.importances(scores)
        places = {id(branch): i for i, branch in enumerate(self.branches)}
        # Of the leaves below a branch: number, sum of shares, whether one recurs only, whether one must stay.
        sums = [[0, 0.0, False, False] for _ in self.branches]
        for leaf, (importance, share) in zip(self.leaves, leaves, strict=True):
            stays = leaf.may == CLOSED or (not leaf.links and importance >= least)
            self._sum(sums[places[id(leaf.branch)]], (1, share, leaf.may == RECURRING, stays))
        for i in range(len(self.branches) - 1, 0, -1):
            self._sum(sums[places[id(self.branches[i].parent)]], sums[i])
        goes = [False] * len(self.branches)
        for i, branch in enumerate(self.branches):
            n, shares, recurring, stays = sums[i]
            goes[i] = branch.parent is not None and goes[places[id(branch.parent)]]
            if n and branches[i] < least and not stays and (not recurring or 2 * shares >= n):
                goes[i] = True
        found = set()
        for i, (leaf, (importance, share)) in enumerate(zip(self.leaves, leaves, strict=True)):
            alone = leaf.may != CLOSED and importance < least and (leaf.may == OPEN or 2 * share >= 1)
            if alone or goes[places[id(leaf.branch)]]:
                found.add(i)
        return found

    @staticmethod
    def _sum(total, part):
        total[0], total[1] = total[0] + part[0], total[1] + part[1]
        total[2], total[3] = total[2] or part[2], total[3] or part[3]

    def kept(self, scores=None, least: float = LEAST) -> str:
        """The text without the branches that `scores` of the merged tree make unimportant."""
        has_main = any(leaf.main for leaf in self.leaves)
        read = [i for i, leaf in enumerate(self.leaves) if leaf.main or not has_main]
        low = self.low(scores, least) if scores is not None else set()
        return " ".join(self.leaves[i].text for i in [i for i in read if i not in low] or read)


def host_of(url: str | None) -> str:
    found = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\s]*)", url or "")
    return found[1].lower() if found else ""


def digest_of(source: str) -> bytes:
    return hashlib.blake2b(source.encode("utf-8", "surrogatepass"), digest_size=16).digest()


TREE = "host string, page binary, body binary, open boolean, numbers array<int>, paths array<long>, features array<long>, flags array<int>"


def tree_rows(pages: DataFrame, markup: bool = True) -> DataFrame:
    """One row per page: its host, digests of its source and of its tree, whether the tree may remove something, and its nodes."""

    def run(batches):
        import pyarrow as pa

        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        schema = pa.schema(
            [("host", pa.string()), ("page", pa.binary()), ("body", pa.binary()), ("open", pa.bool_())]
            + [("numbers", ints), ("paths", longs), ("features", longs), ("flags", ints)]
        )
        for batch in batches:
            rows = []
            for url, source in zip(batch.column(0), batch.column(1), strict=True):
                source = source.as_py() or ""
                page = Page(source, markup)
                nodes = list(zip(*page.tree_rows(), *page.branch_rows(), strict=True)) or [()] * 4
                may = [leaf.may for leaf in page.leaves]
                host = host_of(url.as_py())
                open_ = host != "" and any(m != CLOSED for m in may)
                rows.append((host, digest_of(source), digest_of(repr((nodes, may))), open_, *nodes))
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return pages.select("url", "html").mapInArrow(run, TREE)


def _nodes(trees: DataFrame) -> DataFrame:
    node = F.explode(F.arrays_zip("numbers", "paths", "features", "flags")).alias("node")
    return trees.select("host", "body", node).select("host", "body", *[F.col(f"node.{n}").alias(n) for n in ("numbers", "paths", "features", "flags")])


def merged_tree(distinct: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """(host, paths, features, value, share) of all nodes of `distinct` trees.

    Of a feature of a leaf: its importance and the share of the pages that have it. Of a style of a branch:
    the part of the branch's importance that is its own, and the factor of its children's mean.
    """
    has = lambda flag: F.col("flags").bitwiseAND(flag) > 0
    ones = lambda flag: F.sum(F.when(has(flag), F.lit(1)).otherwise(0).cast("long"))
    counts = (
        _nodes(distinct)
        .groupBy("host", "paths", "features")
        .agg(ones(FIRST_FEATURE).alias("n"), ones(FIRST_PATH).alias("first"), F.max(has(STYLE)).alias("style"))
    )
    of_path = counts.groupBy("host", "paths").agg(
        F.sum("first").alias("pages"), F.sum("n").alias("total"), F.sum(F.col("n") * F.log("n")).alias("n_log_n"), F.count("*").alias("styles")
    )
    few = F.col("pages") < RECUR_PAGES
    entropy = (F.log("total") - F.col("n_log_n") / F.col("total")) / F.log("total")
    passed = F.pow(F.lit(gamma), F.col("styles"))
    novel = F.when(few, 1.0).otherwise(1 - F.log("n") / F.log("pages"))
    return counts.join(of_path, ["host", "paths"]).select(
        "host", "paths", "features",
        F.when(F.col("style"), (1 - passed) * F.when(few, 1.0).otherwise(entropy)).otherwise(novel).alias("value"),
        F.when(F.col("style"), passed).otherwise(F.col("n") / F.col("pages")).alias("share"),
    )


def importances(trees: DataFrame) -> DataFrame:
    """(host, page, number, novel): the importance of every block of text, to look into a site's tree."""
    distinct = trees.dropDuplicates(["host", "body"])
    leaves = _nodes(distinct).filter(F.col("flags").bitwiseAND(STYLE) == 0)
    scored = leaves.join(merged_tree(distinct), ["host", "paths", "features"])
    blocks = scored.groupBy("host", "body", F.col("numbers").alias("number")).agg(F.avg("value").alias("novel"))
    return blocks.join(trees.select("host", "body", "page").distinct(), ["host", "body"]).drop("body")


def page_scores(pages: DataFrame, gamma: float = GAMMA, markup: bool = True) -> DataFrame:
    """(host, page, scores) of the pages where the tree may remove something."""
    trees = cut_lineage(tree_rows(pages, markup))
    # Pages with the same tree count once, so that copies do not make their own text look repeated.
    distinct = cut_lineage(trees.filter("host <> ''").drop("page").dropDuplicates(["host", "body"]))
    open_nodes = _nodes(distinct.filter("open"))
    score = F.struct(F.col("numbers").alias("number"), "flags", "value", "share")
    scores = (
        open_nodes.join(merged_tree(distinct, gamma), ["host", "paths", "features"])
        .groupBy("host", "body")
        .agg(F.collect_list(score).alias("scores"))  # as many as the page has nodes
    )
    return trees.filter("open").select("host", "page", "body").distinct().join(scores, ["host", "body"]).drop("body")


def extract_text(pages: DataFrame, least: float = LEAST, gamma: float = GAMMA, markup: bool = True) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`."""

    @F.pandas_udf("host string, page binary")
    def keys(url, source):
        import pandas as pd

        return pd.DataFrame({"host": [host_of(u) for u in url], "page": [digest_of(s or "") for s in source]})

    @F.pandas_udf("string")
    def text_of(source, scores):
        import pandas as pd

        def one(html, found):
            found = None if found is None else [(s["number"], s["flags"], s["value"], s["share"]) for s in found]
            return Page(html or "", markup).kept(found, least)

        return pd.Series([one(s, n) for s, n in zip(source, scores, strict=True)])

    scores = cut_lineage(page_scores(pages, gamma, markup)).select(F.struct("host", "page").alias("key"), "scores")
    keyed = pages.select("page_id", "url", "html", keys("url", "html").alias("key"))
    # Spark broadcasts the scores only if their written size is under its threshold.
    joined = keyed.join(scores, "key", "left")
    return joined.select("page_id", "url", text_of("html", "scores").alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
