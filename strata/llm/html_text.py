"""Main text of web pages by composite text density.

A page is parsed into a tree. Scripts and the like are left out, and so are
menus, footers, forms, adverts, comments and other elements that by tag, or by
the words of a class, id or role, don't hold the article; where such an element
does hold it, density says so (see ``leave_out``). For every node the composite
density is its characters per tag, damped by the share of characters in links; a
node's density sum adds up those of its children, of its blocks that is, as
marked-up words are no parts of their own. The subtree with the largest sum is
the text's core. It widens to the article or main element that its densest part
lies in; or else it grows to its parents as long as these stay as dense as the
page's body, the threshold on the path to it, and what they add is not mostly
links; headings before it on that path are its own. Other articles beside it are parts of the text however short they are,
unless their headings are links or links are a quarter of them: these are
teasers. All text of what is chosen is returned.

Parsing is the only Python here: Spark deals the pages out, and a page is one
row's work.

Defined cases: a null, empty or unparsable page has the empty text. Repeated
rows are extracted each. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that hold no text of a page, and those that usually hold none of its main text.
SKIPPED = frozenset("script style noscript template head title annotation annotation-xml button select option textarea input iframe object embed canvas svg audio video map datalist".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math annotation mi mn mo ms mtext mrow mstyle msup msub msubsup mfrac msqrt mroot mover munder munderover semantics".split()
)
# A start tag of the one closes an open element of the others.
CLOSES = {
    **{t: frozenset({"p"}) for t in "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()},
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}),
    "th": frozenset({"td", "th", "p"}),
    "option": frozenset({"option"}),
}
# An end tag, or what a start tag closes, is looked for no further than these.
SCOPES = frozenset("article aside body blockquote details div dl fieldset figure footer form header html li main nav ol section table td th ul".split())
# Classes, ids and roles that say that an element isn't the article: these words, or some of them joined.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promos promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay sidebar sidebars side "
    "widget widgets related recommended share sharing social comment comments commentlist replies reply respond disqus nav navbar navigation menu menus breadcrumb breadcrumbs footer "
    "masthead topbar toolbar newsletter subscribe subscription signup login search pagination pager skip complementary contentinfo dialog".split()
)
# Words that say nothing beside one of those: "comments-area", "ad-container", "related-posts".
NEUTRAL = frozenset(
    "area areas box block bar body button buttons column container content footer global header holder inner item items left line link links list main module outer page panel "
    "post posts reader readers region right row section site slot text thread title top unit user users wrap wrapper zone bottom form group icon icons js".split()
)
# "header" is the page's only together with one of these; an article has one too.
PAGE_HEADERS = frozenset("site global top masthead".split())
# Readers' texts and consent texts can be longer than the article; length is no sign that they are it.
OTHERS = frozenset("comment comments commentlist replies reply respond disqus cookie cookies consent gdpr".split())
# What usually stands beside an article, not around it.
BESIDE = frozenset("nav footer aside menu".split())
BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promos promotion sidebar sidebars side widget widgets related recommended share sharing social "
    "nav navbar navigation menu menus breadcrumb breadcrumbs footer newsletter pagination pager complementary contentinfo".split()
)
AROUND, BESIDES = 1.0, 4.0  # so many times denser than all else has a doubtful element to be, to be the text
ROUNDS = 32  # doubtful elements that a page's text may be spread over or nested in
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset({"article", "main"})
HEART = 0.75  # of a node's density sum in one child: the child is its heart
LINKED = 0.25  # of an article's characters in links: a teaser


def noise_words(names: str) -> set[str]:
    """The NOISE words of those names that have no other words but NEUTRAL ones: "sidebar" and "comments-area", not "has-sidebar" or "no-comments"."""
    out: set[str] = set()
    for name in names.split():
        words = [w for w in re.split(r"[_-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]
        found = NOISE.intersection(words)
        if found - {"footer"} or words in (["footer"], ["site", "footer"], ["page", "footer"]):
            if NOISE.union(NEUTRAL).issuperset(words):
                out.update(found)
        elif "header" in words and PAGE_HEADERS.intersection(words) and PAGE_HEADERS.union(NEUTRAL).issuperset(words):
            out.add("masthead")
    return out


class _Tree(HTMLParser):
    """Nodes in page order, each with its parent, and text with the node that holds it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.skipped, self.main = ["#page"], [-1], [False], [False]
        # by tag or name not the article; of these, usually beside it; by name others' texts; a main element
        self.doubtful, self.beside, self.others, self.whole = [False], [False], [False], [False]
        self.pieces: list[tuple[int, str]] = []  # text, or "" where a block begins or ends
        self.open = [0]

    def _edge(self, tag: str) -> None:
        if tag not in INLINE:
            self.pieces.append((self.open[-1], ""))

    def _close(self, tags: frozenset, scopes: frozenset) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[depth]]
            if tag in tags:
                self._edge(tag)
                del self.open[depth:]
                return
            if tag in scopes:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES:
            for _ in CLOSES[tag]:
                self._close(CLOSES[tag], SCOPES - CLOSES[tag])
        self._edge(tag)
        node, parent = len(self.tags), self.open[-1]
        told = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden", "style")}
        names = f"{told.get('class', '')} {told.get('id', '')} {told.get('role', '')}"
        words = set() if tag in HEADINGS or tag in ("html", "body", "main") else noise_words(names)
        if tag == "article":
            words &= OTHERS
        hidden = "hidden" in told or told.get("aria-hidden") == "true" or "display:none" in told.get("style", "").replace(" ", "").lower()
        inside = self.main[parent]
        self.tags.append(tag)
        self.parents.append(parent)
        self.skipped.append(self.skipped[parent] or tag in SKIPPED or hidden)
        self.doubtful.append(tag in BOILERPLATE or bool(words) or (tag == "header" and not inside))
        self.beside.append(tag in BESIDE or not BESIDE_WORDS.isdisjoint(words))
        self.others.append(not OTHERS.isdisjoint(words))
        self.whole.append("main" in (tag, told.get("role")))
        self.main.append(inside or tag in MAIN or told.get("role") in MAIN)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math", "path"):
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._edge(tag)
        elif tag not in VOID:
            self._close(frozenset({tag}), frozenset() if tag in SCOPES else SCOPES)

    def handle_data(self, data: str) -> None:
        if not self.skipped[self.open[-1]]:
            self.pieces.append((self.open[-1], data))

    def unknown_decl(self, data: str) -> None:
        pass


def without_open_tag(html: str) -> str:
    """``html`` without a tag that the page breaks off in; a "<" that begins no tag is text."""
    at = html.find("<", html.rfind(">") + 1)
    while at >= 0:
        if html[at + 1 : at + 2].isalpha() or html[at + 1 : at + 2] in ("/", "!", "?"):
            return html[:at]
        at = html.find("<", at + 1)
    return html


def parse(html: str) -> _Tree:
    html = without_open_tag(html)
    tree = _Tree()
    try:
        tree.feed(html)
        tree.close()
    except AssertionError:
        # the parser gives up on a malformed declaration; read it as a comment
        tree = _Tree()
        tree.feed(re.sub(r"<!\[[^>]*>?", "", html))
        tree.close()
    leave_out(tree)
    return tree


def leave_out(tree: _Tree) -> None:
    """Skip the doubtful elements, but for those that hold the main text.

    These hold a main element; or articles, all of the page's if they are of the
    kind that stands beside the text. On a page without either, density decides:
    a doubtful element stays if its core is denser than that of all else, four
    times as dense if it is of that kind. Others' texts stay if they hold a main
    element or are all that the article or main element around them, or the page,
    has. If nothing is left, nothing doubtful is skipped.
    """
    n = len(tree.tags)
    never = tree.skipped
    plain, linked, outer = [0] * n, [False] * n, [0] * n  # outer: the outermost article or main element around a node
    for node in range(1, n):
        up = tree.parents[node]
        linked[node] = linked[up] or tree.tags[node] == "a"
        outer[node] = outer[up] or (node if tree.main[node] else 0)
    for node, text in tree.pieces:
        if not linked[node]:
            plain[node] += len("".join(text.split()))
    own = plain.copy()
    mains, articles = [0] * n, [0] * n
    for node in range(n - 1, 0, -1):
        if never[node]:
            continue
        if outer[node] == node and not tree.others[node]:
            articles[node] = plain[node]
        mains[node] += tree.whole[node] and plain[node] > 0
        for kind in (plain, mains, articles):
            kind[tree.parents[node]] += kind[node]
    others = never.copy()
    stays = [False] * n
    for node in range(1, n):
        up = tree.parents[node]
        if others[up]:
            others[node] = True
        elif never[node] or not tree.doubtful[node]:
            pass
        elif tree.others[node]:
            others[node] = not mains[node] and plain[node] < max(1, plain[outer[up]])
            stays[node] = not others[node]
        else:
            stays[node] = bool(mains[node]) or articles[node] > 0 and (not tree.beside[node] or articles[node] == articles[0])
    for _ in range(ROUNDS if not articles[0] and not mains[0] else 0):
        found = _densest_doubtful(tree, others, stays)
        if not found:
            break
        stays[found] = True
    skipped = others.copy()
    for node in range(1, n):
        skipped[node] = skipped[node] or skipped[tree.parents[node]] or tree.doubtful[node] and not stays[node]
    if any(own[k] and not skipped[k] for k in range(n)):
        tree.skipped = skipped
    elif plain[0] == 0:  # links at most
        tree.skipped = skipped


def _densest_doubtful(tree: _Tree, others: list[bool], stays: list[bool]) -> int:
    """The doubtful element whose core is dense enough, against all that isn't doubtful; 0 if there is none."""
    n = len(tree.tags)
    within, deep = [0] * n, others.copy()  # the doubtful element around a node; what lies in two of them is looked at later
    for node in range(1, n):
        up = tree.parents[node]
        doubtful = tree.doubtful[node] and not stays[node]
        within[node] = within[up] or (node if doubtful else 0)
        deep[node] = deep[node] or deep[up] or doubtful and within[up] > 0
    if not any(within):
        return 0
    # inside: each doubtful element as a page of its own; outside: the page without them
    inside, _, chars = densities(tree, deep, roots=within)
    outside, sums, left = densities(tree, [d or w > 0 for d, w in zip(deep, within, strict=True)])
    rest = max((max(sums[k], outside[k]) for k in range(n) if left[k] and tree.tags[k] not in INLINE), default=0.0)
    worth: dict[int, float] = {}
    sums = [0.0] * n
    for node in range(n - 1, 0, -1):
        if within[node] and not deep[node] and chars[node] and tree.tags[node] not in INLINE:
            worth[within[node]] = max(worth.get(within[node], 0.0), sums[node], inside[node])
            sums[tree.parents[node]] += inside[node]
    enough = {k: w for k, w in worth.items() if w > (BESIDES if tree.beside[k] else AROUND) * rest}
    return max(enough, key=lambda k: (enough[k], -k), default=0)


def densities(tree: _Tree, skipped: list[bool] | None = None, roots: list[int] | None = None) -> tuple[list[float], list[float], list[int]]:
    """Composite density and density sum of every node, and its characters.

    A page's share of links damps them; with ``roots`` that of each node's root counts.
    """
    n = len(tree.tags)
    skipped = tree.skipped if skipped is None else skipped
    chars, linked, tags, links = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in tree.pieces:
        if not skipped[node]:
            chars[node] += len("".join(text.split()))
    for node in range(n - 1, 0, -1):
        if skipped[node]:
            continue
        tags[node] += tree.tags[node] not in VOID
        if tree.tags[node] == "a":
            linked[node] = chars[node]
            links[node] += 1
        up = tree.parents[node]
        for kind in (chars, linked, tags, links):
            kind[up] += kind[node]
    density, sums = [0.0] * n, [0.0] * n
    for node in range(n - 1, -1, -1):
        root = roots[node] if roots else 0
        share = linked[root] / max(1, chars[root])
        # no link at all counts as one of one character, which keeps the base of the logarithm above 1
        c, lc, t, lt = chars[node], max(1, linked[node]), max(1, tags[node]), max(1, links[node])
        if c:
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            density[node] = c / t * max(0.0, math.log(c / lc * t / lt, base))
        if node and tree.tags[node] not in INLINE:
            sums[tree.parents[node]] += density[node]
    return density, sums, chars


def grown(tree: _Tree, density: list[float], sums: list[float], chars: list[int]) -> tuple[int, int]:
    """The node whose subtree is the main text, and the densest node that led there."""
    nodes = [k for k in range(len(tree.tags)) if not tree.skipped[k] and chars[k] and tree.tags[k] not in INLINE]
    if not nodes:
        return 0, 0
    linked = _linked(tree)
    # a node without blocks that hold text stands by itself
    worth = [max(sums[k], density[k]) for k in range(len(sums))]
    best = max(nodes, key=lambda k: (worth[k], -k))
    densest: dict[int, int] = {}
    for k in nodes[1:]:
        up = tree.parents[k]
        if up not in densest or density[k] > density[densest[up]]:
            densest[up] = k
    heart = best
    while heart in densest and density[densest[heart]] >= HEART * sums[heart] > 0:
        heart = densest[heart]
    path = [heart]
    while tree.parents[path[-1]] >= 0:
        path.append(tree.parents[path[-1]])
    if tree.main[heart]:
        return [k for k in path if tree.main[k]][-1], heart
    body = next((k for k in path if tree.tags[k] in ("body", "html", "#page")), path[-1])
    for up in path[path.index(best) + 1 :]:
        # below the page's body, while a parent is as dense as that and what it adds is no list of links
        added = chars[up] - chars[best]
        if up == body or added and (density[up] < density[body] or linked[up] - linked[best] >= LINKED * added):
            break
        best = up
    return best, heart


def _linked(tree: _Tree) -> list[int]:
    """Characters in links, of every node."""
    n = len(tree.tags)
    inside, linked = [False] * n, [0] * n
    for node in range(1, n):
        inside[node] = inside[tree.parents[node]] or tree.tags[node] == "a"
    for node, text in tree.pieces:
        if inside[node] and not tree.skipped[node]:
            linked[node] += len("".join(text.split()))
    for node in range(n - 1, 0, -1):
        linked[tree.parents[node]] += linked[node]
    return linked


def core(tree: _Tree) -> int:
    """The node whose subtree is the main text."""
    return grown(tree, *densities(tree))[0]


def chosen(tree: _Tree) -> list[bool]:
    """Whether a node is in the main text: in the core, in a heading before it on the path to the body, or in an article beside it that is no teaser.

    An article that growing has met and that is a teaser is not in it.
    """
    density, sums, chars = densities(tree)
    top, heart = grown(tree, density, sums, chars)
    n = len(tree.tags)
    linked, around, titles = _linked(tree), {top}, [0] * n  # titles: headings that are links
    for node in range(1, n):
        pair = {tree.tags[node], tree.tags[tree.parents[node]]}
        titles[node] = "a" in pair and not HEADINGS.isdisjoint(pair)
    for node in range(n - 1, 0, -1):
        titles[tree.parents[node]] += titles[node]
    up = heart
    while up >= 0:
        around.add(up)
        up = tree.parents[up]
    within = [False] * n
    within[top] = True
    for node in range(1, n):
        up = tree.parents[node]
        before = node < top and up in around and tree.tags[node] in HEADINGS and not titles[node] and linked[node] < LINKED * chars[node]
        within[node] = node == top or within[up] or before
        if tree.main[node] and not tree.main[up] and node not in around:
            teaser = bool(titles[node]) or linked[node] >= LINKED * chars[node]
            within[node] = not teaser and (within[up] or tree.main[heart])
    return within


def main_text(html: str | None) -> str:
    if not html:
        return ""
    tree = parse(html)
    within = chosen(tree)
    return " ".join("".join(text or " " for node, text in tree.pieces if within[node] and not tree.skipped[node]).split())


def extract(pages: DataFrame) -> DataFrame:
    """pages with the columns text and n_chars (its code points) added."""

    @F.pandas_udf("string")
    def of(htmls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in htmls:
            yield batch.map(main_text, na_action=None)

    return pages.withColumn("text", of("html")).withColumn("n_chars", F.length("text").cast("long"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
