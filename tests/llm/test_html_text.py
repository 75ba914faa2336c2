import html as entities
import re

import pytest
from pyspark.sql import functions as F

from strata.llm.html_text import core, densities, extract, main_text, parse

PARAGRAPH = "This is a long enough sentence of the article, with commas and words. " * 3


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{body}</body></html>"


CASES = [
    (None, ""),
    ("", ""),
    ("plain  text\nonly", "plain text only"),
    (page("<nav><a href=x>menu</a></nav><article><h1>Head</h1><p>One &amp; two&nbsp;three<br>four</p></article><footer>f</footer>"), "Head One & two three four"),
    (page("<header><a>logo</a></header><main><p>a<b>b</b>c</p><aside>side</aside><form>f<input></form></main><div id=comments><p>nice</p></div>"), "abc"),
    (page("<article><p>x</p><section class='comments'><article class=comment>reader</article></section></article>"), "x"),
    (page("<article><p><b>one<br><p>two</p></article><div class='ad'>buy</div>"), "one two"),
    (page(f"<div id=wrap><div class=menu><ul><li><a>m</a></ul></div><div class=text><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div><div class='cookie-notice'>ok?</div></div>"), f"{PARAGRAPH}{PARAGRAPH}".strip()),
    (page("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><pre>x\n  y</pre></article>"), "one two a b x y"),
    (page("<article><p>a &lt;b&gt; &#233; &#x41; &am &amp</p><!-- no --><noscript>n</noscript></article>"), "a <b> é A &am &"),
    ("<div>" * 5000 + "deep", "deep"),
    ("<![foo<p>x</p>", "x"),
    ("<article>" + "w " * 100_000, ("w " * 100_000).strip()),
    ("<p>unclosed <a href='x", "unclosed"),
    ("<p>1 < 2 and 3 <4", "1 < 2 and 3 <4"),
]


@pytest.mark.parametrize(("html", "expected"), CASES)
def test_main_text(html, expected):
    assert main_text(html) == expected


TEXT = f"Head {PARAGRAPH}{PARAGRAPH}".strip()
BLOCKS = f"<h1>Head</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>"
MENU = "<nav><ul><li><a href=1>one</a><li><a href=2>two</a></ul></nav>"


@pytest.mark.parametrize(
    "body",
    [
        f"<form action=x>{MENU}<div>{BLOCKS}</div><input></form>",
        f"<form action=x>{MENU}<article>{BLOCKS}</article></form>",
        f"{MENU}<main><form>{BLOCKS}</form></main>",
        f"{MENU}<article class='post has-sidebar'>{BLOCKS}</article>",
        f"{MENU}<article class='notice'>{BLOCKS}</article>",
        f"{MENU}<main class='search'>{BLOCKS}</main>",
        f"{MENU}<div class='overlay'><main>{BLOCKS}</main></div><div class=sidebar>beside</div>",
        f"{MENU}<div id='content' class='with-sidebar'>{BLOCKS}</div>",
        f"{MENU}<div class='no-comments'>{BLOCKS}</div><div class=sidebar>beside</div>",
        f"{MENU}<div class='sidebar'>{BLOCKS}</div>",
        f"{MENU}<div id='comments'>{BLOCKS}</div>",
    ],
)
def test_elements_that_hold_the_text_stay(body):
    assert main_text(page(body)) == TEXT


@pytest.mark.parametrize("part", ["<section id='related-work'>{}</section>", "<section id='social-impact'>{}</section>", "<div class='ads-free has-widgets'>{}</div>"])
def test_parts_of_the_article_stay(part):
    assert main_text(page(f"<article>{BLOCKS}{part.format('<h2 id=search>Search</h2><p>more of it</p>')}</article>")) == f"{TEXT} Search more of it"


def test_formulas_stay():
    formula = "<math><semantics><mrow><mi>a</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding='application/x-tex'>a=1</annotation></semantics></math>"
    assert main_text(page(f"<article><p>so {formula}, and on</p></article>")) == "so a=1, and on"


def test_long_comments_and_consent_are_not_the_text():
    others = f"<div id=comments><p>{PARAGRAPH * 9}</p></div><div class=cookie-consent>{PARAGRAPH * 9}</div>"
    assert main_text(page(f"{MENU}<div id=content>{BLOCKS}</div>{others}")) == TEXT


TEASER = "<article class=teaser><h3><a href=3>Read next</a></h3><p>A short teaser.</p></article>"


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        (f"{MENU}<div id=content>{BLOCKS}</div>{TEASER}", TEXT),
        (f"{MENU}{TEASER * 12}<div id=content>{BLOCKS}</div>", TEXT),
        (f"{MENU}<div id=content>{BLOCKS}</div><div class=cards>{TEASER * 3}</div>", TEXT),
        (f"{MENU}<div id=content>{PARAGRAPH}<br>{PARAGRAPH}</div>{TEASER}", f"{PARAGRAPH}{PARAGRAPH}".strip()),
        (f"{MENU}<article>{BLOCKS}</article>{TEASER}", TEXT),
        (f"{MENU}<article>{BLOCKS}</article><article><h2>Two</h2><p>{PARAGRAPH}</p></article>", f"{TEXT} Two {PARAGRAPH}".strip()),
        (f"{MENU}<div><article>{PARAGRAPH * 9}</article></div><div><article>{BLOCKS}</article></div>{TEASER}", f"{PARAGRAPH * 9}{TEXT}"),
        (f"{MENU}<main><article>{BLOCKS}</article><article><p>{PARAGRAPH}</p></article></main>", f"{TEXT} {PARAGRAPH}".strip()),
    ],
)
def test_density_decides_and_articles_widen(body, expected):
    assert main_text(page(body)) == expected


def test_density_prefers_text_over_links():
    tree = parse(page(f"<div class=x><a href=1>{'word ' * 20}</a><a href=2>{'word ' * 20}</a></div><div class=y><p>{'word ' * 40}</p></div>"))
    density, sums, chars = densities(tree)
    by = {tree.tags[k]: density[k] for k in range(len(density)) if chars[k]}
    assert by["p"] > by["a"]
    assert tree.tags[core(tree)] in ("div", "p")


def test_whole_table_equals_the_article_of_each_page(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in extract(rows).collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        plain = re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", article))
        assert r.text == " ".join(entities.unescape(plain).split())
        assert r.n_chars == len(r.text)


def test_rows_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "<p>x</p>")], "page_id long, html string").withColumn("tags", F.lit("clash"))
    assert sorted(((r.page_id, r.text, r.n_chars) for r in extract(df).collect()), key=str) == [(1, "", 0), (1, "", 0), (None, "x", 1)]
    assert extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["comments-area", "user-comments", "post-comments", "commentsSection", "comment_list"])
def test_readers_texts_with_compound_names_go(name):
    readers = f"<div class='{name}'><p>{PARAGRAPH * 2}</p><p>{PARAGRAPH * 2}</p></div>"
    assert main_text(page(f"{MENU}<article>{BLOCKS}{readers}</article>")) == TEXT
    assert main_text(page(f"{MENU}<div id=content>{BLOCKS}</div>{readers}")) == TEXT
    assert main_text(page(f"{MENU}<div id=content>{BLOCKS}{readers}</div>")) == TEXT


@pytest.mark.parametrize("name", ["ad-container", "related-posts", "share-buttons", "sidebar-right", "cookie-box", "newsletter-form", "ad_slot", "social-links", "site-header", "promo-banner"])
def test_other_compound_names_go(name):
    assert main_text(page(f"{MENU}<article>{BLOCKS}<div class='x {name}'><p>something else</p></div></article>")) == TEXT


@pytest.mark.parametrize("name", ["has-sidebar", "no-comments", "with-widgets", "ad-free", "related-work", "social-impact", "comment-free-zone", "content", "post-content", "main", "entry-header", "article-footer-note"])
def test_names_that_only_mention_such_words_stay(name):
    assert main_text(page(f"{MENU}<article>{BLOCKS}<div class='{name}'><p>more of it</p></div></article>")) == f"{TEXT} more of it"
    assert main_text(page(f"{MENU}<div class='{name}'>{BLOCKS}</div>")) == TEXT


def test_a_short_article_beside_a_long_one_stays():
    assert main_text(page(f"<article>{BLOCKS}</article><article><h2>Note</h2><p>Paid work.</p></article>")) == f"{TEXT} Note Paid work."
    assert main_text(page(f"<form><article><p>First, short.</p></article></form><article>{BLOCKS}</article>")) == f"First, short. {TEXT}"


def test_a_long_sidebar_is_no_text_and_a_form_around_the_text_is():
    side = f"<div class=sidebar><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>"
    assert main_text(page(f"{MENU}<div id=content>{BLOCKS}</div>{side}")) == TEXT
    assert main_text(page(f"{MENU}<article><p>Short.</p></article>{side}")) == "Short."
    assert main_text(page(f"<form>{MENU}<div>{BLOCKS}</div>{side}</form><div>Imprint and so on</div>")) == TEXT


def test_a_heading_before_the_text_belongs_to_it():
    assert main_text(page(f"{MENU}<h1>Head</h1><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div><div>Imprint and so on</div>")) == TEXT
    assert main_text(page(f"<div><h2><a href=1>Other</a></h2></div><h1>Head</h1><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>")) == TEXT


def test_a_first_paragraph_of_marked_up_words_belongs_to_the_text():
    start = "<h1>LOOK!! HERE!!</h1><p><b>" + "BUY!! NOW!! " * 90 + "</b></p>"
    assert main_text(page(f"{MENU}<div>{start}<p>And then a quiet end.</p></div>")).startswith("LOOK!! HERE!! BUY!!")


def test_articles_renamed_to_divs_give_the_same_text(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        assert main_text(re.sub(r"(</?)article\b", r"\1div", r.html)) == main_text(r.html)


def slow_densities(tree):
    """Every node's own walk over its subtree."""
    from strata.llm.html_text import INLINE, VOID

    n = len(tree.tags)
    children = [[k for k in range(n) if tree.parents[k] == node and not tree.skipped[k]] for node in range(n)]

    def subtree(node):
        out = [node]
        for k in children[node]:
            out += subtree(k)
        return out

    def counts(node):
        inside = set(subtree(node))
        links = {k for a in inside if tree.tags[a] == "a" for k in subtree(a)}
        c, lc = (sum(len("".join(t.split())) for k, t in tree.pieces if k in which and not tree.skipped[k]) for which in (inside, links))
        return c, sum(tree.tags[k] not in VOID for k in inside if k), lc, sum(tree.tags[k] == "a" for k in inside)

    import math

    all_c, _, all_lc, _ = counts(0)
    density = []
    for node in range(n):
        c, t, lc, lt = counts(node)
        lc, t, lt = max(1, lc), max(1, t), max(1, lt)
        if tree.skipped[node] or not c:
            density.append(0.0)
        else:
            base = math.log(c / max(1, c - lc) * lc + all_lc / max(1, all_c) * c + math.e)
            density.append(c / t * max(0.0, math.log(c / lc * t / lt, base)))
    return density, [sum(density[k] for k in children[node] if tree.tags[k] not in INLINE) for node in range(n)]


@pytest.mark.parametrize("html", [c[0] for c in CASES if c[0] and len(c[0]) < 5_000])
def test_densities_against_a_walk_of_every_subtree(html):
    tree = parse(html)
    density, sums, _ = densities(tree)
    slow, slow_sums = slow_densities(tree)
    # the page itself is no element, and what is skipped has no density
    assert density[1:] == pytest.approx(slow[1:]) and sums == pytest.approx(slow_sums)
