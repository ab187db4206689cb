"""Main text of pages: pages put together from known parts, plain rules on plain pages, odd markup."""

import html
import random
import re

import pytest

from quire.llm import maintext, registry

LONG = "The house of the old man is on the hill, and it was not far from the town that he had come to with his two sons, who are at sea for most of the year."
OTHER = "Das Haus ist auf dem Hügel und nicht weit von der Stadt, in die er mit den beiden Söhnen nach dem Krieg gekommen ist, die auch heute noch an der See sind."


def text(page):
    return maintext.main_text(page)


def test_pages_put_together(spark, tmp_path):
    """Articles of blocks of any length among all that is no article: the blocks come back exactly."""
    rng, pages, want = random.Random(4), [], []
    junk = [
        "<nav><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two</a></li></ul></nav>", f"<div class='ad'>{LONG}</div>", f"<aside>{LONG} {LONG}</aside>", f"<div id='cookie-notice'>{LONG}</div>", f"<form><p>{LONG}</p></form>",
        "<script>var a = '<p>x</p>';</script>", "<style>p{}</style>", f"<!-- <p>{LONG}</p> -->", f"<div class='sidebar left'><p>{LONG}</p></div>", f"<section id='comments'><article class='comment'><p>{LONG} {OTHER}</p></article></section>",
        f"<header><h1>The site of the day</h1><p>{LONG}</p></header>", f"<footer><p>{LONG}</p></footer>", f"<div hidden>{LONG}</div>", f"<div role='alert'>{LONG}</div>",
    ]
    for i in range(120):
        blocks = [rng.choice([LONG, OTHER, "Yes.", "Short one & more", "x" * 400, "a < b", LONG * 4, "Überall"]) for _ in range(rng.randint(1, 8))]
        body = "".join(f"<{t}>\n {html.escape(b).replace(' ', rng.choice([' ', '  ', '&nbsp;', '<br>', ' <b>'] ))} {f'</{t}>' * (rng.random() < 0.7)}" for b in blocks for t in [rng.choice(["p", "h2", "div", "blockquote"])])
        parts = [*rng.sample(junk, rng.randint(0, 6)), f"<{(tag := rng.choice(['article', 'main']))}>{body}{rng.choice(['', junk[2], junk[3]])}</{tag}>", *rng.sample(junk, rng.randint(0, 6))]
        pages.append((i, f"u{i}", f"<!DOCTYPE html><html><head><title>T</title></head><body>{''.join(parts)}{'</body></html>' * (i % 2)}", "more"))
        want.append("\n\n".join(blocks))
    pages += [(500, None, None, None), (501, "u", "", None), (None, "u", f"<article>{LONG}</article>", None), (0, "u0", pages[0][2], "again")]
    want += ["", "", LONG, want[0]]
    spark.createDataFrame(pages, "page_id long, url string, html string, text string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = registry.QUERIES["op12_main_text"](spark, str(tmp_path)).collect()
    key = lambda r: repr(r)
    assert sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got), key=key) == sorted(((p[0], p[1], w, len(w)) for p, w in zip(pages, want, strict=True)), key=key)


def test_given_pages_keep_their_articles(spark, sf):
    """The pages of the tables: blocks of the article and no others, cut by plain splitting."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in registry.QUERIES["op12_main_text"](spark, sf).collect():
        inner = re.search("<article>(.*)</article>", pages[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h\d)>", inner)]
        assert r["text"] == "\n\n".join(filter(None, blocks))


def test_block_rules_without_marks():
    """No article is marked: long blocks with stop words are good, links are bad, short blocks go with their nearest neighbours."""
    links = "<p><a href='/x'>The first of the links that are here</a> <a href='/y'>and the second of them, which is not the last</a></p>"
    page = f"{links}<p>In short.</p><p>{LONG} {LONG}</p><p>Short inside.</p><p>{OTHER * 2}</p><h2>Heading</h2><p>{LONG * 2}</p>{links}<p>Terms</p>"
    assert text(page).split("\n\n") == ["In short.", f"{LONG} {LONG}", "Short inside.", OTHER * 2, "Heading", LONG * 2] or text(page).split("\n\n")[1:] == [f"{LONG} {LONG}", "Short inside.", OTHER * 2, "Heading", LONG * 2]
    assert "links" not in text(page) and "Terms" not in text(page)


def test_short_blocks_inherit_from_the_nearest():
    good, bad = f"<p>{LONG * 3}</p>", "<p><a href='/x'>more and more of the links that are here</a></p>"
    assert text(f"{bad}{good}<p>One</p>{good}{bad}").split("\n\n") == [LONG * 3, "One", LONG * 3]
    assert text(f"{bad}<p>One</p>{bad}{good}") == LONG * 3
    assert text(f"{good}<p>One</p><p>Two</p><p>Three</p>{bad}").split("\n\n") == [LONG * 3, "One"]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article>plain", "plain"), ("plain text alone", "plain text alone"), ("<article><p>a<p>b<p>c</article>d", "a\n\nb\n\nc"), ("<main><ul><li>a<li>b</ul></main>", "a\n\nb"),
        ("<article>&lt;b&gt; &amp;amp; &#8364;&nbsp;&euro;</article>", "<b> &amp; € €"), ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"), ("<article><p title='a > b'>x</p></article>", "x"),
        ("<article>a<!-- never closed <p>b</p></article>", "a"), ("<article>a<script>never closed", "a"), ("<article><header><h1>Title</h1></header>a</article>", "Title\n\na"), ("<ARTICLE CLASS=post>A</ARTICLE>", "A"),
        ("<article>word<b>s</b> in <i>one</i><span class='share'>Share!</span> line</article>", "words in one\n\nline"), ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\n\nb\n\nc"),
        ("<body class='has-sidebar'><div class='content with-sidebar'><article>a</article></div>", "a"), ("<article><p>don't</p><p a=don't>x</p></article>", "don't\n\nx"), ("<div class='entry-header'><main>x</main></div>", "x"),
        ("<nav>a</nav><footer>b</footer>", ""), ("<article></article>", ""), ("<<<>>><article>x</article>", "x"), ("<article>" + "<div>" * 3000 + "x", "x"),
    ],
)
def test_odd_markup(page, want):
    assert text(page) == want


def test_adversarial_pages_end():
    for page in ("<a" * 100_000, "<a b='" * 50_000, "<!--" * 50_000, "&" * 200_000, "<p>" * 50_000 + "x", "</p>" * 50_000, "<script>" * 20_000, "<a x=" * 50_000):
        assert isinstance(text(page), str)


def test_blocks_as_rows(spark):
    df = spark.createDataFrame([(1, "<nav>Menu</nav><article><p>a</p></article>", "x")], "page_id long, html string, text string")
    assert [tuple(r) for r in maintext.page_blocks(df).orderBy("place").collect()] == [(1, 0, "Menu", False), (1, 1, "a", True)]
