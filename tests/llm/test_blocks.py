"""Main text of pages."""

import random

import numpy as np
import pytest

from tillwise.llm import blocks

PARAGRAPH = "A paragraph that is long enough to be taken for the text of an article, whatever the page. "
PAGE = (
    '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>T &amp; t</title><style>p{margin:0}</style><script>var t="</p>";'
    '</script></head><body class="has-sidebar"><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad <p>no</p> -->{before}'
    "<article><header><h1>Head &amp; title</h1></header><p><b>First&nbsp;  line\n two<br><p>Second &lt;b&gt; &#233; <i>in</i>line</p>{inside}<p>End.</article>"
    "{after}<footer>&copy; 2020 &middot; foot</footer></body></html>"
)
WANTED = "Head & title First line two Second <b> é inline End."


@pytest.mark.parametrize("junk", [
    "", '<div class="ad">Buy <p>now</p></div>', '<aside>Side</aside>', '<form action="/"><p>Search <input name=q></p></form>',
    '<div class="cookie-notice">We use cookies</div>', '<section id="comments"><h2>Comments</h2><article class="comment"><p>Nice!</p></article></section>',
    '<div role="banner">Top</div>', '<div hidden>secret</div>', '<p style="display: none">gone</p>', "<noscript>Enable</noscript>",
    '<ul class="navMenu"><li>One</ul>', "<script>document.write('<p>x</p>')</script>", '<div class=sidebar>Unclosed <p>here',
])
@pytest.mark.parametrize("spot", ["before", "inside", "after"])
def test_article_without_what_surrounds_it(junk, spot):
    # an unclosed container reaches to the end of the element that holds it
    if "Unclosed" in junk and spot != "after":
        junk += "</div>"
    page = PAGE
    for name in ("before", "inside", "after"):
        page = page.replace(f"{{{name}}}", junk if name == spot else "")
    assert blocks.main_text(page) == WANTED


def test_page_without_a_marked_article():
    page = f'<div><a href="/">Home</a> <a href="/a">About</a></div><div><p>{PARAGRAPH}</p><p>Short.</p><p>{PARAGRAPH}</p></div><div class="footer">Foot</div>'
    text = PARAGRAPH.strip()
    assert blocks.main_text(page) == f"{text} Short. {text}"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain", "plain"), ("<p>cut off <b", "cut off"), ("a < b and c > d", "a < b and c > d"),
    ("<article><p>x<!-- never closed", "x"), ("</div></p>stray", "stray"), ("<p>&bogus; &am</p>", "&bogus; &am"), ("<article></article>", ""),
    ("<p>a<p>b", "a b"), ("<P CLASS='x'>Up</P>", "Up"),
])
def test_odd_pages(page, text):
    assert blocks.main_text(page) == text


def test_surge_and_dive():
    length = np.array([5, 0, 0, 0, 90, 3, 120, 0, 0, 0, 4, 0])
    keep = blocks.kept_lines(length, np.zeros(12, bool))
    assert np.flatnonzero(keep).tolist() == [4, 5, 6]
    assert blocks.kept_lines(np.zeros(0, np.int64), np.zeros(0, bool)).tolist() == []


def test_long_page_is_whole():
    page = "<article>" + f"<p>{PARAGRAPH}</p>" * 5000 + "</article>"
    assert blocks.main_text(page) == " ".join([PARAGRAPH.strip()] * 5000)


def test_pages_table(spark):
    schema = "page_id long, url string, html string, text string"
    pages = spark.createDataFrame([(1, "u", PAGE.replace("{before}", "").replace("{inside}", "").replace("{after}", ""), "x"), (2, None, None, "x"), (None, "v", "<p>é", "x"), (2, None, None, "x")], schema)
    got = sorted(map(tuple, blocks.extracted(pages).collect()), key=str)
    assert got == sorted([(1, "u", WANTED, len(WANTED)), (2, None, "", 0), (2, None, "", 0), (None, "v", "é", 1)], key=str)
    assert blocks.extracted(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("mark", [
    '<svg class="i"/>', "<math/>", "<iframe src='x'/>", "<template/>", "<svg><title/><path d='M0'/><text>Left out</text></svg>", "<noscript>Left <p>out</noscript>",
    "<template><div>Left out</div></template>", '<iframe src=http://x/>Left out</iframe>',
])
def test_left_out_elements_end_where_they_end(mark):
    assert blocks.main_text(f"<article><p>Intro {mark} more.</p><p>All the rest.</p></article>") == "Intro more. All the rest."


@pytest.mark.parametrize("name", ["svg", "math", "template", "noscript", "iframe"])
def test_an_unclosed_element_reaches_to_the_end_of_what_holds_it(name):
    assert blocks.main_text(f"<article><p>Intro<{name}>x</p><p>All the rest.</p></article>") == "Intro All the rest."
    assert blocks.main_text(f"<article><p>Intro</p><script>x<{name}></article>") == "Intro"


LONG, AD = PARAGRAPH.strip() * 3, "<div class=ad>Buy</div>"


@pytest.mark.parametrize("page, text", [
    (f"<div><p>{LONG}</p>{AD}<p>Short end.</p></div>", f"{LONG} Short end."),
    (f"<div><h1>Head</h1><div class=share>Share</div><p>{LONG}</p></div>", f"Head {LONG}"),
    (f"<div><h1>Head</h1><div class=share>Share</div><div><p>{LONG}</p>{AD}<p>Short.</p>{AD}{AD}<p>End.</p></div></div>", f"Head {LONG} Short. End."),
    (f"<body><nav>Menu</nav><h1>Head</h1>{AD}<p>{LONG}</p>{AD}<p>End.</body>", f"Head {LONG} End."),
    (f"<div><div>{LONG}</div>{AD}<div>Short.</div>{AD}<div>{LONG}</div></div>", f"{LONG} Short. {LONG}"),
    # what stands in another element is still parted
    (f"<div><div>Site</div><nav>Menu</nav><div><p>{LONG}</p>{AD}</div><div>Imprint</div></div>", LONG),
])
def test_left_out_containers_inside_an_unmarked_article(page, text):
    assert blocks.main_text(page) == text


CARD = '<article><h3><a href="/t">Teaser</a></h3></article>'


@pytest.mark.parametrize("page, text", [
    # dense text outside the mark, and short text there
    (f"<body><div><p>{LONG}</p><p>Short end.</p></div><section>{CARD * 3}</section></body>", f"{LONG} Short end."),
    (f"<body><div>Site</div><nav>Menu</nav><article><p>{LONG}</p></article><nav>Menu</nav><div>Imprint</div></body>", LONG),
    # a list of links inside the mark, and single lines of links
    (f"<main><p>{LONG}</p><ul>{'<li><a href=/x>Link</a></li>' * 5}</ul><p>End.</p></main>", f"{LONG} End."),
    (f"<article><h1><a href=/>Head</a></h1><p>{LONG}</p><p><a href=/o>Source</a></p></article>", f"Head {LONG} Source"),
    ("<article><p>Short.</p></article>", "Short."),
])
def test_window_sums_decide_on_marked_pages(page, text):
    assert blocks.main_text(page) == text


@pytest.mark.parametrize("inside, text", [
    # values of other attributes, and other attributes that end alike
    ('<p title="a hidden gem">Text.</p>', "Text."), ('<p data-hidden="false">Text.</p>', "Text."), ('<div data-role="menu"><p>Text.</p></div>', "Text."),
    ('<section data-id="share"><p>Text.</p></section>', "Text."), ("<p title='class=ad' data-class=ad>Text.</p>", "Text."),
    # names of headings, paragraphs and words
    ('<h2 id="search">Search</h2>', "Search"), ('<h2 id="related-work">Related work</h2>', "Related work"),
    ('<p>A <span class="search">word</span> more.</p>', "A word more."), ('<p class="comment">Text.</p>', "Text."),
    # links to sources
    (f"<h2>Sources</h2><ul>{'<li><a href=/s>Source</a></li>' * 3}</ul>", "Sources Source Source Source"),
    # containers that say what they are
    ('<ul class="menu"><li><a href=/>Menu</a></li></ul>', ""), ("<div CLASS=ad>Buy</div>", ""), ("<p hidden>x</p>", ""), ('<x-ad class="ad">Buy</x-ad>', ""),
    ('<div aria-hidden="true">x</div>', ""), ('<p style="color: red">Text.</p>', "Text."), ('<div id = "comments"><p>Nice</p></div>', ""),
])
def test_attributes_are_read_whole(inside, text):
    page = f"<body><article><h1>Head</h1><p>{PARAGRAPH}</p>{inside}<p>End.</p></article></body>"
    assert blocks.main_text(page) == " ".join(f"Head {PARAGRAPH} {text} End.".split())


KEPT = [
    ("<h2 id=share>Heading</h2>", "Heading"), (f"<p>{PARAGRAPH}</p>", PARAGRAPH), ("<p>Short.</p>", "Short."), ("<p>A <b class=ad>bold</b> <a href=/>link</a>.</p>", "A bold link."),
    ("<ul><li>One item</li><li><a href=/i>Second</a></li></ul>", "One item Second"), ("<blockquote><p>Quoted &amp; said.</p></blockquote>", "Quoted & said."),
    ("<table><tr><td>Cell</td><td>Other</td></tr></table>", "Cell Other"), ("<pre>code  here</pre>", "code here"), ("<p><a href=/only>Only a link</a></p>", "Only a link"),
    ("<figure><figcaption>Caption</figcaption></figure>", "Caption"), ("<div><div><p>Deep.</p></div></div>", "Deep."), ("<p data-role=search>Text</p>", "Text"),
]
JUNK = [
    "<div class=ad>Buy now</div>", "<nav><a href=/>Menu</a></nav>", "<aside><p>Aside</p></aside>", "<form><p>Mail</p><input></form>", "<script>if (a < b) x('<p>');</script>",
    "<style>p{}</style>", "<section id=comments><article class=comment><p>Nice</p></article></section>", "<div role=alert>Notice</div>", "<!-- <p>no</p> -->", "<div class='cookie-banner'><p>Cookies</p></div>",
    "<ul class=share><li>Share</li></ul>", "<footer>Foot</footer>", "<div hidden><p>Hidden</p></div>",
]


@pytest.mark.parametrize("seed", range(40))
def test_pages_of_known_blocks_are_whole(seed):
    """Blocks that are article text, in any order and among any others, come out as they went in."""
    rng = random.Random(seed)
    kept = [rng.choice(KEPT) for _ in range(rng.randrange(1, 25))] + [(f"<p>{PARAGRAPH}</p>", PARAGRAPH)]
    body = [part for html, _ in kept for part in ([html] + [rng.choice(JUNK)] * rng.choice((0, 0, 1, 2)))]
    around = [rng.choice(JUNK[:3] + JUNK[6:]) for _ in range(rng.randrange(4))]
    page = f"<html><head><title>T</title></head><body>{''.join(around)}<article>{''.join(body)}</article>{''.join(around)}</body></html>"
    assert blocks.main_text(page) == " ".join(" ".join(text for _, text in kept).split())
