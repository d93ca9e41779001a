import html
import re

import pytest

from signalframe.llm import mainblock
from signalframe.llm.queries import LLM_QUERIES

LONG = "This is a sentence of the article that goes on for a while. " * 4

CASES = {
    "furniture by element": (f"<nav><a href=x>Home</a></nav><header>Site</header><main><h1>Title</h1><p>{LONG}</p><p>End.</p></main><aside>Side</aside><footer>(c)</footer>", f"Title {LONG.strip()} End."),
    "furniture by class": (f"<div class='top-menu'>One</div><div id=content><p>{LONG}<p>Short<p>{LONG}</div><div class='comments'><p>{LONG}</p></div><div role=contentinfo>x</div>", f"{LONG.strip()} Short {LONG.strip()}"),
    "advert inside the article": (f"<article><p>A.</p><div class=\"ad\">Buy</div><p>{LONG}</p></article>", f"A. {LONG.strip()}"),
    "forms, scripts, comments": (f"<article><script>var t='</p><p>x';</script><style>p{{}}</style><form>Name <input></form><!-- <p>no</p> --><p>{LONG}</p></article>", LONG.strip()),
    "references and spaces": ("<article><p>a&amp;b &lt;c&gt;&nbsp; d\n\n e &#233;&eacute;</p></article>", "a&b <c> d e éé"),
    "inline elements": ("<article><p>un<b>bro</b>ken <a href='x>y'>link</a><br>next</p></article>", "unbroken link next"),
    "unclosed elements": (f"<article><p><b>One<p>Two<br>Three<p>{LONG}", f"One Two Three {LONG.strip()}"),
    "unclosed advert before the article": ("<div class=ad>Buy<article><p>Text.</p></article>", "Text."),
    "short article": ("<nav>Menu</nav><article><p>Yes.</p></article>", "Yes."),
    "header of the article": ("<header>Site</header><article><header><h1>T</h1></header><p>x</p></article>", "T x"),
    "links around text": ("<ul>" + "<li><a href=x>Some long link text here</a></li>" * 9 + f"</ul><p>{LONG}</p>" + "<ul>" + "<li><a href=x>More link text</a></li>" * 9 + "</ul>", LONG.strip()),
    "plain text": ("just text", "just text"),
    "none": (None, ""),
    "empty": ("", ""),
    "only furniture": ("<nav>Menu</nav><script>x", ""),
    "broken markup": ("<p>a < b <c & d> e</p", "a < b e"),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    page, want = CASES[name]
    assert mainblock.main_text(page or "") == want


def test_pages_of_the_tables(spark, sf_dir):
    out = {r.page_id: r for r in LLM_QUERIES["op3_line_blocks"](spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(out) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", article))).split())
        assert out[page.page_id].text == want and out[page.page_id].n_chars == len(want) and out[page.page_id].url == page.url


def test_awkward_rows(spark):
    rows = [(k, "u", page, "clash") for k, (page, _) in enumerate(CASES.values())] + [(None, None, "<p>x</p>", "c"), (0, "u", "<p>x</p>", "c"), (0, "u", "<p>x</p>", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = mainblock.page_texts(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == len(rows)
    assert mainblock.page_texts(pages.limit(0)).count() == 0
    assert len(mainblock.main_text("<article>" + "<p>word word</p>" * 50_000 + "</article>")) == 50_000 * 10 - 1


SHORT_LINES = {
    "short lines before": (f"<nav>M</nav><h1>Headline</h1><p>By one</p><p>12 May</p><p>{LONG}</p><p>{LONG}</p><p>End.</p><footer>x</footer>", f"Headline By one 12 May {LONG.strip()} {LONG.strip()} End."),
    "links before last": (f"<p>{LONG}</p><p>Some more text.</p><p><a href=x>Link only</a></p><p><a href=x>Link only</a></p><p><a href=x>Link only</a></p><p>The last paragraph.</p><div class=ad>Buy</div><p>Beyond furniture.</p>", f"{LONG.strip()} Some more text. The last paragraph."),
    "few words": ("<p>One two three four.</p><p>Five six seven eight nine ten.</p><p>Eleven twelve thirteen fourteen fifteen.</p><p>Sixteen seventeen words.</p>", "One two three four. Five six seven eight nine ten. Eleven twelve thirteen fourteen fifteen. Sixteen seventeen words."),
}


@pytest.mark.parametrize("name", SHORT_LINES)
def test_short_lines(name):
    page, want = SHORT_LINES[name]
    assert mainblock.main_text(page) == want


OPTIONAL_END_TAGS = {
    "li": (f"<article><ul><li class=share>Share<li>One<li>Two</ul><p>{LONG}</article>", f"One Two {LONG.strip()}"),
    "li nested": (f"<article><ul><li class=share>Share<ul><li>a<li>b</ul><li>One</ul><p>{LONG}</article>", f"One {LONG.strip()}"),
    "td": (f"<article><table><tr><td class=ad>Buy<td>One<tr class=ad><td>x<td>y<tr><td>Two</table><p>{LONG}</article>", f"One Two {LONG.strip()}"),
    "dd": (f"<article><dl><dt class=ad>Buy<dd>One<dt>T<dd class=ad>x<dt>U</dl><p>{LONG}</article>", f"One T U {LONG.strip()}"),
    "last li": (f"<article><ul><li>One<li class=share>Share</ul><p>{LONG}</article>", f"One {LONG.strip()}"),
    "open div": (f"<article><p>A.</p><div class=ad>Buy<p>{LONG}</p></article><p>x", f"A. {LONG.strip()}"),
}


@pytest.mark.parametrize("name", OPTIONAL_END_TAGS)
def test_optional_end_tags(name):
    page, want = OPTIONAL_END_TAGS[name]
    assert mainblock.main_text(page) == want


FURNITURE_WITH_ARTICLES = {
    "comments": (f"<article><p>{LONG}</p></article><section id=comments><article class=comment><p>Nice one.</p></article></section><aside><article class=teaser><p>More.</p></article></aside><article class=comment><p>Bad.</p></article>", LONG.strip()),
    "form page": (f"<form id=f><article><p>{LONG}</p></article></form>", LONG.strip()),
    "open ad in wrap": (f"<div id=w><div class=ad>Buy<article><p>{LONG}</p></article></div>", LONG.strip()),
    "p ad": (f"<article><p class=ad>Buy <b>now<p>{LONG}<div class=ad>x</div>end</article>", f"{LONG.strip()} end"),
}


@pytest.mark.parametrize("name", FURNITURE_WITH_ARTICLES)
def test_furniture_with_articles(name):
    page, want = FURNITURE_WITH_ARTICLES[name]
    assert mainblock.main_text(page) == want


def test_windows_without_the_element_take_long_text_beside_a_short_article():
    page = f"<article><p>Yes.</p></article><ul>{'<li><a href=x>Link</a></li>' * 9}</ul><p>{LONG}</p>"
    assert mainblock.main_text(page) == "Yes."
    assert mainblock.main_text(page.replace("article>", "div>")) == LONG.strip()
