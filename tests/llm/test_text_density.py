"""Main text: pages with every kind of other block, broken markup, odd rows."""

from __future__ import annotations

import html
import re
import time

import pytest
from conftest import SF_DIR

from aeropunct.llm.text_density import Densities, Page, extracted_pages, main_text

BODY = "<h1>A title</h1><p>First   paragraph\nof the text.</p><p>Second &amp; last&nbsp;one.</p>"
TEXT = "A title\nFirst paragraph of the text.\nSecond & last one."


@pytest.mark.parametrize(
    "other",
    [
        "<nav><ul><li><a href=x>Menu</a></li></ul></nav>",
        "<header><a href=/>Site</a><p>Words of a header that is rather long for one</p></header>",
        "<footer>Copyright and some more words at the end of the page</footer>",
        "<aside><p>Words in a side bar that go on for quite a while, as they do.</p></aside>",
        "<div class='cookie-notice'>We use cookies to make this site better for you.</div>",
        "<div id=ad-1 class=box>Buy this now, it is better than all others were.</div>",
        "<form><p>Your address, please</p><input name=a><button>Send</button></form>",
        "<script>var t = '<p>no text</p>';</script><style>p { margin: 0 }</style>",
        "<!-- <p>left out</p> --><noscript>Please turn it on</noscript>",
        "<section class=comments><article class=comment><p>I do not agree with a word"
        " of this, and here is why.</p></article></section>",
        "<div role=navigation>Home and more</div><div hidden>Unseen words</div>",
    ],
)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div class='post'>{}</div>", "<main>{}</main>"])
def test_other_blocks_go(other, wrap):
    for body in (other + wrap.format(BODY), wrap.format(BODY) + other):
        page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"
        assert main_text(page) == TEXT
    if "header" not in other:
        assert main_text(f"<body>{wrap.format(BODY + other)}</body>") == TEXT


def test_undeclared_text_is_found_by_density():
    text = "".join(f"<p>{'Words of the text, ' * 12}number {i}.</p>" for i in range(6))
    links = "".join(f"<div><a href=x{i}>Link number {i}</a></div>" for i in range(30))
    got = main_text(f"<div><div>{links}</div><div><h2>Head</h2><div>{text}</div></div></div>")
    assert got.split("\n")[0] == "Head" and len(got.split("\n")) == 7 and "Link" not in got


def test_names_of_wrappers_do_not_hide_the_text():
    page = f"<body class='has-sidebar'><div class='content with-comments sidebar'><article>{BODY}</article></div></body>"
    assert main_text(page) == TEXT


def test_broken_markup():
    assert main_text("<article><p><b>One.<br><p>Two &am") == "One.\nTwo &am"
    assert main_text("<ul><li>one<li>two</ul>x</p></b>") == "one\ntwo\nx"
    # A quote that never closes ends with its tag.
    assert main_text("<p title='a > b'>x<p class=\"y>z") == "x\nz"
    assert main_text("no markup < at all") == "no markup < at all"
    assert main_text("<p>a<script>b") == "a"
    assert main_text("<p>a<br>b <i>c</i>d<div>e</div>f") == "a b cd\ne\nf"
    assert main_text("&lt;p&gt; &#233;&eacute;") == "<p> éé"
    for empty in (None, "", " ", "<p></p>", "<nav>x</nav>", "<!-- x"):
        assert main_text(empty) == ""


def test_densities_of_every_node_against_their_definition():
    page = Page("<div><p>abcd <a href=x>ef</a></p><p>ghi</p></div><p>jk</p>")
    found = Densities(page, [True] * len(page.tag))
    children = {i: [j for j, up in enumerate(page.parent) if up == i] for i in range(len(page.tag))}

    def below(i):
        return [j for c in children[i] for j in [c, *below(c)]]

    for i in range(len(page.tag)):
        inside = below(i)
        letters = sum(len("".join(page.text[j].split())) for j in [i, *inside])
        assert found.chars[i] == letters
        assert found.tags[i] == sum(bool(page.tag[j]) for j in inside)
        assert found.sums[i] == pytest.approx(sum(found.composite[c] for c in children[i]))
    assert found.link_chars[0] == 2 and found.link_tags[0] == 1
    assert found.composite[page.tag.index("a")] == 0


@pytest.mark.parametrize(
    "page", ["<a " * 20_000, "<a '<a'" * 20_000, "<!--" * 20_000, "<div>" * 20_000 + "x", "<b><p>" * 9_000]
)
def test_time_grows_with_the_page(page):
    start = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - start < 20


def plain(page: str) -> str:
    """Text of the article element by patterns that hold for the test tables only."""
    article = page[page.index("<article>") :].split("</article>")[0].replace("<article>", "")
    blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
    lines = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return "\n".join(line for line in lines if line)


def test_test_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    want = {r.page_id: (r.url, plain(r.html), len(plain(r.html))) for r in pages.collect()}
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in extracted_pages(pages).collect()}
    assert got == want


def test_odd_rows_and_clashing_columns(spark):
    kinds = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "x", "y"), (None, None, "<p>a", "x", "y"), (2, "u", "<p>b", "x", "y")]
    rows.append(rows[-1])
    pages = spark.createDataFrame(rows, kinds)
    got = sorted(map(tuple, extracted_pages(pages).collect()), key=str)
    assert got == [(1, "u", "", 0), (2, "u", "b", 1), (2, "u", "b", 1), (None, None, "a", 1)]
    assert extracted_pages(pages.limit(0)).count() == 0
