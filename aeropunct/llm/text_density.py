"""Main text of web pages by composite text density over the DOM.

A page becomes a tree. Subtrees that say what they are (navigation, adverts, forms,
comments) leave it. Every other node gets its link-adjusted characters per tag, and the
sum of its children's; the subtree with the largest sum is the text. The densities on the
path from it to the body are the threshold for what stands beside it.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropunct.llm import arrays

# ---------------------------------------------------------------------------
# Classes of HTML elements, and words that name a block's purpose.
# ---------------------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend"
    " li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Block elements whose start does not end an open paragraph.
IN_PARAGRAPH = frozenset("caption tbody td tfoot th thead tr".split())
HEAD_CONTENT = frozenset("base link meta noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Block elements that hold running text; the other ones are containers.
RUNNING = HEADINGS | frozenset("address blockquote caption dd dt figcaption legend li p pre summary".split())
# Start tags that end an open sibling, and the elements that hide it.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
PARAGRAPH_HIDDEN_BY = frozenset("button caption object table td th".split())
NOT_TEXT = frozenset(
    "aside audio button canvas datalist dialog embed footer form head iframe input map math menu"
    " nav noembed noframes noscript object option script select style svg template textarea title"
    " video xmp".split()
)
NOT_TEXT_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation"
    " search toolbar".split()
)
NOT_TEXT_NAMES = frozenset(
    "ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment"
    " commentlist comments consent cookie cookies copyright disqus footer gdpr login masthead menu"
    " modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo"
    " promoted promotion recommendations recommended related replies reply respond share sharing"
    " sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar"
    " widget widgets".split()
)
# Words that turn the name after them around, as in "has-sidebar".
NEGATIONS = frozenset("has have hide no not with without".split())
# ---------------------------------------------------------------------------

# A list or box with this many links, most of its characters in them, is a menu.
MENU_LINKS, MENU_SHARE = 3, 0.7

# Every alternative takes what it begins, so that broken markup costs no second look.
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+>?"
    r"|</(?P<end>[a-zA-Z][^\s/<>]*+)[^<>]*+>?"
    r"|<(?P<start>[a-zA-Z][^\s/<>]*+)"
    r"(?P<attributes>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|[\"'][^<>]*+>?|(?=<)|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s=/\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"']++)))?", re.S
)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """The tree of one page as parallel lists, parents before their children.

    A text is a node of its own without a tag.
    """

    def __init__(self, source: str):
        self.tag: list[str] = ["body"]
        self.parent: list[int] = [-1]
        self.text: list[str] = [""]
        self.attributes: list[dict[str, str]] = [{}]
        self._open = [0]
        self._parse(source)

    def _add(self, tag: str, text: str = "", attributes: dict[str, str] | None = None) -> int:
        self.tag.append(tag)
        self.parent.append(self._open[-1])
        self.text.append(text)
        self.attributes.append(attributes or {})
        return len(self.tag) - 1

    def _close_to(self, wanted: frozenset[str], hidden_by: frozenset[str]) -> None:
        """Ends the innermost open element of the wanted kind unless another one hides it."""
        for at in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[at]]
            if tag in wanted:
                self._leave(at)
                return
            if tag in hidden_by:
                return

    def _leave(self, at: int) -> None:
        for node in self._open[at:]:
            self._count[self.tag[node]] -= 1
        del self._open[at:]

    def _words(self, text: str) -> None:
        if not text.strip():
            # Space between inline elements parts words.
            if text:
                self._add("", " ")
            return
        self._leave_head()
        self._add("", html.unescape(text))

    def _leave_head(self) -> None:
        if self.tag[self._open[-1]] == "head":
            self._leave(len(self._open) - 1)

    def _parse(self, source: str) -> None:
        self._count: dict[str, int] = {}
        at = 0
        while True:
            found = _MARKUP.search(source, at)
            self._words(source[at : found.start() if found else len(source)])
            if not found:
                return
            at = found.end()
            if name := found["start"]:
                at = self._start(name.lower(), found["attributes"], source, at)
            elif name := found["end"]:
                self._end(name.lower())

    def _start(self, tag: str, attributes: str, source: str, at: int) -> int:
        if tag in ("html", "body"):
            self._leave_head()
            return at
        if tag not in HEAD_CONTENT:
            self._leave_head()
        if tag in BLOCK and tag not in IN_PARAGRAPH and self._count.get("p"):
            self._close_to(frozenset(["p"]), PARAGRAPH_HIDDEN_BY)
        if tag in ENDS:
            self._close_to(*ENDS[tag])
        known = {}
        if attributes.strip(" /\t\n\r\f"):
            for name, *values in _ATTRIBUTE.findall(attributes):
                known.setdefault(name.lower(), html.unescape("".join(values)))
        node = self._add(tag, "", known)
        if tag in RAW_TEXT:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
            return end.end() if end else len(source)
        if tag not in VOID and not (attributes.endswith("/") and tag in ("path", "svg")):
            self._open.append(node)
            self._count[tag] = self._count.get(tag, 0) + 1
        return at

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._add("br")
        # Content after the end of the body still belongs to it.
        if tag in ("html", "body") or not self._count.get(tag):
            return
        for at in range(len(self._open) - 1, 0, -1):
            if self.tag[self._open[at]] == tag:
                self._leave(at)
                return

    # -- purpose ----------------------------------------------------------

    def _named(self, node: int) -> bool:
        """Whether class or id names a purpose other than text."""
        known = self.attributes[node]
        before = ""
        for word in _NAME_WORD.findall(f"{known.get('class', '')} {known.get('id', '')}"):
            word = word.lower()
            if word in NOT_TEXT_NAMES and before not in NEGATIONS:
                return True
            before = word
        return False

    def _declares_text(self, node: int) -> bool:
        known = self.attributes[node]
        return (
            self.tag[node] in ("article", "main")
            or known.get("role") in ("main", "article")
            or known.get("itemprop") == "articleBody"
        )

    def content(self) -> tuple[list[bool], list[bool]]:
        """(whether a node may be text, whether it declares to hold the page's text)."""
        n = len(self.tag)
        named = [bool(self.attributes[i]) and self._named(i) for i in range(n)]
        declared = [i > 0 and not named[i] and self._declares_text(i) for i in range(n)]
        # A wrapper around the declared text is no advert, whatever its name.
        wraps = declared[:]
        for i in range(n - 1, 0, -1):
            if wraps[i]:
                wraps[self.parent[i]] = True
        kept, inside = [True] * n, declared[:]
        for i in range(1, n):
            up, known = self.parent[i], self.attributes[i]
            inside[i] = inside[i] or inside[up]
            tag, role = self.tag[i], known.get("role", "").lower()
            hidden = "hidden" in known or "display:none" in known.get("style", "").replace(" ", "")
            other = tag in NOT_TEXT or role in NOT_TEXT_ROLES or (tag == "header" and not inside[i])
            by_name = named[i] and not wraps[i]
            kept[i] = kept[up] and not (hidden or other or by_name)
            declared[i] = declared[i] and kept[i]
        return kept, declared


class Densities:
    """Characters, tags and links of every node, and the densities made of them."""

    def __init__(self, page: Page, kept: list[bool]):
        n = len(page.tag)
        self.chars, self.tags = [0] * n, [0] * n
        self.link_chars, self.link_tags = [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            up = page.parent[i]
            in_link[i] = in_link[up] or page.tag[i] == "a"
            if kept[i] and not page.tag[i]:
                self.chars[i] = len("".join(page.text[i].split()))
                self.link_chars[i] = self.chars[i] if in_link[i] else 0
        for i in range(n - 1, 0, -1):
            if not kept[i]:
                continue
            up = page.parent[i]
            self.chars[up] += self.chars[i]
            self.link_chars[up] += self.link_chars[i]
            self.tags[up] += self.tags[i] + bool(page.tag[i])
            self.link_tags[up] += self.link_tags[i] + (page.tag[i] == "a")
        share = self.link_chars[0] / max(self.chars[0], 1)
        self.composite = [self._composite(i, share) for i in range(n)]
        self.sums = [0.0] * n
        for i in range(1, n):
            if kept[i]:
                self.sums[page.parent[i]] += self.composite[i]

    def plain(self, i: int) -> float:
        """Characters outside links per tag."""
        return (self.chars[i] - self.link_chars[i]) / max(self.tags[i], 1)

    def _composite(self, i: int, body_share: float) -> float:
        """Characters per tag, damped by a logarithm whose base grows with the links.

        Counts of zero in a denominator are taken as one. The base is at least e: it would
        be 1 on a page without links.
        """
        chars, links = self.chars[i], self.link_chars[i]
        if not chars:
            return 0.0
        tags = max(self.tags[i], 1)
        ratio = chars / max(links, 1) * tags / max(self.link_tags[i], 1)
        spread = chars / max(chars - links, 1) * links + body_share * chars + math.e
        return chars / tags * math.log(max(ratio, 1)) / math.log(max(math.log(spread), math.e))


def select(page: Page) -> list[bool]:
    """Which nodes belong to the main text."""
    kept, declared = page.content()
    found = Densities(page, kept)
    n = len(page.tag)
    containers = [i for i in range(n) if kept[i] and page.tag[i] in BLOCK - RUNNING]
    top = max(containers, key=lambda i: (found.sums[i], -i))
    path = []
    node = top
    while node >= 0:
        path.append(node)
        node = page.parent[node]
    chosen = [False] * n
    above = next((i for i in path if declared[i]), None)
    if above is not None:
        # The subtree is part of what the page declares to be its text.
        outer = [i for i in path if declared[i]]
        chosen[above if page.tag[outer[-1]] == "main" else outer[-1]] = True
    else:
        on_path = set(path)
        below = [False] * n
        below[top] = True
        inner = []
        for i in range(1, n):
            below[i] = below[i] or below[page.parent[i]]
            if below[i] and declared[i] and i != top and found.chars[i]:
                inner.append(i)
        if inner:
            # Of a subtree with more around the declared text, only that.
            for i in inner:
                chosen[i] = True
        else:
            chosen[top] = True
            threshold = min(found.composite[i] for i in path)
            plain = min(found.plain(i) for i in path)
            for i in range(1, n):
                if i in on_path or page.parent[i] not in on_path or page.parent[i] == top:
                    continue
                if not kept[i] or not found.chars[i]:
                    continue
                if page.tag[i] in HEADINGS:
                    chosen[i] = 2 * found.link_chars[i] < found.chars[i]
                elif page.tag[i] in RUNNING:
                    # The logarithm favours large nodes: a paragraph is measured without it.
                    chosen[i] = found.plain(i) >= plain
                else:
                    chosen[i] = found.composite[i] >= threshold
    for i in range(1, n):
        chosen[i] = chosen[i] or chosen[page.parent[i]]
        menu = (
            page.tag[i] in ("ul", "ol", "dl", "div", "section", "table")
            and found.link_tags[i] >= MENU_LINKS
            and found.link_chars[i] >= MENU_SHARE * found.chars[i]
        )
        if not kept[i] or menu:
            # Children come later and take this over from their parent.
            kept[i] = False
        kept[i] = kept[i] and kept[page.parent[i]]
    return [c and k for c, k in zip(chosen, kept, strict=True)]


def main_text(source: str | None) -> str:
    """Main text of a page: its blocks in page order, a line each."""
    if not source:
        return ""
    page = Page(source)
    chosen = select(page)
    lines: list[str] = []
    words: list[str] = []

    def end_block() -> None:
        line = " ".join("".join(words).split())
        if line:
            lines.append(line)
        words.clear()

    # Nodes come in page order; a block ends where one begins and where one was left.
    ends: list[int] = []
    for i in range(1, len(page.tag)):
        up = page.parent[i]
        while ends and not _within(page, up, ends[-1]):
            end_block()
            ends.pop()
        tag = page.tag[i]
        if tag in BLOCK:
            end_block()
            if tag != "hr":
                ends.append(i)
        elif chosen[i] and tag == "br":
            words.append(" ")
        elif chosen[i] and not tag:
            words.append(page.text[i])
    end_block()
    return "\n".join(lines)


def _within(page: Page, node: int, block: int) -> bool:
    """Whether the node is the block or inside it; parents have smaller numbers."""
    while node > block:
        node = page.parent[node]
    return node == block


def extracted_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, url, text, n_chars) of every page, from its whole markup.

    Null and empty pages, and pages of which no text is left, have an empty text. Broken
    markup is read as browsers do: missing end tags are implied, unknown ones ignored, an
    unclosed comment or script reaches to the end; a tag with an unclosed quote ends at its
    next ``>``. Repeated rows are extracted each; other
    columns are not read; an empty table gives none. Nothing is shuffled.
    """
    narrow = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        F.col(f"`{html_col}`").alias("html"),
    )
    kinds = dict(narrow.dtypes)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.chunks(batches, "html"):
            texts = [main_text(source) for source in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array(list(map(len, texts)), pa.int64()),
                ],
                ["id", "url", "text", "n_chars"],
            )

    found = narrow.mapInArrow(
        extract, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long"
    )
    return found.withColumnsRenamed({"id": id_col, "url": url_col})
