"""Main text of web pages by the distribution of text over lines."""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame

from signalframe.llm.common import map_texts

#: Lines of a window, and characters in it at which text surges where no element marks the article.
WINDOW, SURGE = 3, 120

#: Elements by what they mean for the text.
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "xmp", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "svg", "canvas", "object", "audio", "video", "head"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: Names of classes, ids and roles of what is not the article.
BOILERPLATE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "sidebar", "nav",
    "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "comment", "comments", "disqus", "reply", "replies",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "popup", "modal", "overlay", "newsletter", "subscribe", "signup",
    "login", "share", "sharing", "social", "related", "recommended", "recommendations", "widget", "toolbar", "pagination", "pager", "search",
    "complementary", "contentinfo", "alert",
}
ARTICLE = {"article", "main"}
#: Elements whose end tag may be left out, and the start tags that end them.
ENDS = {
    "p": BLOCKS - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
}

_TAG = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z][^>]*>|</?[a-zA-Z][^<>]*\Z"
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_CLOSING = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}


def _unwanted(name: str, attrs: str, inside: bool) -> bool:
    """Whether an element is furniture by its tag, or by a class, id or role.  A header inside the article belongs to it."""
    if name in DROPPED:
        return not (name == "header" and inside)
    if not attrs or name in ("main", "html", "body"):
        return False
    if name == "article":
        return any(whole in BOILERPLATE or whole == "teaser" for _, *values in _NAMED.findall(attrs) for whole in "".join(values).lower().split())
    for kind, *values in _NAMED.findall(attrs):
        for whole in "".join(values).lower().split():
            parts = re.split(r"[^a-z0-9]+", whole)
            if parts[0] in ("has", "with", "no") or inside and whole == "header":
                continue
            if parts[0] in BOILERPLATE or parts[-1] in BOILERPLATE and kind.lower() != "role":
                return True
    return bool(_HIDDEN.search(attrs))


def _tags(html: str) -> list[tuple[int, int, str, str, bool]]:
    """Start, end, name, attributes and whether it closes, of every tag; "" for comments and raw elements' whole extent."""
    found, at = [], 0
    while m := _TAG.search(html, at):
        name, at = (m["name"] or "").lower(), m.end()
        if name in RAW and not m["end"]:
            close = _CLOSING[name].search(html, at)
            at = close.end() if close else len(html)
            found.append((m.start(), at, "", "", False))
        else:
            found.append((m.start(), at, name, m["attrs"] or "", bool(m["end"])))
    return found


def _follow(above: list[str], name: str, closes: bool) -> None:
    """Bring the names of the open elements up to date after a tag."""
    if not name or name in VOID:
        return
    if closes:
        if name in above:
            while above.pop() != name:
                pass
        return
    for i in range(len(above) - 1, -1, -1):
        if name in ENDS.get(above[i], ()):
            del above[i:]
        elif above[i] in BLOCKS and above[i] not in ("address", "div", "p"):
            break
    above.append(name)


def _extent(tags: list, k: int, above: list[str], inside: bool) -> int:
    """Index of the last tag of the element that tag ``k`` opens, in elements ``above``.

    Where end tags may be left out, the start of a sibling ends it, and the end
    of what it lies in ends any.  An element that nothing closes goes on to the
    article, or to the end; inside the article, to the next block.
    """
    name, within, parents = tags[k][2], [], {n for n in above if n in BLOCKS or n in DROPPED}
    article, end = len(tags), len(tags)
    for j in range(k, len(tags)):
        other, closes = tags[j][2], tags[j][4]
        if closes and other not in within and other in parents:
            end = j
            break
        _follow(within, other, closes)
        if j > k and (not within or other == within[0] and len(within) == 1 and not closes and other in ENDS.get(name, ())):
            if closes and other == name and (article > j or sum(1 - 2 * t[4] for t in tags if t[2] == name) <= 0):
                return j
            if not closes:
                return j - 1
            end = j
            break
        if other in ARTICLE and not closes and j > k:
            article = min(article, j)
        if j > k and within and within[0] != name:
            return j - 1
    if inside and name not in ENDS:
        end = next((j for j in range(k + 1, min(end, len(tags))) if tags[j][2] in BLOCKS), end)
    return min(article, end) - 1


def lines(html: str) -> list[tuple[str, int, bool]]:
    """The page line by line, a line for each block: its text, characters outside links, whether it is in the article.

    A line without text stands where furniture was.
    """
    tags, out = _tags(html), []
    above: list[str] = []
    text: list[str] = []
    outside = links = inside = 0

    def over() -> None:
        nonlocal text, outside
        line = " ".join(unescape("".join(text)).split())
        if line:
            out.append((line, outside, inside > 0))
        text, outside = [], 0

    def add(part: str) -> None:
        nonlocal outside
        if part:
            text.append(part)
            outside += len(part.strip()) if not links and any(map(str.isalnum, part)) else 0

    k = at = 0
    while k < len(tags):
        start, end, name, attrs, closes = tags[k]
        add(html[at:start])
        at = end
        if name and not closes and name not in VOID and _unwanted(name, attrs, inside > 0):
            last = _extent(tags, k, above, inside > 0)
            held = {t[2] for t in tags[k + 1 : last + 1] if not t[4]}
            if "main" not in held and not (name == "form" and "article" in held):  # what holds these is the page
                over()
                out.append(("", 0, False))
                whole = last + 1 < len(tags) or tags[last][2] == name and tags[last][4]
                at = tags[last][1] if whole and tags[last][4] and tags[last][2] == name else tags[last + 1][0] if last + 1 < len(tags) else len(html)
                k = last + 1
                continue
        _follow(above, name, closes)
        if name in BLOCKS:
            over()
        if name == "a":
            links = 0 if closes else 1
        elif name in ARTICLE:
            inside = max(0, inside + (-1 if closes else 1))
        k += 1
    add(html[at:])
    over()
    return out


def main_text(html: str) -> str:
    """The text between the points where it surges and where it dives.

    A line counts the characters outside links; lines outside an article or
    main element count nothing if the page has one with text.  Windows of
    WINDOW lines sum them up.  Text surges at a window that reaches the limit,
    and dives where the windows become empty; all such stretches are joined.
    Where no window reaches SURGE, the fullest sets the limit.  On pages without
    such an element, short lines beside a stretch belong to it.
    """
    found = lines(html)
    page, border = [], set()
    for line in found:
        if line[0]:
            page.append(line)
        else:
            border.add(len(page))
    marked = any(inside for _, _, inside in page)
    length = [(len(text) if inside else 0) if marked else outside for text, outside, inside in page]
    window = [sum(length[k : k + WINDOW]) for k in range(len(length))]
    limit = min(1 if marked else SURGE, max(window, default=0))
    kept, on = [False] * len(page), False
    for k, (own, total) in enumerate(zip(length, window)):
        on = total > 0 if on else limit > 0 and total >= limit and own > 0
        kept[k] = on and (own > 0 or not marked)
    if not marked:
        _extend(kept, length, border, range(len(page)), 0)
        _extend(kept, length, border, range(len(page) - 1, -1, -1), 1)
    return " ".join(text for (text, _, _), keep in zip(page, kept) if keep)


def _extend(kept: list[bool], length: list[int], border: set[int], order: range, before: int) -> None:
    """Keep lines with text outside links that follow kept ones in ``order``, up to furniture or more than WINDOW lines of links."""
    near, links = False, 0
    for k in order:
        if k + before in border:
            near = False
        if kept[k]:
            near, links = True, 0
        elif length[k]:
            kept[k], links = near, 0
        else:
            links += 1
            near = near and links <= WINDOW


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html); null, empty and text-free pages give "".

    A page without any tag is one line.  Rows that repeat are all returned.
    Nothing is shuffled.
    """

    def step(htmls: list[str]) -> dict[str, object]:
        texts = [main_text(h) for h in htmls]
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_texts(pages.select("page_id", "url", "html"), step, "text string, n_chars long", "html")
