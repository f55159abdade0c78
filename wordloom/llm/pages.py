"""HTML pages as trees of blocks: a tolerant reader for markup that is not closed, cut off or broken.

Inline markup leaves no trace but its text.  Every run of text between two block
boundaries is one block.  Elements that hold no article text by their kind, or by their
class, id or role, are marked.
"""

from __future__ import annotations

import re
from html import unescape

#: Elements deeper than this are taken as part of the one at this depth.
DEPTH = 64

# fixed values: kinds of elements of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
HEAD = frozenset("head title meta link script style base noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
CLOSED_BY = {
    "li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr", ("table",)),
    "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",)),
}

#: Kinds of elements without article text.
BOILERPLATE = frozenset(
    "head nav aside footer button select datalist dialog menu search noscript template object audio video canvas svg math".split()
)
#: Words of classes, ids and roles of parts around an article, and beginnings of such words.
WORDS = frozenset(
    "ad ads adbox adsense adslot adunit advert adverts banner banners sponsor sponsored sponsors promo promos promotion promoted "
    "notice notices notification notifications alert alerts alertdialog cookie cookies consent gdpr popup modal overlay dialog "
    "newsletter subscribe subscription signup login signin paywall "
    "sidebar sidebars side aside rail complementary widget widgets related recommended recommendations teaser teasers "
    "nav navs navbar navigation menu menus menubar breadcrumb breadcrumbs pagination pager toolbar skip "
    "footer foot contentinfo colophon masthead topbar header search form "
    "share sharing social disqus reply replies respond discussion reactions".split()
)
BEGINNINGS = ("comment", "advert", "sidebar", "cookie", "navbar", "newsletter", "breadcrumb")
#: First parts of names that speak of a part without being it: ``has-sidebar``.
ABOUT = frozenset("no not has have with without is hide show".split())
#: Words of classes and ids that hold an article.
CONTENT = frozenset("article articlebody content entry post story maincontent postbody posttext articletext".split())

ARTICLE, MAIN, HOLDER, NEVER, HINTED, HEADER, HEADING = 1, 2, 4, 8, 16, 32, 64

_ATTRIBUTE = r"""[\s/]*+[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?"""
_TAG = re.compile(rf"<([a-zA-Z][^\s/>]*+)((?:{_ATTRIBUTE})*+)[\s/]*+(?:>|\Z)")
_NAMED = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_END = re.compile(r"</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)")
_COMMENT = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))", re.DOTALL)
_BOGUS = re.compile(r"<[!?/][^>]*+(?:>|\Z)")
_LONG = re.compile(r"\d{3,}")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE) for name in RAW}


class Text:
    """A block of text, and how many of its characters are links."""

    __slots__ = ("links", "text")

    def __init__(self, text: str, links: int):
        self.text, self.links = text, links


class Element:
    """A block element: tag, key (tag with its names), marks, children, characters inside."""

    __slots__ = ("chars", "children", "holds", "key", "linked", "marks", "pieces", "tag")

    def __init__(self, tag: str, key: str, marks: int):
        self.tag, self.key, self.marks = tag, key, marks
        self.children: list[Element | Text] = []
        self.pieces: list[str] = []
        self.linked = self.chars = 0
        self.holds = False

    def flush(self) -> None:
        """The text gathered so far becomes a block."""
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.children.append(Text(text, min(self.linked, len(text))))
                self.chars += len(text)
            self.pieces, self.linked = [], 0


def _names(value: str) -> list[str]:
    return unescape(value).split()


def _hinted(name: str) -> bool:
    parts = [x.lower() for x in _PARTS.findall(name)]
    if not parts or parts[0] in ABOUT:
        return False
    return any(x in WORDS or x.startswith(BEGINNINGS) for x in parts)


_KNOWN: dict[tuple[str, str], tuple[str, int]] = {}


def kind_of(tag: str, attributes: str) -> tuple[str, int]:
    """Key and marks of a start tag; long numbers in names count as equal."""
    found = _KNOWN.get((tag, attributes))
    if found is None:
        found = _kind_of(tag, attributes)
        if len(_KNOWN) > 20_000:
            _KNOWN.clear()
        _KNOWN[tag, attributes] = found
    return found


def _kind_of(tag: str, attributes: str) -> tuple[str, int]:
    marks = (NEVER if tag in BOILERPLATE else 0) | (HEADER if tag == "header" else 0) | (HINTED if tag == "form" else 0)
    if re.fullmatch("h[1-6]|hgroup", tag):
        marks |= HEADING
    key, names, role = tag, [], ""
    if attributes:
        given: dict[str, str] = {}
        for name, *values in _NAMED.findall(attributes):
            given.setdefault(name.lower(), next(filter(None, values), ""))
        names = sorted({_LONG.sub("#", x) for x in _names(given.get("class", ""))} | {"#" + _LONG.sub("#", x) for x in _names(given.get("id", ""))})
        role = given.get("role", "").strip().lower()
        style = re.sub(r"\s", "", given.get("style", "")).lower()
        if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in style:
            marks |= NEVER
        spoken = [*_names(given.get("class", "")), *_names(given.get("id", "")), *role.split()]
        if any(map(_hinted, spoken)):
            marks |= HINTED
        plain = {"".join(x.lower() for x in _PARTS.findall(n)) for n in spoken} | {x.lower() for n in spoken for x in _PARTS.findall(n)}
        if "articlebody" in given.get("itemprop", "").lower() or plain & CONTENT:
            marks |= HOLDER
        key = ".".join([tag, *names]) + (f"[{role}]" if role else "")
    if not marks & (HINTED | NEVER):
        if tag == "article" or role == "article":
            marks |= ARTICLE
        elif tag == "main" or role == "main":
            marks |= MAIN
    return key, marks


def read(html: str) -> Element:
    """The page's tree; its root stands for html and body."""
    root = Element("", "", 0)
    stack, link = [root], False

    def close(to: int) -> None:
        while len(stack) > to:
            done = stack.pop()
            done.flush()
            above = stack[-1]
            above.chars += done.chars
            if not done.marks & NEVER:
                above.holds |= done.holds or bool(done.marks & (ARTICLE | MAIN))

    at, size = 0, len(html)
    while at < size:
        start = html.find("<", at)
        if start < 0:
            start = size
        if start > at:
            said = unescape(html[at:start])
            stack[-1].pieces.append(said)
            if link:
                stack[-1].linked += len(said.strip())
        if start == size:
            break
        if (tag := _TAG.match(html, start)) is not None:
            at = tag.end()
            name = tag[1].lower()
            if name in ("html", "body"):
                continue
            if name == "br":
                stack[-1].pieces.append(" ")
                continue
            if name in RAW:
                if name != "textarea" and name not in HEAD:
                    stack[-1].pieces.append(" ")
                end = _RAW_END[name].search(html, at)
                at = end.start() if end else size
                continue
            block = name in BLOCK
            if block or name not in HEAD:
                for n, x in enumerate(stack):
                    if x.tag == "head" and name not in HEAD:
                        close(n)
                        break
            if block:
                if stack[-1].tag == "p":
                    close(len(stack) - 1)
                if name in CLOSED_BY:
                    which, until = CLOSED_BY[name]
                    for n in range(len(stack) - 1, 0, -1):
                        if stack[n].tag in until:
                            break
                        if stack[n].tag in which.split():
                            close(n)
                            break
                stack[-1].flush()
                link = False
            if name in VOID:
                continue
            key, marks = kind_of(name, tag[2])
            if name == "a":
                link = True
            if (block or marks & (NEVER | HINTED)) and len(stack) < DEPTH:
                element = Element(name, key, marks)
                stack[-1].children.append(element)
                stack.append(element)
        elif (tag := _END.match(html, start)) is not None:
            at = tag.end()
            name = tag[1].lower()
            if name == "a":
                link = False
            for n in range(len(stack) - 1, 0, -1):
                if stack[n].tag == name:
                    close(n)
                    break
            else:
                if name in BLOCK:
                    stack[-1].flush()
        else:
            tag = (_COMMENT if html.startswith("<!--", start) else _BOGUS).match(html, start)
            if tag is not None:
                at = tag.end()
            else:
                stack[-1].pieces.append("<")
                at = start + 1
    close(1)
    root.flush()
    return root
