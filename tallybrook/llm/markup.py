"""HTML as blocks of text in a tree of block elements, for pages of any quality.

Inline markup belongs to the text of its block. Missing end tags are made up for, unknown
or stray ones are passed over, and what is not shown (scripts, styles, comments) is left out.
"""

from __future__ import annotations

import re
from html import unescape

# Elements that start a block of text.
BLOCKS = frozenset(
    "html head body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol optgroup p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
# Elements whose content is no markup, and none of which is article text.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
# Further elements whose content is no article text.
UNSHOWN = frozenset("noscript template select button object audio video canvas svg map datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What ends where another begins, if it stands inside the innermost of `within`.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
# Parts of a page that are no article.
APART = frozenset("head nav aside footer header form dialog menu search".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
# Words of a class or id that say the same.
MARK = re.compile(
    r"(?<![a-z])(?:ad|ads|adv|adverts?|adbox|promos?|nav|menus?|pager|pagination|toolbar|topbar|rail|widgets?|notices?|"
    r"alerts?|consent|gdpr|popup|modal|overlay|disclaimer|forms?|login|signup|subscribe|subscription|search|"
    r"repl(?:y|ies)|respond|responses|discussion|share|sharing|social|related|skip|copyright|colophon)(?![a-z])"
    r"|advert|sponsor|banner|navbar|navigation|menubar|breadcrumb|masthead|footer|sidebar|aside|cookie|newsletter|"
    r"comment|disqus"
)
HEADER = re.compile(r"(?<![a-z])header(?![a-z])")
OF_ARTICLE = re.compile(r"(?<![a-z])(?:article|post|entry|story|content|main|title)(?![a-z])")
# Words of the class of an article that is none, and of one that is.
NO_ARTICLE = frozenset("comment reply ad advert advertisement sponsored promo".split())
AN_ARTICLE = frozenset("post entry story main content has with".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</[^A-Za-z>][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)?|[^>=])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WORD = re.compile(r"[a-z]+")


class Element:
    """A block element.

    `key` is its tag and the words of its class, after which come `~` for a part of the page
    that is no article, and `!` where its attributes set it apart. `central` is `article` or
    `main` for what holds the article. `kids` are elements, and (text, characters in links).
    """

    __slots__ = ("central", "key", "kids", "tag")

    def __init__(self, tag: str, key: str, central: str = "") -> None:
        self.tag, self.key, self.central = tag, key, central
        self.kids: list[Element | tuple[str, int]] = []


def _attributes(given: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, double, single, plain in ATTRIBUTE.findall(given):
        out.setdefault(name.lower(), double or single or plain)
    return out


def _described(given: str, inside: bool) -> tuple[str, bool, str]:
    """The words of a class, whether attributes set the element apart, and its role.

    `inside` an article a header is its own.
    """
    if "=" not in given and "hidden" not in given:
        return "", False, ""
    found = _attributes(given)
    names = CAMEL.sub("-", unescape(f"{found.get('class', '')} {found.get('id', '')}")).lower()
    role = found.get("role", "").strip().lower()
    marked = role in ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    marked = marked or bool(HIDDEN.search(found.get("style", "").lower()))
    if not marked and names.strip():
        marked = bool(MARK.search(names)) or bool(not inside and HEADER.search(names) and not OF_ARTICLE.search(names))
    words = CAMEL.sub("-", unescape(found.get("class", ""))).lower()
    return "-".join(sorted(set(WORD.findall(words)))), marked, role


class _Reader:
    """Builds the tree of one page, token by token."""

    def __init__(self, html: str) -> None:
        self.html = html
        self.root = Element("", "")
        self.open = [self.root]
        self.pieces: list[str] = []
        self.linked = 0
        self.links = 0
        # What is passed over: an inline element and all that is open in it.
        self.passed: list[str] = []

    def text(self, piece: str) -> None:
        if self.passed or not piece:
            return
        piece = unescape(piece) if "&" in piece else piece
        self.pieces.append(piece)
        if self.links:
            self.linked += len(piece.strip())

    def end_block(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.open[-1].kids.append((text, min(self.linked, len(text))))
            self.pieces = []
        self.linked = self.links = 0

    def start(self, tag: str, given: str, at: int) -> None:
        """A start tag that ends at `at`."""
        if self.passed:
            if tag not in VOID:
                self.passed.append(tag)
        elif tag == "br":
            self.text(" ")
        elif tag in BLOCKS:
            self.end_block()
            self._start_block(tag, given)
        elif tag == "hr":
            self.end_block()
        elif tag in VOID:
            return
        elif self._unread(tag, given, at):
            self.passed = [tag]
        elif tag == "a":
            self.links += 1

    def _unread(self, tag: str, given: str, at: int) -> bool:
        """Whether an inline element is passed over, which takes an end tag further on.

        In program text classes name parts of speech, so `comment` there is none.
        """
        apart = tag in UNSHOWN or (self._described(given)[1] and not any(e.tag == "pre" for e in self.open))
        return apart and re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I | re.A).search(self.html, at) is not None

    def _described(self, given: str) -> tuple[str, bool, str]:
        return _described(given, any(e.central == "article" for e in self.open)) if given else ("", False, "")

    def _start_block(self, tag: str, given: str) -> None:
        if tag in ("html", "body", "head") and any(e.tag == tag for e in self.open):
            return
        self._end_before(tag)
        words, marked, role = self._described(given)
        central = "main" if role == "main" else tag if tag in ("main", "article") else ""
        if tag in ("html", "body") or central:
            # A page may be named after its parts, such as `with-sidebar`; but a comment may be an article.
            named = set(words.split("-"))
            marked = central == "article" and not named.isdisjoint(NO_ARTICLE) and named.isdisjoint(AN_ARTICLE)
        inside = any(e.central == "article" for e in self.open)
        apart = tag in APART and not central and not (tag == "header" and inside)
        element = Element(tag, f"{central or tag}{'.' + words if words else ''}{'~' * apart}{'!' * marked}", central)
        self.open[-1].kids.append(element)
        self.open.append(element)

    def _end_before(self, tag: str) -> None:
        """End what must end where a block begins: a paragraph, and items of the same list or table."""
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == "p":
                del self.open[at:]
                break
            if self.open[at].tag in ("td", "th", "table", "article", "main", "body"):
                break
        ended, within = ENDED_BY.get(tag, (set(), set()))
        for at in range(len(self.open) - 1, 0, -1):
            if not ended or self.open[at].tag in within:
                break
            if self.open[at].tag in ended:
                del self.open[at:]

    def end(self, tag: str) -> None:
        if self.passed:
            if tag in self.passed:
                del self.passed[len(self.passed) - 1 - self.passed[::-1].index(tag) :]
                return
            if tag not in BLOCKS:
                return
            self.passed = []
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag not in BLOCKS:
            return
        self.end_block()
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return


def read(html: str | None) -> Element:
    """The tree of a page; no html gives a root without kids."""
    html = html or ""
    reader, at = _Reader(html), 0
    while found := TOKEN.search(html, at):
        reader.text(html[at : found.start()])
        at = found.end()
        if (tag := found.group(2)) is None:
            continue
        tag = tag.lower()
        if found.group(1):
            reader.end(tag)
        elif tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I | re.A).search(html, at)
            at = close.end() if close else len(html)
        else:
            reader.start(tag, found.group(3), at)
    reader.text(html[at:])
    reader.end_block()
    return reader.root
