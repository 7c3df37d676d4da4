"""Text blocks of an HTML page and the elements that hold them.

A small reader in the manner of browsers: it never fails, ends paragraphs,
items and cells where browsers do, and ignores end tags without a start.
Inline elements are transparent; every other element is a node.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

# Element names as the HTML standard lists them.
VOID = frozenset("area base br col embed hr img input link meta param source "
                 "track wbr".split())
INLINE = frozenset(
    "a abbr acronym area b bdi bdo big cite code data del dfn em font i img "
    "ins kbd label map mark nobr picture q rb rp rt ruby s samp small source "
    "span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp"
                .split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr li main menu nav ol p pre search section summary table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BARRIERS = frozenset("button caption html marquee object table td template th"
                     .split())
# What a start tag ends, and the elements beyond which it does not look.
ENDS = {
    "li": ({"li"}, {"ol", "ul", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}), "tbody": ({"tbody", "thead", "tfoot"},
                                         {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}

# Elements that hold no article text, whatever is in them.
NEVER = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form "
    "frameset head iframe menu nav noembed noframes noscript object option "
    "search select style script svg template textarea title video".split())
# Words in class, id, role or label that name a part beside the article ...
BESIDE = frozenset(
    "ad adbox ads advert advertisement adverts alert banner breadcrumb "
    "breadcrumbs complementary consent contentinfo cookie cookies copyright "
    "disclaimer footer gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice overlay pager pagination popup promo promoted "
    "promotion rail recommended related search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription toolbar widget"
    .split())
# ... and that name what readers wrote.
READERS = frozenset("comment comments commentlist disqus replies reply "
                    "respond".split())
# Words that may stand beside those in an id (ids also name headings).
FRAME = frozenset("area bar block bottom box col column container form inner "
                  "left links list main outer page primary right secondary "
                  "section site the thread top wrap wrapper".split())
# With one of these, a header is the article's own.
OWN = frozenset("article entry post story".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
_NEGATED = re.compile(r"\b(?:has|no|not|with|without)[-_][\w-]*", re.I)

_SIMPLE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)>")
_NAME = re.compile(r"[^\s/>]*")
_ATTRIBUTE = re.compile(
    r"[\s/]*([^\s/>][^\s/>=]*)"
    r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)))?")
_UNCLOSED = re.compile(r"\s*=\s*[\"']")
_TAG_END = re.compile(r"[\s/]*>")
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in RAW}
_DIGITS = re.compile(r"\d+")

_NONE: dict[str, str] = {}
ROOT, BODY, MAIN, ARTICLE = 0, 1, 2, 3


def name_of(*parts: bytes, size: int = 16) -> bytes:
    h = blake2b(digest_size=size)
    for p in parts:
        h.update(p)
    return h.digest()


def _words(marks: str) -> set[str]:
    return {w.lower() for w in _WORD.findall(_NEGATED.sub(" ", marks))}


def _beside(name: str, attributes: dict[str, str], region: int) -> int:
    """Whether an element stands beside the article: 0 no, 1 yes, but an
    article inside it counts, 2 with all that is in it."""
    if name in NEVER:
        return 1 if name == "form" else 2
    if name == "header" and region != ARTICLE:
        return 2
    if not attributes or name in ("html", "body"):
        return 0
    if "hidden" in attributes or _HIDDEN.search(attributes.get("style", "")):
        return 2
    words = _words(attributes.get("class", "") + " "
                   + attributes.get("role", ""))
    named = _words(attributes.get("id", ""))
    if name not in HEADINGS and named <= BESIDE | READERS | FRAME | {
            "header"}:
        words |= named
    if words & READERS:
        return 2
    if name in ("main", "article"):
        return 0
    return int(bool(words & BESIDE or (
        "header" in words and region != ARTICLE and not words & OWN)))


class Node:
    """An element that is no inline element."""
    __slots__ = ("parent", "sign", "plain", "children", "region")

    def __init__(self, parent, sign: str, plain: bool, region: int):
        self.parent, self.sign, self.plain = parent, sign, plain
        self.children: list = []       # nodes and blocks, in page order
        self.region = region


class Page:
    """Reads a page: ``blocks`` are (text, node, region), in page order."""

    def __init__(self, html: str):
        self.blocks: list[tuple[str, Node, int]] = []
        self.root = Node(None, "", True, ROOT)
        # Open elements with the state before them; how many of each name;
        # places of open paragraphs and of what bounds their scope.
        self.stack: list[tuple[str, Node, int, int]] = []
        self.open: dict[str, int] = {}
        self.scope: list[tuple[int, bool]] = []
        self.node, self.region, self.dropped = self.root, BODY, 0
        self.text: list[str] = []
        self._read(html)
        self._flush()

    # dropped: 0 kept, 1 beside the article (an article inside counts), 2 not
    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            self.text = []
            if text:
                self.node.children.append(len(self.blocks))
                self.blocks.append((text, self.node, self.region))

    def _pop(self, at: int) -> None:
        """Close the elements from place ``at`` of the stack on."""
        names = [entry[0] for entry in self.stack[at:]]
        if not INLINE.issuperset(names):
            self._flush()
        _, self.node, self.region, self.dropped = self.stack[at]
        for name in names:
            self.open[name] -= 1
        while self.scope and self.scope[-1][0] >= at:
            self.scope.pop()
        del self.stack[at:]

    def _end(self, names, stop) -> None:
        for name in names:
            if self.open.get(name):
                break
        else:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in names:
                self._pop(k)
                return
            if self.stack[k][0] in stop:
                return

    def _start(self, name: str, attributes: dict[str, str]) -> None:
        if name == "br":
            self.text.append(" ")
            return
        if name not in INLINE:
            self._flush()
        if name in VOID:
            return
        if name in ENDS_P and self.scope and self.scope[-1][1]:
            self._pop(self.scope[-1][0])
        if name in HEADINGS and self.stack and self.stack[-1][0] in HEADINGS:
            self._pop(len(self.stack) - 1)
        if name in ENDS:
            self._end(*ENDS[name])
        drop = self.dropped
        if drop < 2:
            drop = max(drop, _beside(name, attributes, self.region))
        region = self.region
        kind = (ARTICLE if name == "article" else MAIN if name == "main"
                or attributes.get("role", "").strip().lower() == "main"
                else 0)
        if kind and drop < 2:
            drop, region = 0, max(region, kind)
        if name == "p" or name in BARRIERS:
            self.scope.append((len(self.stack), name == "p"))
        self.stack.append((name, self.node, self.region, self.dropped))
        self.open[name] = self.open.get(name, 0) + 1
        if drop == 2:                  # nothing inside is looked at
            self.dropped = 2
            return
        if name not in INLINE:
            own = _DIGITS.sub("#", " ".join(
                f"{a}={attributes[a]}" for a in ("class", "id", "role")
                if attributes.get(a))) if attributes else ""
            node = Node(self.node, f"{name} {own}", not own, region)
            if not drop:
                self.node.children.append(node)
            self.node = node
        self.region, self.dropped = region, drop

    def _close(self, name: str) -> None:
        if name == "br":
            self.text.append(" ")
            return
        if name not in INLINE:
            self._flush()
        if not self.open.get(name):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            at = self.stack[k][0]
            if at == name:
                self._pop(k)
                return
            if name in INLINE and at not in INLINE:
                return

    def _read(self, html: str) -> None:
        pos, end = 0, len(html)
        while pos < end:
            at = html.find("<", pos)
            stop = end if at < 0 else at
            if stop > pos and not self.dropped:
                self.text.append(unescape(html[pos:stop]))
            if at < 0:
                return
            simple = _SIMPLE.match(html, at)
            if simple:                   # most tags are a bare name
                name = simple[2].lower()
                if simple[1]:
                    self._close(name)
                    pos = simple.end()
                    continue
                if name not in RAW and name != "plaintext":
                    self._start(name, _NONE)
                    pos = simple.end()
                    continue
            mark = html[at + 1:at + 2]
            if mark.isascii() and mark.isalpha():
                pos = self._tag(html, at + 1, True)
            elif mark == "/":
                after = html[at + 2:at + 3]
                if after.isascii() and after.isalpha():
                    pos = self._tag(html, at + 2, False)
                else:
                    pos = self._skip(html, ">", at + 2)
            elif html.startswith("!--", at + 1):
                short = re.match(r"-?>", html[at + 4:at + 6])
                pos = at + 4 + short.end() if short else min(
                    self._skip(html, "-->", at + 4),
                    self._skip(html, "--!>", at + 4))
            elif mark in ("!", "?") and mark:
                pos = self._skip(html, ">", at + 2)
            else:
                if not self.dropped:
                    self.text.append("<")
                pos = at + 1

    @staticmethod
    def _skip(html: str, what: str, pos: int) -> int:
        at = html.find(what, pos)
        return len(html) if at < 0 else at + len(what)

    def _tag(self, html: str, pos: int, start: bool) -> int:
        """Reads a tag from its name on; a tag cut off by the end of the
        page counts for nothing."""
        found = _NAME.match(html, pos)
        name, pos = found[0].lower(), found.end()
        attributes: dict[str, str] = {}
        while True:
            done = _TAG_END.match(html, pos)
            if done:
                pos = done.end()
                break
            a = _ATTRIBUTE.match(html, pos)
            if a is None or (a.lastindex == 1
                             and _UNCLOSED.match(html, a.end())):
                return len(html)
            value = a[2] if a[2] is not None else a[3] if a[3] is not None \
                else a[4] or ""
            attributes.setdefault(a[1].lower(), unescape(value))
            pos = a.end()
        if not start:
            self._close(name)
            return pos
        if name == "plaintext":
            if not self.dropped:
                self.text.append(html[pos:])
            return len(html)
        if name in RAW:
            last = _RAW_END[name].search(html, pos)
            inside = html[pos:last.start() if last else len(html)]
            if name == "xmp" and not self.dropped:
                self.text.append(inside)
            return self._skip(html, ">", last.start()) if last \
                else len(html)
        self._start(name, attributes)
        return pos


def article(page: Page) -> list[int]:
    """Places of the blocks of the page's article: those in article elements,
    or else in a main element, or else all that are left."""
    best = max((r for _, _, r in page.blocks), default=BODY)
    return [i for i, b in enumerate(page.blocks) if b[2] == best]


def texts(html: str) -> list[str]:
    """The blocks of a page's article."""
    page = Page(html)
    return [page.blocks[i][0] for i in article(page)]
