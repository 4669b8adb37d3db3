"""A page as blocks of text in a tree of block elements, and the names that pages give to their parts."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

# What HTML says about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table tbody tfoot"
    " thead tr ul noscript template".split()
)
# Start tags of these end an open paragraph.
ENDS_P = BLOCKS - frozenset("caption dd dt li legend tbody tfoot thead tr noscript template".split()) | {"hr"} | {
    "dd",
    "dt",
    "li",
}
SCOPE = frozenset("button caption object table td th template".split())
# Open elements that a start tag ends, and the elements that shield them.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table td th".split())),
    "dd": (frozenset(["dd", "dt"]), frozenset("dl table td th".split())),
    "dt": (frozenset(["dd", "dt"]), frozenset("dl table td th".split())),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
    "td": (frozenset(["td", "th"]), frozenset("tr table".split())),
    "th": (frozenset(["td", "th"]), frozenset("tr table".split())),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset("tbody thead tfoot".split()), frozenset(["table"])),
    "thead": (frozenset("tbody thead tfoot".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot".split()), frozenset(["table"])),
}
TRANSPARENT = frozenset("html head body".split())
# Elements that are never part of an article.
NO_TEXT = frozenset(
    "script style noscript template iframe object embed svg canvas audio video select datalist button textarea"
    " input output progress meter title".split()
)
OUTER = frozenset("nav footer aside menu dialog search".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
# Words in class and id that name what is no part of an article.
NAMES = frozenset(
    "ad ads adbox adsense adslot advert adverts advertisement advertising sponsor sponsored sponsors promo promotion"
    " banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer header masthead topbar"
    " cookie cookies consent gdpr notice notices notification alert comment comments commentlist disqus reply replies"
    " respond discussion share sharing sharebar social related recommended newsletter subscribe subscription signup"
    " login popup modal overlay widget widgets pagination pager toolbar search form skip".split()
)
# An article element is only taken for something else by these.
ARTICLE_NAMES = frozenset("comment comments reply replies related recommended promo sponsored advert ad".split())
# In an article, these are its own head and foot.
OWN_NAMES = frozenset(["header", "banner", "masthead"])

# Elements nested deeper have no node of their own; their text belongs to the node above.
MAX_DEPTH = 64

OUTSIDE, UNLIKELY, PLAIN, ARTICLE, MAIN = -2, -1, 0, 1, 2

_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))
      | </>
      | <(?:[!?]|/[^A-Za-z])[^>]*+>?
      | <(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+)>?""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_WORD = re.compile(r"[a-z]+|[0-9]+")
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(value.strip("\"'")))
    return found


@lru_cache(maxsize=1 << 15)
def _read_tag(tag: str, text: str) -> tuple[str, int, bool, str]:
    """Signature, what the names say, whether the words are those of a head only, and the link's target."""
    attributes = _attributes(text) if text else {}
    label = attributes.get("class", "")
    signature = DIGITS.sub("0", f"{tag} {label}".strip())
    words = set(_WORD.findall(_HUMP.sub("-", f"{label} {attributes.get('id', '')}").lower()))
    role = attributes.get("role", "").lower()
    link = attributes.get("href") or attributes.get("src") or ""
    if tag in NO_TEXT or tag in OUTER or role in ROLES:
        return signature, OUTSIDE, False, link
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true"
    if hidden or _HIDDEN.search(attributes.get("style", "")):
        return signature, UNLIKELY, False, link
    if tag == "main" or role == "main" or attributes.get("itemprop") == "articleBody":
        return signature, MAIN, False, link
    if tag == "article" or role == "article":
        return signature, UNLIKELY if words & ARTICLE_NAMES else ARTICLE, False, link
    if tag == "form":
        return signature, UNLIKELY, False, link
    named = words & NAMES
    if named or tag == "header":
        return signature, UNLIKELY, not named - OWN_NAMES, link
    return signature, PLAIN, False, link


@dataclass
class Page:
    """Nodes in page order, node 0 the page itself, and blocks (node, text)."""

    parent: list[int] = field(default_factory=lambda: [-1])
    signature: list[str] = field(default_factory=lambda: [""])
    named: list[int] = field(default_factory=lambda: [PLAIN])
    blocks: list[tuple[int, str]] = field(default_factory=list)
    links: list[tuple[int, str]] = field(default_factory=list)


class _Builder:
    def __init__(self) -> None:
        self.page = Page()
        # Open elements: tag, their node or -1, whether they are silent.
        self.open: list[tuple[str, int, bool]] = []
        self.count: dict[str, int] = {}
        self.nodes = [0]
        self.silent = 0
        self.inside = 0
        self.buffer: list[str] = []

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer.clear()
            if text:
                self.page.blocks.append((self.nodes[-1], text))

    def text(self, text: str) -> None:
        if not self.silent:
            self.buffer.append(unescape(text) if "&" in text else text)

    def pop(self) -> None:
        tag, node, silent = self.open.pop()
        self.count[tag] -= 1
        if silent:
            self.silent -= 1
        if tag in BLOCKS:
            self.flush()
        if node >= 0:
            self.nodes.pop()
            if self.page.named[node] in (ARTICLE, MAIN):
                self.inside -= 1

    def close(self, tags: frozenset[str], shields: frozenset[str]) -> None:
        """Ends the innermost of these elements and all in it, unless a shield comes first."""
        if not any(self.count.get(tag) for tag in tags):
            return
        for k in range(len(self.open) - 1, -1, -1):
            tag = self.open[k][0]
            if tag in tags:
                while len(self.open) > k:
                    self.pop()
                return
            if tag in shields:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag in TRANSPARENT:
            return
        if tag in ENDS_P:
            self.close(_P, SCOPE)
        if tag in IMPLIED:
            self.close(*IMPLIED[tag])
        block = tag in BLOCKS
        if block or tag == "hr":
            self.flush()
        elif tag in ("br", "td", "th"):
            self.text(" ")
        signature, named, own, link = _read_tag(tag, attributes)
        if link and not self.silent:
            self.page.links.append((self.nodes[-1], link))
        if tag in VOID:
            return
        if own and self.inside:
            named = PLAIN
        silent = tag in NO_TEXT or (named < PLAIN and not block)
        node = -1
        if block and not silent and not self.silent and len(self.nodes) <= MAX_DEPTH:
            node = len(self.page.parent)
            self.page.parent.append(self.nodes[-1])
            self.page.signature.append(signature)
            self.page.named.append(named)
            self.nodes.append(node)
            if named in (ARTICLE, MAIN):
                self.inside += 1
        elif block and named < PLAIN and not silent:
            silent = True
        if silent:
            self.silent += 1
        self.open.append((tag, node, silent))
        self.count[tag] = self.count.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag not in VOID and self.count.get(tag):
            self.close(frozenset([tag]), _CELLS if tag in BLOCKS else BLOCKS)
        elif tag == "br":
            self.text(" ")


_P = frozenset(["p"])
_CELLS = frozenset(["td", "th", "caption"])


def parse(html: str) -> Page:
    """The page's blocks of text. Anything can be parsed: what is not markup is text, what is not closed ends itself.

    White space in a block is one space; blocks are the texts between starts and ends of block elements.
    """
    builder = _Builder()
    at, end = 0, len(html)
    while at < end:
        token = _TOKEN.search(html, at)
        if token is None:
            builder.text(html[at:])
            break
        if token.start() > at:
            builder.text(html[at : token.start()])
        at = token.end()
        tag = token[2]
        if tag is None:
            continue
        tag = tag.lower()
        if token[1]:
            builder.end(tag)
        elif html[at - 1] == ">":
            builder.start(tag, token[3])
            if tag in RAW:
                stop = _raw_end(tag).search(html, at)
                at = stop.end() if stop else end
                builder.end(tag)
    while builder.open:
        builder.pop()
    builder.flush()
    return builder.page


@lru_cache(maxsize=16)
def _raw_end(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I)


def article_nodes(page: Page) -> list[bool]:
    """Which nodes belong to the article by the names on the page alone.

    The article is the page's main elements, else its article elements, else all of it. What is named as something
    else goes with all in it, but what merely looks so stays if it holds the first main or article element.
    """
    n = len(page.parent)
    outside = [False] * n
    for k in range(1, n):
        outside[k] = outside[page.parent[k]] or page.named[k] == OUTSIDE
    roots: list[int] = []
    for kind in (MAIN, ARTICLE):
        found = [k for k in range(1, n) if page.named[k] == kind and not outside[k]]
        # The first one that nothing unlikely is around, if there is one.
        found.sort(key=lambda k: _doubtful(page, k))
        if found:
            shielded, up = set(), found[0]
            while up > 0:
                up = page.parent[up]
                shielded.add(up)
            roots = _kept(page, outside, shielded)
            held = _within(page, roots, kind)
            if any(held[node] for node, _ in page.blocks):
                return held
    kept = _kept(page, outside, set())
    return kept


def _doubtful(page: Page, node: int) -> bool:
    while node > 0:
        if page.named[node] == UNLIKELY:
            return True
        node = page.parent[node]
    return False


def _kept(page: Page, outside: list[bool], shielded: set[int]) -> list[bool]:
    kept = [True] * len(page.parent)
    for k in range(1, len(kept)):
        unlikely = page.named[k] == UNLIKELY and k not in shielded
        kept[k] = kept[page.parent[k]] and not outside[k] and not unlikely
    return kept


def _within(page: Page, kept: list[bool], kind: int) -> list[bool]:
    inside = [False] * len(kept)
    for k in range(1, len(kept)):
        inside[k] = inside[page.parent[k]] or page.named[k] == kind
    return [a and b for a, b in zip(kept, inside, strict=True)]
