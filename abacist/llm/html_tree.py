"""HTML to a tree of elements and text leaves, with the features the content model sees."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from math import log2

import numpy as np

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<""",
    re.S,
)
_NAMED = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
# Element names by their part in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes template svg select".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var".split()
)
# Formulas run in the text; their elements have no features of their own.
FLAT = INLINE | set(
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts "
    "mtable mtr mtd mspace mstyle mpadded mphantom menclose merror maction semantics annotation annotation-xml".split()
)
IN_HEAD = set("base basefont bgsound link meta title style script noscript noframes template".split())
LANDMARK = set("nav header footer aside form button noscript fieldset dialog menu".split())
KNOWN = (
    INLINE
    | LANDMARK
    | set(
        "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr td th pre "
        "blockquote figure figcaption center hgroup address details summary".split()
    )
)
_NESTED = set("svg select template".split())
_EDGES = {t: re.compile(rf"<(/?){t}(?=[\s/>]|\Z)", re.I | re.A) for t in RAW}
# Start tags that end an unclosed picture or list of options.
_BREAKS = "p|div|h[1-6]|ul|ol|dl|table|pre|blockquote|article|section|main|header|footer|nav|aside|figure"
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
# Words in class, id and role that say what an element is for.
HINTS = {
    word: kind
    for kind, words in {
        "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pagination pager links toolbar skip",
        "head": "header masthead topbar top banner logo branding site",
        "foot": "footer foot bottom copyright legal credits colophon",
        "side": "sidebar side aside rail widget widgets complementary secondary column",
        "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion dfp teaser partner",
        "note": "cookie cookies consent gdpr notice alert popup modal overlay banner disclaimer message paywall",
        "talk": "comment comments reply replies respond discussion disqus thread reader readers feedback",
        "form": "form search login signup subscribe newsletter register input contact",
        "more": "related recommended share sharing social tags meta byline author popular trending next prev",
        "main": "article content main post entry story text prose copy",
    }.items()
    for word in words.split()
}
LEAF, INNER, BLOCK, MARKED = range(4)
_LENGTHS = 9
FEATURES = {
    name: at
    for at, name in enumerate(
        ["bias", "leaf", "other"]
        + [f"tag:{t}" for t in sorted(KNOWN)]
        + [f"hint:{k}" for k in sorted(set(HINTS.values()))]
        + [f"leaf:{i}" for i in range(_LENGTHS)]
        + [f"size:{i}" for i in range(_LENGTHS)]
        + [f"links:{i}" for i in range(4)]
        + ["stop", "commas", "digits", "sign", "linked", "deep"]
    )
}


def folded(text: str) -> str:
    return " ".join(text.split())


class Page:
    """Nodes in page order: parent, kind, tag, and for leaves their text and block."""

    def __init__(self, html: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["html"]
        self.hints: list[set[str]] = [set()]
        self.kind: list[int] = [BLOCK]
        self.text: list[str | None] = [None]
        self.block: list[int] = [0]
        self.depth: list[int] = [0]
        self.flags: list[str] = [""]
        self._build(html)

    def _add(self, parent: int, tag: str, kind: int, text: str | None, block: int, flags: str = "") -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.kind.append(kind)
        self.text.append(text)
        self.block.append(block)
        self.depth.append(self.depth[parent] + 1)
        self.hints.append(set())
        self.flags.append(flags)
        return len(self.parent) - 1

    def _build(self, html: str) -> None:
        stack, at, block, in_head, begun = [0], 0, 0, False, False
        opened = Counter()  # open elements by name
        while at < len(html):
            found = _TOKEN.match(html, at)
            at = found.end()
            closing, name, attributes = found[1], found[2] or found[4], found[3] or found[5] or ""
            if closing:
                tag = closing.lower()
                if tag == "head":
                    in_head = False
                elif tag not in FLAT:
                    block += 1
                # a stray one ends nothing, and is not looked for among the open elements
                for up in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                    if self.tag[stack[up]] == tag:
                        self._close(stack, up, opened)
                        break
                    if self.tag[stack[up]] in ("table", "article", "body") and tag in FLAT:
                        break
            elif name:
                tag = name.lower()
                if tag in ("html", "body", "head"):
                    in_head = tag == "head" and not begun
                    if tag == "body":
                        self._hint(0, attributes)
                    continue
                if tag not in IN_HEAD:
                    in_head, begun = False, True
                if tag not in FLAT:
                    block += 1
                    self._close_before(stack, tag, opened)
                if tag in RAW:
                    end = at if attributes.endswith("/") else self._end(html, at, tag, stack)
                    if tag == "xmp":
                        self._add(self._add(stack[-1], tag, BLOCK, None, block), "", LEAF, html[at:end], block)
                    at = end
                elif tag not in VOID and not attributes.endswith("/"):
                    kind = INNER if tag in FLAT else MARKED if tag in LANDMARK else BLOCK
                    node = self._add(stack[-1], tag, kind, None, block, attributes if "data-main" in attributes else "")
                    self._hint(node, attributes)
                    stack.append(node)
                    opened[tag] += 1
            elif found[0][0] != "<" or found[0] == "<":
                if found[0].strip():
                    in_head, begun = False, True
                if not in_head:
                    text = unescape(found[0]) if "&" in found[0] else found[0]
                    self._add(stack[-1], "", LEAF, text, block)

    def _end(self, html: str, at: int, tag: str, stack: list[int]) -> int:
        """Where an element without nodes ends; an unclosed one ends with its parents or at a block."""
        if tag not in _NESTED:
            return next((m.start() for m in _EDGES[tag].finditer(html, at) if m[1]), len(html))
        own = _EDGES[tag].search(html, at)
        if own and own[1]:
            return own.start()
        parents = "|".join(re.escape(t) for t in {"body", "html", *(self.tag[i] for i in stack)})
        found = re.compile(rf"<(?:/(?:{parents})|{_BREAKS})(?=[\s/>]|\Z)", re.I | re.A).search(html, at)
        return min((m.start() for m in (own, found) if m), default=len(html))

    def _close(self, stack: list[int], up: int, opened: Counter) -> None:
        """Close the open elements from place ``up`` on."""
        for node in stack[up:]:
            opened[self.tag[node]] -= 1
        del stack[up:]

    def _close_before(self, stack: list[int], tag: str, opened: Counter) -> None:
        """End what a start tag of this name ends by itself."""
        ends = _ENDS.get(tag)
        scope = _SCOPES.get(tag, set())
        for up in range(len(stack) - 1, 0, -1):
            here = self.tag[stack[up]]
            if here == "p" or ends and here in ends:
                self._close(stack, up, opened)
                if not ends:
                    return
            elif here in scope or not ends and here not in FLAT:
                return

    def _hint(self, node: int, attributes: str) -> None:
        if "=" in attributes:
            for value in _NAMED.findall(attributes):
                self.hints[node].update(HINTS[w] for w in _WORD.findall(value.lower()) if w in HINTS)

    def features(self) -> tuple[list[int], list[int], list[float]]:
        """(node, feature, value) of all nodes."""
        n = len(self.parent)
        size, linked = [0] * n, [0] * n
        inside = [False] * n
        for i in range(1, n):
            inside[i] = inside[self.parent[i]] or self.tag[i] == "a"
            if self.text[i] is not None:
                size[i] = len(folded(self.text[i]))
                linked[i] = size[i] if inside[i] else 0
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
            linked[self.parent[i]] += linked[i]
        nodes, names, values = [], [], []

        def put(node: int, name: str, value: float = 1.0) -> None:
            nodes.append(node)
            names.append(FEATURES[name])
            values.append(value)

        for i in range(n):
            put(i, "bias")
            length = min(int(log2(size[i] + 1)), _LENGTHS - 1)
            text = self.text[i]
            if text is not None:
                put(i, "leaf")
                put(i, f"leaf:{length}")
                if size[i]:
                    end = text.rstrip()[-1:]
                    if end in (".", "!", "?", "…", "\"", "”"):
                        put(i, "stop")
                    put(i, "commas", min(text.count(",") / size[i] * 40, 2.0))
                    put(i, "digits", sum(map(text.count, "0123456789")) / size[i])
                    if "©" in text or "|" in text or "·" in text or "»" in text:
                        put(i, "sign")
                if inside[i]:
                    put(i, "linked")
            else:
                put(i, f"tag:{self.tag[i]}" if self.tag[i] in KNOWN else "other")
                for kind in self.hints[i]:
                    put(i, f"hint:{kind}")
                put(i, f"size:{length}")
                share = linked[i] / size[i] if size[i] else 0
                put(i, f"links:{0 if share < 0.05 else 1 if share < 0.3 else 2 if share < 0.7 else 3}")
            if self.depth[i] > 8:
                put(i, "deep")
        return nodes, names, values

    def main_text(self, content: np.ndarray) -> str:
        """Blocks of the leaves that are content, in page order."""
        blocks: list[str] = []
        last = None
        for i, text in enumerate(self.text):
            if text is None or not content[i]:
                continue
            if self.block[i] == last:
                blocks[-1] += text
            else:
                blocks.append(text)
                last = self.block[i]
        return " ".join(filter(None, map(folded, blocks)))
