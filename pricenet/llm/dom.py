"""A forgiving HTML reader: page text to a flat list of elements with their text, in page order."""

from __future__ import annotations

import re
from html import unescape

# Fixed values of HTML: elements without end tags, with raw text, and those that break a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
# Elements whose start closes an open paragraph, and what ends the search for it.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
SCOPE = frozenset("html body table td th caption button object template article section main div aside nav".split())
# An item closes the open item of the same list.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
    re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?")


class Element:
    __slots__ = ("tag", "attributes", "parent", "depth", "index", "end", "start_text", "end_text")

    def __init__(self, tag: str, attributes: str, parent: int, depth: int, index: int, start_text: int) -> None:
        self.tag, self.attributes, self.parent, self.depth, self.index = tag, attributes, parent, depth, index
        # Elements up to ``end`` lie below this one; its text is texts[start_text:end_text].
        self.end, self.start_text, self.end_text = index + 1, start_text, start_text

    def named(self) -> dict[str, str]:
        return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(self.attributes)}


class Page:
    """``elements`` in document order (the first is the root) and ``texts``: (owner, decoded text).

    A text of owner -1 is a block boundary: it joins no words.
    """

    def __init__(self, html: str) -> None:
        self.elements = [Element("#root", "", -1, 0, 0, 0)]
        self.texts: list[tuple[int, str]] = []
        self._open = [0]
        # Where in ``_open`` elements of a tag, and those of SCOPE, stand.
        self._places: dict[str, list[int]] = {}
        self._scopes: list[int] = []
        at, n = 0, len(html)
        for m in self._markup(html):
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1]:
                self._close(tag)
            else:
                self._start(tag, m[3])
        if at < n:
            self._text(html[at:])
        self._pop_to(0)

    def _markup(self, html: str):
        """Markup matches; the content of raw-text elements is skipped over."""
        at = html.find("<")
        while at >= 0:
            m = _MARKUP.match(html, at)
            if m is None:
                at = html.find("<", at + 1)
                continue
            yield m
            tag = (m[2] or "").lower()
            at = m.end()
            if tag in RAW and not m[1] and not m[3].endswith("/"):
                ends = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
                # Without its end tag the element runs to the end of the page.
                end = ends.start() if ends else len(html)
                yield _Skipped(at, end)
                at = end
            at = html.find("<", at)

    def _text(self, raw: str) -> None:
        self.texts.append((self._open[-1], unescape(raw) if "&" in raw else raw))

    def _pop_to(self, depth: int) -> None:
        while len(self._open) > depth:
            e = self.elements[self._open.pop()]
            if e.index:
                self._places[e.tag].pop()
                if e.tag in SCOPE:
                    self._scopes.pop()
            e.end, e.end_text = len(self.elements), len(self.texts)
            if e.tag not in INLINE:
                self.texts.append((-1, " "))

    def _last(self, tags) -> int:
        """Place of the innermost open element of some tags, 0 without one."""
        return max((self._places[t][-1] for t in tags if self._places.get(t)), default=0)

    def _close_open(self, tags: set[str], stop) -> None:
        k = self._last(tags)
        if not k or k < self._last(stop):
            return
        # Close the outermost one of these before the boundary.
        while k > 1 and self.elements[self._open[k - 1]].tag in tags and len(tags) > 1:
            k -= 1
        self._pop_to(k)

    def _start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self._close_open({"p"}, SCOPE)
        if tag in SIBLINGS:
            self._close_open(*SIBLINGS[tag])
        if tag not in INLINE:
            self.texts.append((-1, " "))
        index = len(self.elements)
        self.elements.append(Element(tag, attributes, self._open[-1], len(self._open), index, len(self.texts)))
        if tag not in VOID:
            self._places.setdefault(tag, []).append(len(self._open))
            if tag in SCOPE:
                self._scopes.append(len(self._open))
            self._open.append(index)

    def _close(self, tag: str) -> None:
        places = self._places.get(tag)
        if places and not (tag in INLINE and self._scopes and self._scopes[-1] > places[-1]):
            self._pop_to(places[-1])


class _Skipped:
    """Stands for the content of a raw-text element among the markup matches."""

    def __init__(self, start: int, end: int) -> None:
        self._span = (start, end)

    def start(self) -> int:
        return self._span[0]

    def end(self) -> int:
        return self._span[1]

    def __getitem__(self, group: int) -> None:
        return None
