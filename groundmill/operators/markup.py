"""Tags and texts of an HTML page, and the stack of open elements, each in time that grows with the page's length only."""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Collection, Iterator

_OPEN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
#: Attributes up to the tag's end; quotes count after an equals sign only.
_REST = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)>")


@functools.lru_cache(maxsize=64)
def _edge(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.I)


class Tokens:
    """Iterates over (kind, text or tag name in lower case, attributes): "text", "start", "end". Comments and declarations are left out.

    A comment without an end reaches to the page's end. Where no ``>`` outside quotes follows a start tag, quotes
    are ordinary characters from there on, so that no part of the page is read more than twice.
    """

    def __init__(self, page: str) -> None:
        self.page, self.at, self.last, self.quotes = page, 0, page.rfind(">"), True

    def __iter__(self) -> Iterator[tuple[str, str, str]]:
        page = self.page
        while True:
            m = _OPEN.search(page, self.at)
            if m is None or (m.start() > self.last and not m[1]):
                if self.at < len(page):
                    yield "text", page[self.at :], ""
                return
            if m.start() > self.at:
                yield "text", page[self.at : m.start()], ""
            end = m.end()
            if m[1]:
                short = next((s for s in (">", "->") if page.startswith(s, end)), None)
                stop = -1 if short else page.find("-->", end)
                self.at = end + len(short) if short else stop + 3 if stop >= 0 else len(page)
            elif m[3] is None or m[2]:
                self.at = page.find(">", end) + 1
                if m[3]:
                    yield "end", m[3].lower(), ""
            elif page.startswith(">", end):
                self.at = end + 1
                yield "start", m[3].lower(), ""
            else:
                rest = _REST.match(page, end) if self.quotes else None
                self.quotes = rest is not None
                self.at = rest.end() if rest else page.find(">", end) + 1
                yield "start", m[3].lower(), page[end : self.at - 1]

    def skip(self, tag: str, nests: bool = False) -> str:
        """What stands before the end tag of an element that has just begun; reading goes on behind it, or at the page's end."""
        begin, depth = self.at, 1
        for m in _edge(tag).finditer(self.page, begin, self.last + 1):
            depth += -1 if m[1] else int(nests)
            if not depth:
                self.at = m.end()
                return self.page[begin : m.start()]
        self.at = len(self.page)
        return self.page[begin:]


class Open:
    """Open elements, outermost first, with the places of each name, so that none is searched for one by one."""

    def __init__(self) -> None:
        self.items: list[tuple[str, object]] = []
        self.places: dict[str, list[int]] = defaultdict(list)

    def push(self, tag: str, item: object = None) -> None:
        self.places[tag].append(len(self.items))
        self.items.append((tag, item))

    def pop(self) -> tuple[str, object]:
        tag, item = self.items.pop()
        self.places[tag].pop()
        return tag, item

    def nearest(self, tags: Collection[str]) -> int:
        """Place of the innermost open element of these names; -1 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def within(self, tags: Collection[str], fences: Collection[str]) -> int:
        """As ``nearest``, but only if no element of ``fences`` is open inside it."""
        k = self.nearest(tags)
        return k if k >= 0 and k > self.nearest(fences) else -1
