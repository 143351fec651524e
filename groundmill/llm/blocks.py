"""Text blocks of an HTML page with the path of tags that leads to each."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

from groundmill.operators.markup import Open, Tokens

#: Fixed lists of element names.
BLOCK = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav"
    " ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset("script style noscript template annotation annotation-xml".split())
FOREIGN = frozenset(["svg", "math"])
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag closes an open element of these names first, if none of the bounds stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
ENDS_P = BLOCK - {"button", "label", "option", "optgroup", "body", "html", "head", "title"}

_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[A-Za-z]+|\d+")


class Node:
    """An open element: its tag, classes, ids and role, and the element around it. Blocks share the nodes above them."""

    __slots__ = ("above", "mark", "names")

    def __init__(self, names: tuple[str, ...], above: Node | None = None) -> None:
        self.names, self.above, self.mark = names, above, None


@dataclass
class Block:
    """``node`` is the innermost element that is open at the block's end; ``linked`` counts characters inside links."""

    node: Node | None
    text: str
    linked: int

    @property
    def path(self) -> tuple[str, ...]:
        """Names of all elements around the block, outermost first."""
        out: list[tuple[str, ...]] = []
        node = self.node
        while node is not None:
            out.append(node.names)
            node = node.above
        return tuple(n for names in reversed(out) for n in names)


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    out = [tag]
    if attributes:
        for kind, a, b, c in _ATTRIBUTE.findall(attributes):
            value = a or b or c
            out += [f".{n.lower()}" for n in _NAME.findall(value)]
            if kind.lower() == "role":
                out.append(f"role={value.lower()}")
    return tuple(out)


def split_blocks(page: str | None) -> list[Block]:
    """Blocks in page order; character references are decoded and white space inside a block is one space.

    Elements of the block kind begin and end a block, inline ones do not, and a line break is white space.
    Comments and what browsers never render (scripts, styles, noscript, templates, annotations of formulas) are no
    text, up to the page's end if the end tag is missing, as in browsers. Formulas, drawings and the fallback of objects
    are inline; a text area is a block. End tags without a start are ignored, missing ones are implied as
    browsers do for paragraphs, list items and table cells. Null and empty pages have none. Time and memory
    grow with the page's length, however deep its elements are or broken its tags.
    """
    if not page:
        return []
    open_, blocks = Open(), []
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(open_.items[-1][1] if open_.items else None, text, min(linked, len(text))))
        parts, linked = [], 0

    def push(tag: str, attributes: str) -> None:
        open_.push(tag, Node(_names(tag, attributes), open_.items[-1][1] if open_.items else None))

    def pop(k: int) -> None:
        while 0 <= k < len(open_.items):
            open_.pop()

    tokens = Tokens(page)
    for kind, tag, attributes in tokens:
        if kind == "text":
            text = html.unescape(tag)
            parts.append(text)
            if open_.places.get("a"):
                linked += len(text.strip())
        elif kind == "end":
            k = open_.nearest([tag])
            if k >= 0:
                if any(n in BLOCK for n, _ in open_.items[k:]):
                    flush()
                pop(k)
        elif attributes.rstrip().endswith("/") and (tag in FOREIGN or open_.nearest(FOREIGN) >= 0):
            continue
        elif tag in HIDDEN:
            tokens.skip(tag, nests=tag == "template")
        elif tag == "textarea":
            flush()
            push(tag, attributes)
            parts.append(html.unescape(tokens.skip(tag)))
            flush()
            open_.pop()
        elif tag in EMPTY:
            if tag == "hr":
                flush()
            elif tag == "br":
                parts.append(" ")
        else:
            if tag in BLOCK:
                flush()
            if tag in CLOSES:
                pop(open_.within(*CLOSES[tag]))
            if tag in ENDS_P and open_.places["p"]:
                pop(open_.within({"p"}, {"button", "td", "th", "table"}))
            push(tag, attributes)
    flush()
    return blocks
