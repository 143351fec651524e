"""Main text of web pages by a recurrent labeller over blocks.

Every block becomes a vector of hashed tag-path names, hashed words and a few measures. A bidirectional LSTM in
numpy reads a page's blocks in order, so that each decision sees the whole document, and a logistic output
keeps or drops the block. The weights are trained on pages that this module makes up: layouts with menus,
notices, adverts, forms, sidebars, comments and footers around an article, with every block's label known.
"""

from __future__ import annotations

import functools
import math
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Block, Node, split_blocks
from .shared import map_column

PATH, WORDS, MEASURES, HIDDEN = 256, 128, 6, 24
INPUT = PATH + WORDS + MEASURES
#: Pages that the labeller is trained on, passes over them, pages of a step, seed.
PAGES, PASSES, STEP, SEED = 800, 7, 25, 11
#: Blocks of a page that are held as vectors at a time.
PART = 8192


_SERIAL = re.compile(r"\bq\d+q ?")


@functools.lru_cache(maxsize=200_000)
def _slot(name: str, size: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % size


def _path_marks(node: Node | None) -> int:
    """Bits of the hashed names of an element and all around it; each element is hashed once, whatever blocks lie in it."""
    chain = []
    while node is not None and node.mark is None:
        chain.append(node)
        node = node.above
    mark = 0 if node is None else node.mark
    for x in reversed(chain):
        for n in x.names:
            mark |= 1 << _slot(n, PATH)
        x.mark = mark
    return mark


def features(blocks: list[Block], first: int = 0, total: int | None = None) -> np.ndarray:
    """One row per block: which path names are present, counts of all hashed words over the root of their number, length, links, marks, place.

    ``blocks`` may be a part of a page that begins with block ``first`` of ``total``.
    """
    x = np.zeros((len(blocks), INPUT), np.float32)
    if not blocks:
        return x
    at, share, measures, marks = [], [], [], []
    for i, b in enumerate(blocks):
        marks.append(_path_marks(b.node).to_bytes(PATH // 8, "little"))
        words = b.text.lower().split()
        at += [i * INPUT + PATH + _slot(w, WORDS) for w in words]
        share += [1 / math.sqrt(len(words))] * len(words)
        n = len(b.text)
        measures.append((math.log1p(n) / 8, b.linked / n, min(1.0, 20 * (b.text.count(".") + b.text.count(",")) / n), (first + i) / (total or len(blocks)), float(b.text[-1] in ".!?"), math.log1p(b.text.count(" ")) / 6))
    x += np.bincount(at, share, x.size).reshape(x.shape).astype(np.float32)
    x[:, :PATH] = np.unpackbits(np.frombuffer(b"".join(marks), np.uint8).reshape(len(blocks), -1), axis=1, bitorder="little")
    x[:, PATH + WORDS :] = measures
    return x


def _forward(w: dict[str, np.ndarray], side: str, x: np.ndarray, mask: np.ndarray, keep: bool, state: tuple[np.ndarray, np.ndarray] | None = None):
    """Hidden states of one direction over (T, B, INPUT), what training needs of them, and the last state; masked steps carry the state on."""
    steps, n = mask.shape
    h, c = state or (np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32))
    inputs = x.reshape(-1, INPUT) @ w["x" + side] + w["b" + side]
    inputs = inputs.reshape(steps, n, 4 * HIDDEN)
    out, tape = np.zeros((steps, n, HIDDEN), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        z = inputs[t] + h @ w["h" + side]
        gates = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        if keep:
            tape.append((t, h, c, i, f, o, g, tanh_c, m))
        h, c = np.where(m, o * tanh_c, h), np.where(m, new_c, c)
        out[t] = h
    return out, tape, (h, c)


def _backward(w, side, x, tape, grad_out, grads) -> None:
    n = grad_out.shape[1]
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    dz_all = np.zeros((*grad_out.shape[:2], 4 * HIDDEN), np.float32)
    for t, h, c, i, f, o, g, tanh_c, m in reversed(tape):
        dh = dh + grad_out[t]
        live_h, live_c = np.where(m, dh, 0), np.where(m, dc, 0)
        d_cell = live_c + live_h * o * (1 - tanh_c**2)
        dz = np.concatenate([d_cell * g * i * (1 - i), d_cell * c * f * (1 - f), live_h * tanh_c * o * (1 - o), d_cell * i * (1 - g**2)], axis=1)
        dz_all[t] = dz
        grads["h" + side] += h.T @ dz
        dh, dc = np.where(m, dz @ w["h" + side].T, dh), np.where(m, d_cell * f, dc)
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    grads["x" + side] += x.reshape(-1, INPUT).T @ flat
    grads["b" + side] += flat.sum(0)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), INPUT), np.float32), np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, True
    return x, mask


def probabilities(w: dict[str, np.ndarray], pages: list[np.ndarray]) -> list[np.ndarray]:
    """Chance that each block is main text; pages of like length are read together."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and j - i < 256 and len(pages[order[j]]) * (j - i + 1) <= 16_384 and len(pages[order[j]]) <= 2 * len(pages[order[i]]) + 4:
            j += 1
        x, mask = _padded([pages[k] for k in order[i:j]])
        both = np.concatenate([_forward(w, "f", x, mask, False)[0], _forward(w, "b", x, mask, False)[0]], axis=2)
        p = 1 / (1 + np.exp(-np.clip(both @ w["out"] + w["bias"], -30, 30)))[..., 0]
        for k, c in zip(order[i:j], range(j - i), strict=True):
            out[k] = p[: len(pages[k]), c]
        i = j
    return out


def _long(w: dict[str, np.ndarray], blocks: list[Block]) -> np.ndarray:
    """As ``probabilities`` for one page of any length: blocks are read ``PART`` at a time in both directions, and only hidden states are held for all."""
    starts = range(0, len(blocks), PART)
    both = np.zeros((len(blocks), 2 * HIDDEN), np.float32)
    for side, order, columns in (("f", starts, slice(0, HIDDEN)), ("b", reversed(starts), slice(HIDDEN, 2 * HIDDEN))):
        state = None
        for i in order:
            x = features(blocks[i : i + PART], i, len(blocks))
            out, _, state = _forward(w, side, x[:, None], np.ones((len(x), 1), bool), False, state)
            both[i : i + len(x), columns] = out[:, 0]
    return 1 / (1 + np.exp(-np.clip(both @ w["out"] + w["bias"], -30, 30)))[:, 0]


def main_text(w: dict[str, np.ndarray], pages: list[str | None]) -> list[str]:
    """The blocks of each page that the labeller keeps, joined by line feeds."""
    blocks = [split_blocks(p) for p in pages]
    short = [k for k, b in enumerate(blocks) if len(b) <= PART]
    chances = dict(zip(short, probabilities(w, [features(blocks[k]) for k in short]), strict=True))
    return ["\n".join(x.text for x, p in zip(b, chances[k] if k in chances else _long(w, b), strict=True) if p >= 0.5) for k, b in enumerate(blocks)]


class _Maker:
    """Pages with labelled blocks: each text carries a serial number, and labels go by it."""

    #: Names that layouts use, by part; fixed lists.
    NAMES = {
        "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs pagination pager toc links tabs".split(),
        "top": "header masthead banner site-header page-header branding hero topbar".split(),
        "bottom": "footer site-footer page-footer colophon bottom copyright legal".split(),
        "side": "sidebar aside widget rail related recommended popular trending secondary right-column tags".split(),
        "notice": "cookie cookies notice consent gdpr banner alert popup modal overlay warning newsletter paywall disclaimer".split(),
        "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad adsbox".split(),
        "comments": "comment comments comment-list discussion disqus replies responses reader-comments thread respond".split(),
        "form": "form search login signup subscribe newsletter-form contact-form searchbox".split(),
        "share": "share social sharing share-buttons follow byline-tools meta".split(),
        "main": "content main article post entry story body text article-body post-content entry-content page-content".split(),
    }
    CHROME = "home about contact login sign in register search privacy terms cookies accept subscribe newsletter share tweet follow reply copyright rights reserved advertisement sponsored related more read next previous menu skip close comments posted by".split()

    def __init__(self, rng: random.Random) -> None:
        self.rng = rng
        self.keep: set[str] = set()
        self.serial = 0

    def words(self, low: int, high: int, chrome: float = 0.0) -> str:
        r = self.rng
        syllables = "an the er in on re ti ed nd ha es or en at th le de la ei ch um ca mo ri so pa".split()
        out = [r.choice(self.CHROME) if r.random() < chrome else "".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))]
        text, k = [], 0
        for word in out:
            text.append((word.capitalize() if k == 0 else word) + ("." if r.random() < 0.08 else "," if r.random() < 0.04 else ""))
            k = 0 if text[-1][-1] == "." else k + 1
        return " ".join(text)

    def say(self, low: int, high: int, keep: bool, chrome: float = 0.0) -> str:
        self.serial += 1
        mark = f"q{self.serial}q"
        if keep:
            self.keep.add(mark)
        return f"{mark} {self.words(low, high, chrome)}" + ("." if keep and self.rng.random() < 0.8 else "")

    def host(self) -> str:
        return f"{self.rng.choice(['www', 'm', 'blog', 'news'])}.{self.words(1, 1).strip('.,').lower()}.{self.rng.choice(['com', 'net', 'org', 'example.com', 'example.org'])}"

    def wrap(self, kind: str, tags: list[str], inside: str) -> str:
        r = self.rng
        tag, name = r.choice(tags), r.choice(self.NAMES[kind])
        attribute = r.choice([f' class="{name}"', f' id="{name}"', f' class="{name} c{r.randint(0, 9)}"', ""]) if tag != "div" else r.choice([f' class="{name}"', f' id="{name}"', f' class="box {name}"'])
        return f"<{tag}{attribute}>{inside}</{tag}>"

    def links(self, n: int, keep: bool = False) -> str:
        items = [f'<a href="/x">{self.say(1, 4, keep, 0.3)}</a>' for _ in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.rng.random() < 0.7 else "".join(f"<p>{x}</p>" for x in items) if self.rng.random() < 0.3 else " ".join(items)

    def junk(self, kind: str) -> str:
        r = self.rng
        line = lambda a=2, b=25: self.say(a, b, False, r.choice([0.0, 0.0, 0.3]))
        para = lambda: r.choice([f"<p>{line(4, 60)}</p>", line(), f"<span>{line()}</span>", f"<h3>{line(1, 5)}</h3><p>{line(5, 40)}</p>"])
        if kind == "menu":
            return self.wrap("menu", ["nav", "nav", "div", "ul"], self.links(r.randint(2, 9)))
        if kind == "top":
            return self.wrap("top", ["header", "header", "div"], r.choice([f"<h1>{line(1, 4)}</h1>", f"<a href='/'>{line(1, 4)}</a>", para()]) + (self.links(r.randint(2, 5)) if r.random() < 0.5 else ""))
        if kind == "bottom":
            return self.wrap("bottom", ["footer", "footer", "div"], r.choice([f"&copy; {self.host()} &middot; {line(2, 30)}", f"{line(2, 30)}", f"<p>{line(2, 40)}</p>", self.links(3) + line(2, 10)]))
        if kind == "side":
            return self.wrap("side", ["aside", "aside", "div", "section"], f"<h3>{line(1, 4)}</h3>" + r.choice([self.links(r.randint(2, 6)), para(), para() + para()]))
        if kind == "form":
            return r.choice([f"<form><label>{line(1, 4)}</label><input type=text><button>{line(1, 2)}</button></form>", self.wrap("form", ["form", "div"], f"<p>{line(2, 20)}</p><select><option>{line(1, 2)}</option><option>{line(1, 2)}</option></select><button>{line(1, 3)}</button>")])
        if kind == "comments":
            one = lambda: r.choice([f'<li class="comment"><p>{line(3, 60)}</p></li>', f'<div class="comment"><b>{line(1, 2)}</b><p>{line(3, 60)}</p></div>', f'<article class="comment"><p>{line(3, 60)}</p></article>', f"<p>{line(3, 60)}</p>"])
            return self.wrap("comments", ["section", "div", "div", "ol"], (f"<h2>{line(1, 3)}</h2>" if r.random() < 0.5 else "") + "".join(one() for _ in range(r.randint(1, 6))))
        return self.wrap(kind, ["div", "div", "section", "aside"] if kind in ("notice", "advert") else ["div", "ul", "p"], "".join(para() for _ in range(r.randint(1, 2))))

    def article(self, small: bool = False) -> str:
        r = self.rng
        parts = [f"<h1>{self.say(2, 14, True)}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8, 14])):
            kind = r.random()
            if kind < 0.74:
                end = r.choice(["</p>", "</p>", "</p>", ""])
                parts.append(r.choice(["<p>", "<p>", "<p><b>", "<p class='lead'>"]) + self.say(*r.choice([(1, 6), (8, 60), (40, 160)]), True) + r.choice(["", "", "<br>"]) + end)
            elif kind < 0.80:
                parts.append(f"<h2>{self.say(1, 8, True)}</h2>")
            elif kind < 0.86:
                parts.append("<ul>" + "".join(f"<li>{self.say(1, 20, True)}</li>" for _ in range(r.randint(1, 4))) + "</ul>")
            elif kind < 0.89:
                parts.append(f"<blockquote><p>{self.say(4, 40, True)}</p></blockquote>")
            elif kind < 0.91:
                parts.append("<table><tr>" + "".join(f"<td>{self.say(1, 5, True)}</td>" for _ in range(3)) + "</tr></table>")
            elif kind < 0.93:
                parts.append(f"<figure><img src=x><figcaption>{self.say(2, 15, True)}</figcaption></figure>")
            else:
                parts.append(self.junk(r.choice(["advert", "share", "side", "form", "notice", "menu"])))
        if r.random() < 0.3 and not parts:
            parts.append(f"<p>{self.say(2, 20, True)}")
        inside = "".join(parts)
        kind = r.random()
        if kind < 0.6:
            return f"<article>{inside}</article>"
        if kind < 0.7:
            return f"<main><article>{inside}</article></main>"
        if kind < 0.8:
            return f"<main>{inside}</main>"
        return self.wrap("main", ["div", "div", "section"], inside)

    def page(self) -> str:
        r = self.rng
        before = [self.junk(k) for k, p in (("notice", 0.25), ("top", 0.35), ("menu", 0.75), ("form", 0.15), ("advert", 0.5), ("side", 0.15)) if r.random() < p]
        after = [self.junk(k) for k, p in (("share", 0.2), ("advert", 0.2), ("side", 0.35), ("comments", 0.35), ("form", 0.2), ("bottom", 0.8), ("notice", 0.2)) if r.random() < p]
        if r.random() < 0.3:
            r.shuffle(before)
        body = "".join(before) + self.article() + "".join(after)
        if r.random() < 0.2:
            body = f'<div id="{r.choice(["page", "wrapper", "container", "root"])}">{body}</div>'
        return f"<html><head><title>{self.say(2, 10, False)}</title><style>p{{}}</style></head><body>{body}" + r.choice(["</body></html>", ""])


@functools.lru_cache(maxsize=1)
def trained() -> dict[str, np.ndarray]:
    """Weights of the labeller; the same on every machine up to rounding, in a few seconds."""
    pages, labels = [], []
    maker = _Maker(random.Random(SEED))
    for _ in range(PAGES):
        blocks = split_blocks(maker.page())
        labels.append(np.array([any(w in maker.keep for w in b.text.split()[:5]) for b in blocks], np.float32))
        pages.append(features([Block(b.node, _SERIAL.sub("", b.text) or b.text, b.linked) for b in blocks]))
    rng = np.random.default_rng(SEED)
    w = {}
    for side in "fb":
        w["x" + side] = rng.normal(0, 0.2, (INPUT, 4 * HIDDEN)).astype(np.float32)
        w["h" + side] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        w["b" + side] = np.zeros(4 * HIDDEN, np.float32)
        w["b" + side][HIDDEN : 2 * HIDDEN] = 1
    w["out"], w["bias"] = rng.normal(0, 0.3, (2 * HIDDEN, 1)).astype(np.float32), np.zeros(1, np.float32)
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for epoch in range(PASSES):
        order = sorted(rng.permutation(PAGES).tolist(), key=lambda k: len(pages[k]) // 4)
        batches = [order[i : i + STEP] for i in range(0, PAGES, STEP)]
        rng.shuffle(batches)
        rate = 0.01 * (0.6**epoch)
        for batch in batches:
            batch = [k for k in batch if len(pages[k])]
            x, mask = _padded([pages[k] for k in batch])
            y = np.zeros(mask.shape, np.float32)
            for c, k in enumerate(batch):
                y[: len(labels[k]), c] = labels[k]
            hf, tf, _ = _forward(w, "f", x, mask, True)
            hb, tb, _ = _forward(w, "b", x, mask, True)
            both = np.concatenate([hf, hb], axis=2)
            p = 1 / (1 + np.exp(-np.clip(both @ w["out"] + w["bias"], -30, 30)))
            d = ((p[..., 0] - y) * mask)[..., None] / mask.sum()
            grads = {k: np.zeros_like(v) for k, v in w.items()}
            grads["out"] += both.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, 1)
            grads["bias"] += d.sum()
            back = d @ w["out"].T
            _backward(w, "f", x, tf, back[..., :HIDDEN], grads)
            _backward(w, "b", x, tb, back[..., HIDDEN:], grads)
            step += 1
            norm = max(1.0, float(np.sqrt(sum((g**2).sum() for g in grads.values()))))
            for k, g in grads.items():
                g /= norm
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return w


def extract_main(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add ``text``: the blocks that the labeller keeps, in page order, joined by line feeds.

    Null and empty pages, and pages of which nothing is kept, give an empty string. A column of that name is
    replaced; all others stay.
    """
    weights = trained()

    def make(column: pa.Array) -> pa.Array:
        out = []
        for i in range(0, len(column), 256):
            out += main_text(weights, column.slice(i, 256).to_pylist())
        return pa.array(out, pa.string())

    return map_column(pages, html, text, "string", make)


def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every row of ``pages``."""
    found = extract_main(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
