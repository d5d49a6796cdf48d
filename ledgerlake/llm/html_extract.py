"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks, runs of text between block-level
tags.  A block is read as a vector: the hashed names (and class, id and role
words) of the elements it stands in, its hashed words, and a few counts.  A
bidirectional LSTM in numpy runs over all blocks of the page, so each block is
labelled in the light of the whole document; blocks of one container are
decided together.  The text of a page is its accepted blocks in page order.

Training: at most ``sample_pages`` different pages (those with the least hash of
their html) are taken to the driver.  Structure gives their labels: blocks inside
``article`` or ``main`` are text, others are not.  As real pages name these
things differently, the network is also trained on variants of the sample
in which the article is marked up in other ways and sidebars, notices, adverts,
forms and reader comments with words of other sample pages are put in.

Scale: labelling is a narrow map, no shuffle; a task holds a few pages at a
time.  The model and its sample have a fixed size.

Defined results: null and empty html give the empty text; a page without an
accepted block gives the empty text; repeated rows are treated alike; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_SIZE, WORD_SIZE, COUNTS = 128, 24, 6
INPUT = PATH_SIZE + WORD_SIZE + COUNTS

#: Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe noembed noframes xmp".split())
INLINE = set("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark
 q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br input""".split())
SPACED = {"br", "img", "input", "wbr"} - {"wbr"}
#: an open element of the first kind ends where one of the second kind starts
CLOSED_BY = {
    "p": set("""address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6
 header hr main nav ol p pre section table ul""".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
WHITE = re.compile(r"[\s]+")
MARK = re.compile("[\"'>]")
TAG_NAME, NAME_END = re.compile("<(/?)[a-zA-Z]"), re.compile(r"[\s/>]")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME_WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Labeller:
    sample_pages: int = 300
    max_sample_chars: int = 40_000   # longer pages are not used for training,
    max_sample_depth: int = 100      # nor are more deeply nested ones
    hidden: int = 16
    epochs: int = 6
    batch: int = 32
    rate: float = 0.01
    seed: int = 7


def _hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace"))


class Node:
    """An open element: its name and the words of its class, id and role, and
    the element it stands in.  Blocks share nodes, so a path costs nothing."""
    __slots__ = ("entry", "parent", "depth", "number", "inside", "vector")

    def __init__(self, entry: tuple, parent: Node | None, number: int = 0):
        self.entry, self.parent, self.number = entry, parent, number
        self.depth = parent.depth + 1 if parent else 0
        self.inside = entry[0] in TEXT_HOLDERS or bool(parent and parent.inside and entry[0] not in OUTSIDE)
        self.vector: np.ndarray | None = None

    def path(self) -> tuple:
        """The entries from the root down."""
        out, node = [], self
        while node.parent:
            out.append(node.entry)
            node = node.parent
        return tuple(reversed(out))

    @staticmethod
    def at(path: tuple) -> Node:
        node = ROOT
        for entry in path:
            node = Node(entry, node)
        return node


TEXT_HOLDERS, OUTSIDE = {"article", "main"}, {"nav", "aside", "footer", "header", "form"}
ROOT = Node(("",), None)


class Block:
    __slots__ = ("text", "node", "container", "linked")

    def __init__(self, text: str, node: Node, container: int, linked: int):
        self.text, self.node, self.container, self.linked = text, node, container, linked


class TagEnds:
    """Where tags end: at the first ``>`` outside quotes.  Each quote of a page
    is followed once, so pages of unclosed tags and quotes cost one pass."""

    def __init__(self, html: str):
        found = [(m.start(), m[0]) for m in MARK.finditer(html)]
        self.places = [p for p, _ in found]
        follow: list[int] = [-1] * len(found)      # of a quote: the next of its kind
        last = {}
        for k in range(len(found) - 1, -1, -1):
            c = found[k][1]
            follow[k] = last.get(c, -1)
            last[c] = k
        # outside quotes and before mark k, the tag ends at mark ends[k]
        self.ends = [-1] * (len(found) + 1)
        for k in range(len(found) - 1, -1, -1):
            if found[k][1] == ">":
                self.ends[k] = k
            elif follow[k] >= 0:
                self.ends[k] = self.ends[follow[k] + 1]

    def of(self, start: int) -> int:
        """The place of the ``>`` that ends the tag at ``start``; -1 if none."""
        k = self.ends[bisect_left(self.places, start)]
        return self.places[k] if k >= 0 else -1


def blocks(html: str) -> list[Block]:
    """The leaf blocks of a page in order.  A tag that never ends is text; a
    comment or declaration that never ends takes the rest of the page."""
    out: list[Block] = []
    stack: list[tuple[str, Node]] = []
    piece: list[str] = []
    open_names: Counter[str] = Counter()
    ends = TagEnds(html)
    linked = number = 0
    link_at = -1               # depth of the stack where a link is open

    def end_block() -> None:
        nonlocal linked
        if piece:
            text = WHITE.sub(" ", unescape("".join(piece))).strip()
            if text:
                node = stack[-1][1] if stack else ROOT
                out.append(Block(text, node, node.parent.number if node.parent else 0, linked))
            piece.clear()
        linked = 0

    def pop_to(k: int) -> None:
        nonlocal link_at
        for name, _ in stack[k:]:
            open_names[name] -= 1
        del stack[k:]
        if link_at > k:
            link_at = -1

    at, size = 0, len(html)
    while at < size:
        start = html.find("<", at)
        # text up to the next thing that is a tag
        tag = TAG_NAME.match(html, start) if start >= 0 else None
        end = -1
        if start >= 0 and html.startswith("<!--", start):
            end = html.find("-->", start + 4) + 3
            end = end if end > 2 else size
        elif start >= 0 and html[start + 1:start + 2] in ("!", "?"):
            end = html.find(">", start) + 1 or size
        elif tag and (closed := ends.of(start)) >= 0:
            end = closed + 1
        stop = size if start < 0 else start + (end < 0)
        if stop > at:
            piece.append(html[at:stop])
            if link_at >= 0 and len(stack) - link_at <= 2:
                linked += stop - at
        if end < 0:
            at = stop
            continue
        at = end
        if not tag:
            continue
        # a name ends at white space, a slash or the end of the tag
        body = html[tag.end() - 1:end - 1]
        written = NAME_END.split(body, maxsplit=1)[0]
        name, attributes, closing = written.lower(), body[len(written):], bool(tag[1])
        if name in INLINE:
            if name in SPACED:
                piece.append(" ")
            if name == "a":
                link_at = -1 if closing else len(stack)
            continue
        end_block()
        if closing:
            if open_names[name]:
                k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
                pop_to(k)
            continue
        for k in range(len(stack) - 1, -1, -1):
            if name in CLOSED_BY.get(stack[k][0], ()):
                pop_to(k)
                break
            if stack[k][0] not in CLOSED_BY:
                break
        if name in RAW:
            raw_end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
            at = raw_end.end() if raw_end else size
        elif name not in VOID and not attributes.endswith("/"):
            number += 1
            words = NAME_WORD.findall(" ".join(a or b or c for a, b, c in NAMED.findall(attributes)).lower()) \
                if attributes else []
            stack.append((name, Node((name, *words), stack[-1][1] if stack else ROOT, number)))
            open_names[name] += 1
    end_block()
    return out


class Reader:
    """Vectors of blocks; remembers hashed words and paths up to a bound."""

    def __init__(self, bound: int = 200_000):
        self.words: dict[str, int] = {}
        self.entries: dict[tuple, list[int]] = {}
        self.bound = bound

    def word(self, w: str) -> int:
        k = self.words.get(w)
        if k is None:
            if len(self.words) >= self.bound:
                self.words.clear()
            k = self.words[w] = _hash(w) % WORD_SIZE
        return k

    def path(self, node: Node) -> np.ndarray:
        """The vector of a path: that of the path above it and its own entry."""
        way = []
        while node.vector is None and node.parent:
            way.append(node)
            node = node.parent
        v = node.vector if node.vector is not None else np.zeros(PATH_SIZE, np.float32)
        for node in reversed(way):
            v = v.copy()
            v[self.marks(node.entry)] = 1
            node.vector = v
        return v

    def marks(self, entry: tuple) -> list[int]:
        """The places of an entry in the vector."""
        found = self.entries.get(entry)
        if found is None:
            if len(self.entries) >= self.bound // 10:
                self.entries.clear()
            found = self.entries[entry] = [_hash(f"{min(j, 1)}{name}{end}") % PATH_SIZE
                                           for j, name in enumerate(entry) for end in ("", "!")]
        return found

    def matrix(self, page: list[Block]) -> np.ndarray:
        x = np.zeros((len(page), INPUT), np.float32)
        for i, b in enumerate(page):
            w = b.text.split(" ")
            x[i, :PATH_SIZE] = self.path(b.node)
            n = np.bincount([self.word(v) for v in w], minlength=WORD_SIZE)
            x[i, PATH_SIZE:PATH_SIZE + WORD_SIZE] = n / len(w)
            x[i, -COUNTS:] = (np.log1p(len(b.text)) / 5, np.log1p(len(w)) / 4,
                              min(1, b.linked / len(b.text)), b.text[-1] in ".!?",
                              i / len(page), 1 / (1 + i))
        return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """Two LSTMs, one per direction, and a logistic output on both states."""

    def __init__(self, hidden: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p["w" + d] = rng.normal(0, 0.1, (INPUT, 4 * hidden)).astype(np.float32)
            self.p["u" + d] = rng.normal(0, 0.2, (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1
            self.p["c" + d] = bias
        self.p["v"] = rng.normal(0, 0.2, 2 * hidden).astype(np.float32)
        self.p["o"] = np.zeros(1, np.float32)

    def run(self, x: np.ndarray, d: str, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """x: steps, pages, inputs.  Padded steps leave the state as it is."""
        n, pages, h = len(x), x.shape[1], self.h
        wx = x @ self.p["w" + d] + self.p["c" + d]
        s, c = np.zeros((pages, h), np.float32), np.zeros((pages, h), np.float32)
        out = np.zeros((n, pages, h), np.float32)
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            z = wx[t] + s @ self.p["u" + d]
            i, f, o = _sigmoid(z[:, :h]), _sigmoid(z[:, h:2 * h]), _sigmoid(z[:, 2 * h:3 * h])
            g = np.tanh(z[:, 3 * h:])
            m = mask[t][:, None]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            if keep is not None:
                keep.append((t, s, c, i, f, o, g, tc, m))
            c = m * c2 + (1 - m) * c
            s = m * (o * tc) + (1 - m) * s
            out[t] = s
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate((self.run(x, "f", mask), self.run(x, "b", mask)), axis=2)
        return both @ self.p["v"] + self.p["o"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        h, kept = self.h, {"f": [], "b": []}
        out = {d: self.run(x, d, mask, kept[d]) for d in "fb"}
        both = np.concatenate((out["f"], out["b"]), axis=2)
        err = (_sigmoid(both @ self.p["v"] + self.p["o"]) - y) * mask / mask.sum()
        g = {"v": np.einsum("tp,tph->h", err, both), "o": np.array([err.sum()], np.float32)}
        for k, d in enumerate("fb"):
            down = err[:, :, None] * self.p["v"][k * h:(k + 1) * h]
            u, gu, dz_all = self.p["u" + d], np.zeros_like(self.p["u" + d]), np.zeros((*x.shape[:2], 4 * h), np.float32)
            ds, dc = np.zeros_like(down[0]), np.zeros_like(down[0])
            for t, s0, c0, i, f, o, a, tc, m in reversed(kept[d]):
                ds = ds + down[t]
                dout, dcell = ds * m, dc * m
                dc2 = dcell + dout * o * (1 - tc * tc)
                dz = np.concatenate((dc2 * a * i * (1 - i), dc2 * c0 * f * (1 - f),
                                     dout * tc * o * (1 - o), dc2 * i * (1 - a * a)), axis=1)
                dz_all[t] = dz
                gu += s0.T @ dz
                ds = ds * (1 - m) + dz @ u.T
                dc = dc * (1 - m) + dc2 * f
            g["u" + d], g["c" + d] = gu, dz_all.sum(axis=(0, 1))
            g["w" + d] = np.einsum("tpi,tpz->iz", x, dz_all, optimize=True)
        return g


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = max(map(len, pages))
    x, mask = np.zeros((n, len(pages), INPUT), np.float32), np.zeros((n, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[:len(p), k], mask[:len(p), k] = p, 1
    return x, mask


def weak_label(b: Block) -> int:
    """Whether a block stands in an article or main element, and in none of
    ``OUTSIDE`` inside it."""
    return int(b.node.inside)


def _variant(page: list[Block], words: list[str], rng: random.Random) -> tuple[list[Block], list[int]]:
    """Another page with the same article: other names around it, and other
    things beside, inside and after it."""
    article = [b for b in page if weak_label(b)]
    rest = [b for b in page if not weak_label(b)]
    base = (("html",), ("body",), *(rng.choice([(), (("div", "wrapper"),), (("div", "page", "container"),)])))
    own = rng.choice([(("article",),), (("main",),), (("main",), ("article",)), (("div", "content"),),
                      (("div", "post", "content"),), (("div", "entry", "content"),),
                      (("article", "post"), ("div", "body")), (("section", "article"),),
                      (("div", "story", "text"),), (("div", "entry", "text"),), (("div", "article", "body"),),
                      (("div", "".join(rng.choices("abcdefghiklmnoprstu", k=rng.randint(3, 9)))),)])
    number = iter(range(1_000_000, 2_000_000))
    paths = [b.node.path() for b in article]
    depth = next((k for p in paths for k, e in enumerate(p) if e[0] in TEXT_HOLDERS), 0)
    holder, seq, y = next(number), [], []

    def some(lo: int, hi: int) -> str:
        return " ".join(rng.choice(words) for _ in range(rng.randint(lo, hi)))

    def put(path: tuple, n: int, lo: int, hi: int, link: bool = False) -> None:
        box = next(number)
        for _ in range(n):
            text = some(lo, hi)
            seq.append(Block(text, Node.at(path), box, len(text) if link else 0))
            y.append(0)

    def aside(inside: tuple) -> None:
        kind = rng.choice(["aside", "aside2", "ad", "ad2", "form", "notice", "cookie", "share", "related"])
        p = {"aside": (("aside",), ("p",)), "aside2": (("div", "sidebar"), ("ul",), ("li",)),
             "ad": (("div", "ad"),), "ad2": (("div", "advert", "sponsored"), ("p",)),
             "form": (("form",), ("div",)), "notice": (("div", "notice"), ("p",)),
             "cookie": (("div", "cookie", "banner"), ("p",)), "share": (("div", "share", "social"), ("ul",), ("li",)),
             "related": (("section", "related"), ("ul",), ("li",))}[kind]
        put(inside + p, rng.randint(1, 4), 3, 30, kind in ("share", "related", "aside2"))

    if rng.random() < 0.6:
        put(base + (("header",), ("h1",)) if rng.random() < 0.5 else base + (("div", "header"),), 1, 1, 8)
    if rng.random() < 0.7:
        put(base + (("nav",), ("ul",), ("li",)) if rng.random() < 0.6 else base + (("div", "menu"), ("ul",), ("li",)),
            rng.randint(2, 8), 1, 3, True)
    for b in rest:
        if rng.random() < 0.3:
            seq.append(b)
            y.append(0)
    for _ in range(rng.randint(0, 2)):
        aside(base)
    hole = rng.randint(1, max(1, len(article)))
    for k, b in enumerate(article):
        if k == hole and rng.random() < 0.8:
            aside(base + own)
        tail = paths[k][depth + 1:]
        if rng.random() < 0.1:
            tail = rng.choice([(("blockquote",), ("p",)), (("ul",), ("li",)), (("h2",),), (("pre",),)])
        seq.append(Block(b.text, Node.at(base + own + tail), holder, b.linked if rng.random() < 0.8 else len(b.text) // 4))
        y.append(1)
    if rng.random() < 0.5:
        where = base + own if rng.random() < 0.3 else base
        put(where + rng.choice([(("section", "comments"), ("p",)), (("div", "comments"), ("div", "comment"), ("p",)),
                                (("ol", "commentlist"), ("li", "comment"), ("p",)),
                                (("div", "discussion"), ("p",)), (("div", "replies"), ("div", "reply"), ("p",)),
                                (("section", "responses"), ("div", "response"))]), rng.randint(1, 5), 4, 60)
    for _ in range(rng.randint(0, 2)):
        aside(base)
    if rng.random() < 0.8:
        put(base + (("footer",),) if rng.random() < 0.6 else base + (("div", "footer"), ("p",)), rng.randint(1, 3), 2, 20)
    return seq, y


def train(sample: list[str], how: Labeller) -> BiLstm:
    rng, reader = random.Random(how.seed), Reader()
    # (a page nested without end would cost its depth for every block)
    pages = [p for p in map(blocks, sample) if p and max(b.node.depth for b in p) <= how.max_sample_depth]
    words = [w for p in pages for b in p for w in b.text.split(" ")][:200_000] or ["word"]
    pages = pages or [[Block("word word word.", Node.at((("html",), ("body",), ("article",), ("p",))), 1, 0)]]
    data = []
    for p in pages:
        data.append((reader.matrix(p), np.array([weak_label(b) for b in p], np.float32)))
        if any(weak_label(b) for b in p):
            for _ in range(2):
                q, y = _variant(p, words, rng)
                data.append((reader.matrix(q), np.array(y, np.float32)))
    net = BiLstm(how.hidden, how.seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(w) for k, w in net.p.items()}
    step = 0
    for epoch in range(how.epochs):
        order = sorted(range(len(data)), key=lambda i: (len(data[i][0]) + rng.random() * 8))
        batches = [order[i:i + how.batch] for i in range(0, len(order), how.batch)]
        rng.shuffle(batches)
        for b in batches:
            x, mask = padded([data[i][0] for i in b])
            y = np.zeros(mask.shape, np.float32)
            for k, i in enumerate(b):
                y[:len(data[i][1]), k] = data[i][1]
            step += 1
            rate = how.rate * (1 - 0.7 * epoch / how.epochs)
            for k, g in net.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net.p[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                             / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def main_texts(pages: list[str], net: BiLstm, reader: Reader) -> list[str]:
    """The main text of each page."""
    parsed = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if parsed[k]), key=lambda k: len(parsed[k]))
    at = 0
    while at < len(order):
        some = [order[at]]
        at += 1
        while at < len(order) and len(some) < 64 and (len(some) + 1) * len(parsed[order[at]]) < 20_000:
            some.append(order[at])
            at += 1
        x, mask = padded([reader.matrix(parsed[k]) for k in some])
        score = net.logits(x, mask)
        for j, k in enumerate(some):
            by_holder: dict[tuple, float] = {}
            for b, s in zip(parsed[k], score[:, j]):
                key = (b.container, b.node.entry)
                by_holder[key] = by_holder.get(key, 0.0) + float(s)
            out[k] = " ".join(b.text for b in parsed[k] if by_holder[b.container, b.node.entry] > 0)
    return out


def _sample(pages: DataFrame, how: Labeller) -> list[str]:
    """At most ``sample_pages`` different pages, those of least hash.  Only hashes
    are ordered: the page of a hash is fetched when the greatest one is known."""
    hashed = pages.where(F.length("html").between(1, how.max_sample_chars)).select(
        "html", F.xxhash64("html").alias("h"))
    n, share = hashed.count(), 0
    while share < 1:
        # the least hashes lie in a small share of their range
        share = min(1.0, max(4 * how.sample_pages / max(n, 1), 16 * share))
        below = F.col("h") <= F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))
        least = [r.h for r in hashed.where(below).select("h").distinct().orderBy("h").limit(how.sample_pages).collect()]
        if len(least) == how.sample_pages:
            break
    if not least:
        return []
    found = hashed.where(F.col("h") <= least[-1]).groupBy("h").agg(F.min("html").alias("html"))
    return [r.html for r in sorted(found.collect(), key=lambda r: r.h)]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            how: Labeller = Labeller()) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    given = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                         F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    net = train(_sample(given, how), how)
    kinds = given.drop("html").schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for b in batches:
            for s in range(0, len(b), 256):
                part = b.slice(s, 256)
                text = main_texts([v.as_py() for v in part.column(2)], net, reader)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(text, pa.string()),
                     pa.array([len(t) for t in text], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return given.mapInArrow(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds)
                            + ", text string, n_chars long")
