"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks: runs of text between block-level tags, with
the path of open tags (and their class, id and role words). Each block is a vector: a
hashed bag of its path, a hashed bag of all its words, and a few lengths. A bidirectional LSTM
in numpy reads the whole sequence, so each block is judged in the context of the whole
page, and a logistic output marks it as main text or not.

The labeller is trained here. A hash-chosen sample of about ``MAX_PAGES`` pages, or of fewer
where those would hold more than about ``MAX_CHARS`` characters together, gives texts; no page
is left out for its length or its tags. The texts are laid out anew under varied templates
(article, main or classed containers; headers, menus, sidebars, notices, adverts, forms,
comments), whose blocks have known labels, beside the pages themselves where semantic tags
label them plainly. Where they don't, a rough guess tells which texts fill the templates'
main part; the labels are those of the templates. A training sequence of more than
``max_steps`` blocks keeps its first and last halves, and a layout takes at most ``max_main``
main texts, spread over the page. Extraction reads every page whole, in memory that follows
the page's length: an open tag keeps its path as one vector, which its blocks share.

Text of scripts, styles, head and comments never forms blocks. Character references are
decoded, white space inside a block becomes one space, blocks are trimmed and joined by
one space in page order.

Defined cases: null and empty html, pages without blocks or without main text give an
empty string; unclosed and stray tags are tolerated; repeated rows are extracted alike;
a table without any text has nothing to train on, and nothing is called main text. Only id, url and html are read; the result has its own
columns.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape
from html.parser import HTMLParser
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, grouped_by_bytes, unit_hash

MAX_PAGES = 240
MAX_CHARS = 4_800_000
MAX_STEPS = 2000
MAX_MAIN = 30
HIDDEN = 16
PATH_DIM, WORD_DIM = 96, 24
#: Tags by their role in the page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
SILENT = set("script style head title noscript template svg math iframe object canvas".split())
CLOSES_P = set("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = set("ul ol dl table select".split())
_WORD = re.compile(r"[^\W_]+")
#: Containers that the templates use, as (tag, class).
MAIN = [("article", ""), ("main", ""), ("article", "post"), ("div", "content"), ("div", "post-body"), ("div", "entry-content"), ("section", "article-body"), ("div", "story"), ("main", "main-content")]
AROUND = {
    "top": [("header", ""), ("header", "site-header"), ("div", "header"), ("div", "masthead"), ("nav", ""), ("nav", "menu"), ("div", "navbar"), ("ul", "menu"), ("div", "breadcrumbs"), ("div", "topbar")],
    "notice": [("div", "cookie-notice"), ("div", "cookie"), ("div", "notice"), ("div", "banner"), ("div", "alert"), ("div", "consent"), ("div", "newsletter"), ("section", "subscribe")],
    "ad": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "sponsored"), ("aside", "promo"), ("div", "advertisement")],
    "side": [("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "related"), ("div", "widget"), ("section", "related-posts"), ("div", "share"), ("div", "tags")],
    "form": [("form", ""), ("form", "search"), ("form", "login"), ("div", "form")],
    "comments": [("div", "comments"), ("section", "comments"), ("div", "comment"), ("ol", "comment-list"), ("section", "discussion")],
    "bottom": [("footer", ""), ("footer", "site-footer"), ("div", "footer"), ("div", "copyright"), ("nav", "footer-nav")],
}
_AROUND_TAGS = set("nav header footer aside form".split())
_AROUND_WORDS = {f".{w}" for places in AROUND.values() for _, name in places for w in _WORD.findall(name)} - {".post", ".site", ".list"}


class Path:
    """Open tags from the root to one that forms blocks, as its hashed words and two marks."""

    __slots__ = ("parent", "words", "semantic", "around", "vector")

    def __init__(self, parent: Path | None, tag: str, words: list[str]) -> None:
        self.parent, self.words, self.vector = parent, words, None
        self.semantic = tag in ("article", "main") or (parent is not None and parent.semantic)
        self.around = tag in _AROUND_TAGS or not _AROUND_WORDS.isdisjoint(words) or (parent is not None and parent.around)

    def hashed(self, cache: dict[str, tuple[int, float]]) -> np.ndarray:
        """The vector of the path, made once a tag from that of the tag around it."""
        new, at = [], self
        while at is not None and at.vector is None:
            new.append(at)
            at = at.parent
        vector = at.vector if at is not None else np.zeros(PATH_DIM, np.float32)
        for path in reversed(new):
            vector = vector.copy()
            for w in path.words:
                i, sign = _slot(w, PATH_DIM, cache)
                vector[i] = sign
            path.vector = vector
        return vector


_NOWHERE: list[int] = []


class Blocks(HTMLParser):
    """Leaf blocks of a page: (path, text, characters inside links)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, Path]] = []
        self.places: dict[str, list[int]] = {}  # open places of each tag in the stack
        self.lists: list[int] = []  # and of those that hold siblings together
        self.root = Path(None, "", [])
        self.silent = 0
        self.text: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[Path, str, int]] = []

    def end_block(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((self.stack[-1][1] if self.stack else self.root, text, self.linked))
        self.text, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            if tag not in INLINE:
                self.end_block()
            return
        if tag == "body":
            while self.stack and self.stack[-1][0] != "html":
                self.close_top()
        if tag not in INLINE:
            self.end_block()
            if tag in CLOSES_P and self.places.get("p"):
                self.close("p")
            for other in SIBLINGS.get(tag, ()):
                if self.open_in_list(other):
                    self.close(other)
        above = self.stack[-1][1] if self.stack else self.root
        path = above  # inline tags add nothing to the path
        if tag not in INLINE:
            words = [tag]
            for name, value in attrs:
                if name in ("class", "id", "role") and value:
                    words += [f".{w.lower()}" for w in _WORD.findall(value)]
            path = Path(above, tag, words)
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in LISTS:
            self.lists.append(len(self.stack))
        self.stack.append((tag, path))
        self.silent += tag in SILENT

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def open_in_list(self, tag: str) -> bool:
        at = self.places.get(tag, _NOWHERE)
        return bool(at) and (not self.lists or at[-1] >= self.lists[-1])

    def close_top(self) -> None:
        tag = self.stack.pop()[0]
        self.places[tag].pop()
        if tag in LISTS:
            self.lists.pop()
        self.silent -= tag in SILENT

    def close(self, tag: str) -> None:
        while self.stack:
            top = self.stack[-1][0]
            self.close_top()
            if top == tag:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag not in INLINE:
            self.end_block()
        if self.places.get(tag):
            self.close(tag)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.text.append(data)
            if any(t == "a" for t, _ in self.stack[-6:]):
                self.linked += len(data.strip())


Block = tuple[Path, str, int]


def leaf_blocks(html: str | None) -> list[Block]:
    parser = Blocks()
    parser.feed(html or "")
    HTMLParser.close(parser)  # flushes what is left of an unfinished tag or reference
    parser.end_block()
    return parser.blocks


def _slot(word: str, dim: int, cache: dict[str, tuple[int, float]]) -> tuple[int, float]:
    if word not in cache:
        h = zlib.crc32(word.encode("utf-8", "replace"))
        cache[word] = (h >> 1) % dim, 1.0 if h & 1 else -1.0
    return cache[word]


class WordSlots(dict):
    """Place of each word in the hashed bag, negative signs in its second half."""

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        i, sign = _slot(word, WORD_DIM, {})
        self[word] = slot = i if sign > 0 else i + WORD_DIM
        return slot


def block_vectors(blocks: list[Block], paths: dict, words: WordSlots) -> np.ndarray:
    """Hashed path, hashed bag of all words (scaled to length one where there are many),
    and lengths."""
    n = len(blocks)
    x = np.zeros((n, PATH_DIM + WORD_DIM + 4), np.float32)
    if not n:
        return x
    x[:, :PATH_DIM] = [path.hashed(paths) for path, _, _ in blocks]
    tokens = [text.lower().split() for _, text, _ in blocks]
    many = np.array([len(t) for t in tokens])
    slots = np.fromiter(map(words.__getitem__, chain.from_iterable(tokens)), np.int64, int(many.sum()))
    bag = np.bincount(np.repeat(np.arange(n) * (2 * WORD_DIM), many) + slots, minlength=n * 2 * WORD_DIM).reshape(n, -1)
    signed = (bag[:, :WORD_DIM] - bag[:, WORD_DIM:]).astype(np.float32)
    x[:, PATH_DIM:-4] = signed / np.maximum(8.0, np.sqrt((signed * signed).sum(1)))[:, None]
    sizes = np.array([len(text) for _, text, _ in blocks])
    x[:, -4], x[:, -3] = np.log1p(sizes) / 8, np.log1p(many) / 6
    x[:, -2], x[:, -1] = np.array([linked for _, _, linked in blocks]) / np.maximum(sizes, 1), 1.0
    return x


@dataclass
class Labeller:
    """LSTM weights of both directions (input and state to the four gates) and the output."""

    wx: list[np.ndarray]
    wh: list[np.ndarray]
    out: np.ndarray
    bias: float


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _direction(x: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, keep: bool):
    """Runs one LSTM over (steps, pages, inputs); ``mask`` freezes the state of padding."""
    steps, pages, _ = x.shape
    hid = wh.shape[0]
    zx = (x.reshape(-1, x.shape[2]) @ wx).reshape(steps, pages, -1)
    h, c = np.zeros((pages, hid), np.float32), np.zeros((pages, hid), np.float32)
    hs, tape = np.empty((steps, pages, hid), np.float32), []
    for t in range(steps):
        z = zx[t] + h @ wh
        gates = _sigmoid(z[:, : 3 * hid])
        i, f, o, g = gates[:, :hid], gates[:, hid : 2 * hid], gates[:, 2 * hid :], np.tanh(z[:, 3 * hid :])
        m = mask[t][:, None]
        new = f * c + i * g
        tc = np.tanh(new)
        if keep:
            tape.append((h, c, i, f, o, g, tc, m))
        c = np.where(m, new, c)
        h = np.where(m, o * tc, h)
        hs[t] = h
    return hs, tape


def _back(x: np.ndarray, tape: list, wh: np.ndarray, dhs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps, pages, hid = dhs.shape
    dz = np.zeros((steps, pages, 4 * hid), np.float32)
    dwh = np.zeros_like(wh)
    dh, dc = np.zeros((pages, hid), np.float32), np.zeros((pages, hid), np.float32)
    for t in reversed(range(steps)):
        h0, c0, i, f, o, g, tc, m = tape[t]
        dh = dh + dhs[t]
        d = np.where(m, dh, 0)
        dcn = np.where(m, dc, 0) + d * o * (1 - tc * tc)
        step = np.concatenate([dcn * g * i * (1 - i), dcn * c0 * f * (1 - f), d * tc * o * (1 - o), dcn * i * (1 - g * g)], axis=1)
        dz[t] = step
        dwh += h0.T @ step
        dh = np.where(m, step @ wh.T, dh)
        dc = np.where(m, dcn * f, dc)
    return x.reshape(-1, x.shape[2]).T @ dz.reshape(-1, 4 * hid), dwh


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32), np.zeros((steps, len(pages)), bool)
    for j, p in enumerate(pages):
        x[: len(p), j], mask[: len(p), j] = p, True
    return x, mask


def _states(model: Labeller, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    ahead, tape_a = _direction(x, mask, model.wx[0], model.wh[0], keep)
    behind, tape_b = _direction(x[::-1], mask[::-1], model.wx[1], model.wh[1], keep)
    return np.concatenate([ahead, behind[::-1]], axis=2), tape_a, tape_b


def train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 14, size: int = 24, rate: float = 0.01, seed: int = 11) -> Labeller:
    """Adam on the mean cross-entropy of the blocks."""
    rng, dim = np.random.default_rng(seed), PATH_DIM + WORD_DIM + 4

    def start(a: int, b: int) -> np.ndarray:
        return (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)

    model = Labeller([start(dim, 4 * HIDDEN) for _ in "ab"], [start(HIDDEN, 4 * HIDDEN) for _ in "ab"], start(2 * HIDDEN, 1)[:, 0], 0.0)
    if not pages:
        model.out, model.bias = model.out * 0, -30.0
        return model
    params = [*model.wx, *model.wh, model.out, np.zeros(1, np.float32)]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    order = np.argsort([len(p) for p in pages], kind="stable")
    batches = [order[a : a + size] for a in range(0, len(order), size)]
    for _ in range(epochs):
        for b in rng.permutation(len(batches)):
            x, mask = _padded([pages[j] for j in batches[b]])
            y = _padded([labels[j][:, None].astype(np.float32) for j in batches[b]])[0][:, :, 0]
            hs, tape_a, tape_b = _states(model, x, mask, keep=True)
            d = np.where(mask, _sigmoid(hs @ model.out + params[5][0]) - y, 0).astype(np.float32) / mask.sum()
            dhs = d[:, :, None] * model.out
            gx0, gh0 = _back(x, tape_a, model.wh[0], dhs[:, :, :HIDDEN])
            gx1, gh1 = _back(x[::-1], tape_b, model.wh[1], dhs[::-1, :, HIDDEN:])
            t += 1
            for j, g in enumerate((gx0, gx1, gh0, gh1, (hs * d[:, :, None]).sum((0, 1)), np.array([d.sum()]))):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                params[j] -= (rate * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    model.bias = float(params[5][0])
    return model


def label(model: Labeller, pages: list[np.ndarray], budget: int = 40_000) -> list[np.ndarray]:
    """Which blocks are main text, for every page; pages of like length share a pass."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = [j for j in sorted(range(len(pages)), key=lambda j: -len(pages[j])) if len(pages[j])]
    at = 0
    while at < len(order):
        many = max(1, min(256, budget // len(pages[order[at]])))
        part = order[at : at + many]
        x, mask = _padded([pages[j] for j in part])
        chosen = _states(model, x, mask)[0] @ model.out + model.bias > 0
        for j, k in enumerate(part):
            out[k] = chosen[: len(pages[k]), j]
        at += many
    return out


# -- training pages ----------------------------------------------------------------------

def plain_labels(blocks: list[Block]) -> np.ndarray | None:
    """Labels of a page whose tags say them plainly (an article or main element), else None."""
    if not any(path.semantic for path, _, _ in blocks):
        return None
    return np.array([path.semantic and not path.around for path, _, _ in blocks])


def laid_out(main: list[str], other: list[str], rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A page of the given main texts among the others under a random template."""
    parts: list[str] = []
    labels: list[bool] = []

    def pick(values: list):
        return values[int(rng.integers(len(values)))]

    def tagged(place: tuple[str, str], inner: str) -> str:
        tag, name = place
        named = "" if not name else f' {pick(["class", "class", "id"])}="{name}"'
        return f"<{tag}{named}>{inner}</{tag}>"

    def blocks(kind: str, n: int) -> str:
        out = []
        for _ in range(n):
            text = escape(pick(other))
            labels.append(False)
            if kind in ("top", "bottom", "side") and rng.random() < 0.6:
                out.append(f'<li><a href="/x">{text}</a></li>')
            elif kind == "form":
                out.append(f"<label>{text}</label><input>" if n == 1 else f"<p>{text}</p>")
            elif rng.random() < 0.5:
                out.append(f"<p>{text}</p>")
            else:
                out.append(f"<div>{text}</div>")
        return "".join(out)

    def around(kind: str) -> str:
        return tagged(pick(AROUND[kind]), blocks(kind, int(rng.integers(1, 6))))

    for kind in ("top", "top", "notice", "ad"):
        if rng.random() < 0.6:
            parts.append(around(kind))
    body = []
    for i, text in enumerate(main):
        shape = pick(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<h2>{}</h2>", "<p><b>{}</b></p>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<pre>{}</pre>", "<table><tr><td>{}</td></tr></table>", "<div>{}</div>"])
        body.append(("<h1>{}</h1>" if i == 0 else shape).format(escape(text)))
        labels.append(True)
        if rng.random() < 0.06:
            body.append(around(pick(["ad", "side", "form", "notice"])))
    inside = rng.random() < 0.3
    tail = around("comments") if inside else ""
    parts.append(tagged(pick(MAIN), "".join(body) + tail))
    for kind in ("comments", "side", "ad", "form", "bottom", "bottom"):
        if rng.random() < 0.5:
            parts.append(around(kind))
    page = "".join(parts)
    return f"<html><head><title>{escape(main[0])}</title></head><body>{tagged(('div', pick(['page', 'wrapper', 'container'])), page) if rng.random() < 0.4 else page}</body></html>", labels


def filler(blocks: list[Block]) -> np.ndarray:
    """A guess for pages without semantic tags: texts outside the usual surroundings, and
    not mostly links, are of the main kind."""
    return np.array([not path.around and 2 * linked <= len(text) for path, text, linked in blocks])


def _ends(values: list, most: int) -> list:
    """All values, or of more than ``most`` the first and the last half of them."""
    return values if len(values) <= most else [*values[: most // 2], *values[len(values) - (most - most // 2) :]]


def training_pages(htmls: list[str], rounds: int, max_steps: int = MAX_STEPS, max_main: int = MAX_MAIN) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Vectors and labels of the pages labelled by their tags and of ``rounds`` layouts of
    the texts of every page. Sequences keep at most ``max_steps`` blocks, half of them from
    either end, and layouts take ``max_main`` main texts, evenly spread."""
    rng, xs, ys, paths, words = np.random.default_rng(17), [], [], {}, WordSlots()
    for h in htmls:
        blocks = leaf_blocks(h)
        if not blocks:
            continue
        labels = plain_labels(blocks)
        if labels is not None and labels.any():
            xs.append(block_vectors(_ends(blocks, max_steps), paths, words))
            ys.append(np.array(_ends(labels.tolist(), max_steps)))
        else:
            labels = filler(blocks)
            if not labels.any():
                labels = ~labels
        main = [b[1] for b, y in zip(blocks, labels) if y]
        main = main[:: -(-len(main) // max_main)]
        other = [b[1] for b, y in zip(blocks, labels) if not y] or ["Home"]
        # Texts around the article may be as long as those in it: so may comments be.
        other += [m for m in main if rng.random() < 0.3]
        for _ in range(rounds):
            page, known = laid_out(main, other, rng)
            made = leaf_blocks(page)
            if len(made) == len(known):
                xs.append(block_vectors(_ends(made, max_steps), paths, words))
                ys.append(np.array(_ends(known, max_steps)))
    return xs, ys


def fit(pages: DataFrame, html: str = "html", page_id: str = "page_id", max_pages: int = MAX_PAGES, rounds: int = 3, max_chars: int = MAX_CHARS, max_steps: int = MAX_STEPS, max_main: int = MAX_MAIN) -> Labeller:
    """Train on about ``max_pages`` of the pages, or on fewer if those would hold more than
    about ``max_chars`` characters, each laid out ``rounds`` times
    (more often if there are fewer pages than ``max_pages``)."""
    bounded_batches(pages.sparkSession)
    usable = pages.where(F.length(html) > 0)
    n, chars = usable.agg(F.count("*"), F.sum(F.length(html).cast("double"))).first()
    share = min(max_pages / max(n, 1), max_chars / max(chars or 0, 1))
    chance = unit_hash(F.col(page_id), F.col(html), seed=41)
    chosen = usable.select(F.col(html).alias("h"), F.col(page_id).alias("i"), chance.alias("c"))
    rows = chosen.where(F.col("c") < share).toPandas()
    if n and not len(rows):
        rows = chosen.orderBy("c", "i").limit(1).toPandas()  # few pages, all of them huge
    # Few pages are laid out more often, so that the labeller always sees as many layouts.
    rounds = max(rounds, -(-rounds * max_pages // max(len(rows), 1)))
    return train(*training_pages(list(rows.sort_values(["i", "h"], kind="stable")["h"]), rounds, max_steps, max_main))


def extract_texts(model: Labeller, pages: list[str | None]) -> list[str]:
    blocks = [leaf_blocks(h) for h in pages]
    paths, words = {}, WordSlots()
    marks = label(model, [block_vectors(b, paths, words) for b in blocks])
    return [" ".join(b[1] for b, m in zip(page, mark) if m) for page, mark in zip(blocks, marks)]


def extract(pages: DataFrame, model: Labeller, html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    @F.pandas_udf("string")
    def main_text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            texts, out = [h or "" for h in s], []
            for part in grouped_by_bytes(texts, 512):
                out += extract_texts(model, texts[part])
            yield pd.Series(out, dtype=object)

    return pages.select("page_id", "url", main_text(F.col(html)).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
