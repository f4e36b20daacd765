"""Operator 9: main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: the text between two block-level tags, with the path of open tags above
it. Every block is a vector of its tag path (tags, classes, ids), hashed words and a few measures. A bidirectional LSTM
in numpy reads the sequence in both directions, so each block is judged in the context of the whole document.

It is trained here, on a bounded sample of the pages: their blocks with the labels their own structure gives (inside or
outside article or main), and pages put together anew from the sampled texts with frames of many kinds (menus, headers,
sidebars, notices, adverts, forms, comments, footers) around article, main or a plain content division. As texts are
dealt out at random, labels follow structure, not words.

Defined results: NULL and pages without text give an empty text; scripts, styles, comments of the markup and the head are
never blocks; a page without any main block gives an empty text; broken markup is read as far as it goes; equal pages
give equal texts.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds of the training sample and of training.
SAMPLE_PAGES = 200
SAMPLE_CHARS = 30_000
COMPOSED_PAGES = 700
EPOCHS = 3

PATH_SIZE, WORD_SIZE, MEASURES = 192, 32, 6
SIZE = PATH_SIZE + WORD_SIZE + MEASURES
HIDDEN = 24

# A tag ends before the next "<", but for one inside a quoted value of up to 10,000 characters; what is opened and never
# closed reaches to the end of the page. So no search for an end is made twice, and reading stays linear.
_ATTRS = r"""(?:[^<>"']|"[^"<]*"|'[^'<]*'|"[^"<]{0,5000}<[^"]{0,5000}"|'[^'<]{0,5000}<[^']{0,5000}')*+"""
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*>"""
    rf"""|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title)\b{_ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"""
    rf"""|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9-]*)(?P<attrs>{_ATTRS})>""",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"\w+")
_SPACE = re.compile(r"\s+")
# Tags that don't interrupt a block of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())

# Different tokens of the open tags and the last one once more, text, characters inside links.
Block = tuple[tuple[str, ...], str, int]


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in order; texts as they are to be returned."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    # How many open tags have a token, and how many are of a name: kept up to date, as stacks may be deep.
    tokens: Counter[str] = Counter()
    open_tags: Counter[str] = Counter()
    parts: list[str] = []
    linked, links = 0, 0
    page = page or ""

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text and "head" not in tokens:
            out.append(((*tokens, stack[-1][1][-1]) if stack else (), text, linked))
        parts.clear()
        linked = 0

    def push(tag: str, names: list[str]) -> None:
        stack.append((tag, tuple(names)))
        open_tags[tag] += 1
        tokens.update(names)

    def pop() -> None:
        tag, names = stack.pop()
        open_tags[tag] -= 1
        for name in names:
            tokens[name] -= 1
            if not tokens[name]:
                del tokens[name]

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            parts.append(page[at : token.start()])
            linked += (token.start() - at) * (links > 0)
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if token["close"] else 1
            continue
        flush()
        if token["close"]:
            if open_tags[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
        elif tag not in VOID and not token["attrs"].endswith("/"):
            if tag in CLOSES_ITSELF and stack and stack[-1][0] == tag:
                pop()
            names = [tag]
            for found in _NAMES.finditer(token["attrs"]):
                value = found[1] or found[2] or found[3] or ""
                names += [f".{word}" for word in re.split(r"[\s_-]+", value.lower()) if word][:6]
            while tag == "body" and stack:
                pop()  # a head left open ends here
            push(tag, names)
    parts.append(page[at:])
    flush()
    return out


@lru_cache(100_000)
def _place(word: str, size: int) -> int:
    return zlib.crc32(word.encode()) % size


def vectors(blocks: list[Block]) -> np.ndarray:
    x = np.zeros((len(blocks), SIZE), np.float32)
    places: dict[str, int] = {}
    for k, (path, text, linked) in enumerate(blocks):
        for token in path:
            place = places.get(token)
            if place is None:
                place = places[token] = _place(token, PATH_SIZE)
            x[k, place] = 1.0
        if path:
            x[k, _place("last:" + path[-1], PATH_SIZE)] = 1.0
        words = _WORD.findall(text)
        for word in words:
            x[k, PATH_SIZE + _place(word.lower(), WORD_SIZE)] += 1.0
        x[k, PATH_SIZE : PATH_SIZE + WORD_SIZE] /= max(1, len(words))
        rest = PATH_SIZE + WORD_SIZE
        x[k, rest] = min(1.0, len(text) / 400)
        x[k, rest + 1] = min(1.0, linked / max(1, len(text)))
        x[k, rest + 2] = k / max(1, len(blocks) - 1)
        x[k, rest + 3] = (text.count(".") + text.count("!") + text.count("?")) / max(1, len(words))
        x[k, rest + 4] = 1.0 if len(words) <= 3 else 0.0
        x[k, rest + 5] = 1.0
    return x


Weights = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_weights(seed: int = 7) -> Weights:
    rng = np.random.default_rng(seed)
    out: Weights = {}
    for way in ("f", "b"):
        out[way + "x"] = (rng.standard_normal((SIZE, 4 * HIDDEN)) * 0.1).astype(np.float32)
        out[way + "h"] = (rng.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.2).astype(np.float32)
        out[way + "c"] = np.zeros(4 * HIDDEN, np.float32)
        out[way + "c"][HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
    out["o"] = (rng.standard_normal(2 * HIDDEN) * 0.2).astype(np.float32)
    out["c"] = np.zeros(1, np.float32)
    return out


def _run(x: np.ndarray, w: Weights, way: str, keep: list | None = None) -> np.ndarray:
    """Hidden states of one direction; `keep` gets what the way back needs."""
    inputs = x @ w[way + "x"] + w[way + "c"]
    h = np.zeros(HIDDEN, np.float32)
    c = np.zeros(HIDDEN, np.float32)
    out = np.empty((len(x), HIDDEN), np.float32)
    recurrent = w[way + "h"]
    for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
        z = inputs[t] + h @ recurrent
        gates = _sigmoid(z[: 3 * HIDDEN])
        new = np.tanh(z[3 * HIDDEN :])
        i, f, o = gates[:HIDDEN], gates[HIDDEN : 2 * HIDDEN], gates[2 * HIDDEN :]
        before, c = c, f * c + i * new
        squeezed = np.tanh(c)
        if keep is not None:
            keep.append((t, h, before, i, f, o, new, squeezed))
        h = o * squeezed
        out[t] = h
    return out


def scores(x: np.ndarray, w: Weights) -> np.ndarray:
    """How likely every block is main text."""
    if not len(x):
        return np.empty(0, np.float32)
    both = np.concatenate((_run(x, w, "f"), _run(x, w, "b")), axis=1)
    return _sigmoid(both @ w["o"] + w["c"])


def _gradients(x: np.ndarray, y: np.ndarray, w: Weights) -> Weights:
    kept = {"f": [], "b": []}
    both = np.concatenate([_run(x, w, way, kept[way]) for way in ("f", "b")], axis=1)
    miss = (_sigmoid(both @ w["o"] + w["c"]) - y) / len(x)
    out: Weights = {"o": both.T @ miss, "c": miss.sum(keepdims=True)}
    for k, way in enumerate(("f", "b")):
        d_out = np.outer(miss, w["o"][k * HIDDEN : (k + 1) * HIDDEN])
        d_z = np.zeros((len(x), 4 * HIDDEN), np.float32)
        d_recurrent = np.zeros_like(w[way + "h"])
        d_h, d_c = np.zeros(HIDDEN, np.float32), np.zeros(HIDDEN, np.float32)
        for t, h, before, i, f, o, new, squeezed in reversed(kept[way]):
            d_h = d_h + d_out[t]
            d_c = d_c + d_h * o * (1 - squeezed**2)
            z = np.concatenate((d_c * new * i * (1 - i), d_c * before * f * (1 - f), d_h * squeezed * o * (1 - o), d_c * i * (1 - new**2)))
            d_z[t] = z
            d_recurrent += np.outer(h, z)
            d_h, d_c = w[way + "h"] @ z, d_c * f
        out[way + "x"], out[way + "h"], out[way + "c"] = x.T @ d_z, d_recurrent, d_z.sum(axis=0)
    return out


def train(examples: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 7, rate: float = 0.01) -> Weights:
    """Adam over pages in a shuffled order; the same examples give the same weights."""
    w = new_weights(seed)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    order, step = random.Random(seed), 0
    total = max(1, epochs * len(examples))
    for _ in range(epochs):
        for x, y in order.sample(examples, len(examples)):
            if not len(x):
                continue
            step += 1
            speed = rate * (1 - step / total) + 1e-4
            for k, g in _gradients(x, y, w).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                w[k] = w[k] - speed * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return w


# What surrounds an article, by kind: opening and closing markup of the frame, and of each of its blocks.
FRAMES = {
    "menu": [("<nav><ul>", "</ul></nav>", '<li><a href="#">', "</a></li>"), ('<div class="menu"><ul>', "</ul></div>", '<li><a href="#">', "</a></li>"), ('<ul id="navigation" class="nav navbar">', "</ul>", '<li><a href="#">', "</a></li>"), ('<div class="breadcrumb">', "</div>", '<a href="#">', "</a>")],
    "header": [("<header>", "</header>", "<p>", "</p>"), ('<div id="header" class="masthead">', "</div>", "<div>", "</div>"), ('<header class="site-header"><div class="logo">', "</div></header>", "<h1>", "</h1>"), ('<div class="topbar banner">', "</div>", "<span>", "</span>")],
    "sidebar": [("<aside>", "</aside>", "<p>", "</p>"), ('<div class="sidebar">', "</div>", "<div>", "</div>"), ('<aside class="related widget">', "</aside>", "<h3>", "</h3>"), ('<div id="side" class="popular recent">', "</div>", '<li><a href="#">', "</a></li>")],
    "notice": [('<div class="cookie-notice">', "</div>", "<p>", "</p>"), ('<div class="notice alert">', "</div>", "", ""), ('<div id="cookie-banner" class="consent">', "</div>", "<p>", "</p>"), ('<div role="alert" class="message warning popup modal">', "</div>", "<div>", "</div>")],
    "advert": [('<div class="ad">', "</div>", "", ""), ('<div class="ads advert advertisement">', "</div>", "<p>", "</p>"), ('<div class="sponsored promo">', "</div>", '<a href="#">', "</a>"), ("<!-- ad --><ins class=\"adsbygoogle\"></ins><div class=\"banner ad-slot\">", "</div>", "<p>", "</p>")],
    "form": [("<form>", "</form>", "<label>", "</label>"), ('<form class="newsletter subscribe signup">', "</form>", "<p>", "</p><button>ok</button>"), ('<div class="search"><form>', "</form></div>", "<label>", "</label>")],
    "comments": [('<div class="comments">', "</div>", '<div class="comment"><p>', "</p></div>"), ('<section id="comments">', "</section>", "<p>", "</p>"), ('<ol class="comment-list">', "</ol>", '<li class="comment">', "</li>"), ('<div id="discussion" class="replies">', "</div>", "<blockquote>", "</blockquote>")],
    "footer": [("<footer>", "</footer>", "<p>", "</p>"), ("<footer>&copy; ", "</footer>", "", ""), ('<div id="footer" class="copyright">', "</div>", "<div>", "</div>"), ('<div class="share social">', "</div>", '<a href="#">', "</a>")],
}
BEFORE, AFTER = ("menu", "header", "notice", "advert", "sidebar", "form"), ("comments", "sidebar", "advert", "form", "notice", "footer", "menu")
MAIN = [("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main" class="post entry">', "</div>"), ('<section class="article body text">', "</section>"), ('<article class="post">', "</article>")]
MAIN_BLOCKS = [("<p>", "</p>"), ("<p>", "</p>"), ("<p>", "</p>"), ("<p>", ""), ("<h2>", "</h2>"), ("<ul><li>", "</li></ul>"), ("<blockquote>", "</blockquote>"), ("<p><b>", "<br>"), ("<pre>", "</pre>"), ("<table><tr><td>", "</td></tr></table>")]
# A private character in front of every main block of a composed page.
_MARK = "\ue000"


def compose(texts: list[str], rng: random.Random) -> str:
    """A page with marked main blocks, from sampled texts. Frames may stand inside the article, too."""

    def short(most: int) -> str:
        words = rng.choice(texts).split()
        start = rng.randrange(max(1, len(words) - most))
        return html.escape(" ".join(words[start : start + rng.randint(1, most)]) or "x")

    def frame(kind: str) -> str:
        opening, closing, before, after = rng.choice(FRAMES[kind])
        most = 3 if kind in ("menu", "form") else 60 if kind == "comments" else 20
        return opening + "".join(before + short(most) + after for _ in range(rng.randint(1, 6))) + closing

    def block() -> str:
        opening, closing = rng.choice(MAIN_BLOCKS)
        return opening + _MARK + short(rng.choice((2, 8, 60, 120))) + closing

    opening, closing = rng.choice(MAIN)
    title = f"<h1>{_MARK}{short(8)}</h1>" if rng.random() < 0.8 else ""
    inner = [block() for _ in range(rng.randint(0 if title else 1, 12))]
    if inner and rng.random() < 0.3:
        inner.insert(rng.randrange(len(inner) + 1), frame(rng.choice(("advert", "sidebar", "notice", "form", "comments"))))
    some = lambda kinds: "".join(frame(k) for k in kinds if rng.random() < 0.45)
    wrap = ('<div class="page wrapper container">', "</div>") if rng.random() < 0.4 else ("", "")
    return f"<html><head><title>{short(6)}</title></head><body>{wrap[0]}{some(BEFORE)}{opening}{title}{''.join(inner)}{closing}{some(AFTER)}{wrap[1]}</body></html>"


def learn(pages: DataFrame) -> Weights:
    """Weights from a bounded sample: the pages with the smallest hashes."""
    hashed = pages.where(F.col("html").isNotNull()).select(F.xxhash64("html").alias("hash"), "html")
    least = [row[0] for row in hashed.select("hash").orderBy("hash").limit(SAMPLE_PAGES).collect()]
    sample = hashed.where(F.col("hash").isin(least)).select("hash", F.substring("html", 1, SAMPLE_CHARS).alias("html")).dropDuplicates(["hash"])
    found = [blocks_of(row["html"]) for row in sorted(sample.collect(), key=lambda r: r["hash"])]
    rng = random.Random(11)
    texts = [text for blocks in found for _, text, _ in blocks] or ["text"]
    examples = []
    for blocks in found:
        inside = [1.0 if {"article", "main"} & set(path) else 0.0 for path, _, _ in blocks]
        if any(inside):
            examples.append((vectors(blocks), np.array(inside, np.float32)))
    for _ in range(COMPOSED_PAGES):
        blocks = blocks_of(compose(texts, rng))
        labels = np.array([float(text.startswith(_MARK)) for _, text, _ in blocks], np.float32)
        clean = [(path, text.lstrip(_MARK), linked) for path, text, linked in blocks]
        examples.append((vectors(clean), labels))
    return train(examples)


def main_text(page: str | None, weights: Weights) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return " ".join(text for (_, text, _), score in zip(blocks, scores(vectors(blocks), weights), strict=True) if score >= 0.5)


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages` (page_id, url, html)."""
    known = pages.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), known.value) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select("page_id", "url", "html").mapInArrow(
        work, f"page_id {kinds['page_id']}, url string, text string, n_chars long"
    )
