"""Main text of web pages: every block labelled by a bidirectional LSTM.

A page becomes a sequence of leaves: runs of text between block borders, each with
the path of open elements. A leaf's vector holds its path (tags, and the words
of class and id, hashed), its words (hashed) and some sizes. The network reads
the sequence both ways, so each label knows what comes before and after.

It is trained at each run, on a bounded sample of the pages at hand, whose
leaves are labelled by what their elements say, and on pages put together from
the sample's texts with the menus, notices, adverts, forms and comments that pages
have elsewhere, under containers of many names. Parts of paths are left out at
random, so that words and place count too.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattshed.llm.common import first_by_hash, free_name, table, with_struct
from wattshed.llm.lstm import BiLstm
from wattshed.llm.words import mix, words_of

#: Pages of the sample that the network is trained on, and pages put together from it.
TRAIN_PAGES, MADE_PAGES = 240, 720
HIDDEN, ROUNDS, SEED = 24, 5, 11
PATH_SLOTS, WORD_SLOTS = 256, 32
#: Leaves that are read in one go; longer pages are a batch of their own.
LEAVES = 6000

#: Elements whose content is no text, that stand inside a line, that have no end tag.
HIDDEN_TAGS = "script|style|noscript|template|svg|iframe|canvas|object|title|textarea"
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var wbr br img input".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag closes, and how far up to look for it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({HIDDEN_TAGS})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
WORDS_OF_NAME = re.compile(r"[a-z]+", re.I)

#: What names mean for the labels of the sample.
BODY = {"article", "main"}
ASIDE = set(
    "nav menu header masthead footer aside sidebar widget ad ads advert advertisement sponsored promo banner notice cookie"
    " alert form newsletter comments comment share social related breadcrumb popup modal".split()
)


@dataclass
class Leaf:
    path: tuple[str, ...]  # tags and words of class and id, outermost first
    text: str
    linked: int  # characters inside links


def leaves(html: str) -> list[Leaf]:
    """The runs of text between block borders, in order."""
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links = 0, 0
    path: tuple[str, ...] | None = None

    def close() -> None:
        nonlocal parts, linked, path
        text = " ".join("".join(parts).split())
        if text and path is not None:
            out.append(Leaf(path, text, linked))
        parts, linked, path = [], 0, None

    def text(raw: str) -> None:
        nonlocal linked, path
        if not raw:
            return
        if "&" in raw:
            raw = entities.unescape(raw)
        parts.append(raw)
        if not raw.isspace():
            if path is None:
                path = tuple(w for _, words in stack for w in words)
            if links:
                linked += len(raw)

    def drop(n: int) -> None:
        nonlocal links
        links -= sum(tag == "a" for tag, _ in stack[n:])
        del stack[n:]

    at = 0
    for m in TOKEN.finditer(html):
        text(html[at : m.start()])
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            continue
        tag, ends = tag.lower(), m[2] or m[5]
        if tag == "br":
            parts.append(" ")
        elif tag not in INLINE:
            close()
        if tag in VOID:
            continue
        if ends:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if k is not None:
                drop(k)
            continue
        if tag not in INLINE:
            ends_of, until = CLOSES.get(tag, (set(), set()))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends_of or stack[k][0] == "p":
                    drop(k)
                    break
                if stack[k][0] in until or stack[k][0] not in INLINE:
                    break
        attributes = m[4] or m[7] or ""
        words = [tag]
        if "=" in attributes:
            for name in NAMES.finditer(attributes):
                words += [w.lower() for w in WORDS_OF_NAME.findall(name[1] or name[2] or name[3] or "")]
        stack.append((tag, tuple(words)))
        links += tag == "a"
    text(html[at:])
    close()
    return out


def vectors(pages: list[list[Leaf]]) -> np.ndarray:
    """One row for each leaf of all pages, in order."""
    every = [leaf for page in pages for leaf in page]
    out = np.zeros((len(every), PATH_SLOTS + WORD_SLOTS + 6), dtype=np.float32)
    if not every:
        return out
    seen: dict[str, int] = {}
    for i, leaf in enumerate(every):
        for word in leaf.path:
            slot = seen.get(word)
            if slot is None:
                slot = seen[word] = zlib.crc32(word.encode()) % PATH_SLOTS
            out[i, slot] = 1
    raw = [leaf.text.encode() for leaf in every]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    words = words_of(data, offsets)
    slot = (mix(words.hashes(folded=True)) % np.uint64(WORD_SLOTS)).astype(np.int64)
    count = np.bincount(words.owner * WORD_SLOTS + slot, minlength=len(every) * WORD_SLOTS).reshape(len(every), -1)
    n_words = np.diff(words.first)
    out[:, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = count / np.maximum(n_words, 1)[:, None]
    size = np.array([len(leaf.text) for leaf in every])
    linked = np.array([leaf.linked for leaf in every])
    place = np.concatenate([np.arange(len(p)) / max(len(p) - 1, 1) for p in pages])
    stop = np.array([leaf.text[-1] in ".!?" for leaf in every])
    out[:, -6:] = np.stack(
        [np.log1p(size) / 8, np.minimum(linked / size, 1), np.log1p(n_words) / 6, place, stop, np.full(len(every), 1)], axis=1
    )
    return out


def padded(rows: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(steps, pages, inputs) and its mask, from the rows of all pages."""
    steps = max(lengths, default=0)
    x = np.zeros((steps, len(lengths), rows.shape[1]), dtype=np.float32)
    mask = np.zeros((steps, len(lengths)), dtype=np.float32)
    at = 0
    for k, n in enumerate(lengths):
        x[:n, k], mask[:n, k] = rows[at : at + n], 1
        at += n
    return x, mask


def said(leaf: Leaf) -> bool:
    """Whether the names in the path put a leaf into the article."""
    path = set(leaf.path)
    return bool(path & BODY) and not path & ASIDE


#: Containers of the pages that are put together.
ARTICLES = [
    ["article"], ["main"], ["main", "article"], ["div content"], ["div main content"], ["div post"], ["div entry content"],
    ["section article body"], ["div story"], ["div page text"], ["article post"], ["div id content", "div"],
]
MENUS = [
    ["nav", "ul", "li", "a"], ["div menu", "a"], ["ul nav", "li", "a"], ["header", "nav", "ul", "li", "a"],
    ["div navbar", "ul", "li", "a"], ["div breadcrumb", "a"], ["ul menu", "li", "a"],
]
HEADS = [["header", "h1"], ["header", "p"], ["div header", "div"], ["div masthead", "h2"], ["header site", "div logo"]]
NOTICES = [
    ["div cookie notice", "p"], ["div notice"], ["div alert"], ["div banner"], ["div gdpr consent", "p"], ["aside notice", "p"],
    ["div popup", "p"], ["div newsletter", "p"], ["section notice", "p"], ["div message"], ["div cookie", "button"],
]
ADVERTS = [["div ad"], ["div advert", "p"], ["aside ad", "p"], ["div sponsored", "p"], ["div ads"], ["section promo", "p"], ["div advertisement", "p"]]
SIDES = [
    ["aside", "p"], ["aside", "ul", "li", "a"], ["div sidebar", "p"], ["div id sidebar", "ul", "li", "a"], ["div widget", "p"],
    ["div related", "ul", "li", "a"], ["aside sidebar", "h3"], ["section related", "p"], ["div share", "a"], ["div social", "a"],
]
FORMS = [["form", "label"], ["form", "button"], ["form", "p"], ["form search", "div"], ["form newsletter", "p"], ["form", "select", "option"], ["form contact", "div", "label"]]
REMARKS = [
    ["section comments", "div comment", "p"], ["div comments", "p"], ["ol commentlist", "li comment", "p"], ["div id comments", "div comment", "div"],
    ["section id comments", "article comment", "p"], ["div comments", "h3"], ["section comments", "h2"], ["div reply", "p"], ["ul comments", "li"],
]
FEET = [["footer"], ["footer", "p"], ["div footer", "p"], ["footer site", "div"], ["div id footer", "ul", "li", "a"], ["footer", "nav", "a"], ["div copyright"]]
INSIDE = [["h1"], ["h2"], ["h3"], ["p"], ["p"], ["p"], ["p"], ["ul", "li"], ["ol", "li"], ["blockquote", "p"], ["div"], ["pre"], ["table", "tr", "td"], ["figure", "figcaption"], ["header", "h1"], ["section", "p"]]


def _made(rng: np.random.Generator, texts: list[str], shorts: list[str]) -> tuple[list[Leaf], list[int]]:
    """A page put together, and its labels."""
    page: list[Leaf] = []
    labels: list[int] = []
    pick = lambda options: options[rng.integers(len(options))]

    def add(path: list[str], label: int, long: bool, outer: tuple[str, ...] = ()) -> None:
        words = tuple(w for part in ["html", "body", *outer, *path] for w in part.split() if w != "id")
        text = pick(texts) if long else pick(shorts)
        page.append(Leaf(words, text, len(text) if "a" in path else 0))
        labels.append(label)

    def several(options: list[list[str]], most: int, long: float, outer: tuple[str, ...] = ()) -> None:
        path = pick(options)
        for _ in range(rng.integers(1, most + 1)):
            add(path, 0, rng.random() < long, outer)

    wrap = ("div wrapper",) if rng.random() < 0.3 else ()
    for options, most, long, chance in (
        (HEADS, 2, 0.2, 0.5), (MENUS, 8, 0.0, 0.8), (NOTICES, 2, 0.5, 0.4), (ADVERTS, 2, 0.4, 0.5), (SIDES, 5, 0.3, 0.25), (FORMS, 3, 0.1, 0.2),
    ):
        if rng.random() < chance:
            several(options, most, long, wrap)
    body = (*wrap, *pick(ARTICLES))
    for k in range(rng.integers(1, 14)):
        path = ["h1"] if k == 0 and rng.random() < 0.7 else pick(INSIDE)
        add(path, 1, path[0] in ("p", "blockquote", "div", "section") or rng.random() < 0.2, body)
        if rng.random() < 0.08:
            several(pick([ADVERTS, SIDES, FORMS, NOTICES]), 2, 0.4, body)
    if rng.random() < 0.2:
        several(REMARKS, 4, 0.6, body)
    for options, most, long, chance in (
        (REMARKS, 6, 0.6, 0.5), (SIDES, 6, 0.4, 0.5), (FORMS, 4, 0.1, 0.3), (ADVERTS, 2, 0.4, 0.3), (NOTICES, 1, 0.5, 0.2), (FEET, 3, 0.4, 0.8),
    ):
        if rng.random() < chance:
            several(options, most, long, wrap)
    return page, labels


def train(htmls: list[str], made: int = MADE_PAGES, rounds: int = ROUNDS) -> BiLstm:
    """The network, from a sample of pages (none is enough) and pages put together."""
    rng = np.random.default_rng(SEED)
    sample = [p for p in map(leaves, htmls) if p]
    own = [(p, [int(said(leaf)) for leaf in p]) for p in sample if any(set(leaf.path) & BODY for leaf in p)]
    texts = sorted({leaf.text for p in sample for leaf in p if len(leaf.text) > 60})[:4000]
    shorts = sorted({leaf.text for p in sample for leaf in p if len(leaf.text) <= 60})[:4000]
    texts = texts or ["The text of a paragraph that goes on for a while, with a stop at its end. Then it goes on."]
    shorts = shorts or ["Home", "About us", "Read more", "A short line"]
    pages = own + [_made(rng, texts, shorts) for _ in range(made)]
    # Long pages teach no more for each leaf; short ones train in larger batches.
    pages = sorted(((p[:120], y[:120]) for p, y in pages), key=lambda p: len(p[0]))
    batches = []
    for lo in range(0, len(pages), 32):
        part = pages[lo : lo + 32]
        rows = vectors([p for p, _ in part])
        gone = rng.random(rows.shape) < 0.1
        gone[:, PATH_SLOTS:] = False
        rows[gone] = 0
        x, mask = padded(rows, [len(p) for p, _ in part])
        y = np.zeros_like(mask)
        for k, (_, labels) in enumerate(part):
            y[: len(labels), k] = labels
        batches.append((x, mask, y))
    order = rng.permutation(len(batches))
    net = BiLstm(PATH_SLOTS + WORD_SLOTS + 6, HIDDEN, SEED)
    net.fit([batches[i] for i in order], rounds)
    return net


def main_text(net: BiLstm, pages: list[list[Leaf]]) -> list[str]:
    """Main text of each page: its blocks labelled as such, two line breaks between."""
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi - lo + 1) * len(pages[order[hi]]) <= LEAVES:
            hi += 1
        part = [pages[k] for k in order[lo:hi]]
        x, mask = padded(vectors(part), [len(p) for p in part])
        main = net.scores(x, mask) >= 0.5
        for j, k in enumerate(order[lo:hi]):
            out[k] = "\n\n".join(leaf.text for leaf, good in zip(pages[k], main[:, j], strict=False) if good)
        lo = hi
    return out


_TEXT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extracted(pages: DataFrame, html: str = "html", train_pages: int = TRAIN_PAGES) -> tuple[DataFrame, str]:
    """pages with a struct more, and its name: main text and its length in code points.

    NULL and empty pages give empty text; each row is read for itself. The network
    is trained on the train_pages pages that come first by hash. Columns of pages
    keep their names: the struct takes one that is free.
    """
    own = pages.where(F.col(html).isNotNull()).select(F.col(html).alias("html"))
    net = train([r["html"] for r in first_by_hash(own, train_pages, "html").collect()])

    def make(batch: pa.RecordBatch) -> pa.Array:
        texts: list[str] = []
        held = batch.column(html)
        for lo in range(0, len(held), 500):
            texts += main_text(net, [leaves(h or "") for h in held.slice(lo, 500).to_pylist()])
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["text", "n_chars"]
        )

    name = free_name(pages, "main")
    return with_struct(pages, name, _TEXT, make), name


def op8_recurrent_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, name = extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", f"{name}.*")
