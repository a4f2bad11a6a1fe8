"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read once into leaf blocks: runs of text between block tags, each
with the tags and name words (class, id, role) of its ancestors. A block's
features are its ancestors, its text's shape and its place; the chain has two
labels (article, other) and learned transitions; Viterbi's best labelling picks
the blocks of the article. The model is trained here, on labelled pages that
`labelled_pages` writes by rule from layouts and invented words (fixed seed,
`TRAINING_PAGES` pages), once per Python process that needs it.

Defined results: null or empty html, or a page without text, gives an empty text;
unclosed, misplaced and unknown tags are tolerated; text outside any tag is a
block; repeated rows are extracted alike, ties of two labellings go to the one without
the article; an empty table gives no row; pages of any length are read whole.
Columns beyond page_id, url and html are ignored. A map: no shuffle.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table

TRAINING_PAGES = 400
SEED = 7
#: Tags that begin and end blocks.
BLOCK_TAGS = frozenset("address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe label legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
#: Elements whose content is no text of the page.
RAW_TAGS = frozenset("script style noscript template textarea svg object canvas xmp".split())
#: Those of them that hold elements of their own name; the others are text up to their closing tag.
NESTED_TAGS = frozenset("svg object template canvas".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the first kind ends an open element of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words in class, id and role that tell what an element is, by kind.
NAME_WORDS = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs tabs toc pagination pager",
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner",
    "notice": "cookie cookies notice consent gdpr privacy alert warning popup modal overlay newsletter subscribe paywall",
    "comment": "comment comments reply replies respond discussion disqus reader readers",
    "side": "sidebar side aside related recommended more widget rail trending popular",
    "footer": "footer foot copyright legal colophon",
    "header": "header head masthead topbar logo branding",
    "form": "form search login signup register",
    "social": "share social sharing follow tags meta byline author date",
    "article": "article content post entry story body main text page prose",
}
_KIND = {w: k for k, words in NAME_WORDS.items() for w in words.split()}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|<[/!?][^>]*>|<(/?)([a-zA-Z][^\s/>\"']*)([^>]*)>", re.S)
_NAMES = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_SPACE = re.compile(r"\s+")


class Block:
    """A leaf block: its text, the letters of it inside links, and the path of (tag, name kinds) above it."""

    __slots__ = ("linked", "path", "text")

    def __init__(self, text: str, linked: int, path: tuple):
        self.text, self.linked, self.path = text, linked, path


@functools.lru_cache(maxsize=4096)
def _kinds(attributes: str) -> frozenset[str]:
    found = set()
    for _, value in _NAMES.findall(attributes):
        for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower()):
            if w in _KIND:
                found.add(_KIND[w])
    return frozenset(found)


@functools.cache
def _tags_named(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){re.escape(tag)}(?![^\s/>])((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>", re.I)


def _end_of(tag: str, page: str, at: int) -> int:
    """Where an element whose content begins at `at` ends; the page's end if it does not."""
    depth = 1
    for m in _tags_named(tag).finditer(page, at):
        if m[1]:
            depth -= 1
        elif tag in NESTED_TAGS and not m[2].endswith("/"):
            depth += 1
        if not depth or (m[1] and tag not in NESTED_TAGS):
            return m.end()
    return len(page)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in its order, those without text left out."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    parts: list[str] = []
    links, linked, at, n = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                out.append(Block(text, linked, tuple(stack)))
            parts.clear()
        linked = 0

    while at < n:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            run = page[at:stop]
            parts.append(run)
            if links:
                linked += len(run)
        if not m:
            break
        at = m.end()
        closing, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW_TAGS:
            # only an element of another language (svg) can close itself; <script src=/a/> does not
            if not closing and not (tag in NESTED_TAGS and (rest or "").endswith("/")):
                at = _end_of(tag, page, at)
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in BLOCK_TAGS:
            continue
        flush()
        if tag in VOID_TAGS:
            continue
        if closing:
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        links = 0
        if stack and stack[-1][0] == "p":
            stack.pop()  # a block ends an open paragraph
        if tag in CLOSES and stack and stack[-1][0] in CLOSES[tag]:
            stack.pop()
        stack.append((tag, _kinds(rest) if rest else frozenset()))
    flush()
    return out


@functools.lru_cache(maxsize=65536)
def _path_features(path: tuple) -> tuple[str, ...]:
    out = {"depth0"} if not path else set()
    for tag, kinds in path:
        if tag not in ("html", "body"):
            out.add("in:" + tag)
        out.update("named:" + k for k in kinds)
    named = [k for _, kinds in path for k in sorted(kinds)]
    if path:
        out.add("tag:" + path[-1][0])
        out.update("own:" + k for k in path[-1][1])
    # the innermost section decides where an article holds comments or an aside holds an article
    for tag, kinds in reversed(path):
        mark = next(iter(sorted(kinds)), None) or (tag if tag in ("nav", "aside", "header", "footer", "form", "article", "main", "head", "figure") else None)
        if mark:
            out.add("inner:" + mark)
            break
    else:
        out.add("inner:none")
    if not named and not any(t in ("nav", "aside", "header", "footer", "form", "head", "article", "main") for t, _ in path):
        out.add("unmarked")
    return tuple(sorted(out))


def _text_features(block: Block) -> tuple[str, ...]:
    text = block.text
    words = text.count(" ") + 1
    share = block.linked / max(len(text), block.linked, 1)
    out = ["words:" + ("1" if words == 1 else "4" if words < 5 else "10" if words < 11 else "25" if words < 26 else "60" if words < 61 else "more"),
           "linked:" + ("none" if share == 0 else "some" if share < 0.5 else "most")]
    if text[-1] in ".!?…。":
        out.append("sentence")
    if "©" in text or "|" in text[:40]:
        out.append("copyright" if "©" in text else "bar")
    return tuple(out)


def features(found: list[Block]) -> list[tuple[str, ...]]:
    """Feature names of each block of a page."""
    last = len(found) - 1
    return [(*_path_features(b.path), *_text_features(b), *(("first",) if i == 0 else ()), *(("last",) if i == last else ())) for i, b in enumerate(found)]


# --- training -------------------------------------------------------------


def _words(rng: random.Random, low: int, high: int) -> str:
    stems = ["ka", "lo", "mi", "ren", "tas", "vel", "dor", "shi", "pan", "ué", "gra", "ön"]
    out = ["".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
    if rng.random() < 0.08:
        out = [w + " |" for w in out]
    if rng.random() < 0.05:
        out = [w.upper() + "!!" for w in out]
    return " ".join(out).capitalize() + rng.choice([".", ".", ".", "!", "?", ""])


def labelled_page(rng: random.Random) -> list[tuple[tuple, str, int, bool]]:
    """(path, text, linked letters, is article) of the blocks of an invented page, from a random layout."""
    page: list[tuple[tuple, str, int, bool]] = []
    body: tuple = (("html", frozenset()), ("body", frozenset()))

    def put(path: tuple, text: str, article: bool, linked: bool = False) -> None:
        page.append((path, text, len(text) if linked else 0, article))

    def el(tag: str, *kinds: str) -> tuple:
        return ((tag, frozenset(kinds)),)

    def boiler(where: tuple) -> None:
        kind = rng.choice(["menu", "advert", "notice", "comment", "side", "form", "social", "footer", "header"])
        box = {"menu": [el("nav"), el("div", "menu"), el("ul", "menu")], "advert": [el("div", "advert"), el("aside", "advert"), el("section", "advert")],
               "notice": [el("div", "notice"), el("section", "notice")], "comment": [el("section", "comment"), el("div", "comment"), el("ol", "comment")],
               "side": [el("aside"), el("div", "side"), el("aside", "side")], "form": [el("form"), el("div", "form")], "social": [el("div", "social"), el("ul", "social")],
               "footer": [el("footer"), el("div", "footer")], "header": [el("header"), el("div", "header")]}[kind]
        path = where + rng.choice(box)
        for _ in range(rng.randint(1, 7)):
            inner = {"menu": el("ul") + el("li"), "social": el("li")}.get(kind, rng.choice([(), (), el("p"), el("div"), el("ul") + el("li"), el("h3"), el("h2")]))
            if kind == "form":
                inner = rng.choice([(), el("label"), el("button"), el("p")])
            link = kind in ("menu", "social") or (kind in ("side", "footer") and rng.random() < 0.4)
            low, high = rng.choice([(1, 3), (1, 4), (5, 20), (20, 70)]) if kind in ("advert", "notice", "comment", "side", "footer") else (1, 4)
            text = _words(rng, low, high)
            if kind == "footer" and rng.random() < 0.6:
                text = "© " + text
            put(path + inner, text, False, link)

    put((("html", frozenset()), ("head", frozenset()), ("title", frozenset())), _words(rng, 2, 12), False)
    for _ in range(rng.randint(0, 3)):
        boiler(body)
    wraps = [el("article"), el("main"), el("main") + el("article"), el("div", "article"), el("article", "article"), el("div") + el("article"), el("div", "article") + el("div", "article"), el("td"), el("div")]
    main = body + rng.choices(wraps, weights=[6, 2, 2, 2, 2, 2, 2, 1, 1])[0]
    if rng.random() < 0.85:
        put(main + rng.choice([el("h1"), el("h1"), el("header") + el("h1"), el("h2")]), _words(rng, 1, 14), True)
    count = rng.randint(1, 14)
    for i in range(count):
        tag = rng.choices([el("p"), el("h2"), el("ul") + el("li"), el("blockquote") + el("p"), el("pre"), (), el("table") + el("tr") + el("td"), el("h3")], weights=[30, 3, 3, 1, 1, 2, 1, 1])[0]
        low, high = rng.choice([(1, 1), (1, 4), (5, 20), (20, 60), (60, 200)])
        text = _words(rng, low, high)
        put(main + tag, text, True, rng.random() < 0.03)
        if i < count - 1 and rng.random() < 0.06:
            boiler(main)
    for _ in range(rng.randint(0, 2)):
        if rng.random() < 0.3:
            boiler(main)
    for _ in range(rng.randint(0, 3)):
        boiler(body)
    if rng.random() < 0.7:
        put(body + el("footer"), "© " + _words(rng, 1, 20), False)
    return page


class Field:
    """Weights [feature, label], transitions [label, label] and start scores; label 1 is the article."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.gain = {f: float(emit[i, 1] - emit[i, 0]) for f, i in index.items()}
        m = move.tolist()
        self.move, self.start = m, start.tolist()

    @functools.lru_cache(maxsize=65536)  # noqa: B019  one model for each process
    def _of(self, names: tuple[str, ...]) -> float:
        return sum(self.gain.get(f, 0.0) for f in names)

    def decode(self, found: list[Block]) -> list[bool]:
        """Viterbi's labelling: which blocks are the article."""
        last = len(found) - 1
        (m00, m01), (m10, m11) = self.move
        a, b = self.start
        back: list[tuple[int, int]] = []
        for i, block in enumerate(found):
            gain = self._of(_path_features(block.path)) + self._of(_text_features(block)) + (self.gain.get("first", 0.0) if i == 0 else 0.0) + (self.gain.get("last", 0.0) if i == last else 0.0)
            if i:
                to0, to1 = (a + m00, b + m10), (a + m01, b + m11)
                back.append((int(to0[1] > to0[0]), int(to1[1] > to1[0])))
                a, b = max(to0), max(to1)
            b += gain
        label = int(b > a)
        out = [bool(label)]
        for step in reversed(back):
            label = step[label]
            out.append(bool(label))
        return out[::-1]


def train(pages: list[list[tuple[tuple[str, ...], int]]], steps: int = 150, ridge: float = 0.002) -> Field:
    """pages: per block its feature names and label. Maximum likelihood by Adam, forward and backward in lockstep."""
    index: dict[str, int] = {}
    for page in pages:
        for names, _ in page:
            for f in names:
                index.setdefault(f, len(index))
    n, width = len(pages), max(map(len, pages))
    x = np.zeros((n, width, len(index)), dtype=np.float32)
    y = np.zeros((n, width), dtype=np.int64)
    mask = np.zeros((n, width), dtype=bool)
    for i, page in enumerate(pages):
        for j, (names, label) in enumerate(page):
            x[i, j, [index[f] for f in names]] = 1
            y[i, j], mask[i, j] = label, True
    flat, total = x[mask], int(mask.sum())
    one = np.eye(2)
    truth = one[y]
    params = [np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    size = mask.sum(axis=1)
    for t in range(1, steps + 1):
        emit, move, start = params
        score = np.zeros((n, width, 2))
        score[mask] = flat @ emit
        fwd = np.zeros((n, width, 2))
        bwd = np.zeros((n, width, 2))
        fwd[:, 0] = start + score[:, 0]
        for j in range(1, width):
            fwd[:, j] = np.logaddexp(fwd[:, j - 1, :1] + move[0], fwd[:, j - 1, 1:] + move[1]) + score[:, j]
        for j in range(width - 2, -1, -1):
            after = score[:, j + 1] + bwd[:, j + 1]
            b = np.logaddexp(move[:, 0] + after[:, :1], move[:, 1] + after[:, 1:])
            bwd[:, j] = np.where((j + 1 < size)[:, None], b, 0)
        z = np.logaddexp(fwd[np.arange(n), size - 1, 0], fwd[np.arange(n), size - 1, 1])
        prob = np.where(mask[..., None], np.exp(fwd + bwd - z[:, None, None]), 0)
        pair = np.exp(fwd[:, :-1, :, None] + move + (score[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None]) * mask[:, 1:, None, None]
        real = (truth[:, :-1, :, None] * truth[:, 1:, None, :]) * mask[:, 1:, None, None]
        grads = [flat.T @ (truth[mask] - prob[mask]) / total, (real - pair).sum(axis=(0, 1)) / total, (truth[:, 0] - prob[:, 0]).sum(axis=0) / total]
        for p, g, (m, v) in zip(params, grads, moments):
            g = g - ridge * p / 10
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Field(index, *params)


def labelled_pages(count: int = TRAINING_PAGES, seed: int = SEED) -> list[list[tuple[tuple[str, ...], int]]]:
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        page = labelled_page(rng)
        names = features([Block(text, linked, path) for path, text, linked, _ in page])
        out.append([(f, int(label)) for f, (_, _, _, label) in zip(names, page)])
    return out


@functools.cache
def model() -> Field:
    return train(labelled_pages())


def extract(page: str | None, field: Field | None = None) -> str:
    """The main text of one page."""
    found = blocks(page or "")
    if not found:
        return ""
    kept = (field or model()).decode(found)
    return "\n".join(b.text for b, keep in zip(found, kept) if keep)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    field = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x, field) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    types = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
