"""HTML extraction: a bidirectional LSTM labels every text block of a page."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALPHANUMERIC, Words, map_arrow

#: Pages that the labeller is fitted on, at most, and the longest of them in bytes.
SAMPLE = 240
SAMPLE_BYTES = 100_000

_TAG = re.compile(
    # What a browser reads as text up to the end tag, or to the end of the page; then
    # what has to be closed to have a content: without an end tag only the tag goes.
    r"<!--.*?(?:-->|$)|<(script|style|textarea|iframe)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|$)"
    r"|<(?P<closed>svg|select|object|noscript|template)\b"
    r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?<!/)>.*?</(?P=closed)\s*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<names>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE)
_NAMES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))",
                    re.IGNORECASE)
_TOKEN = re.compile(r"[a-z]+")

# Fixed by HTML: elements that start a block, and those without content.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title "
    "tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Of these only what is closed is left out; without an end tag they hold nothing.
CLOSED_TAGS = frozenset("svg select object noscript template".split())
SPACE_TAGS = frozenset(("br", "wbr", "img", "input", "button"))

# Words in tags, classes, ids and roles that tell what an area is for.
AREAS = {
    "navigation": "nav menu breadcrumb breadcrumbs navbar navigation toc pagination pager",
    "header": "header masthead topbar branding logo",
    "footer": "footer colophon copyright bottom",
    "sidebar": "aside sidebar side widget related recommended rail complementary",
    "notice": "notice cookie cookies consent banner alert popup modal gdpr warning",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion",
    "form": "form search subscribe newsletter signup login button fieldset input",
    "comments": "comment comments commentlist discussion disqus reply replies respond reader",
    "share": "share sharing social follow tags meta byline",
    "hidden": "head title",
}
CONTENT = "article main content post entry story body text"
_AREA_OF = {word: area for area, words in AREAS.items() for word in words.split()}
_AREA_NAMES = tuple(AREAS)
_CONTENT = frozenset(CONTENT.split()) - {"body", "text"}

PATH_SLOTS, WORD_SLOTS, PLAIN = 32, 16, 8
INPUTS = PATH_SLOTS + WORD_SLOTS + len(AREAS) + 1 + PLAIN
HIDDEN = 12


@dataclass
class Block:
    """A run of text between block boundaries."""

    path: tuple[str, ...]  # tags and names of the elements around it, outermost first
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def parse(page: str) -> list[Block]:
    """The text blocks of a page in order; unclosed and stray tags are tolerated."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    blocks: list[Block] = []
    current: Block | None = None
    links = 0

    def path() -> tuple[str, ...]:
        return tuple(token for _, tokens in stack for token in tokens)

    def add(text: str) -> None:
        nonlocal current
        if not text:
            return
        if current is None:
            if not text.strip():
                return
            current = Block(path())
            blocks.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    at = 0
    for match in _TAG.finditer(page):
        add(page[at:match.start()])
        at = match.end()
        name = match.group("name")
        if name is None:
            continue
        name = name.lower()
        if match.group("end"):
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                for closed, _ in stack[depth:]:
                    links -= closed == "a"
                    if closed in BLOCK_TAGS:
                        current = None
                del stack[depth:]
            if name in BLOCK_TAGS:
                current = None
            continue
        if name in SPACE_TAGS:
            add(" ")
        if name in BLOCK_TAGS:
            current = None
            open_tags = [tag for tag, _ in stack]
            if "p" in open_tags and name not in ("title",):
                depth = len(open_tags) - 1 - open_tags[::-1].index("p")
                links -= open_tags[depth:].count("a")
                del stack[depth:]
            elif name in ("li", "dd", "dt", "tr", "td", "th") and stack and stack[-1][0] == name:
                stack.pop()
        if name in VOID_TAGS or name in CLOSED_TAGS:
            continue
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(match.group("names") or ""))
        stack.append((name, (name, *("." + t for t in _TOKEN.findall(names.lower())))))
        links += name == "a"
    add(page[at:])
    return [block for block in blocks if block.text]


def weak_label(block: Block) -> int:
    """A first guess from the names of areas: 1 for the article.  Used for fitting only."""
    inside = 0
    for token in block.path:
        word = token.lstrip(".")
        area = _AREA_OF.get(word)
        if area == "header" and inside:
            area = None  # an article's own heading
        if area and not (area == "share" and not token.startswith(".")):
            return 0
        inside |= word in _CONTENT
    return inside


def _slot(token: str, slots: int) -> int:
    return zlib.crc32(token.encode()) % slots


def features(pages: list[list[Block]]) -> list[np.ndarray]:
    """A row of inputs for each block of each page."""
    flat = [block for page in pages for block in page]
    out = np.zeros((len(flat), INPUTS), dtype=np.float32)
    texts = [block.text.encode() for block in flat]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    words = Words(data, np.concatenate([[0], np.cumsum(sizes)]), ALPHANUMERIC)
    counts = np.diff(words.doc_starts)
    owner = np.repeat(np.arange(len(flat)), counts)
    slots = (words.hashes % np.uint64(WORD_SLOTS)).astype(np.int64)
    hashed = np.bincount(owner * WORD_SLOTS + slots, minlength=len(flat) * WORD_SLOTS)
    out[:, PATH_SLOTS:PATH_SLOTS + WORD_SLOTS] = (
        hashed.reshape(len(flat), WORD_SLOTS) / np.maximum(counts, 1)[:, None])
    known: dict[tuple[str, ...], tuple[list[int], list[int]]] = {}
    row = 0
    base = PATH_SLOTS + WORD_SLOTS
    for page in pages:
        for place, block in enumerate(page):
            if block.path not in known:
                tokens = block.path
                areas = [_AREA_NAMES.index(_AREA_OF[w]) for w in
                         (t.lstrip(".") for t in tokens) if w in _AREA_OF]
                if any(t.lstrip(".") in _CONTENT for t in tokens):
                    areas.append(len(AREAS))
                known[block.path] = ([_slot(t, PATH_SLOTS) for t in tokens[-6:]],
                                     [base + a for a in areas])
            path_at, area_at = known[block.path]
            out[row, path_at] = 1
            out[row, area_at] = 2
            size = max(len(texts[row]), 1)
            out[row, -PLAIN:] = (
                np.log1p(counts[row]) / 4, min(block.linked / size, 1),
                place / len(page), (len(page) - place) / len(page), block.path[-1:] == ("p",),
                texts[row][-1:] in (b".", b"!", b"?"), "h1" in block.path,
                texts[row].count(b",") > 0)
            row += 1
    ends = np.cumsum([len(page) for page in pages])
    return [out[e - len(page):e] for e, page in zip(ends, pages)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with a logistic output for each block."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 3):
        if weights is None:
            rng = np.random.default_rng(seed)
            weights = {}
            for way in ("f", "b"):
                weights[f"x{way}"] = rng.normal(0, 0.15, (INPUTS, 4 * HIDDEN))
                weights[f"h{way}"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
                bias = np.zeros(4 * HIDDEN)
                bias[HIDDEN:2 * HIDDEN] = 1  # remember at first
                weights[f"c{way}"] = bias
            weights["o"] = rng.normal(0, 0.15, 2 * HIDDEN)
            weights["s"] = rng.normal(0, 0.05, INPUTS)
            weights["p"] = np.zeros(1)
            weights = {name: w.astype(np.float32) for name, w in weights.items()}
        self.weights = weights

    def _run(self, way: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        w, steps = self.weights, range(x.shape[0])
        n = x.shape[1]
        h = np.zeros((n, HIDDEN), dtype=np.float32)
        c = np.zeros_like(h)
        out = np.zeros((x.shape[0], n, HIDDEN), dtype=np.float32)
        inputs = x @ w[f"x{way}"] + w[f"c{way}"]
        memory = {}
        for t in steps if way == "f" else reversed(steps):
            z = inputs[t] + h @ w[f"h{way}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            new = f * c + i * g
            th = np.tanh(new)
            if keep:
                memory[t] = (i, f, o, g, c, h, th)
            c, h = m * new + (1 - m) * c, m * (o * th) + (1 - m) * h
            out[t] = h
        return out, memory

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Probabilities (steps x pages) of padded pages (steps x pages x inputs)."""
        ahead, am = self._run("f", x, mask, keep)
        back, bm = self._run("b", x, mask, keep)
        both = np.concatenate([ahead, back], axis=2)
        w = self.weights
        return _sigmoid(both @ w["o"] + x @ w["s"] + w["p"]), (both, am, bm)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over the blocks, by backpropagation through time."""
        p, (both, *memories) = self.forward(x, mask, keep=True)
        error = (p - y) * mask / mask.sum()
        w = self.weights
        grads = {"o": np.einsum("tn,tnk->k", error, both),
                 "s": np.einsum("tn,tnk->k", error, x), "p": np.array([error.sum()])}
        for number, (way, memory) in enumerate(zip("fb", memories)):
            top = w["o"][number * HIDDEN:(number + 1) * HIDDEN]
            dx = np.zeros_like(w[f"x{way}"])
            dh_w = np.zeros_like(w[f"h{way}"])
            db = np.zeros_like(w[f"c{way}"])
            dh = np.zeros((x.shape[1], HIDDEN))
            dc = np.zeros_like(dh)
            steps = range(x.shape[0])
            for t in reversed(steps) if way == "f" else steps:
                i, f, o, g, c, h, th = memory[t]
                m = mask[t][:, None]
                dh = dh + error[t][:, None] * top
                inner = m * dh
                dnew = m * dc + inner * o * (1 - th ** 2)
                dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f),
                                     inner * th * o * (1 - o), dnew * i * (1 - g ** 2)], axis=1)
                dx += x[t].T @ dz
                dh_w += h.T @ dz
                db += dz.sum(0)
                dh = (1 - m) * dh + dz @ w[f"h{way}"].T
                dc = (1 - m) * dc + dnew * f
            grads |= {f"x{way}": dx, f"h{way}": dh_w, f"c{way}": db}
        return grads

    def label(self, pages: list[np.ndarray], batch: int = 128) -> list[np.ndarray]:
        """Probabilities of the blocks of each page, as many as there are."""
        out: list = [None] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        for first in range(0, len(order), batch):
            some = order[first:first + batch]
            x, mask = _pad([pages[i] for i in some])
            p, _ = self.forward(x, mask)
            for column, i in enumerate(some):
                out[i] = p[:len(pages[i]), column]
        return out


def _pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max((len(p) for p in pages), default=0)
    x = np.zeros((longest, len(pages), INPUTS), dtype=np.float32)
    mask = np.zeros((longest, len(pages)), dtype=np.float32)
    for i, page in enumerate(pages):
        x[:len(page), i] = page
        mask[:len(page), i] = 1
    return x, mask


def varied(page: list[Block], labels: list[int], texts: list[str], rng: np.random.Generator
           ) -> tuple[list[Block], list[int]]:
    """A page like the given one, with other areas added and its article renamed."""
    names = ("main", "section", "div", "div .content", "div .post .body", "div .entry .content",
             "div .story", "article .post", "div .article", "div .main")
    renamed = names[rng.integers(len(names))].split()
    out, marks = [], []
    for block, label in zip(page, labels):
        path = []
        for token in block.path:
            path += renamed if token == "article" and rng.random() < 0.95 else [token]
        out.append(Block(tuple(path), block.parts, block.linked))
        marks.append(label)
    inner = [i for i, label in enumerate(marks) if label]
    for area in rng.choice(len(AREAS) - 1, size=rng.integers(1, 5), replace=False):
        words = AREAS[_AREA_NAMES[area]].split()
        word = words[rng.integers(len(words))]
        tag = word if word in BLOCK_TAGS and rng.random() < 0.7 else "div ." + word
        tail = (("p",), ("div",), ("ul", "li"), ("ul", "li", "a"), ())[rng.integers(5)]
        within = inner and rng.random() < 0.35
        around = out[inner[0]].path[:-1] if within else ("html", "body")
        at = (int(rng.integers(inner[0], inner[-1] + 2)) if within
              else int(rng.choice([0, inner[0] if inner else 0, len(out)])))
        added = []
        for _ in range(rng.integers(1, 5)):
            text = texts[rng.integers(len(texts))]
            if "a" in tail or rng.random() < 0.4:
                text = " ".join(text.split()[:rng.integers(1, 8)])
            added.append(Block((*around, *tag.split(), *tail), [html.escape(text)],
                               len(text) if "a" in tail else 0))
        out[at:at] = added
        marks[at:at] = [0] * len(added)
        inner = [i for i, label in enumerate(marks) if label]
    return out, marks


def fit(pages: list[str], epochs: int = 14, rate: float = 0.01) -> Labeller:
    """A labeller fitted on weak labels of ``pages`` and of varied copies of them."""
    parsed = [page for page in map(parse, pages) if page]
    rng = np.random.default_rng(9)
    texts = [block.text for page in parsed for block in page] or ["a"]
    examples = []
    for page in parsed:
        labels = [weak_label(block) for block in page]
        examples.append((page, labels))
        for _ in range(2):
            examples.append(varied(page, labels, texts, rng))
    model = Labeller()
    if not examples:
        return model
    inputs = features([page for page, _ in examples])
    targets = [np.array(labels, dtype=np.float32) for _, labels in examples]
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step, batch = 0, 24
    for epoch in range(epochs):
        order = rng.permutation(len(examples))
        order = order[np.argsort([len(inputs[i]) // 8 for i in order], kind="stable")]
        groups = [order[i:i + batch] for i in range(0, len(order), batch)]
        for at in rng.permutation(len(groups)):
            x, mask = _pad([inputs[i] for i in groups[at]])
            y = np.zeros_like(mask)
            for column, i in enumerate(groups[at]):
                y[:len(targets[i]), column] = targets[i]
            step += 1
            # Adam; the rate falls to a tenth.
            now = rate * (1 - 0.9 * epoch / epochs)
            for name, g in model.gradients(x, mask, y).items():
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                model.weights[name] = (model.weights[name] - now * (
                    first[name] / (1 - 0.9 ** step))
                    / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def train(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    """Fit in one task on at most ``sample`` pages of bounded length, taken by hash.

    Weights of a fixed size come back to the driver.
    """
    some = (pages.where((F.octet_length("html") > 0) & (F.octet_length("html") <= SAMPLE_BYTES))
            .orderBy(F.xxhash64("page_id"), "page_id").limit(sample).select("html"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages = sorted(text for batch in batches for text in batch.column("html").to_pylist())
        model = fit(pages)
        names = sorted(model.weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([model.weights[n].astype(np.float32).tobytes()
                                        for n in names], pa.binary())], ["name", "weight"])

    rows = map_arrow(some.repartition(1), apply, "name string, weight binary").collect()
    shapes = {name: w.shape for name, w in Labeller().weights.items()}
    return Labeller({row["name"]: np.frombuffer(row["weight"], dtype=np.float32)
                     .reshape(shapes[row["name"]]) for row in rows}) if rows else Labeller()


def extract(pages: DataFrame, model: Labeller, batch: int = 256) -> DataFrame:
    """All columns of ``pages`` and ``text``: the blocks labelled as the article's.

    White space within a block becomes one space, blocks are joined by a blank
    line, character references are decoded.  NULL, empty and text-free pages give
    an empty text; broken markup is read as far as it goes; whole pages are read.
    Every row stands alone.  A column ``text`` already there is replaced.
    """
    kept = pages.drop("text")
    at, names = kept.columns.index("html"), [*kept.columns, "text"]
    shared = pages.sparkSession.sparkContext.broadcast(model.weights)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Labeller(shared.value)
        for rows in batches:
            for first in range(0, rows.num_rows, batch):
                part = rows.slice(first, batch)
                parsed = [parse(page or "") for page in part.column(at).to_pylist()]
                labels = model.label(features(parsed)) if any(parsed) else [()] * len(parsed)
                texts = ["\n\n".join(b.text for b, p in zip(page, label) if p >= 0.5)
                         for page, label in zip(parsed, labels)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names)

    return map_arrow(kept, apply, T.StructType(
        [*kept.schema.fields, T.StructField("text", T.StringType())]))
