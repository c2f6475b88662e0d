"""Main text of web pages by a recurrent block labeller.

A page is read as the sequence of its text blocks. Each block is a vector: its tag path (element names and words of
class, id and role, hashed), its words (hashed), and its length, share of link text and punctuation. A bidirectional LSTM in numpy reads
the whole sequence both ways, so each block is labelled with the context of the whole document, and the blocks labelled as article are joined
by newlines in page order.

The labeller is trained here, on at most `max_pages` pages (a documented bound; those with the least hash of url and html among
pages of up to `max_chars` characters): their blocks are labelled by the elements that say what they are (article and main against navigation,
header, footer, aside, form, and class or id words for adverts, notices, menus, comments). So that it does not depend on one layout,
the same texts are also laid out anew by a seeded generator with many kinds of wrappers. Its weights, some tens of
kilobytes, go to the tasks with the code; every page is labelled, whole.

Null html counts as empty; a page without article blocks has the text ''. Repeated rows are read each for itself. An empty table gives
an empty table. Only the named columns are read. Memory follows the longest page: about 800 bytes for each of its blocks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from fleetgauge.llm.common import Memo, bounded_sample, sliced, utf8
from fleetgauge.llm.html_blocks import PLACES, Block, Path, blocks_of, marks_inside_out

PATH, WORDS, FIGURES = PLACES, 32, 6
SIZE = PATH + WORDS + FIGURES

# What elements say about their text: names of elements, and words of class, id or role.
ARTICLE_MARKS = frozenset(("article", "main"))
FRAME_MARKS = frozenset(
    "nav header footer aside form menu sidebar ad ads advert advertisement banner sponsored promo cookie cookies consent notice "
    "comment comments newsletter subscribe share social related breadcrumb breadcrumbs pagination button select option label "
    "legend fieldset dialog popup modal copyright navigation toolbar widget login search masthead topbar disclaimer".split()
)


@dataclass(frozen=True)
class Labeller:
    max_pages: int = 200
    max_chars: int = 100_000
    layouts: int = 1_200
    hidden: int = 20
    epochs: int = 6
    rate: float = 0.01
    seed: int = 42


DEFAULT = Labeller()
_BUCKETS = Memo(lambda word: zlib.crc32(word.encode()) % WORDS, 200_000)
_TRIMMED = re.compile(r"[.!?…]$")


def vectors_of(blocks: list[Block]):
    """One row for each block."""
    import numpy as np

    out = np.zeros((len(blocks), SIZE), "float32")
    for row, block in zip(out, blocks):
        if block.path:
            bits = np.frombuffer(block.path.bits.to_bytes(PATH // 8, "little"), "uint8")
            row[:PATH] = np.unpackbits(bits, bitorder="little")
        words = block.text.lower().split()
        counts = np.bincount([_BUCKETS[w] for w in words], minlength=WORDS)
        row[PATH : PATH + WORDS] = counts / len(words)
        n = len(block.text)
        row[PATH + WORDS :] = (
            min(np.log1p(n) / 8, 2), min(np.log1p(len(words)) / 6, 2), block.link_chars / n,
            bool(_TRIMMED.search(block.text)), sum(map(block.text.count, "0123456789")) / n, 1.0,
        )
    return out


def _sigmoid(x):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """A bidirectional LSTM with a logistic unit over both states of each step."""

    def __init__(self, size: int, hidden: int, seed: int):
        import numpy as np

        random = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights = {}
        for way in "fb":
            self.weights["x" + way] = random.normal(0, 1 / np.sqrt(size), (size, 4 * hidden)).astype("float32")
            self.weights["h" + way] = random.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype("float32")
            bias = np.zeros(4 * hidden, "float32")
            bias[hidden : 2 * hidden] = 1  # remember at first
            self.weights["c" + way] = bias
        self.weights["o"] = random.normal(0, 1 / np.sqrt(2 * hidden), 2 * hidden).astype("float32")
        self.weights["p"] = np.zeros(1, "float32")

    def _run(self, x, mask, way: str, keep: bool):
        """States of all steps of a batch (steps, pages, size); a masked step leaves the state as it is."""
        import numpy as np

        w, h_ = self.weights, self.hidden
        steps, pages, _ = x.shape
        h = c = np.zeros((pages, h_), "float32")
        inputs = x @ w["x" + way] + w["c" + way]
        states, saved = np.zeros((steps, pages, h_), "float32"), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            gates = inputs[t] + h @ w["h" + way]
            i, f, o = _sigmoid(gates[:, :h_]), _sigmoid(gates[:, h_ : 2 * h_]), _sigmoid(gates[:, 2 * h_ : 3 * h_])
            g = np.tanh(gates[:, 3 * h_ :])
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            m = mask[t][:, None]
            if keep:
                saved.append((t, i, f, o, g, c, tanh_c, h, m))
            c = np.where(m, new_c, c)
            h = np.where(m, o * tanh_c, h)
            states[t] = h
        return states, saved

    def scores(self, x, mask):
        """Probability of article for each step of a batch."""
        import numpy as np

        both = np.concatenate([self._run(x, mask, way, False)[0] for way in "fb"], axis=2)
        return _sigmoid(both @ self.weights["o"] + self.weights["p"])

    def gradients(self, x, mask, y):
        import numpy as np

        w, h_ = self.weights, self.hidden
        runs = {way: self._run(x, mask, way, True) for way in "fb"}
        both = np.concatenate([runs[way][0] for way in "fb"], axis=2)
        wrong = (_sigmoid(both @ w["o"] + w["p"]) - y) * mask / max(1, mask.sum())
        out = {"o": np.einsum("tp,tph->h", wrong, both), "p": wrong.sum(keepdims=True).reshape(1)}
        spread = wrong[:, :, None] * w["o"]
        for place, way in enumerate("fb"):
            up = spread[:, :, place * h_ : (place + 1) * h_]
            dx, dh_w = np.zeros(x.shape[:2] + (4 * h_,), "float32"), np.zeros_like(w["h" + way])
            dh = dc = np.zeros((x.shape[1], h_), "float32")
            for t, i, f, o, g, c, tanh_c, before, m in reversed(runs[way][1]):
                dh = dh + up[t]
                live = np.where(m, dh, 0)
                d_c = live * o * (1 - tanh_c**2) + np.where(m, dc, 0)
                gates = np.concatenate(
                    [d_c * g * i * (1 - i), d_c * c * f * (1 - f), live * tanh_c * o * (1 - o), d_c * i * (1 - g**2)], axis=1
                )
                dx[t] = gates
                dh_w += before.T @ gates
                dh = np.where(m, 0, dh) + gates @ w["h" + way].T
                dc = np.where(m, 0, dc) + d_c * f
            out["x" + way] = np.einsum("tpi,tpj->ij", x, dx, optimize=True)
            out["h" + way] = dh_w
            out["c" + way] = dx.sum((0, 1))
        return out

    def train(self, pages: list[tuple], epochs: int, rate: float, seed: int, batch: int = 32) -> None:
        """Adam over batches of pages of about equal length; `pages` holds (vectors, labels)."""
        import numpy as np

        random = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        batches = [order[a : a + batch] for a in range(0, len(order), batch)]
        step = 0
        for _ in range(epochs):
            for b in random.permutation(len(batches)):
                x, mask = padded([pages[i][0] for i in batches[b]])
                y = np.zeros(mask.shape, "float32")
                for column, i in enumerate(batches[b]):
                    y[: len(pages[i][1]), column] = pages[i][1]
                step += 1
                for k, g in self.gradients(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)


def padded(pages: list):
    import numpy as np

    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), SIZE), "float32"), np.zeros((steps, len(pages)), bool)
    for column, page in enumerate(pages):
        x[: len(page), column] = page
        mask[: len(page), column] = True
    return x, mask


def marked_label(block: Block) -> int | None:
    """1 for article, 0 for the frame around it, by the innermost element that says so; None if none does."""
    for mark in marks_inside_out(block.path):
        words = mark.split()
        if FRAME_MARKS.intersection(words):
            return 0
        if ARTICLE_MARKS.intersection(words[:1]):
            return 1
    return None


ARTICLE_WRAPPERS = (
    "article", "main", "main|article", "div content", "div main content", "div post content", "div entry content", "div article body",
    "div story", "section content", "div text", "article post", "div page|div content", "td content", "div body|section",
    "", "div wrapper|main", "div container|article|div body", "section article text", "div post|div body", "article|section",
)
ARTICLE_LEAVES = ("p", "p", "p", "p", "h1", "h2", "h3", "blockquote", "ul|li", "ol|li", "pre", "div", "figure|figcaption", "p|b", "table|tr|td")
# wrapper, leaf, whether texts are links, how many blocks, whether texts are long
FRAMES = (
    ("nav", "ul|li", 1, 6, 0), ("div menu", "ul|li", 1, 5, 0), ("div navbar navigation", "a", 1, 4, 0), ("header", "h1", 0, 1, 0),
    ("header", "p", 0, 2, 0), ("header|nav", "ul|li", 1, 5, 0), ("footer", "p", 0, 1, 0), ("footer", "", 0, 1, 0), ("div footer", "p", 0, 2, 0),
    ("footer|ul", "li", 1, 4, 0), ("aside", "p", 0, 2, 1), ("aside sidebar", "h3", 0, 1, 0), ("div sidebar", "ul|li", 1, 4, 0),
    ("div sidebar", "p", 0, 2, 1), ("div ad", "", 0, 1, 1), ("div ads", "p", 0, 1, 1), ("div advert", "p", 0, 1, 1),
    ("div advertisement", "", 0, 1, 1), ("div banner", "p", 0, 1, 0), ("div sponsored", "p", 0, 1, 1), ("div promo", "p", 0, 1, 1),
    ("div cookie notice", "p", 0, 1, 1), ("div cookie banner", "p", 0, 1, 1), ("div consent", "p", 0, 1, 1), ("div notice", "", 0, 1, 1),
    ("div comments", "div comment|p", 0, 3, 1), ("section comments", "p", 0, 3, 1), ("section comments", "article comment|p", 0, 2, 1),
    ("ul comments", "li comment", 0, 3, 1), ("ol comment list", "li|p", 0, 3, 1), ("div newsletter|form", "label", 0, 1, 0),
    ("form", "label", 0, 2, 0), ("form", "p", 0, 1, 0), ("form search", "button", 0, 1, 0), ("form", "select|option", 0, 4, 0),
    ("div related", "ul|li", 1, 3, 0), ("div share", "a", 1, 3, 0), ("div social", "ul|li", 1, 3, 0), ("div breadcrumbs", "a", 1, 3, 0),
    ("ul pagination", "li", 1, 3, 0), ("p copyright", "", 0, 1, 0), ("div popup modal", "p", 0, 1, 1), ("dialog", "p", 0, 1, 0),
    ("div widget", "p", 0, 1, 0), ("div subscribe", "p", 0, 1, 0), ("menu", "li", 1, 3, 0), ("div disclaimer", "p", 0, 1, 1),
)
INSIDE = tuple(f for f in FRAMES if f[0].split("|")[0].split()[-1] in ("ad", "ads", "advert", "comments", "share", "related", "promo", "newsletter", "aside"))


def laid_out(texts: dict[int, list[str]], how: Labeller) -> list[list[Block]]:
    """Pages of labelled blocks with random layouts, filled with article texts (key 1) and other texts (key 0)."""
    import numpy as np

    random = np.random.default_rng(how.seed)
    pick = lambda options: options[int(random.integers(len(options)))]

    def text(long: bool, kind: int) -> str:
        words = pick(texts[kind] if random.random() < 0.7 else texts[1]).split()
        n = int(random.integers(8, 120) if long else random.integers(1, 9))
        start = int(random.integers(max(1, len(words) - n)))
        return " ".join(words[start : start + n])

    def marks(*paths: str) -> tuple[str, ...]:
        return tuple(m for path in paths for m in path.split("|") if m)

    def frame(kind, outer: tuple[str, ...]) -> Iterator[Block]:
        wrapper, leaf, link, most, long = kind
        for _ in range(int(random.integers(1, most + 1))):
            t = text(bool(long) and random.random() < 0.7, 0)
            yield Block(t, Path.of(outer + marks(wrapper, leaf, "a" if link and leaf != "a" else "")), len(t) * link, 0)

    pages = []
    for _ in range(how.layouts):
        outer = ("html", "body") + marks(pick(("", "", "div wrapper", "div container", "div page", "div site|div row")))
        page = [b for _ in range(int(random.integers(0, 5))) for b in frame(pick(FRAMES), outer)]
        inner = outer + marks(pick(ARTICLE_WRAPPERS))
        for n in range(int(random.integers(1, 14))):
            leaf = "h1" if n == 0 and random.random() < 0.6 else pick(ARTICLE_LEAVES)
            t = text(leaf[0] != "h" and random.random() < 0.8, 1)
            page.append(Block(t, Path.of(inner + marks(leaf)), int(len(t) * (random.random() < 0.1) * random.random()), 1))
            if random.random() < 0.06:
                page += frame(pick(INSIDE), inner)
        page += [b for _ in range(int(random.integers(0, 5))) for b in frame(pick(FRAMES), outer)]
        pages.append(page)
    return pages


def train_labeller(pages: DataFrame, how: Labeller = DEFAULT, html: str = "html", tie: str = "url") -> BiLstm:
    """Fit the labeller on a bounded sample of `pages`, on the driver."""
    usable = pages.where(F.length(html).between(1, how.max_chars)).select(F.col(html).alias("h"), F.col(tie).alias("t"))
    sample = bounded_sample(usable, F.xxhash64("t", "h"), how.max_pages).collect()
    known = []
    for row in sample:
        blocks = blocks_of(row.h)
        labels = [marked_label(b) for b in blocks]
        if blocks and None not in labels:
            known.append((blocks, labels))
    texts = {kind: [b.text for blocks, labels in known for b, y in zip(blocks, labels) if y == kind] for kind in (0, 1)}
    for kind in (0, 1):
        texts[kind] = texts[kind] or ["some plain words that fill a block when no page says more about its parts"]
    made = [(page, [b.label for b in page]) for page in laid_out(texts, how)]
    model = BiLstm(SIZE, how.hidden, how.seed)
    model.train([(vectors_of(blocks), labels) for blocks, labels in known + made], how.epochs, how.rate, how.seed)
    return model


def article_blocks(model: BiLstm, pages: list[str], batch: int = 128) -> list[list[Block]]:
    """The blocks of each page that the labeller takes for the article."""
    blocks = [blocks_of(page) for page in pages]
    out: list[list[Block]] = [[] for _ in pages]
    order = sorted((i for i in range(len(pages)) if blocks[i]), key=lambda i: len(blocks[i]))
    at = 0
    while at < len(order):
        # longer pages go in smaller batches
        size = max(1, min(batch, 20_000 // len(blocks[order[min(at + batch, len(order)) - 1]])))
        part, at = order[at : at + size], at + size
        score = model.scores(*padded([vectors_of(blocks[i]) for i in part]))
        for column, i in enumerate(part):
            out[i] = [b for b, s in zip(blocks[i], score[: len(blocks[i]), column].tolist()) if s > 0.5]
    return out


def extract_text(pages: DataFrame, model: BiLstm, carry: list[str], html: str = "html") -> DataFrame:
    """The columns `carry` with `text`, the article's blocks joined by newlines."""
    fields = [pages.schema[c] for c in carry]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part in sliced(batches):
            found = article_blocks(model, [page.decode() for page in utf8(part["_html"])])
            texts = pa.array(["\n".join(b.text for b in blocks) for blocks in found], pa.string())
            yield pa.RecordBatch.from_arrays([*(part[c] for c in carry), texts], names=[*carry, "_text"])

    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["_text string"])
    narrow = pages.select(*carry, F.col(html).alias("_html"))
    return narrow.mapInArrow(run, ddl).withColumnRenamed("_text", "text")
