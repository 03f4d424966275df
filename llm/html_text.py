"""Main text of web pages: a recurrent labeller reads a page's blocks and keeps the article's.

A page becomes a sequence of leaf blocks in page order. A block's vector is made of its tag path
(tag names, words of class and id, hashed), its words (hashed) and a few figures. A bidirectional
LSTM in numpy reads the whole sequence in both directions and gives each block the probability
that it is part of the article. The labeller is trained on generated pages, whose blocks' labels
are known: articles amid menus, headers, footers, sidebars, notices, adverts, forms and comments,
in many arrangements, with class names that help, mislead or are absent.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import drop_columns, ship

# Elements by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg iframe select textarea title".split())
#: Of these an element without an end runs to the end of the page; the text of other silent ones stays then.
RAW_TEXT = frozenset("script style textarea title".split())
IN_HEAD = frozenset("html head title meta link base script style noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br img input object "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mspace "
    "mstyle semantics annotation".split()
)
#: A start tag of the first kind ends an open element of the second.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+")
_NO_DIGITS = re.compile(r"\D+")

PATH_CELLS, WORD_CELLS = 1024, 512
PATH_SIZE, WORD_SIZE, FIGURES, HIDDEN = 24, 12, 7, 24
#: Generated pages to train on, passes over them, and the seed; the model depends on nothing else.
TRAINING_PAGES, PASSES, SEED = 900, 7, 11
#: Blocks (with padding) that are labelled at once.
BATCH_BLOCKS = 20_000
_MEMORY = 200_000


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    words: int
    linked: int  # characters inside links


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks with text, in page order. Unclosed elements end where their parent does, and the
    head where text or an element begins that cannot stand in it."""
    stack: list[tuple[str, str]] = []  # tag, hashed names of it
    found: list[Block] = []
    pieces: list[str] = []
    state = {"linked": 0, "links": 0, "path": ()}
    page = page or ""
    at, size = 0, len(page)

    def close_block() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                found.append(Block(state["path"], text, text.count(" ") + 1, state["linked"]))
            pieces.clear()
        state["linked"] = 0

    def end_head() -> None:
        depth = next((k for k, (tag, _) in enumerate(stack) if tag == "head"), None)
        if depth is not None:
            del stack[depth:]

    def add(text: str) -> None:
        if not text:
            return
        if not pieces:
            if text.isspace():
                return
            end_head()
            state["path"] = tuple(name for _, names in stack for name in names.split())
        pieces.append(text)
        if state["links"]:
            state["linked"] += len(text.strip())

    def end_of(tag: str, start: int, empty: bool) -> int:
        """Where the text of a silent element is over, 0 if it has none or never ends."""
        if empty:
            return 0
        if tag not in missing:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, start)
            if end:
                return end.end()
            missing.add(tag)  # looked for once, so many open tags take linear time
        return size if tag in RAW_TEXT else 0

    missing: set[str] = set()
    for token in iter(lambda: _TOKEN.search(page, at), None):
        add(page[at : token.start()])
        at = token.end()
        tag = (token.group(2) or "").lower()
        if not tag:
            continue
        if token.group(1):
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is None:
                continue
            if any(name not in INLINE for name, _ in stack[depth:]):
                close_block()
            del stack[depth:]
        elif tag in SILENT and (end := end_of(tag, at, (token.group(3) or "").endswith("/"))):
            at = end
            continue
        else:
            if tag not in IN_HEAD:
                end_head()
            if tag == "br":
                add(" ")
            if tag not in INLINE:
                close_block()
                ends = CLOSES.get(tag, ())
                if ends and stack and stack[-1][0] in ends:
                    del stack[-1]
                # A block element inside an unclosed paragraph ends the paragraph.
                depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p"), None)
                if depth is not None and all(name in INLINE for name, _ in stack[depth + 1 :]):
                    del stack[depth:]
            if tag not in VOID and not (token.group(3) or "").endswith("/"):
                names = [tag]
                for name in _NAMED.finditer(token.group(3) or "") if token.group(3) else ():
                    value = (name.group(2) or name.group(3) or name.group(4) or "").lower()
                    names += [f".{part}" for part in _PARTS.findall(value)]
                stack.append((tag, " ".join(names)))
        state["links"] = sum(name == "a" for name, _ in stack)
    add(page[at:])
    close_block()
    return found


_cells: dict[str, int] = {}


def _cell(name: str, cells: int) -> int:
    if (value := _cells.get(name)) is None:
        if len(_cells) >= _MEMORY:
            _cells.clear()
        value = _cells[name] = xxhash.xxh32_intdigest(name.encode("utf-8", "replace"))
    return value % cells


def _figures(block: Block) -> list[float]:
    length = len(block.text)
    ends = block.text[-1] in ".!?…\"'”»"
    return [
        np.log1p(block.words) / 4, min(1.0, block.linked / length), float(ends),
        min(1.0, block.text.count(",") / block.words), len(_NO_DIGITS.sub("", block.text)) / length,
        len(block.path) / 10, 1.0,
    ]


def _bags(blocks: list[Block]) -> tuple[np.ndarray, ...]:
    """Hashed path and words of all blocks, end to end, with sizes, and the figures."""
    path = [[_cell(name, PATH_CELLS) for name in (*b.path, b.path[-1] + ">" if b.path else ">")] for b in blocks]
    words = [[_cell(w, WORD_CELLS) for w in b.text.lower().split()] for b in blocks]
    flat = lambda lists: np.array([x for one in lists for x in one], np.int64)
    sizes = lambda lists: np.array([len(x) for x in lists], np.int64)
    figures = np.array([_figures(b) for b in blocks], np.float32).reshape(-1, FIGURES)
    return flat(path), sizes(path), flat(words), sizes(words), figures


def _mean(table: np.ndarray, cells: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Means of table rows; every block has at least one cell. In steps, for very long texts."""
    out = np.empty((len(sizes), table.shape[1]), np.float32)
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        first = ends[low] - sizes[low]
        high = max(low + 1, int(np.searchsorted(ends, first + 200_000, side="right")))
        part = table[cells[first : ends[high - 1]]]
        out[low:high] = np.add.reduceat(part, ends[low:high] - sizes[low:high] - first, axis=0)
        low = high
    return out / sizes[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block vectors with a logistic output per block."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        width = PATH_SIZE + WORD_SIZE + FIGURES
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.w = {"path": draw(PATH_CELLS, PATH_SIZE) * 8, "word": draw(WORD_CELLS, WORD_SIZE) * 4}
        for side in "fb":
            self.w |= {f"x{side}": draw(width, 4 * HIDDEN), f"h{side}": draw(HIDDEN, 4 * HIDDEN)}
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember, to begin with
            self.w[f"b{side}"] = bias
        self.w |= {"out": draw(2 * HIDDEN + width, 1), "bias": np.zeros(1, np.float32)}

    def inputs(self, blocks: list[Block]) -> tuple[np.ndarray, tuple]:
        bags = _bags(blocks)
        path, path_sizes, words, word_sizes, figures = bags
        x = [_mean(self.w["path"], path, path_sizes), _mean(self.w["word"], words, word_sizes), figures]
        return np.concatenate(x, axis=1), bags

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        steps, pages = mask.shape
        into, weights = x @ self.w[f"x{side}"] + self.w[f"b{side}"], self.w[f"h{side}"]
        h = c = np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = into[t] + h @ weights
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c_new = f * c + i * g
            squashed = np.tanh(c_new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, squashed, m))
            c = m * c_new + (1 - m) * c
            h = m * (o * squashed) + (1 - m) * h
            out[t] = h
        return out

    def _pages(self, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Where block k of page p stands: index [step, page], and which are blocks at all."""
        steps, starts = max(sizes), np.cumsum([0, *sizes[:-1]])
        step = np.arange(steps)[:, None]
        mask = step < np.array(sizes)[None, :]
        return np.where(mask, starts[None, :] + step, 0), mask

    def probabilities(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Per page its blocks' probabilities. Pages of similar length are labelled together."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= BATCH_BLOCKS:
                end += 1
            group = order[at:end]
            x, _ = self.inputs([b for k in group for b in pages[k]])
            index, mask = self._pages([len(pages[k]) for k in group])
            seq, m = x[index], mask.astype(np.float32)
            hidden = [self._run(seq, m, side, None) for side in "fb"]
            p = _sigmoid((np.concatenate([*hidden, seq], axis=2) @ self.w["out"])[:, :, 0] + self.w["bias"])
            for column, k in enumerate(group):
                out[k] = p[: len(pages[k]), column]
            at = end
        return out

    def gradients(self, pages: list[list[Block]], labels: list[list[int]]) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of one batch, by back-propagation through time."""
        w = self.w
        x, (path, path_sizes, words, word_sizes, _) = self.inputs([b for page in pages for b in page])
        index, mask = self._pages([len(p) for p in pages])
        m, seq = mask.astype(np.float32), x[index]
        truth = np.array([y for page in labels for y in page], np.float32)[index]
        kept: dict[str, list] = {"f": [], "b": []}
        hidden = [self._run(seq, m, side, kept[side]) for side in "fb"]
        top = np.concatenate([*hidden, seq], axis=2)
        p = _sigmoid((top @ w["out"])[:, :, 0] + w["bias"])
        loss = -np.sum(m * (truth * np.log(p + 1e-7) + (1 - truth) * np.log(1 - p + 1e-7))) / m.sum()
        d_out = (m * (p - truth) / m.sum())[:, :, None].astype(np.float32)
        grads = {"out": np.einsum("tpk,tpo->ko", top, d_out), "bias": d_out.sum(axis=(0, 1))}
        d_top = d_out @ w["out"].T
        d_seq = d_top[:, :, 2 * HIDDEN :].copy()
        for number, side in enumerate("fb"):
            d_hidden = d_top[:, :, number * HIDDEN : (number + 1) * HIDDEN]
            d_into = np.zeros((*m.shape, 4 * HIDDEN), np.float32)
            d_weights = np.zeros_like(w[f"h{side}"])
            dh = dc = np.zeros((m.shape[1], HIDDEN), np.float32)
            for t, h, c, i, f, o, g, squashed, live in reversed(kept[side]):
                dh = dh + d_hidden[t]
                inner = live * dh
                d_c = live * dc + inner * o * (1 - squashed**2)
                dz = np.concatenate(
                    [d_c * g * i * (1 - i), d_c * c * f * (1 - f), inner * squashed * o * (1 - o), d_c * i * (1 - g**2)], axis=1
                )
                d_into[t] = dz
                d_weights += h.T @ dz
                dh = dz @ w[f"h{side}"].T + (1 - live) * dh
                dc = d_c * f + (1 - live) * dc
            grads[f"h{side}"], grads[f"b{side}"] = d_weights, d_into.sum(axis=(0, 1))
            grads[f"x{side}"] = np.einsum("tpd,tpk->dk", seq, d_into)
            d_seq += d_into @ w[f"x{side}"].T
        d_x = np.zeros_like(x)
        d_x[index[mask]] = d_seq[mask]
        for name, cells, sizes, cut in (
            ("path", path, path_sizes, slice(0, PATH_SIZE)), ("word", words, word_sizes, slice(PATH_SIZE, PATH_SIZE + WORD_SIZE)),
        ):
            grads[name] = np.zeros_like(w[name])
            np.add.at(grads[name], cells, np.repeat(d_x[:, cut] / sizes[:, None], sizes, axis=0))
        return float(loss), grads

    def train(self, pages: list[list[Block]], labels: list[list[int]], passes: int, seed: int, rate: float = 0.01) -> None:
        """Adam on batches of 32 pages."""
        rng, step = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for number in range(passes):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), 32):
                group, step = order[at : at + 32], step + 1
                _, grads = self.gradients([pages[k] for k in group], [labels[k] for k in group])
                pace = rate * (1 - 0.8 * number / max(1, passes - 1))
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.w[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)


class Pages:
    """Generates pages with known labels. Main text carries the mark {1}, the rest {0}."""

    SYLLABLES = "th er on an in re ed at en es or ti ou ea ha st nd le la ei un ch ca mo si du vé ño ü ko".split()

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(self.SYLLABLES) for _ in range(self.r.choice((1, 1, 2, 2, 3, 4))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def prose(self, low: int = 1, high: int = 5) -> str:
        return " ".join(f"{self.words(1, 16).capitalize()}." for _ in range(self.r.randint(low, high)))

    def named(self, tag: str, names: str, content: str, strict: bool = False) -> str:
        """An element, with a telling name, without one, or with one that says nothing."""
        draw = self.r.random()
        if names and (strict or draw < 0.8):
            name = self.r.choice(names.split())
            attribute = f' {self.r.choice(("class", "class", "id"))}="{name}"'
        else:
            attribute = f' class="{self.word()}"' if draw > 0.9 else ""
        return f"<{tag}{attribute}>{content}</{tag}>"

    def paragraph(self, mark: str, tag: str = "p", low: int = 1, high: int = 6) -> str:
        inner = self.prose(low, high)
        draw = self.r.random()
        if draw < 0.15:
            return f"<{tag}><b>{mark}{inner}<br>"  # left open
        if draw < 0.3:
            inner = f"{inner} <a href='/{self.word()}'>{self.words(1, 3)}</a> {self.prose(1, 2)}"
        if draw < 0.4:
            inner = f"<em>{self.words(1, 3)}</em> {inner}"
        return f"<{tag}>{mark}{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        return "".join(f"<li><a href='/{self.word()}'>{{0}}{self.words(1, 3)}</a></li>" for _ in range(self.r.randint(low, high)))

    def article(self) -> str:
        r, parts = self.r, []
        if r.random() < 0.85:
            parts.append(f"<h1>{{1}}{self.words(1, 12)}</h1>")
        for _ in range(r.choice((1, 1, 2, 3, 5, 8, 12, 20))):
            draw = r.random()
            if draw < 0.78:
                parts.append(self.paragraph("{1}", high=r.choice((2, 6, 12))))
            elif draw < 0.84:
                parts.append(f"<h{(n := r.choice((2, 3)))}>{{1}}{self.words(1, 6)}</h{n}>")
            elif draw < 0.89:
                parts.append("<ul>" + "".join(f"<li>{{1}}{self.prose(1, 2)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif draw < 0.93:
                parts.append(f"<blockquote>{self.paragraph('{1}')}</blockquote>")
            elif draw < 0.96:
                parts.append("<table>" + "".join(f"<tr><td>{{1}}{self.words(1, 3)}</td><td>{{1}}{self.words(1, 4)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            else:
                parts.append(self.named("div", "ad advert banner sponsored promo", f"{{0}}{self.prose(1, 2)}", strict=True))
        body, draw = "".join(parts), r.random()
        if draw < 0.45:
            return f"<article>{body}</article>"
        if draw < 0.6:
            return self.named("main", "content main", body)
        if draw < 0.7:
            return f"<main><article>{body}</article></main>"
        tag = r.choice(("div", "div", "section", "td"))
        whole = self.named(tag, "content post entry article story main body text maincontent postbody entry-content article-body post-content", body, strict=True)
        return f"<table><tr>{whole}</tr></table>" if tag == "td" else whole

    def comments(self) -> str:
        one = lambda: self.named(self.r.choice(("div", "li", "article")), "comment reply", f"<span>{{0}}{self.word()}</span>{self.paragraph('{0}')}")
        inner = f"<h3>{{0}}{self.words(1, 3)}</h3>" + "".join(one() for _ in range(self.r.randint(1, 5)))
        return self.named(self.r.choice(("section", "div", "ol")), "comments comment-list discussion responses replies", inner, strict=True)

    def form(self) -> str:
        fields = "".join(f"<label>{{0}}{self.words(1, 3)}</label><input name='{self.word()}'>" for _ in range(self.r.randint(1, 4)))
        return f"<form><p>{{0}}{self.words(1, 8)}</p>{fields}<button>{{0}}{self.word()}</button></form>"

    def sidebar(self) -> str:
        inner = f"<h3>{{0}}{self.words(1, 3)}</h3>" + (f"<ul>{self.links(2, 6)}</ul>" if self.r.random() < 0.5 else self.paragraph("{0}"))
        if self.r.random() < 0.5:
            return self.named("aside", "sidebar side widget", inner)
        return self.named("div", "sidebar side widget rail right-column related", inner, strict=True)

    def before(self) -> list[str]:
        r = self.r
        header = f"<h{(n := r.choice((1, 2)))}>{{0}}{self.words(1, 3)}</h{n}><p>{{0}}{self.words(2, 8)}</p>"
        menu = f"<ul>{self.links(3, 9)}</ul>"
        choices = [
            (0.75, lambda: self.named("nav", "menu nav navbar", menu) if r.random() < 0.7 else self.named("div", "menu nav navigation navbar topnav", menu, strict=True)),
            (0.4, lambda: self.named("header", "header masthead site-header", header) if r.random() < 0.6 else self.named("div", "header masthead banner top site-header", header, strict=True)),
            (0.5, lambda: self.named(r.choice(("div", "div", "section", "ins")), "ad ads advert advertisement sponsored promo banner", f"{{0}}{self.prose(1, 3)}", strict=True)),
            (0.35, lambda: self.named("div", "notice cookie cookie-notice consent gdpr alert message", r.choice((f"{{0}}{self.prose(1, 3)}", self.paragraph("{0}"))), strict=True)),
            (0.2, lambda: self.named("div", "breadcrumb breadcrumbs crumbs", f"{{0}}<a href='/'>{self.word()}</a> &gt; <a href='/x'>{self.word()}</a>", strict=True)),
            (0.2, self.sidebar),
            (0.12, self.form),
        ]
        found = [make() for chance, make in choices if r.random() < chance]
        r.shuffle(found)
        return found

    def after(self) -> list[str]:
        r = self.r
        choices = [
            (0.35, self.comments),
            (0.3, self.sidebar),
            (0.2, self.form),
            (0.25, lambda: self.named("div", "related more recommended share social tags pagination", f"<ul>{self.links(2, 6)}</ul>", strict=True)),
            (0.25, lambda: self.named(r.choice(("div", "section")), "ad ads advert sponsored promo newsletter subscribe", f"{{0}}{self.prose(1, 3)}", strict=True)),
        ]
        found = [make() for chance, make in choices if r.random() < chance]
        r.shuffle(found)
        foot = r.choice((f"{{0}}&copy; {self.words(1, 3)} &middot; {self.prose(1, 2)}", f"<p>{{0}}{self.prose(1, 2)}</p><ul>{self.links(2, 5)}</ul>"))
        if r.random() < 0.85:
            found.append(self.named("footer", "footer", foot) if r.random() < 0.7 else self.named("div", "footer foot bottom site-footer copyright", foot, strict=True))
        return found

    def page(self) -> tuple[list[Block], list[int]]:
        body = "".join([*self.before(), self.article(), *self.after()])
        for _ in range(self.r.choice((0, 0, 1, 2))):
            body = self.named("div", "wrap wrapper container page row col site layout inner", body)
        blocks = blocks_of(f"<html><head><title>x</title></head><body>{body}</body></html>")
        labels = [int("{1}" in b.text) for b in blocks]
        for block in blocks:
            block.text = block.text.replace("{1}", "").replace("{0}", "").strip() or "x"
        return blocks, labels


@functools.cache
def trained_labeller(pages: int = TRAINING_PAGES, passes: int = PASSES, seed: int = SEED) -> Labeller:
    make = Pages(seed)
    drawn = [page for page in (make.page() for _ in range(pages)) if page[0]]
    labeller = Labeller(seed)
    labeller.train([blocks for blocks, _ in drawn], [labels for _, labels in drawn], passes, seed)
    return labeller


def extract_main_text(df: DataFrame, html: str = "html", pages: int = TRAINING_PAGES) -> DataFrame:
    """Replace nothing, add `text` (the article's blocks, joined by line ends) and `n_chars` (code points).

    Null and empty pages, and pages without a block of the article, have an empty text. Pages
    of any length are read whole, and all blocks of a page are labelled in one sequence. Repeated
    rows get the same text; an empty table stays empty; columns of the two names are replaced.
    The model's size is fixed (under 1 MB); it is trained on the driver from generated pages, as
    many as `pages` says, and broadcast. Nothing is shuffled.
    """
    ship(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(trained_labeller(pages))

    def batch(values: pa.Array) -> pa.Array:
        labeller, texts = model.value, []
        for at in range(0, len(values), 512):
            pages = [blocks_of(v) for v in values.slice(at, 512).to_pylist()]
            for blocks, p in zip(pages, labeller.probabilities(pages), strict=True):
                texts.append("\n".join(b.text for b, keep in zip(blocks, p >= 0.5, strict=True) if keep))
        return pa.array(texts, pa.string())

    text = F.arrow_udf(batch, "string")(F.col(html))
    return drop_columns(df, "text", "n_chars").withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("bigint"))
