"""Main text of web pages by a recurrent block labeller.

A page is cut at block elements into its leaf blocks, each with the path of elements it lies in. Every block becomes a
vector: hashed elements, classes and ids of its path, hashed words, and a few measures. A bidirectional LSTM reads the
page's sequence of blocks in both directions and decides for each block, from all of the page, whether it is main text.

There are no hand-labelled pages. The labeller learns from a bounded sample of the pages: where a page names its article,
that is main text, save for what lies in elements or classes that stand for something else; otherwise long paragraphs with
few links are. Each sample page is also varied: article elements are replaced by plain containers, and notices, comments,
forms, adverts and the like, with words of the page, are put between, so that the labeller does not depend on one layout.

Tags are read by the states of the HTML standard: a quoted value may hold `<` and `>`, an unquoted one quotes, and what
is no attribute is still part of the tag.

Defined results: NULL and empty pages, and pages without main text, give the empty text; no pages give no rows. Unclosed
elements end with the page or with the element around them; an unclosed tag, comment, script or style hides the rest.
Repeated rows are extracted once each; rows without a key like others; further columns are ignored. Very long and very
deep pages take time and memory in proportion to their length.
"""

from __future__ import annotations

import re
import zlib
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, slices, texts_of

SAMPLE_PAGES = 400
PIECE_BLOCKS = 120  # longer sample pages are learned from in pieces
PATH_SIZE, WORD_SIZE, MEASURES = 96, 128, 4
SIZE = PATH_SIZE + WORD_SIZE + MEASURES
HIDDEN = 12
EPOCHS = 12

HIDDEN_ELEMENTS = "script|style|noscript|template|svg|iframe|object|select|textarea|title|annotation-xml|annotation|canvas|audio|video"
FOREIGN = "svg|annotation-xml|annotation"  # of those, what "/>" closes
BLANK = r"[ \t\n\f\r]"
VALUE = r"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^ \t\n\f\r>\"'][^ \t\n\f\r>]*+"
NAMED = rf"(?:=[^ \t\n\f\r/>=]*+|[^ \t\n\f\r/>=]++)(?:{BLANK}*+={BLANK}*+(?:{VALUE})?+)?+"
# Each step takes all it can and none is tried twice, so that a tag is read in one pass whatever it holds.
ATTRIBUTES = rf"(?:[ \t\n\f\r/]++|{NAMED})*+"
AFTER_NAME = r"(?=[ \t\n\f\r/>])"
MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<(?:{FOREIGN}){AFTER_NAME}{ATTRIBUTES}(?<=/)>"
    rf"|<({HIDDEN_ELEMENTS}){AFTER_NAME}{ATTRIBUTES}>(?:.*?</\1{AFTER_NAME}{ATTRIBUTES}(?:>|\Z)|.*\Z)"
    rf"|<(/?)([a-z][^ \t\n\f\r/>]*+)({ATTRIBUTES})(?:>|\Z)"
    r"|<(?:[!?]|/(?![a-z]|\Z))[^>]*+(?:>|\Z)", re.S | re.I | re.A)
ATTRIBUTE = re.compile(rf"({NAMED})|[ \t\n\f\r/]++", re.S | re.A)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong "
    "sub sup time tt u var wbr label "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover "
    "munderover mmultiscripts mprescripts mtable mtr mtd maction semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKS = ".,:;!?()[]{}\"'«»“”‘’…"
NAME = re.compile(r"[a-z]+")
MAIN = frozenset({"article", "main"})
OTHER = frozenset(
    "nav footer aside form button dialog menu sidebar comment comments reply replies ad ads advert adverts advertisement "
    "sponsored promo banner cookie cookies consent notice notices alert popup modal share sharing social related "
    "recommended newsletter subscribe subscription login signup search breadcrumb breadcrumbs pagination pager "
    "navigation complementary contentinfo toolbar widget disqus".split())
CLOSED_BY = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}


class Path:
    """A path of elements and their class words, each part with a link to the one before.

    `mask` has the bits of the path's hashed parts and `marks` says whether the path lies in main text, apart from it, or
    in a header, so that neither asks for a walk up the path.
    """

    __slots__ = ("above", "part", "mask", "marks")

    def __init__(self, above: Path | None, part: str):
        mask, marks = PARTS[part]
        self.above, self.part = above, part
        self.mask, self.marks = (mask, marks) if above is None else (mask | above.mask, marks | above.marks)

    def then(self, *parts: str) -> Path:
        path = self
        for part in parts:
            path = Path(path, part)
        return path


WITHIN, APART, HEADER = 1, 2, 4


class PartNumbers(dict):
    """Bits and marks of a path's parts, remembered up to a bound."""

    def __missing__(self, part: str) -> tuple[int, int]:
        if len(self) > 200_000:
            self.clear()
        name = part.lstrip(".")
        h = zlib.crc32(name.encode())
        mask = 1 << h % PATH_SIZE | 1 << (h >> 16) % PATH_SIZE if part else 0
        value = self[part] = mask, WITHIN * (name in MAIN) | APART * (name in OTHER) | HEADER * (name == "header")
        return value


PARTS = PartNumbers()
ROOT = Path(None, "")
BODY = ROOT.then("html", "body")
HEADINGS = ("h1", "h2", "h3")


def class_words(attributes: str) -> list[str]:
    """The words in a tag's class, id and role."""
    out = []
    for m in ATTRIBUTE.finditer(attributes):
        name, _, value = (m[1] or "").partition("=")
        if value and name.rstrip().lower() in ("class", "id", "role"):
            out += NAME.findall(value.lower())
    return out


def blocks(html: str) -> list[tuple[str, Path, int]]:
    """Text, path and number of characters within links of the page's leaf blocks. A path's last part is its element."""
    out, pieces, stack, at = [], [], [], 0
    opened: dict[str, int] = {}
    linked = in_link = 0

    def close():
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                out.append((text, stack[-1][1] if stack else ROOT, linked))
            pieces.clear()
        linked = 0

    for m in MARKUP.finditer(html):
        if m.start() > at:
            pieces.append(html[at : m.start()])
            linked += (m.start() - at) * (in_link > 0)
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if m[2] else 1
            elif tag == "br":
                pieces.append(" ")
            continue
        close()
        if m[2]:
            while opened.get(tag):
                last = stack.pop()[0]
                opened[last] -= 1
                if last == tag:
                    break
            in_link = 0
        elif tag not in VOID:
            if tag in CLOSED_BY and stack and stack[-1][0] == tag or stack and stack[-1][0] == "p":
                opened[stack.pop()[0]] -= 1
            path = (stack[-1][1] if stack else ROOT).then(tag, *("." + w for w in (class_words(m[4]) if "=" in m[4] else ())))
            stack.append((tag, path))
            opened[tag] = opened.get(tag, 0) + 1
    if at < len(html):
        pieces.append(html[at:])
    close()
    return out


def guess(found: list[tuple[str, Path, int]]) -> list[bool]:
    """What the labeller learns from: whether each block is main text, by what its page says of itself."""
    names_article = any(path.marks & WITHIN for _, path, _ in found)
    out = []
    for text, path, linked in found:
        inside = bool(path.marks & WITHIN)
        apart = bool(path.marks & APART) or (bool(path.marks & HEADER) and not inside)
        if names_article:
            out.append(inside and not apart)
        else:
            out.append(not apart and linked * 2 < len(text) and (path.part in HEADINGS or len(text) > 60))
    return out


class WordNumbers(dict):
    """Numbers of words without case and the marks around them, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        bare = word.strip(MARKS).lower() or word
        value = self[word] = zlib.crc32(bare.encode("utf-8", "surrogatepass")) % WORD_SIZE
        return value


class Featuriser:
    """Vectors of blocks. Path vectors are remembered up to a bound."""

    def __init__(self):
        self.paths: dict[int, np.ndarray] = {}
        self.words = WordNumbers()

    def path(self, path: Path) -> np.ndarray:
        found = self.paths.get(path.mask)
        if found is None:
            if len(self.paths) > 50_000:
                self.paths.clear()
            bits = np.frombuffer(path.mask.to_bytes(PATH_SIZE // 8, "little"), np.uint8)
            found = self.paths[path.mask] = np.unpackbits(bits, bitorder="little").astype(np.float32)
        return found

    def page(self, found: list[tuple[str, Path, int]]) -> np.ndarray:
        x = np.zeros((len(found), SIZE), np.float32)
        for i, (text, path, linked) in enumerate(found):
            x[i, :PATH_SIZE] = self.path(path)
            words = text.split()
            ids = [self.words[w] for w in words]
            x[i, PATH_SIZE : PATH_SIZE + WORD_SIZE] = np.bincount(ids, minlength=WORD_SIZE) / len(ids)
            x[i, -MEASURES:] = np.log1p(len(text)) / 8, min(1.0, linked / len(text)), i / len(found), text.endswith((".", "!", "?"))
        return x


def plainer(path: Path, to: tuple[str, ...], known: dict[int, Path]) -> Path:
    """The path with `to` in place of its article elements; `known` holds what was made for the page so far."""
    todo = []
    while path.above is not None and id(path) not in known:
        todo.append(path)
        path = path.above
    new = known.get(id(path), ROOT)
    for path in reversed(todo):
        new = known[id(path)] = new.then(*(to if path.part in MAIN else (path.part,)))
    return new


def varied(found: list[tuple[str, Path, int]], draw: np.random.Generator) -> tuple[list, list[bool]]:
    """A page in another layout, with its labels."""
    labels = guess(found)
    plain = draw.random() < 0.5
    to = [("div", ".content"), ("div", ".post"), ("section",), ("div", ".entry", ".text"), ("div",), ("main",)][draw.integers(6)]
    words = " ".join(t for t, _, _ in found[:20]).split() or ["x"]

    def some(most):
        n, start = int(draw.integers(1, most)), int(draw.integers(0, len(words)))
        return " ".join((words[start:] + words)[:n])

    out, kept, known = [], [], {}
    for (text, path, linked), label in zip(found, labels):
        if plain:
            path = plainer(path, to, known)
        if label and draw.random() < 0.1:
            path = (path.above or ROOT).then(*[("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("h2",), ("h3",), ("pre",), ("table", "tr", "td"),
                                 ("figure", "figcaption")][draw.integers(8)])
        out.append((text, path, linked))
        kept.append(label)
    names = sorted(OTHER)
    for _ in range(int(draw.integers(0, 7))):
        spot = int(draw.integers(0, len(out) + 1))
        around = (out[spot - 1][1].above or ROOT) if spot else BODY
        name = names[draw.integers(len(names))]
        tag = name if name in ("nav", "footer", "aside", "form", "button", "dialog", "menu") else "div"
        within = [("p",), (), ("ul", "li"), ("div",), ("h3",), ("article", "p") if name.startswith("comment") else ("p",)][draw.integers(6)]
        for _ in range(int(draw.integers(1, 4))):
            text = some(40)
            part = (tag,) if tag == name else (tag, "." + name)
            out.insert(spot, (text, around.then(*part, *within), len(text) if draw.random() < 0.4 else 0))
            kept.insert(spot, False)
    if draw.random() < 0.5:
        for _ in range(int(draw.integers(1, 4))):
            text = some(8)
            out.insert(0, (text, BODY.then("header", *[("h1",), ("p",), ("div",), ()][draw.integers(4)]), 0))
            kept.insert(0, False)
    return out, kept


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Direction:
    """One direction of the LSTM over padded pages (page, place, feature); the gates are input, forget, output, candidate."""

    def __init__(self, draw: np.random.Generator):
        self.wx = draw.normal(0, 1 / np.sqrt(SIZE / 4), (SIZE, 4 * HIDDEN)).astype(np.float32)
        self.wh = draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN : 2 * HIDDEN] = 1.0

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        pages, places = x.shape[:2]
        z = x @ self.wx + self.b
        h = c = np.zeros((pages, HIDDEN), np.float32)
        out, trace = np.zeros((pages, places, HIDDEN), np.float32), []
        for t in range(places):
            a = z[:, t] + h @ self.wh
            gates, g = _sigmoid(a[:, : 3 * HIDDEN]), np.tanh(a[:, 3 * HIDDEN :])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            m = mask[:, t, None]
            c_new = m * (f * c + i * g) + (1 - m) * c
            tc = np.tanh(c_new)
            h_new = m * (o * tc) + (1 - m) * h
            if keep:
                trace.append((h, c, i, f, o, g, tc, m))
            h, c = h_new, c_new
            out[:, t] = h
        return out, trace

    def backward(self, x: np.ndarray, trace: list, grad: np.ndarray) -> list[np.ndarray]:
        dz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        dwh = np.zeros_like(self.wh)
        dh = dc = np.zeros((len(x), HIDDEN), np.float32)
        for t in range(x.shape[1] - 1, -1, -1):
            h, c, i, f, o, g, tc, m = trace[t]
            dh = dh + grad[:, t]
            live, skip = dh * m, dh * (1 - m)
            dct = dc * m + live * o * (1 - tc * tc)
            dz[:, t] = np.concatenate([dct * g * i * (1 - i), dct * c * f * (1 - f), live * tc * o * (1 - o), dct * i * (1 - g * g)], 1)
            dwh += h.T @ dz[:, t]
            dh = dz[:, t] @ self.wh.T + skip
            dc = dct * f + dc * (1 - m)
        return [np.einsum("ptf,ptg->fg", x, dz), dwh, dz.sum((0, 1))]


class Labeller:
    """The two directions and the decision over their states."""

    def __init__(self):
        draw = np.random.default_rng(11)
        self.ahead, self.back = Direction(draw), Direction(draw)
        self.w, self.b = draw.normal(0, 0.3, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.wx, self.ahead.wh, self.ahead.b, self.back.wx, self.back.wh, self.back.b, self.w, self.b]

    @staticmethod
    def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        longest = max(map(len, pages))
        x, mask = np.zeros((len(pages), longest, SIZE), np.float32), np.zeros((len(pages), longest), np.float32)
        for i, page in enumerate(pages):
            x[i, : len(page)], mask[i, : len(page)] = page, 1.0
        return x, mask

    def _states(self, x, mask, keep=False):
        one, trace_one = self.ahead.forward(x, mask, keep)
        two, trace_two = self.back.forward(x[:, ::-1], mask[:, ::-1], keep)
        return np.concatenate([one, two[:, ::-1]], axis=2), trace_one, trace_two

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text."""
        x, mask = self._padded(pages)
        score = self._states(x, mask)[0] @ self.w + self.b
        return [score[i, : len(page)] > 0 for i, page in enumerate(pages)]

    def learn(self, examples: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.01) -> None:
        draw = np.random.default_rng(5)
        first, second = ([np.zeros_like(p) for p in self.parameters()] for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = sorted(range(len(examples)), key=lambda i: (len(examples[i][0]) // 8, draw.random()))
            groups = [order[i : i + 32] for i in range(0, len(order), 32)]
            for g in draw.permutation(len(groups)):
                chosen = [examples[i] for i in groups[g]]
                x, mask = self._padded([c[0] for c in chosen])
                y = np.zeros(mask.shape, np.float32)
                for i, (_, label) in enumerate(chosen):
                    y[i, : len(label)] = label
                states, one, two = self._states(x, mask, keep=True)
                d = (_sigmoid(states @ self.w + self.b) - y) * mask / mask.sum()
                grad = d[:, :, None] * self.w
                gradients = [
                    *self.ahead.backward(x, one, grad[:, :, :HIDDEN]),
                    *self.back.backward(x[:, ::-1], two, grad[:, ::-1, HIDDEN:]),
                    np.einsum("pt,pth->h", d, states), np.array([d.sum()], np.float32)]
                step += 1
                for p, a, b, gr in zip(self.parameters(), first, second, gradients):
                    a += 0.1 * (gr - a)
                    b += 0.001 * (gr * gr - b)
                    p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)


def _examples(batches):
    make = Featuriser()
    for batch in slices(batches, 32):
        x, y = [], []
        for html, seed in zip(texts_of(batch, "html"), batch.column("place").to_pylist()):
            found = blocks(html)
            draw = np.random.default_rng(seed & 0xFFFFFFFF)
            for page, labels in ((found, guess(found)), varied(found, draw), varied(found, draw)):
                rows, kept = make.page(page), np.array(labels, np.uint8)
                for start in range(0, len(page), PIECE_BLOCKS):
                    x.append(rows[start : start + PIECE_BLOCKS].tobytes())
                    y.append(kept[start : start + PIECE_BLOCKS].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["x", "y"])


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Labeller:
    """A labeller from at most `sample_pages` pages, chosen by the hashes of their keys.

    Three layouts of each, whole, come to the driver, which fits the model.
    """
    place = F.xxhash64("page_id")
    chosen = pages.select("page_id").where(F.col("page_id").isNotNull()).distinct()
    chosen = bounded_sample(chosen, place, sample_pages).select("page_id", place.alias("place"))
    # Bounded by `sample_pages` narrow rows.
    rows = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").select("place", "html")
    found = sorted(rows.mapInArrow(_examples, "x binary, y binary").dropDuplicates().collect())
    labeller = Labeller()
    examples = [(np.frombuffer(r["x"], np.float32).reshape(-1, SIZE), np.frombuffer(r["y"], np.uint8)) for r in found]
    if examples:
        labeller.learn(examples)
    return labeller


def extract(pages: DataFrame, labeller: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    labeller = labeller or train(pages)

    def run(batches):
        make = Featuriser()
        for batch in slices(batches):
            found = [blocks(html) for html in texts_of(batch, "html")]
            texts = [""] * len(found)
            order = sorted((i for i in range(len(found)) if found[i]), key=lambda i: len(found[i]))
            start = 0
            while start < len(order):
                # Pages of like length together; very long ones alone.
                longest = len(found[order[min(start + 63, len(order) - 1)]])
                group = order[start : start + (64 if longest < 2000 else 1)]
                start += len(group)
                for i, kept in zip(group, labeller.label([make.page(found[i]) for i in group])):
                    texts[i] = "\n".join(b[0] for b, k in zip(found[i], kept) if k)
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
