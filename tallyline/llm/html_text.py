"""Main text of web pages by a recurrent block labeller.

A page is read as its sequence of leaf blocks: runs of text that no block-level tag interrupts. Each
block is described by the tags, classes and ids on the way to it, by its words, both hashed into
small learnt vectors, and by a few numbers. A bidirectional LSTM in numpy reads the whole sequence,
so what a block is taken for depends on all blocks before and after it, and labels every block as
main text or not.

There are no labelled pages. The labeller is trained on a bounded sample of the pages at hand,
labelled by the containers that HTML itself names, and on sequences recombined from their blocks
under many other containers and class names that pages use for articles and for everything else.
Training takes seconds on the driver, whatever the number of pages; labelling runs page by page in
the tasks and shuffles nothing.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 300             # pages that the labeller is trained on
LEARNT = 64 << 10        # characters of a sampled page that are learnt from: as many at its start as at its end
DEEPEST = 128            # open elements; one that is opened inside them takes the place of the last
PATH, WORDS = 1024, 1024  # hash slots
PATH_SIZE, WORD_SIZE, HIDDEN = 16, 8, 20
STEPS, BATCH, LENGTH = 260, 48, 48
CELLS = 1 << 14          # blocks that are labelled together

# Elements that end a run of text, that hold no text, and that are never open.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p
pre section select summary table tbody td tfoot th thead tr ul""".split())
RAW = frozenset("script style title".split())  # run to their end tag or else to the end of the page
HIDDEN_TEXT = RAW | frozenset("noscript template svg math iframe object".split())  # the others hide nothing without an end tag
VOID = frozenset("area base br col embed head hr img input link meta param source track wbr".split())  # a head may lack its end tag
# Containers and words of class names that say what a block is.
MAIN = frozenset("article main".split())
OTHER = frozenset("nav header footer aside form button select menu dialog".split())
OTHER_WORDS = frozenset("""ad ads advert advertisement banner sponsor promo nav navbar menu breadcrumb breadcrumbs header masthead
footer copyright sidebar aside widget related share social newsletter subscribe popup modal cookie consent notice alert comment
comments respond reply login signup form pagination pager tags""".split())
MAIN_PATHS = ["article", "main", "main article", "div.content", "div#content div.post", "div.article-body", "section.story",
              "div.entry-content", "div.post-content", "div#main div.text", "main div.body", "div.wrapper article", "section article.post",
              "div.page div.main-content", "div.container main", "article div.content", "article section", "div#article", "div.story-body"]
MAIN_TAGS = ["p"] * 12 + ["h1", "h2", "h3", "ul li", "ol li", "blockquote p", "pre", "table tr td", "div", "figure figcaption"]
OTHER_PATHS = ["nav ul li", "header", "header div.title", "header nav", "footer", "footer p", "aside", "aside p", "div.ad", "div.ads p",
               "div.advert", "div.advertisement", "div.banner", "div.sponsor", "div.promo", "div.sidebar", "div.sidebar ul li",
               "div#sidebar p", "div.widget", "div.cookie-notice p", "div.cookie", "div.notice", "div.alert", "div.consent p", "form",
               "form label", "form button", "form p", "div.newsletter form", "div.newsletter p", "div.popup", "div.modal p",
               "section#comments", "section.comments p", "div.comments div.comment p", "div#comments ol li", "div.comment", "div.comment p",
               "ol.comment-list li p", "article.comment p", "section#comments article p", "div.reply", "div.share", "div.social ul li",
               "ul.breadcrumb li", "div.breadcrumbs", "div.related ul li", "div.related p", "div.menu ul li", "ul.menu li", "div.navbar ul li",
               "div#nav ul li", "div#menu", "div#footer", "div#footer p", "div.footer ul li", "div.copyright", "p.copyright", "div#header",
               "div.header", "div.masthead", "div.login form", "div.pagination", "div.tags", "select option", "div.subscribe"]
INSIDE = ["div.ad", "div.ads", "aside", "div.promo", "div.newsletter p", "div.share", "div.related ul li", "form", "div.notice",
          "section.comments p", "div.comment p", "footer", "header", "nav ul li", "div.advert p", "div.comments div.comment p"]

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"<]*\"|'[^'<]*'|[^>\"'])*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>|<[!?/][^>]*>", re.S | re.I)
_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in HIDDEN_TEXT}
# A slash that ends a value without quotes belongs to the value.
_SELF_CLOSED = re.compile(r"""<\w+(?:\s(?:.*[\s"'])?[^\s=>"'/]*)?/>""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SLOTS: dict[str, int] = {}


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    names: frozenset
    linked: int  # characters inside links


def _slot(name: str) -> int:
    found = _SLOTS.get(name)
    if found is None:
        if len(_SLOTS) > 1 << 18:
            _SLOTS.clear()
        found = _SLOTS[name] = zlib.crc32(name.encode())
    return found


def _names(tag: str, rest: str) -> list[str]:
    out = [tag]
    if "=" in rest:
        for m in _NAMED.finditer(rest):
            out += ["." + w.lower() for w in _PART.findall(m[1] or m[2] or m[3] or "")]
    return out


def blocks(page: str, hints: bool = True) -> list[Block]:
    """The leaf blocks of a page in order, with the names of their containers if ``hints``, character references decoded and white space made one.
    Scripts, styles, titles and comments hold no text, nor do drawings, frames and objects that were
    closed. Text in the head belongs to the body, as in HTML. Tags that were not closed end with the
    element around them, a paragraph with the next one."""
    out: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    opened: dict[str, int] = {}  # how often each tag and each name is open; names in the order of opening
    named: dict[str, int] = {}
    parts: list[str] = []
    linked = at = 0
    endless: set[str] = set()  # elements without text that have no end tag from here on
    close = page.rfind(">") + 1  # no tag begins behind it

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(html.unescape(text) if "&" in text else text)
            if opened.get("a"):
                linked += len(text)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                last = next((tag for tag, _ in reversed(stack) if tag in BLOCKS), "")
                out.append(Block(text, tuple(_slot(n) % PATH for n in [*named, "leaf " + last]), frozenset(named) if hints else frozenset(), linked))
            parts.clear()
        linked = 0

    def push(tag: str, own: list[str]) -> None:
        if len(stack) >= DEEPEST:
            pop(DEEPEST - 1)
        stack.append((tag, own))
        opened[tag] = opened.get(tag, 0) + 1
        for n in own:
            named[n] = named.get(n, 0) + 1

    def pop(depth: int) -> None:
        while len(stack) > depth:
            tag, own = stack.pop()
            opened[tag] -= 1
            for n in own:
                named[n] -= 1
                if not named[n]:
                    del named[n]

    while m := _TOKEN.search(page, at, close):
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(page)
            continue
        tag = tag.lower()
        if tag in HIDDEN_TEXT and not (m["end"] or m["end2"]):
            if tag not in RAW and _SELF_CLOSED.fullmatch(m[0]):
                continue
            end = None if tag in endless else _END[tag].search(page, at)
            if end or tag in RAW:
                at = end.end() if end else len(page)
            else:
                endless.add(tag)
            continue
        block = tag in BLOCKS
        if tag == "br":
            parts.append(" ")
        if block:
            flush()
        if m["end"] or m["end2"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None) if opened.get(tag) else None
            if depth is not None and (block or all(t not in BLOCKS for t, _ in stack[depth:])):
                pop(depth)
        elif tag not in VOID:
            if block:  # a block ends an open paragraph, an item or cell one like it
                for i in range(len(stack) - 1, -1, -1):
                    open_ = stack[i][0]
                    if open_ == "p" or open_ == tag and tag in ("li", "td", "th", "tr", "dd", "dt", "option"):
                        pop(i)
                        break
                    if open_ in BLOCKS:
                        break
            push(tag, _names(tag, m["rest"] or m["rest2"] or ""))
    rest = page[at:]
    add(rest[:rest.find("<!--")] if "<!--" in rest else rest)
    flush()
    return out


def hinted(names: frozenset) -> bool:
    """What the containers alone say of a block: the labels of the training sample."""
    return not names.isdisjoint(MAIN) and names.isdisjoint(OTHER) and not any(n[1:] in OTHER_WORDS for n in names if n[0] == ".")


class Pages:
    """Sequences of blocks as arrays: bags of path and word slots, numbers, and where pages begin."""

    def __init__(self, pages: list[list[Block]]):
        flat = [b for p in pages for b in p]
        self.sizes = np.array([len(p) for p in pages], np.int64)
        self.path, self.path_n = self._bag([b.path for b in flat])
        slot = _slot
        self.words, self.words_n = self._bag([[slot(w) % WORDS for w in b.text.lower().split()] for b in flat])
        size = np.array([len(b.text) for b in flat], np.float32)
        linked = np.array([b.linked for b in flat], np.float32)
        place = np.concatenate([np.arange(n) / n for n in self.sizes if n] or [np.zeros(0)]).astype(np.float32)
        self.numbers = np.stack([np.log1p(size) / 5, np.minimum(1, linked / np.maximum(1, size)), place], 1).astype(np.float32)

    @staticmethod
    def _bag(rows: list) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([len(r) for r in rows], np.int64)
        return np.array([x for r in rows for x in r], np.int32), n


def _sum_bags(table: np.ndarray, slots: np.ndarray, n: np.ndarray, mean: bool) -> np.ndarray:
    out = np.zeros((len(n), table.shape[1]), table.dtype)
    some = n > 0
    if some.any():
        out[some] = np.add.reduceat(table[slots], (np.cumsum(n) - n)[some], axis=0)
    return out / np.maximum(1, n)[:, None].astype(table.dtype) if mean else out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Embedding bags, an LSTM in each direction, and a logistic output."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        size, h = PATH_SIZE + WORD_SIZE + 3, HIDDEN

        def init(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.w = {"path": init(PATH, PATH_SIZE, scale=0.3), "words": init(WORDS, WORD_SIZE, scale=0.1),
                  "out": init(2 * h, scale=0.2), "bias": np.zeros(1, np.float32)}
        for d in ("f", "b"):
            self.w[d + "x"], self.w[d + "h"] = init(size, 4 * h, scale=size ** -0.5), init(h, 4 * h, scale=h ** -0.5)
            self.w[d + "0"] = np.zeros(4 * h, np.float32)
            self.w[d + "0"][h:2 * h] = 1  # cells remember at first

    def inputs(self, p: Pages) -> np.ndarray:
        return np.concatenate([_sum_bags(self.w["path"], p.path, p.path_n, False),
                               _sum_bags(self.w["words"], p.words, p.words_n, True), p.numbers], 1)

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """x (time, page, size) -> states; direction b reads from the end. Where mask is 0 the state
        stays zero, so padding in front of a reversed sequence says nothing."""
        t_all, b, _ = x.shape
        n = HIDDEN
        gates_x = x @ self.w[d + "x"] + self.w[d + "0"]
        h, c = np.zeros((b, n), np.float32), np.zeros((b, n), np.float32)
        out = np.zeros((t_all, b, n), np.float32)
        for t in range(t_all) if d == "f" else range(t_all - 1, -1, -1):
            z = gates_x[t] + h @ self.w[d + "h"]
            i, f, o, g = _sigmoid(z[:, :n]), _sigmoid(z[:, n:2 * n]), _sigmoid(z[:, 2 * n:3 * n]), np.tanh(z[:, 3 * n:])
            m = mask[t][:, None]
            before_h, before_c = h, c
            c = (f * c + i * g) * m
            tc = np.tanh(c)
            h = o * tc * m
            out[t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, before_c, before_h, tc, m))
        return out

    def _back(self, d: str, x: np.ndarray, keep: list, dh_out: np.ndarray, grads: dict) -> np.ndarray:
        n = HIDDEN
        dx = np.zeros_like(x)
        dh, dc = np.zeros_like(keep[0][6]), np.zeros_like(keep[0][6])
        for t, i, f, o, g, before_c, before_h, tc, m in reversed(keep):
            dh = (dh + dh_out[t]) * m
            dc = (dc + dh * o * (1 - tc * tc)) * m
            dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            grads[d + "x"] += x[t].T @ dz
            grads[d + "h"] += before_h.T @ dz
            grads[d + "0"] += dz.sum(0)
            dx[t] = dz @ self.w[d + "x"].T
            dh, dc = dz @ self.w[d + "h"].T, dc * f
        return dx

    @staticmethod
    def _pad(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        t = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        b = np.repeat(np.arange(len(sizes)), sizes)
        x = np.zeros((int(sizes.max(initial=0)), len(sizes), flat.shape[1]), np.float32)
        mask = np.zeros(x.shape[:2], np.float32)
        x[t, b], mask[t, b] = flat, 1
        return x, mask, t, b

    def chances(self, p: Pages) -> np.ndarray:
        """For every block, how likely it is main text."""
        flat, out = self.inputs(p), np.zeros(len(p.numbers), np.float32)
        begin, order, i = np.cumsum(p.sizes) - p.sizes, np.argsort(p.sizes, kind="stable"), 0
        order = order[p.sizes[order] > 0]
        while i < len(order):  # pages of like length together
            j = i + 1
            while j < len(order) and (j + 1 - i) * p.sizes[order[j]] <= CELLS:
                j += 1
            mine, sizes = order[i:j], p.sizes[order[i:j]]
            rows = np.repeat(begin[mine], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x, mask, t, b = self._pad(flat[rows], sizes)
            h = np.concatenate([self._run("f", x, mask), self._run("b", x, mask)], 2)
            out[rows] = _sigmoid(h @ self.w["out"] + self.w["bias"])[t, b]
            i = j
        return out

    def fit(self, pages: list[list[Block]], labels: list[list[bool]], seed: int = 5) -> None:
        """Adam on the cross-entropy of all blocks, over windows of ``LENGTH`` blocks."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, STEPS + 1):
            picked, wanted = [], []
            for k in rng.integers(len(pages), size=BATCH):
                at = int(rng.integers(max(1, len(pages[k]) - LENGTH + 1)))
                picked.append(pages[k][at:at + LENGTH])
                wanted += labels[k][at:at + LENGTH]
            p, y = Pages(picked), np.array(wanted, np.float32)
            x, mask, t, b = self._pad(self.inputs(p), p.sizes)
            kept_f, kept_b = [], []
            h = np.concatenate([self._run("f", x, mask, kept_f), self._run("b", x, mask, kept_b)], 2)
            d_out = np.zeros(mask.shape, np.float32)
            d_out[t, b] = (_sigmoid(h[t, b] @ self.w["out"] + self.w["bias"]) - y) / max(1, len(y))
            g = {k: np.zeros_like(v) for k, v in self.w.items()}
            g["out"], g["bias"] = np.tensordot(d_out, h, ((0, 1), (0, 1))), np.array([d_out.sum()], np.float32)
            dh = d_out[:, :, None] * self.w["out"]
            dx = (self._back("f", x, kept_f, dh[:, :, :HIDDEN], g) + self._back("b", x, kept_b, dh[:, :, HIDDEN:], g))[t, b]
            np.add.at(g["path"], p.path, np.repeat(dx[:, :PATH_SIZE], p.path_n, axis=0))
            share = dx[:, PATH_SIZE:PATH_SIZE + WORD_SIZE] / np.maximum(1, p.words_n)[:, None]
            np.add.at(g["words"], p.words, np.repeat(share, p.words_n, axis=0).astype(np.float32))
            for k, v in self.w.items():
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.01 * (g[k] ** 2 - second[k])
                rate = 0.02 * (1 - step / (STEPS + 1))
                v -= (rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)


def _made(text: str, path: str, linked: bool) -> Block:
    names, last = ["html", "body"], "body"
    for step in path.split():
        tag, *marks = re.split(r"(?=[.#])", step)
        names += [tag, *["." + w.lower() for m in marks for w in _PART.findall(m[1:])]]
        last = tag if tag in BLOCKS else last
    return Block(text, tuple(_slot(n) % PATH for n in dict.fromkeys([*names, *(["a"] if linked else []), "leaf " + last])),
                 frozenset(names), len(text) if linked else 0)


def _recombined(main: list[str], other: list[str], rng) -> tuple[list[Block], list[bool]]:
    """Blocks of a page under other containers."""
    def pick(texts):
        return texts[int(rng.integers(len(texts)))]

    page: list[Block] = []
    labels: list[bool] = []

    def boilerplate(paths, most):
        for _ in range(int(rng.integers(0, most))):
            path = pick(paths)
            if rng.random() < 0.4:
                path += " " + pick(("h2", "h3", "h4", "p", "div", "span", "ul li"))
            for _ in range(int(rng.integers(1, 7))):
                # Any text may stand anywhere: only place and path tell.
                text = pick(other if rng.random() < 0.5 else main)
                page.append(_made(" ".join(text.split()[:int(rng.integers(1, 40))]) or text, path, "li" in path.split() and rng.random() < 0.8))
                labels.append(False)

    boilerplate(OTHER_PATHS, 5)
    root = pick(MAIN_PATHS) if rng.random() < 0.9 else ""
    for k in range(int(rng.integers(1, 16))):
        tag = "h1" if k == 0 and rng.random() < 0.7 else pick(MAIN_TAGS)
        page.append(_made(pick(main if rng.random() < 0.8 else other), f"{root} {tag}", False))
        labels.append(True)
        if rng.random() < 0.12:
            path = pick(INSIDE) + (" " + pick(("h2", "h3", "p", "span")) if rng.random() < 0.4 else "")
            page.append(_made(pick(other if rng.random() < 0.5 else main), f"{root} {path}", False))
            labels.append(False)
    boilerplate(OTHER_PATHS, 6)
    return page, labels


def learnt(page: str) -> list[Block]:
    """The blocks of a page that are learnt from: all, or of a long one those that begin and end it."""
    found = blocks(page)
    ends = np.cumsum([len(b.text) for b in found])
    if not found or ends[-1] <= LEARNT:
        return found
    first, last = np.searchsorted(ends, LEARNT // 2), np.searchsorted(ends, ends[-1] - LEARNT // 2)
    kept = [*found[:max(1, first)], *found[max(1, first, last):]]
    return [Block(b.text[:LEARNT], b.path, b.names, b.linked) for b in kept]


def train(sequences: list[list[Block]], seed: int = 5) -> Labeller:
    """Learn from the blocks of pages. Without any the labeller learns from a few plain words."""
    rng = np.random.default_rng(seed)
    sequences = [s for s in sequences if s]
    labels = [[hinted(b.names) for b in s] for s in sequences]
    main = [b.text for s, y in zip(sequences, labels) for b, k in zip(s, y) if k] or ["The text of an article.", "Another paragraph."]
    other = [b.text for s, y in zip(sequences, labels) for b, k in zip(s, y) if not k] or ["Home", "Contact", "Sign in"]
    known = [(s, y) for s, y in zip(sequences, labels) if any(y)]  # pages that name no container teach nothing
    made = [_recombined(main, other, rng) for _ in range(900)]
    labeller = Labeller(seed)
    every = known + made
    labeller.fit([s for s, _ in every], [y for _, y in every], seed)
    return labeller


def main_text(labeller: Labeller, pages: list[str | None]) -> list[str]:
    found = [blocks(p, hints=False) if p else [] for p in pages]
    chances = labeller.chances(Pages(found))
    out, at = [], 0
    for page in found:
        out.append("\n".join([b.text for b, c in zip(page, chances[at:at + len(page)].tolist()) if c >= 0.5]))
        at += len(page)
    return out


def _extract(sent, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = sent.value
        for batch in batches:
            start = size = 0
            for i in range(batch.num_rows + 1):
                n = len(batch.column(column)[i].as_py() or "") if i < batch.num_rows else 0
                if i == batch.num_rows or i > start and size + n > 4 << 20:
                    part = batch.slice(start, i - start)
                    text = main_text(labeller, part.column(column).to_pylist())
                    columns, names = list(part.columns), list(part.schema.names)
                    columns[column], names[column] = pa.array(text, pa.string()), "text"
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    start, size = i, 0
                size += n
    return run


_BLOCK = "mark long, place int, text string, path array<int>, names array<string>, linked long"


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for mark, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = learnt(page.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array([mark] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), pa.array([b.text for b in found], pa.string()),
                 pa.array([b.path for b in found], pa.list_(pa.int32())), pa.array([sorted(b.names) for b in found], pa.list_(pa.string())),
                 pa.array([b.linked for b in found], pa.int64())], names=["mark", "place", "text", "path", "names", "linked"])


def sample_blocks(pages: DataFrame, n: int = SAMPLE) -> list[list[Block]]:
    """The blocks of about ``n`` pages of any size, picked by a hash. Only hashes are ordered, pages
    are read into blocks by the tasks, and of each at most ``LEARNT`` characters come to the driver."""
    fit = pages.where(F.octet_length("html") > 0).select(F.xxhash64("html", "page_id", "url").alias("mark"), "html")
    total = fit.count()
    marks = fit.select("mark")
    if total > n:
        marks = marks.where(F.pmod("mark", F.lit(1 << 30)) < F.lit(int(min(1.0, (n + 3 * n ** 0.5) / total) * (1 << 30))))
    chosen = [r[0] for r in marks.distinct().orderBy("mark").limit(n).collect()]
    found: dict[int, dict[int, Block]] = {mark: {} for mark in chosen}
    for r in fit.where(F.col("mark").isin(chosen)).mapInArrow(_sampled, _BLOCK).collect():
        found[r.mark][r.place] = Block(r.text, tuple(r.path), frozenset(r.names), r.linked)  # a repeated row once
    return [[page[k] for k in sorted(page)] for page in found.values()]


def extract(pages: DataFrame, labeller: Labeller | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text`` (main blocks joined by \\n) and ``n_chars`` of every row.

    A null or empty html, or one without main text, gives an empty text. Rows that repeat an id or
    an html each give a row, alike ones the same text; null ids and urls stay null. An empty table
    gives an empty result. Other columns are ignored. Pages of any length and with any tags left
    open are read in one pass, nested as deep as ``DEEPEST``. Without a labeller one is trained on
    at most ``SAMPLE`` of these pages, whatever their size, and ``LEARNT`` characters of each.
    """
    spark = pages.sparkSession
    if labeller is None:
        labeller = train(sample_blocks(pages))
    sent = spark.sparkContext.broadcast(labeller)
    found = pages.select("page_id", "url", "html").mapInArrow(_extract(sent, 2), "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
