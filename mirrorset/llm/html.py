"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element and every run of text is a variable: dropped, kept, or (elements only) mixed, when it
holds both. Potentials between parent and child and the weights of a node's features (its tag, words
of its class, id and role, its share of linked text) are estimated from labelled pages. Messages are
passed from the leaves to the root and back by sum-product, for all pages of a block at once, level
by level; runs of text whose marginal favours "kept" are written out, one line per block element.

Defined cases: null or empty html, and pages without kept text, give an empty text; unclosed
elements end where their parent ends or where HTML implies it; repeated pages are extracted each.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorset.llm.common import blocks
from mirrorset.llm.labelled_pages import labelled_pages

DROP, KEEP, MIXED = range(3)
# Elements by their role in HTML.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = {"script", "style", "textarea", "title", "xmp", "noframes"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span"
    " strike strong sub sup time tt u var wbr #text".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# Elements whose share of links counts, those whose tag says nothing by itself, and features of whole blocks.
GROUPS = {"ul", "ol", "div", "section", "table"}
PLAIN = (INLINE - {"#text", "label", "samp"}) | {"li", "ul", "ol", "tr", "tbody", "dd", "dt"}
NEVER_MIXED = {f"<{t}>" for t in ("#text", "p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "footer", "label")} | {"links"}
_MIXED_COST = 1.5
_BOUNDARY = {"td", "th", "table", "button", "caption", "object", "template", "html"}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile("[a-z]+")
#: Counts added to those of features and of parent-child pairs.
_SMOOTH, _PAIR_SMOOTH = 0.01, 0.5


class Page:
    """Nodes of one page in document order: parent, depth, tag, words of the attributes, text."""

    def __init__(self) -> None:
        self.parent, self.depth, self.tag, self.words, self.text = [-1], [0], ["#root"], [()], [None]
        self.marks: dict[int, int] = {}
        self.stack = [0]
        self.open: dict[str, list[int]] = {}  # places of the open elements in the stack, by tag

    def add(self, tag: str, words: tuple[str, ...] = (), text: str | None = None) -> int:
        up = self.stack[-1]
        self.parent.append(up)
        self.depth.append(self.depth[up] + 1)
        self.tag.append(tag)
        self.words.append(words)
        self.text.append(text)
        return len(self.tag) - 1

    def close(self, names: set[str], until: set[str]) -> None:
        """End the nearest open element of the names, unless one of ``until`` is nearer."""
        nearest = max((self.open[n][-1] for n in names if self.open.get(n)), default=0)
        if not nearest or any(self.open[u][-1] > nearest for u in until if self.open.get(u)):
            return
        for node in self.stack[nearest:]:
            self.open[self.tag[node]].pop()
        del self.stack[nearest:]

    def enter(self, node: int) -> None:
        """The nodes that follow lie inside of ``node``."""
        self.open.setdefault(self.tag[node], []).append(len(self.stack))
        self.stack.append(node)


def _words(attributes: str) -> tuple[str, ...]:
    found = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            found += [w.rstrip("s") for w in _WORD.findall((a or b or c).lower())]
    return tuple(dict.fromkeys(found))


def parse(source: str, marked: bool = False) -> Page:
    """Tree of a page; with ``marked`` the labels of labelled pages are kept by node."""
    page = Page()
    at, n = 0, len(source)

    def text(piece: str) -> None:
        if piece and not piece.isspace():
            page.add("#text", (), entities.unescape(piece) if "&" in piece else piece)
        elif piece:
            page.add("#text", (), " ")

    while at < n:
        found = _TOKEN.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at : found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            page.close({name}, _BOUNDARY - {name} if name in INLINE or name == "p" else set())
            continue
        if name in CLOSES:
            page.close(*CLOSES[name])
        elif name not in INLINE:
            page.close({"p"}, _BOUNDARY)
        attributes = found[3] or found[6] or ""
        node = page.add(name, _words(attributes) if "=" in attributes else ())
        if marked and (mark := re.search(r"\b(keep|drop)\b", attributes)):
            page.marks[node] = KEEP if mark[1] == "keep" else DROP
        if name in VOID:
            continue
        page.enter(node)
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}", re.I).search(source, at)
            stop = end.start() if end else n
            if stop > at:
                page.add("#text", (), source[at:stop])
            at = stop
    return page


def _link_share(page: Page) -> list[float]:
    """Share of each node's text that is linked."""
    total, linked = [0] * len(page.tag), [0] * len(page.tag)
    for i in range(len(page.tag) - 1, 0, -1):
        up = page.parent[i]
        if page.text[i] is not None:
            total[i] = len(page.text[i].strip())
        if page.tag[i] == "a":
            linked[i] = total[i]
        total[up] += total[i]
        linked[up] += linked[i]
    return [b / a if a else 0.0 for a, b in zip(total, linked)]


def _features(page: Page) -> list[tuple[str, ...]]:
    shares = _link_share(page)
    out = []
    inside = [False] * len(page.tag)  # of an article: what it lists belongs to it, linked or not
    for i, (tag, words, share, up) in enumerate(zip(page.tag, page.words, shares, page.parent)):
        inside[i] = tag in ("article", "main") or (up >= 0 and inside[up])
        link = ("links" if share > 0.6 and not inside[i] else "few links",) if tag in GROUPS else ()
        named = () if tag in PLAIN else (f"<{page.tag[up]}><header>",) if tag == "header" else (f"<{tag}>",)
        out.append((*named, *link, *words))
    return out


class Model:
    """Log potentials by counting in labelled pages, with smoothing."""

    def __init__(self, pages: list[str]):
        pairs = np.full((3, 3), _PAIR_SMOOTH)
        counts = [Counter(), Counter(), Counter()]
        for source in pages:
            page = parse(source, marked=True)
            label = self._labels(page)
            for i, features in enumerate(_features(page)):
                if label[i] is None:
                    continue
                counts[label[i]].update(features)
                if i and label[page.parent[i]] is not None:
                    pairs[label[page.parent[i]], label[i]] += 1
        self.pairs = np.log(pairs / pairs.max(axis=1, keepdims=True))  # a mixed parent costs nothing for each child
        names = set().union(*counts)
        totals = np.array([sum(c.values()) for c in counts]) + _SMOOTH * len(names)
        self.weights = {f: np.log((np.array([c[f] for c in counts]) + _SMOOTH) / totals) for f in names}
        for f, weight in self.weights.items():  # what holds an article may as well hold something else beside it
            if f not in NEVER_MIXED:
                weight[MIXED] = max(weight[MIXED], weight[KEEP] - _MIXED_COST)

    @staticmethod
    def _labels(page: Page) -> list[int | None]:
        n = len(page.tag)
        own: list[int | None] = [None] * n
        for i in range(n):
            own[i] = page.marks.get(i, own[page.parent[i]] if i else None)  # the nearest mark at or above the node
        below: list[set[int]] = [set() for _ in range(n)]
        for i in range(n - 1, -1, -1):
            if page.text[i] is not None and own[i] is not None:
                below[i].add(own[i])
            if i:
                below[page.parent[i]] |= below[i]
        return [MIXED if len(b) == 2 else next(iter(b)) if b else own[i] for i, b in enumerate(below)]

    def unary(self, page: Page) -> np.ndarray:
        """Sum of the weights of each node's features."""
        known, base = self.weights, np.zeros(3)
        rows = np.empty((len(page.tag), 3))
        for i, features in enumerate(_features(page)):
            rows[i] = sum([known[f] for f in features if f in known], base)
        return rows


@functools.cache
def trained() -> Model:
    return Model(labelled_pages())


def marginals(unary: np.ndarray, parent: np.ndarray, depth: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Sum-product on a forest: probability of each state for every node.

    Messages run upward and then downward, all nodes of one depth together.
    """
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(depth.max() + 2))
    levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    up = unary.copy()
    sent = np.zeros_like(unary)
    for nodes in levels[:0:-1]:
        sent[nodes] = np.logaddexp.reduce(up[nodes][:, None, :] + pairs[None], axis=2)
        for state in range(3):
            up[:, state] += np.bincount(parent[nodes], sent[nodes, state], len(up)) if len(nodes) * 20 > len(up) else 0
        if len(nodes) * 20 <= len(up):
            np.add.at(up, parent[nodes], sent[nodes])
    down = up.copy()
    for nodes in levels[1:]:
        rest = down[parent[nodes]] - sent[nodes]
        rest -= rest.max(axis=1, keepdims=True)
        down[nodes] += np.logaddexp.reduce(rest[:, :, None] + pairs[None], axis=1)
    down -= down.max(axis=1, keepdims=True)
    shares = np.exp(down)
    return shares / shares.sum(axis=1, keepdims=True)


def main_texts(sources: list[str | None], model: Model) -> list[str]:
    """Main text of each page."""
    pages = [parse(s or "") for s in sources]
    if not pages:
        return []
    sizes = [len(p.tag) for p in pages]
    starts = np.cumsum([0, *sizes])
    parent = np.concatenate([np.array(p.parent) + s for p, s in zip(pages, starts)])
    depth = np.concatenate([p.depth for p in pages])
    unary = np.concatenate([model.unary(p) for p in pages])
    leaves = np.concatenate([[t is not None for t in p.text] for p in pages])
    unary[leaves, MIXED] = -1e6
    share = marginals(unary, np.maximum(parent, 0), depth, model.pairs)
    kept = leaves & (share[:, KEEP] > share[:, DROP])
    return [_written(p, kept[a : a + n]) for p, a, n in zip(pages, starts, sizes)]


def _written(page: Page, kept: np.ndarray) -> str:
    """Kept text, one line per block; a block ends where a block element begins or ends."""
    block = [0] * len(page.tag)
    for i in range(1, len(page.tag)):
        block[i] = block[page.parent[i]] if page.tag[i] in INLINE else i
    lines: list[list[str]] = []
    last = None
    for i in range(1, len(page.tag)):
        if page.text[i] is None:
            if page.tag[i] == "br" and lines:
                lines[-1].append(" ")
            elif page.tag[i] not in INLINE:
                last = None
        elif kept[i]:
            if block[i] != last:
                lines.append([])
                last = block[i]
            lines[-1].append(page.text[i])
    joined = (" ".join("".join(parts).split()) for parts in lines)
    return "\n".join(line for line in joined if line)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` per page, in one pass without a shuffle."""
    given = model or trained()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "html"):
            texts = main_texts(block.column("html").to_pylist(), given)
            columns = [block.column("page_id"), block.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")
