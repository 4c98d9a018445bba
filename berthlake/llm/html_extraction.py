"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks at block tags. A logistic classifier on text features, fitted here on blocks whose container
says what they are, gives each block a bounded score, and the nearest telling container (element name, class and id words) a
bounded one of its own; text and container may outvote each other. Scores are the terminal capacities of a graph: positive ones
tie a block to the source (content), negative ones to the sink. Blocks that follow each other, and following blocks of one parent, are
joined by smoothness edges that weaken with their distance in the document tree and where their containers disagree. One edge
can outweigh what is left of a disputed score. The cut of least capacity separates content from boilerplate.

A block whose own capacity outweighs all its edges keeps its side in every least cut, so it is fixed at once and its
edges go to the neighbours' terminals; maximum flow decides about what remains.

Edge cases: null and empty html give empty text; markup that does not close ends with the page; a stray ``<`` is text;
repeated rows each get their result; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

SAMPLE_PAGES = 400       # pages of which blocks are taken for the fit, of any size
SAMPLE_BLOCKS = 20_000   # blocks of these pages at most
TEXT_BOUND = 3.0
CONTAINER_BOUND = 2.0
SMOOTHNESS = 2.0         # of siblings; falls with the square of the distance in the tree
DISAGREEMENT = 0.05      # of an edge's weight between blocks whose containers tell different things

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^<>]*+>"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)>", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z]+")

VOID = {"area", "base", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "br"}
UNSEEN = {"script", "style", "noscript", "template", "svg", "iframe", "object", "head", "title", "select", "textarea", "button",
          "canvas", "audio", "video", "math", "datalist"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "html", "legend", "li", "main",
         "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption"}
CLOSED_TAGS = {"nav", "footer", "aside", "menu", "dialog"}     # boilerplate whatever stands inside
OPEN_TAGS = {"form", "header", "fieldset", "legend"}           # boilerplate but for an article inside
GOOD_TAGS = {"article", "main"}
BAD_WORDS = {"ad", "ads", "advert", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner", "nav", "navbar",
             "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "header", "masthead", "comment", "comments",
             "reply", "replies", "respond", "cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "newsletter",
             "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "widget", "toolbar",
             "copyright", "pagination", "pager", "complementary", "contentinfo", "search", "gdpr", "feedback", "discussion"}
# what such containers hold is never the article, even if parts of it are called body, text or article
CLOSED_WORDS = {"ad", "ads", "advert", "advertisement", "advertising", "sponsor", "sponsored", "promo", "nav", "navbar", "navigation", "menu",
                "breadcrumb", "breadcrumbs", "comment", "comments", "reply", "replies", "respond", "cookie", "cookies", "consent", "popup",
                "modal", "newsletter", "subscribe", "subscription", "signup", "login", "related", "recommended", "footer", "pagination",
                "pager", "contentinfo", "discussion", "feedback", "gdpr"}
GOOD_WORDS = {"article", "content", "post", "entry", "story", "main", "body", "text"}
LAYOUT = re.compile(r"(?:with|without|has|no|layout|page|col|is)[-_]")  # such names say how a page is laid out
# an open element of the second kind ends where one of the first begins
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}


class Block:
    __slots__ = ("text", "path", "container", "linked")

    def __init__(self, text: str, path: tuple[int, ...], container: int, linked: int):
        self.text, self.path, self.container, self.linked = text, path, container, linked


def told_by_names(attributes: str) -> int:
    """2 if a name says article, -1 or -2 (closed) if it says boilerplate, 1 if names say both, 0 if they say nothing."""
    good = mixed = bad = 0
    for name in (n for m in NAMES.findall(attributes) for n in m.strip("\"'").lower().split()):
        words = set(WORD.findall(name))
        if LAYOUT.match(name) or not words & (BAD_WORDS | GOOD_WORDS):
            continue
        if not words & BAD_WORDS:
            good = 1
        elif words & GOOD_WORDS:
            mixed = min(mixed, -2 if words & CLOSED_WORDS else -1)
        else:
            bad = min(bad, -2 if words & CLOSED_WORDS else -1)
    if bad:
        return bad
    return (1 if mixed else 2) if good else mixed


def container_of(tag: str, attributes: str, inside: int) -> int:
    """1 in an article, -1 in boilerplate that an article may stand in, -2 in any other, 0 if nothing tells; ``inside`` is the parent's."""
    if inside == -2 and tag != "main":
        return -2
    if tag in CLOSED_TAGS:
        return -2
    names = told_by_names(attributes) if attributes and tag not in ("html", "body") else 0
    if names < 0 and tag != "main":
        return names
    if tag in GOOD_TAGS or names == 2:
        return 1
    if names == 1:  # names say both, so the parent tells
        return 1 if inside >= 0 else inside
    if tag in OPEN_TAGS and inside <= 0:
        return -1
    return inside


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # element, its number, what its container tells
    parts: list[str] = []
    linked = number = at = 0
    in_link = False
    unseen: list[str] = []

    def close() -> None:
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, tuple(s[1] for s in stack), max(-1, stack[-1][2]) if stack else 0, linked))
        parts, linked = [], 0

    pos, end = 0, len(page)
    while pos < end:
        found = TOKEN.search(page, pos)
        stop = found.start() if found else end
        if stop > at and not unseen:
            piece = page[at:stop]
            parts.append(piece)
            if in_link:
                linked += len(piece)
        if not found:
            break
        pos = at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), bool(found[1] or found[4]), found[3] or found[6] or ""
        if tag in UNSEEN:
            if closing:
                if tag in unseen:
                    del unseen[unseen.index(tag):]
            elif not attributes.endswith("/"):
                if tag in RAW:  # its content is no markup
                    ending = re.compile(f"</{tag}", re.I).search(page, pos)
                    pos = at = ending.start() if ending else end
                unseen.append(tag)
            continue
        if unseen:
            if tag == "body" and "head" in unseen:  # a head that was left open
                unseen.clear()
            else:
                continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not closing
        elif tag in BLOCK or tag == "hr":
            close()
            if tag in VOID:
                continue
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            else:
                if stack and stack[-1][0] == "p":
                    stack.pop()
                if stack and stack[-1][0] in CLOSES.get(tag, ()):
                    stack.pop()
                number += 1
                inside = stack[-1][2] if stack else 0
                stack.append((tag, number, container_of(tag, attributes, inside)))
    close()
    return out


def features(block: Block) -> list[float]:
    words = block.text.count(" ") + 1
    return [1.0, math.log1p(words) - 2.5, min(1.0, block.linked / max(1, len(block.text))),
            float(block.text[-1] in ".!?…\"”"), min(1.0, block.text.count(",") / words * 5),
            sum(map(str.isdigit, block.text)) / len(block.text)]


PRIOR = [0.0, 1.0, -3.0, 1.0, 0.5, -1.0]  # weights where the pages tell nothing


def telling_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (place, html): features and label of every block whose container tells."""
    for batch in batches:
        for place, page in zip(*(c.to_pylist() for c in batch.columns)):
            told = [(k, b) for k, b in enumerate(blocks(page)) if b.container]
            yield pa.RecordBatch.from_arrays(
                [pa.array([place] * len(told), pa.int64()), pa.array([k for k, _ in told], pa.int32()),
                 pa.array([features(b) for _, b in told], pa.list_(pa.float64())), pa.array([b.container > 0 for _, b in told], pa.bool_())],
                names=["place", "k", "x", "y"])


def fit(pages: DataFrame) -> np.ndarray:
    """Weights of the text features, from a bounded sample of blocks whose containers tell.

    The pages of the lowest hashes are taken, and of their blocks those of the lowest (hash of page, then number). If these are
    of one kind only, a long text without links counts as content.
    """
    placed = pages.select(F.xxhash64(F.col("page_id").cast("string")).alias("place"), F.coalesce("html", F.lit("")).alias("html"))
    last = placed.select("place").orderBy("place").limit(SAMPLE_PAGES).agg(F.max("place")).first()[0]
    if last is None:
        return np.array(PRIOR)
    sample = placed.filter(F.col("place") <= last).mapInArrow(telling_blocks, "place bigint, k int, x array<double>, y boolean")
    rows = sample.orderBy("place", F.xxhash64("k"), "x").limit(SAMPLE_BLOCKS).toArrow()
    x, y = rows["x"].to_pylist(), rows["y"].to_pylist()
    if not y or all(y) or not any(y):
        return np.array(PRIOR)
    x, y = np.array(x), np.array(y, float)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + 1e-2 * np.eye(len(w)), x.T @ (weight * (p - y)) + 1e-2 * w)
    return w


def edges(page: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness between neighbours in the page and between following blocks of one parent, weak where containers disagree."""
    out: dict[tuple[int, int], float] = {}
    last: dict[tuple[int, ...], int] = {}
    for i, block in enumerate(page):
        parent = block.path[:-1]
        for j in {i - 1, last.get(parent, i - 1)}:
            if j >= 0:
                other = page[j].path
                common = 0
                for a, b in zip(block.path, other):
                    if a != b:
                        break
                    common += 1
                distance = len(block.path) + len(other) - 2 * common
                agree = page[j].container == block.container or not page[j].container or not block.container
                out[(j, i)] = SMOOTHNESS * (2 / max(2, distance)) ** 2 * (1.0 if agree else DISAGREEMENT)
        last[parent] = i
    return out


def least_cut(score: list[float], joined: dict[tuple[int, int], float]) -> list[bool]:
    """True for blocks on the source's side of a least cut."""
    near: list[dict[int, float]] = [{} for _ in score]
    for (i, j), w in joined.items():
        near[i][j] = near[j][i] = w
    score, side = list(score), [None] * len(score)
    queue = deque(range(len(score)))
    while queue:
        i = queue.popleft()
        if side[i] is None and abs(score[i]) >= sum(near[i].values()):
            side[i] = score[i] > 0
            for j, w in near[i].items():
                if side[j] is None:
                    score[j] += w if side[i] else -w
                    del near[j][i]
                    queue.append(j)
            near[i] = {}
    rest = [i for i, s in enumerate(side) if s is None]
    if rest:
        for i, inside in zip(rest, max_flow([score[i] for i in rest], rest, near)):
            side[i] = inside
    return side


def max_flow(score: list[float], nodes: list[int], near: list[dict[int, float]]) -> list[bool]:
    """Shortest augmenting paths in level graphs; the blocks that the source still reaches are on its side."""
    n = len(nodes)
    source, sink, index = n, n + 1, {v: k for k, v in enumerate(nodes)}
    rest: list[dict[int, float]] = [{} for _ in range(n + 2)]
    for k, (v, s) in enumerate(zip(nodes, score)):
        if s > 0:
            rest[source][k], rest[k][source] = s, 0.0
        elif s < 0:
            rest[k][sink], rest[sink][k] = -s, 0.0
        for u, w in near[v].items():
            rest[k][index[u]] = w
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            v = queue.popleft()
            for u, w in rest[v].items():
                if w > 1e-12 and u not in level:
                    level[u] = level[v] + 1
                    queue.append(u)
        if sink not in level:
            return [k in level for k in range(n)]
        todo = [iter(list(r)) for r in rest]
        path = [source]
        while path:
            v = path[-1]
            if v == sink:
                least = min(rest[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    rest[a][b] -= least
                    rest[b][a] = rest[b].get(a, 0.0) + least
                cut = next(k for k, (a, b) in enumerate(zip(path, path[1:])) if rest[a][b] <= 1e-12)
                del path[cut + 1:]
                continue
            for u in todo[v]:
                if rest[v][u] > 1e-12 and level.get(u) == level[v] + 1:
                    path.append(u)
                    break
            else:
                path.pop()


def main_text(page: str, weights: np.ndarray) -> str:
    found = blocks(page)
    if not found:
        return ""
    x = np.array([features(b) for b in found])
    score = np.clip(x @ weights, -TEXT_BOUND, TEXT_BOUND) + CONTAINER_BOUND * np.array([b.container for b in found])
    inside = least_cut(score.tolist(), edges(found))
    return " ".join(b.text for b, keep in zip(found, inside) if keep)


def extract(pages: DataFrame, keep: list[str] | None = None, weights: np.ndarray | None = None) -> DataFrame:
    """``_row`` (the input row as a struct, or its columns ``keep``) with the main text as ``main_text``."""
    weights = fit(pages) if weights is None else weights
    picked = pages.select(F.coalesce("html", F.lit("")).alias("_html"), F.struct(*(keep or ["*"])).alias("_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 200):
                part = batch.slice(first, 200)
                texts = [main_text(page, weights) for page in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(texts, pa.string())], names=["_row", "main_text"])

    return picked.mapInArrow(run, T.StructType([picked.schema["_row"], T.StructField("main_text", T.StringType())]))
