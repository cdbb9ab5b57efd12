"""HTML main text by a linear-chain conditional random field over DOM leaf blocks.

A page becomes its leaf blocks, the runs of text between tags that start a new line, in page order. A block's features are the
tags, classes and ids of its ancestors, the nearest ancestor that gives a part of the page its role, and its text: length,
closing mark, share inside links. The field has two labels; it is trained on ``page_samples.labelled_pages`` by its exact
likelihood (forward and backward sums, gradient steps with weight decay), and every page is decoded by Viterbi. The model has some
hundred weights and is trained once on the driver; pages never leave their partition.

Rows: a null or empty page has no text; broken, unclosed or cut-off markup is read as far as it goes; comments, scripts and styles
are no blocks, closed or not; long pages are read whole; repeated rows give the same text; extra columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import table
from tessella.llm.page_samples import MARK, labelled_pages

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|object)\b[^>]*+>.*?(?:</\1\s*+>|\Z)|<[!?][^>]*+>?|</?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+'|["'][^>"']*+\Z)*+>?|[^<]++|<""",
    re.S | re.I,
)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: Elements of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
ROLES = frozenset("article main nav header footer aside form section head".split())
SIZES = (0, 2, 5, 10, 20, 40, 80)
ROUNDS, DECAY = 300, 0.02
#: Nodes that a worker keeps before it starts anew, with the same results; each has one entry of ``Field._of_path`` at most.
NODES = 50_000


class Node:
    """An element as its descendants see it: the features of the path so far, as places in the model's weights."""

    __slots__ = ("features", "link", "made", "nodes", "parent", "tag")

    def __init__(self, tag: str, parent: Node | None, features: frozenset, link: bool) -> None:
        self.tag, self.parent, self.features, self.link, self.nodes, self.made = tag, parent, features, link, {}, 0


def child(node: Node, tag: str, raw: str, root: Node) -> Node:
    """The node of a tag inside ``node``; the same markup at the same place is the same node. ``root`` counts what is made, by size."""
    known = node.nodes.get(raw)
    if known is None:
        names = {w for m in NAMES.findall(raw) for w in re.split(r"[^a-z]+", "".join(m).lower()) if len(w) > 1}
        own = {f"a:{tag}"} | {f"k:{w}" for w in names}
        features = node.features
        if tag in ROLES or names:
            features = frozenset(f for f in features if f[0] != "n")
            own |= {f"n:{tag}"} | {f"n:{w}" for w in names}
        known = node.nodes[raw] = Node(tag, node, features | own, node.link or tag == "a")
        root.made += 1 + len(raw) // 200
    return known


def blocks(page: str, root: Node) -> list[tuple[str, frozenset, float]]:
    """(text, features of the path, share of its letters inside links) of each leaf block that has text."""
    out: list[tuple[str, frozenset, float]] = []
    parts: list[str] = []
    linked = 0
    node = place = root

    def end() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, place.features, linked / len(text)))
            parts.clear()
            linked = 0

    for m in TOKEN.finditer(page):
        raw = m[0]
        if raw[0] != "<" or raw == "<":
            if not parts or parts[-1] == " " and len(parts) == 1:
                place = node
            parts.append(raw)
            if node.link:
                linked += len(raw)
            continue
        tag = TAG.match(raw)
        if m[1] or tag is None:
            continue
        name = tag[2].lower()
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            end()
        if tag[1]:
            up = node
            while up is not root and up.tag != name:
                up = up.parent
            if up is not root:
                node = up.parent
        elif name not in VOID:
            if name not in INLINE:  # a paragraph ends where the next block starts
                up = node
                while up.tag in INLINE:
                    up = up.parent
                if up.tag == "p" or up.tag == name and name in CLOSES_ITSELF:
                    node = up.parent
            if not raw.endswith("/>"):
                node = child(node, name, raw, root)
    end()
    return out


def text_features(text: str, linked: float) -> list[str]:
    n = text.count(" ") + 1
    return [f"s:{sum(n > k for k in SIZES)}", f"e:{text[-1] in '.!?:;…'}", f"l:{(linked > 0.3) + (linked > 0.8)}", f"c:{text[0].isupper()}", f"d:{text[:1] == '©'}"]


class Field:
    """Weights of features for label 1 against 0, and of pairs of neighbouring labels."""

    def __init__(self, weights: dict[str, float], pairs: np.ndarray) -> None:
        self.weights, self.pairs = weights, pairs
        self._of_path: dict[frozenset, float] = {}
        self._of_text: dict[str, float] = {}
        self._fresh()

    def _fresh(self) -> None:
        self.root = Node("", None, frozenset(), False)
        self._of_path.clear()

    def __reduce__(self):
        return Field, (self.weights, self.pairs)

    def _sum(self, features) -> float:
        return sum(self.weights.get(f, 0.0) for f in features)

    def extract(self, page: str) -> str:
        """The main text of a page, decoded by Viterbi."""
        if self.root.made > NODES:
            self._fresh()
        found = blocks(page, self.root)
        (p00, p01), (p10, p11) = self.pairs.tolist()
        none, one, back = 0.0, 0.0, []
        for text, path, linked in found:
            score = self._of_path.get(path)
            if score is None:
                score = self._of_path[path] = self.weights.get("bias", 0.0) + self._sum(path)
            score += self._sum(text_features(text, linked))
            from0, from1 = none + p01 >= one + p11, none + p00 >= one + p10
            back.append((from1, from0))
            none, one = (none + p00 if from1 else one + p10), (none + p01 if from0 else one + p11) + score
        kept = []
        state = one > none
        for (text, _, _), (to0, to1) in zip(reversed(found), reversed(back), strict=True):
            if state:
                kept.append(text)
            state = not (to1 if state else to0)
        return "\n".join(reversed(kept))


def train(pages: list[str], rounds: int = ROUNDS, decay: float = DECAY) -> Field:
    """Maximum likelihood with weight decay; all pages at once, padded to the longest."""
    root = Node("", None, frozenset(), False)
    rows, labels = [], []
    for page in pages:
        found = blocks(page, root)
        rows.append([["bias", *path, *text_features(t.lstrip(MARK), linked)] for t, path, linked in found])
        labels.append([t.startswith(MARK) for t, _, _ in found])
    names = sorted({f for r in rows for fs in r for f in fs})
    at = {f: i for i, f in enumerate(names)}
    longest = max(map(len, rows))
    x = np.zeros((len(rows), longest, len(names)))
    y, live = np.zeros((len(rows), longest), int), np.zeros((len(rows), longest), bool)
    for i, (r, own) in enumerate(zip(rows, labels, strict=True)):
        for t, fs in enumerate(r):
            x[i, t, [at[f] for f in fs]] = 1
        y[i, : len(own)], live[i, : len(own)] = own, True
    w, pairs = np.zeros(len(names)), np.zeros((2, 2))
    first, second = [np.zeros(len(names) + 4) for _ in range(2)]
    flat = x[live]
    joint = live[:, 1:] & live[:, :-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][joint], y[:, 1:][joint]), 1)
    for step in range(1, rounds + 1):
        score = np.zeros((*y.shape, 2))
        score[..., 1][live] = flat @ w
        ahead, behind = score.copy(), np.zeros_like(score)
        for t in range(1, longest):
            new = score[:, t] + np.logaddexp.reduce(ahead[:, t - 1, :, None] + pairs, axis=1)
            ahead[:, t] = np.where(live[:, t, None], new, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(pairs + (score[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(live[:, t + 1, None], new, behind[:, t + 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        p = np.exp(ahead[..., 1] + behind[..., 1] - total[:, None])
        both = np.exp(ahead[:, :-1, :, None] + pairs + (score + behind)[:, 1:, None, :] - total[:, None, None, None])[joint].sum(0)
        gradient = np.append(flat.T @ (p[live] - y[live]) + decay * w, (both - seen + decay * pairs).ravel())
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        move = 0.15 * (1 - step / (rounds + 30)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, pairs = w - move[:-4], pairs - move[-4:].reshape(2, 2)
    return Field(dict(zip(names, w.tolist(), strict=True)), pairs)


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_pages())


def main_text(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text) of every row of (page_id, url, html)."""
    shared = pages.sparkSession.sparkContext.broadcast(field or default_field())  # some hundred weights

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": [shared.value.extract(p) for p in pdf["_html"]]})

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("_html"))
    return rows.mapInPandas(run, "page_id bigint, url string, text string")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page and its length in code points."""
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))
