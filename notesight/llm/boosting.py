"""A quality classifier: histogram gradient-boosted trees over document statistics, flattened into arrays.

Training rows are a bounded sample; scoring is one pass over whole texts, a batch of rows at a time through
all trees at once. A null or empty text has all statistics 0 and is scored like any other. With no labelled
rows the score is 0.5; with labels of one class only it lies near that class."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from notesight.llm.common import by_batch
from notesight.llm.stats import COUNTS, FEATURES, RATIOS, labelled_sample, text_stats

#: Labelled rows the trees are fitted on, at most.
MAX_ROWS = 40_000


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees in one set of arrays. A leaf points to itself, so that every row can take
    `depth` steps whatever the shape of a tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray, block: int = 4096) -> np.ndarray:
        """The probability of class 1 for each row of `x`."""
        out = np.empty(len(x))
        for start in range(0, len(x), block):
            part = x[start : start + block]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots))).copy()
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                at = np.where(part[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out[start : start + block] = self.value[at].sum(1) + self.base
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    ridge: float = 1.0, least: int = 10,
) -> Trees:
    """Boost the logistic loss. Each level of a tree takes one histogram of gradients for all its nodes."""
    n, width = x.shape
    grown = _Nodes()
    if not n:
        return grown.arrays(0, 0.0)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    edges = [_edges(x[:, f], bins) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    raw = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = p - y, p * (1 - p)
        raw += grown.tree(binned, edges, gradient, hessian, depth, rate, bins, ridge, least)
    return grown.arrays(depth, base)


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    distinct = np.unique(values)
    middles = (distinct[1:] + distinct[:-1]) / 2
    if len(middles) < bins:
        return middles
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


class _Nodes:
    """Nodes as they grow."""

    def __init__(self) -> None:
        self.feature, self.threshold, self.left, self.right, self.value, self.roots = [], [], [], [], [], []

    def node(self, value: float) -> int:
        at = len(self.feature)
        self.feature.append(0)
        self.threshold.append(np.inf)
        self.left.append(at)
        self.right.append(at)
        self.value.append(value)
        return at

    def tree(self, binned, edges, gradient, hessian, depth, rate, bins, ridge, least) -> np.ndarray:
        n, width = binned.shape
        weight = lambda g, h: -rate * g / (h + ridge)
        open_nodes = [self.node(weight(gradient.sum(), hessian.sum()))]
        self.roots.append(open_nodes[0])
        place = np.zeros(n, int)  # of each row among the open nodes; -1 in a finished leaf
        out = np.full(n, self.value[open_nodes[0]])
        for _ in range(depth):
            live = place >= 0
            spots, rows = place[live], binned[live]
            g_rows, h_rows = gradient[live], hessian[live]
            best = [(1e-6, -1, 0)] * len(open_nodes)
            for f in range(width):
                cells = spots * bins + rows[:, f]
                g, h, c = (
                    np.bincount(cells, w, len(open_nodes) * bins).reshape(-1, bins).cumsum(1)
                    for w in (g_rows, h_rows, None)
                )
                gt, ht, ct = g[:, -1:], h[:, -1:], c[:, -1:]
                gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
                gain = np.where((c >= least) & (ct - c >= least), gain, -1)[:, : max(len(edges[f]), 1)]
                for spot, at in enumerate(gain.argmax(1)):
                    if len(edges[f]) and gain[spot, at] > best[spot][0]:
                        best[spot] = (gain[spot, at], f, int(at))
            following, moved = [], np.full(n, -1)
            for spot, (_, f, at) in enumerate(best):
                if f < 0:
                    continue
                inside = place == spot
                below = inside & (binned[:, f] <= at)
                above = inside & ~below
                parent = open_nodes[spot]
                self.feature[parent], self.threshold[parent] = f, float(edges[f][at])
                for side, name in ((below, self.left), (above, self.right)):
                    child = self.node(weight(gradient[side].sum(), hessian[side].sum()))
                    name[parent] = child
                    moved[side] = len(following)
                    out[side] = self.value[child]
                    following.append(child)
            place, open_nodes = moved, following
            if not open_nodes:
                break
        return out

    def arrays(self, depth: int, base: float) -> Trees:
        return Trees(
            np.array(self.feature, int), np.array(self.threshold, float), np.array(self.left, int),
            np.array(self.right, int), np.array(self.value, float), np.array(self.roots, int), depth, base,
        )


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Trees:
    """Fit on at most `max_rows` labelled documents (`labels.quality`)."""
    return train(*labelled_sample(docs, labels, "quality", max_rows))


def features(counts: np.ndarray) -> np.ndarray:
    """FEATURES from COUNTS, as `stats.ratio` has them."""
    column = {c: counts[:, i].astype(float) for i, c in enumerate(COUNTS)}
    made = []
    for name in FEATURES:
        above, below = (column[c] for c in RATIOS[name])
        made.append(np.divide(above, below, out=np.zeros(len(above)), where=below > 0))
    return np.stack(made, 1)


def score(docs: DataFrame, trees: Trees, cut: float = 0.3) -> DataFrame:
    """doc_id, `score` (0 to 1) and `predicted` (1 if score >= cut) of every row; only the text is read."""

    def make(batch: dict[str, list]) -> dict[str, list]:
        counts = np.array([text_stats(t) for t in batch["text"]], float).reshape(-1, len(COUNTS))
        return {"score": trees.score(features(counts))}

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return by_batch(texts, ["doc_id"], "score double", make).withColumn("predicted", (F.col("score") >= cut).cast("int"))
