"""Quality rules learned as a decision list: sequential covering grows a conjunction of thresholds for the
rejected class, prunes it on rows kept aside, removes what it covers, and goes on.

The list is a plain value that prints as text and becomes one nested Spark condition over statistics columns.

Nulls and odd rows: a null or empty text has all statistics 0. Rows whose statistics tie get the same verdict.
With no labelled rows, or labels of one class only, the list is empty and keeps all."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from notesight.llm.stats import FEATURES, labelled_sample, ratio, with_stats

#: Labelled rows the rules are learned from, at most.
MAX_ROWS = 20_000


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = ratio(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, x: np.ndarray) -> np.ndarray:
        value = x[:, FEATURES.index(self.feature)]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a row is rejected by the first rule whose conditions all hold, else kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def rejected_by(self) -> Column:
        """The number (from 1) of the rule that rejects the row, else null."""
        out: Column | None = None
        for number, rule in enumerate(self.rules, 1):
            both = rule[0].column()
            for condition in rule[1:]:
                both = both & condition.column()
            out = F.when(both, F.lit(number)) if out is None else out.when(both, F.lit(number))
        return F.lit(None).cast("int") if out is None else out

    def keeps(self, x: np.ndarray) -> np.ndarray:
        kept = np.ones(len(x), bool)
        for rule in self.rules:
            kept &= ~_covers(rule, x)
        return kept

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, rule)) for rule in self.rules) or "keep all"


def _covers(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    held = np.ones(len(x), bool)
    for condition in rule:
        held &= condition.holds(x)
    return held


def learn(
    x: np.ndarray, keep: np.ndarray, bins: int = 128, longest: int = 4, precision: float = 0.95, least: int = 5,
    seed: int = 7,
) -> DecisionList:
    """Cover the rows with `keep` 0. A rule stands if, on the rows kept aside for pruning and on all rows,
    at least `precision` of what it covers is to be rejected, and it covers `least` such rows in all."""
    bad = keep == 0
    rules: list[tuple[Condition, ...]] = []
    if not bad.any() or bad.all():
        return DecisionList(())
    edges = [_edges(x[:, f], bins) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    aside = np.random.default_rng(seed).random(len(x)) < 1 / 3
    left = np.ones(len(x), bool)
    while (left & bad).sum() >= least:
        rule = _grow(binned, edges, bad, left & ~aside, longest)
        rule = _prune(rule, x, bad, left & aside)
        if not rule:
            break
        covered = _covers(rule, x) & left
        if (covered & bad).sum() < max(least, precision * covered.sum()):
            break
        rules.append(rule)
        left &= ~covered
    return DecisionList(tuple(rules))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds half way between neighbouring values, at quantiles if there are many."""
    distinct = np.unique(values)
    middles = (distinct[1:] + distinct[:-1]) / 2
    return middles if len(middles) <= bins else np.unique(np.quantile(middles, np.linspace(0, 1, bins)))


def _grow(binned: np.ndarray, edges: list[np.ndarray], bad: np.ndarray, rows: np.ndarray, longest: int) -> tuple[Condition, ...]:
    """Add the condition with the largest information gain until no row to keep is covered."""
    rule: list[Condition] = []
    rows = rows.copy()
    while len(rule) < longest:
        p, n = (rows & bad).sum(), (rows & ~bad).sum()
        if not p or not n:
            break
        now = np.log2(p / (p + n))
        best: tuple[float, int, int, bool] = (1e-9, -1, 0, False)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            inside = [np.bincount(binned[rows & side, f], minlength=len(e) + 1).cumsum()[:-1] for side in (bad, ~bad)]
            for above in (False, True):
                ps, ns = ((p - inside[0], n - inside[1]) if above else inside)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - now), 0.0)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (float(gain[at]), f, at, above)
        if best[1] < 0:
            break
        _, f, at, above = best
        rule.append(Condition(FEATURES[f], above, float(edges[f][at])))
        rows &= (binned[:, f] > at) if above else (binned[:, f] <= at)
    return tuple(rule)


def _prune(rule: tuple[Condition, ...], x: np.ndarray, bad: np.ndarray, rows: np.ndarray) -> tuple[Condition, ...]:
    """The beginning of the rule with the best (p - n) / (p + n) on the rows kept aside; the shorter on a tie."""
    best, kept = -2.0, rule
    for length in range(1, len(rule) + 1):
        covered = _covers(rule[:length], x) & rows
        p, n = (covered & bad).sum(), (covered & ~bad).sum()
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best + 1e-12:
            best, kept = worth, rule[:length]
    return kept


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DecisionList:
    """Learn from at most `max_rows` rows of `labels.quality`."""
    return learn(*labelled_sample(docs, labels, "quality", max_rows))


def judge(docs: DataFrame, rules: DecisionList, keep: list[str] | None = None) -> DataFrame:
    """Add the statistics of every whole text, `base_failed`, `rule` (that rejects, else null) and `kept`.

    Columns of `docs` with those names are replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("base_failed", "rule", "kept")]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        with_stats(docs, keep=keep)
        .withColumn("base_failed", failed)
        .withColumn("rule", rules.rejected_by())
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )
