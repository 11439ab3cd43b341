"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q and at least max(12, 2 q) words that no neighbouring word
extends. Every Arrow batch is taken in groups of documents of similar length; the words of a group are one
array of numbers with a number of its own between documents, which no run can hold.

* Periods under SHORT: the words are compared with those q places on, for each q.
* Longer ones by scales: scale P (24, 48, ...) is for the periods from P to 2 P - 1. An anchor is the place with the least
  hash among the contexts (P / 2 words from a place on) of a window of P words. The first window of a run and the one
  a period later hold the same words, so they have anchors with equal contexts at the distance of the period. Contexts
  with a period of at most P / 4 are left out of the minima; so equal contexts lie more than P / 4 apart, an anchor has
  fewer than nine partners, and their number grows with the words.
* A window left without any context lies within one known run R of a period p <= P / 4. Its copy a period later lies in
  another run S of the same root, and the distance of both is one of those that bring the phases of R and S together;
  these distances are taken for each such pair of runs.
* Pairs are extended both ways by comparing prefix hashes (two primes near 2^31), by halving, all pairs at once. A
  stretch whose length has a smaller period is dropped: its run is known from a smaller period.

So each run is found, whatever the text, in time that grows with the words (and their logarithm). Hashes decide how far a
stretch goes; two different stretches have equal hashes with a chance under 2^-50.

Null or empty texts and texts without words have no runs. A text is one row and is held whole. Repeated rows are treated
alike; an empty table gives no rows. Columns named as the new ones are replaced."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from notesight.llm.common import WORD, by_batch, reads

LEAST = 12
#: Periods below this are found by direct comparison; it is the first scale, whose contexts have LEAST words.
SHORT = 2 * LEAST
#: Words of the documents that are looked at together, about; a longer document is looked at by itself.
GROUP_WORDS = 1 << 16
#: Pairs extended at a time.
PAIRS = 1 << 20
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525027)
COLUMNS = ("n_words", "runs", "kept_text")


class Prefixes:
    """Hashes of any stretch of an array of numbers, by prefix sums of powers modulo two primes."""

    def __init__(self, numbers: np.ndarray):
        mixed = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        n = len(numbers)
        self.n = n
        self.sums, self.powers = [], []
        for shift, prime, base in zip((0, 32), map(np.uint64, PRIMES), BASES):
            powers = np.ones(n + 1, np.uint64)
            step, done = np.uint64(base), 1
            while done <= n:  # powers[done:2 done] = powers[:done] * base^done
                more = min(done, n + 1 - done)
                powers[done : done + more] = powers[:more] * step % prime
                step, done = step * step % prime, 2 * done
            letters = (mixed >> np.uint64(shift) & np.uint64(0xFFFFFFFF)) % prime
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(letters * powers[1:] % prime, out=sums[1:])  # below 2^31 each: no overflow before 2^33 words
            self.sums.append(sums % prime)
            self.powers.append(powers)

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of `length` at a and at b (a < b) are equal."""
        same = np.ones(len(a), bool)
        for sums, powers, prime in zip(self.sums, self.powers, map(np.uint64, PRIMES)):
            first = (sums[a + length] + prime - sums[a]) % prime
            second = (sums[b + length] + prime - sums[b]) % prime
            same &= first * powers[b - a] % prime == second
        return same

    def windows(self, start: int, stop: int, length: int) -> np.ndarray:
        """One number for each stretch of `length` from `start` to before `stop`, equal for equal stretches."""
        out = np.zeros(stop - start, np.uint64)
        for sums, powers, prime in zip(self.sums, self.powers, map(np.uint64, PRIMES)):
            here = (sums[start + length : stop + length] + prime - sums[start:stop]) % prime
            # moved to a common place by the power that is left
            out = out << np.uint64(31) | here * powers[self.n - stop + 1 : self.n - start + 1][::-1] % prime
        return out

    def extend(self, m: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places [start, stop) around m where the words equal those `lag` places on."""
        right = self._reach(self.n - m - lag, lambda at, more: self.equal(m + at, m + at + lag, more))
        left = self._reach(m.copy(), lambda at, more: self.equal(m - at - more, m - at - more + lag, more))
        return m - left, m + right

    @staticmethod
    def _reach(most: np.ndarray, equal) -> np.ndarray:
        """How far equality goes, by doubling steps and then halving ones."""
        reach = np.zeros(len(most), np.int64)
        if not len(most):
            return reach
        step = np.ones(len(most), np.int64)
        growing = np.ones(len(most), bool)
        while growing.any():
            more = np.minimum(step, most - reach)
            ok = equal(reach, np.where(growing, more, 0)) & growing & (more > 0)
            reach += np.where(ok, more, 0)
            growing = ok
            step = np.where(ok, step * 2, step)
        while step.max() > 1:
            step = step >> 1
            ok = (step > 0) & (reach + step <= most)
            ok &= equal(reach, np.where(ok, step, 0))
            reach += np.where(ok, step, 0)
        return reach


def _prime_factors(n: int) -> Iterator[int]:
    factor = 2
    while factor * factor <= n:
        if n % factor == 0:
            yield factor
            while n % factor == 0:
                n //= factor
        factor += 1
    if n > 1:
        yield n


def _primitive(prefixes: Prefixes, starts: np.ndarray, lags: np.ndarray) -> np.ndarray:
    """Whether the first `lag` words of each stretch are no repetition of fewer words."""
    keep = np.ones(len(starts), bool)
    for lag in np.unique(lags).tolist():
        here = np.flatnonzero(lags == lag)
        at = starts[here]
        for factor in _prime_factors(lag):
            less = lag // factor
            keep[here] &= ~prefixes.equal(at, at + less, np.full(len(at), lag - less))
    return keep


def _short_runs(numbers: np.ndarray, prefixes: Prefixes) -> list[np.ndarray]:
    """Runs (start, stop, period) of the periods below SHORT."""
    found = []
    for lag in range(1, min(SHORT, len(numbers))):
        least = max(LEAST, 2 * lag) - lag
        equal = np.flatnonzero(numbers[lag:] == numbers[:-lag])
        if len(equal) < least or not (equal[least - 1 :] - equal[: len(equal) - least + 1] == least - 1).any():
            continue
        ends = np.flatnonzero(np.diff(equal) > 1)
        starts = equal[np.concatenate([[0], ends + 1])]
        stops = equal[np.concatenate([ends, [len(equal) - 1]])] + 1
        long = stops - starts >= least
        found.append(_checked(prefixes, starts[long], stops[long], np.full(int(long.sum()), lag)))
    return found


def _checked(prefixes: Prefixes, starts: np.ndarray, stops: np.ndarray, lags: np.ndarray) -> np.ndarray:
    """Rows (start, stop, period) of the runs among stretches whose words equal those `lag` places on."""
    runs = np.stack([starts, stops + lags, lags], axis=1).astype(np.int64)
    runs = np.unique(runs[runs[:, 1] - runs[:, 0] >= np.maximum(LEAST, 2 * runs[:, 2])], axis=0)
    return runs[_primitive(prefixes, runs[:, 0], runs[:, 2])]


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row, in two passes over blocks of that size."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def _anchor_pairs(prefixes: Prefixes, scale: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors with equal contexts at a distance from `scale` to before 2 `scale`."""
    context = scale // 2
    places = prefixes.n - context + 1
    hashes = prefixes.windows(0, places, context)
    edges = np.zeros(places + 1, np.int32)
    for start, stop, period in runs[(runs[:, 2] <= context // 2) & (runs[:, 1] - runs[:, 0] >= context)].tolist():
        edges[start] += 1
        edges[stop - context + 1] -= 1
    bits = places.bit_length()
    keyed = hashes >> np.uint64(bits + 1) << np.uint64(bits) | np.arange(places, dtype=np.uint64)
    keyed[edges[:-1].cumsum() > 0] = np.uint64(1) << np.uint64(63)
    minima = _window_minima(keyed, scale - context + 1)
    minima = minima[np.concatenate([[True], minima[1:] != minima[:-1]])]
    anchors = np.unique(minima[minima < np.uint64(1) << np.uint64(63)] & np.uint64((1 << bits) - 1)).astype(np.int64)
    order = np.argsort(hashes[anchors], kind="stable")  # by context, then by place
    anchors, context_of = anchors[order], hashes[anchors][order]
    first, lags = [], []
    step, ahead = 1, np.arange(len(anchors) - 1)
    while len(ahead):
        gap = anchors[ahead + step] - anchors[ahead]
        near = (context_of[ahead + step] == context_of[ahead]) & (gap < 2 * scale)
        fits = near & (gap >= scale)
        first.append(anchors[ahead[fits]])
        lags.append(gap[fits])
        step += 1
        ahead = ahead[near]
        ahead = ahead[ahead + step < len(anchors)]
    none = np.zeros(0, np.int64)
    return np.concatenate(first or [none]), np.concatenate(lags or [none])


def _phase_pairs(prefixes: Prefixes, scale: int, runs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each two runs of one root that can both hold a window of `scale` words: the distances that bring their
    phases together, and a place where both meet."""
    long = runs[(runs[:, 2] <= scale // 4) & (runs[:, 1] - runs[:, 0] >= scale)]
    known = []
    for start, stop, period in long.tolist():
        turns = prefixes.windows(start, start + period, period)
        least = int(turns.argmin())
        known.append((period, int(turns[least]), start, stop, start + least))
    known.sort()
    for i, (period, root, start, stop, phase) in enumerate(known):
        for other_period, other_root, other_start, other_stop, other_phase in known[i + 1 :]:
            if (other_period, other_root) != (period, root) or other_start - stop >= 2 * scale:
                break
            lags = np.arange(scale + (other_phase - phase - scale) % period, 2 * scale, period)
            low = np.maximum(start, other_start - lags)
            both = np.minimum(stop, other_stop - lags) - low >= scale
            yield low[both], lags[both]


def find_runs(numbers: np.ndarray, longest: int) -> np.ndarray:
    """All runs of an array of word numbers, none longer than `longest`: rows (start, stop, period) by start, then
    period."""
    prefixes = Prefixes(numbers)
    found = _short_runs(numbers, prefixes)
    scale = SHORT
    while 2 * scale <= longest:
        runs = np.concatenate([np.zeros((0, 3), np.int64), *found])
        more = []
        for m, lags in (_anchor_pairs(prefixes, scale, runs), *_phase_pairs(prefixes, scale, runs)):
            for low in range(0, len(m), PAIRS):
                lag = lags[low : low + PAIRS]
                more.append(_checked(prefixes, *prefixes.extend(m[low : low + PAIRS], lag), lag))
        if more:
            found.append(np.unique(np.concatenate(more), axis=0))
        scale *= 2
    runs = np.concatenate([np.zeros((0, 3), np.int64), *found])
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


class Numbers(dict):
    """Numbers of words, given as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def group_runs(documents: list[list[str]]) -> list[np.ndarray]:
    """The runs of each of some documents, given as lists of words."""
    numbers = Numbers()
    lengths = np.array([len(words) for words in documents])
    ends = (lengths + 1).cumsum()  # a number of its own after each document
    every = np.empty(int(ends[-1]), np.int64)
    for words, end in zip(documents, ends.tolist()):
        every[end - 1 - len(words) : end - 1] = [numbers[w] for w in words]
    every[ends - 1] = np.arange(len(documents)) + len(numbers)
    runs = find_runs(every, int(lengths.max()))
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    runs[:, :2] -= (ends - lengths - 1)[owner][:, None]
    cuts = np.searchsorted(owner, np.arange(len(documents) + 1))
    return [runs[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def kept_words(words: list[str], runs: np.ndarray) -> list[str]:
    """The words without those that some run holds after its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(edges[:-1].cumsum() == 0).tolist()]


def grouped(lengths: list[int]) -> Iterator[list[int]]:
    """Rows in groups of similar length and of about GROUP_WORDS words."""
    waiting: dict[int, list[int]] = {}
    held: dict[int, int] = {}
    for row, n in enumerate(lengths):
        size = n.bit_length()
        waiting.setdefault(size, []).append(row)
        held[size] = held.get(size, 0) + n + 1
        if held[size] >= GROUP_WORDS:
            yield waiting.pop(size)
            held[size] = 0
    yield from waiting.values()


def detect(docs: DataFrame, keep: list[str] | None = None, text: str = "text", digests: bool = False) -> DataFrame:
    """Add to the columns `keep` (default: all) of `docs`:

    n_words, runs (array of start, length, period as longs, by start and period; `start` is a word number from 0)
    and kept_text (the words that are left when repetitions are dropped, joined by a space; null only for a null text).
    With `digests`, runs_sha256 (of `start,length,period` and a line feed for each run) and collapsed_sha256 (of the kept
    words) are put in place of kept_text. One pass over whole texts, no shuffle."""
    last = ("runs_sha256", "collapsed_sha256") if digests else ("kept_text",)
    made = ("n_words", "runs", *last)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    kept = docs.select(*keep, *([] if text in keep else [text]))

    @reads(text)
    def make(batch: dict[str, list]) -> dict[str, list]:
        texts = batch[text]
        out: dict[str, list] = {c: [None] * len(texts) for c in made}
        # words are counted by length of text first, so that only one group's lists are held
        for rows in grouped([len(t or "") // 4 for t in texts]):
            documents = [WORD.findall(texts[row] or "") for row in rows]
            for row, words, runs in zip(rows, documents, group_runs(documents)):
                triples = [(s, e - s, q) for s, e, q in runs.tolist()]
                left = " ".join(kept_words(words, runs))
                out["n_words"][row] = len(words)
                out["runs"][row] = [dict(zip(("start", "length", "period"), t)) for t in triples]
                if digests:
                    listed = "".join("%d,%d,%d\n" % t for t in triples)
                    out["runs_sha256"][row] = hashlib.sha256(listed.encode()).hexdigest()
                    out["collapsed_sha256"][row] = hashlib.sha256(left.encode()).hexdigest()
                else:
                    out["kept_text"][row] = None if texts[row] is None else left
        return out

    ddl = "n_words long, runs array<struct<start: long, length: long, period: long>>, " + ", ".join(f"{c} string" for c in last)
    return by_batch(kept, keep, ddl, make)
