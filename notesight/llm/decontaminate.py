"""Benchmark decontamination: windows of normalised benchmark words, as hash sets of a bounded size, are
scanned over the words of every document; hits are verified word by word, then spans or documents removed.

The benchmark goes to the executors in blocks of at most `block_bytes` of its text. A block's set is sorted arrays: 20 bytes a
window (hash, place, item) and 4 a word, beside a number for each distinct word. Each block is one more pass, and rows
are written to the shared folder between two passes, so that one block is in memory at a time.

Null or empty texts and texts without words have no windows and no hits. An item with fewer words than the
width is one window. Repeated items count once by item_id; a null item_id marks words but is no item. Rows of
`docs` are kept as they are, repeated or not; columns named n_words, n_hit, hits and hit_items are replaced."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from notesight.llm.common import by_batch, query_blocks, reads, staged

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Benchmark text that one pass broadcasts, at most (plus one item): about 25 MB of arrays, and the distinct words.
BLOCK_BYTES = 4 << 20


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then runs of digits, letters and anything beyond ASCII. UTF-8 bytes do for that."""
    return WORD.findall(text.encode().lower()) if text else []


@dataclass
class Windows:
    """The windows of some items as sorted hashes, for each window length, with where each window is."""

    width: int
    vocabulary: dict[bytes, int]
    numbers: np.ndarray  # of the words of all items, one after the other
    ids: list  # of the items
    sets: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # hashes, places, items, by length

    @classmethod
    def of(cls, items: list[tuple[object, str | None]], width: int) -> Windows:
        vocabulary: dict[bytes, int] = {}
        every, at, sets = [], 0, {}
        for item, (_, text) in enumerate(items):
            numbers = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)], np.uint32)
            length = min(width, len(numbers))
            if length:
                hashes = _rolled(numbers, length)
                places = np.arange(at, at + len(hashes), dtype=np.int64)
                sets.setdefault(length, []).append((hashes, places, np.full(len(hashes), item, np.int32)))
            every.append(numbers)
            at += len(numbers)
        made = {}
        for length, parts in sets.items():
            hashes, places, owners = (np.concatenate(p) for p in zip(*parts))
            order = np.lexsort((owners, hashes))
            made[length] = hashes[order], places[order], owners[order]
        return cls(width, vocabulary, np.concatenate(every or [np.zeros(0, np.uint32)]), [i for i, _ in items], made)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words lie in a window that occurs, and the items of those windows."""
        hit = np.zeros(len(words) + 1, np.int32)
        found: set[int] = set()
        get = self.vocabulary.get
        numbers = np.array([get(w, 0) for w in words], np.uint32)
        known = np.concatenate([[0], (numbers > 0).cumsum()])
        for length, (hashes, places, owners) in self.sets.items():
            if len(numbers) < length:
                continue
            whole = np.flatnonzero(known[length:] - known[:-length] == length)
            if not len(whole):
                continue
            rolled = _rolled(numbers, length)[whole]
            first, last = np.searchsorted(hashes, rolled), np.searchsorted(hashes, rolled, side="right")
            seen: dict[int, np.ndarray] = {}
            for at, low, high in zip(*(a[last > first].tolist() for a in (whole, first, last))):
                window = numbers[at : at + length]
                # verified on the words themselves, once for each window that is found again
                before = seen.get(low)
                if before is None or not np.array_equal(before, window):
                    same = np.ones(high - low, bool)
                    for j in range(length):
                        same &= self.numbers[places[low:high] + j] == window[j]
                    if not same.any():
                        continue
                    seen[low] = window
                    found.update(owners[low:high][same].tolist())
                hit[at] += 1
                hit[at + length] -= 1
        return hit.cumsum()[:-1] > 0, {self.ids[i] for i in found} - {None}


def _rolled(numbers: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit polynomial of every window, with wrap-around."""
    wide = numbers.astype(np.uint64)
    out = np.zeros(len(wide) - length + 1, np.uint64)
    for j in range(length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + wide[j : j + len(out)] + np.uint64(1)
    return out


def scan(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, keep: list[str] | None = None, text: str = "text",
    item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add `n_words`, `n_hit`, `hits` (first and last word number of each run of hit words) and `hit_items`
    (ids as sorted strings) to the columns `keep` (default: all) of `docs`, which must have `text`."""
    made = ("n_words", "n_hit", "hits", "hit_items")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    scanned = docs.select(
        *keep, F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("hit_items"),
    )
    rest = query_blocks(benchmark.select(item, item_text), item_text, block_bytes)
    for number, items in enumerate(rest):
        if number:
            scanned = staged(scanned, "scanned")
        index = docs.sparkSession.sparkContext.broadcast(Windows.of(items, width))

        @reads(text)
        def make(batch: dict[str, list], index=index) -> dict[str, list]:
            out: dict[str, list] = {c: [] for c in made}
            for value, hits, before in zip(batch[text], batch["hits"], batch["hit_items"]):
                words = words_of(value)
                hit, items = index.value.scan(words)
                for first, last in zip(hits[::2], hits[1::2]):
                    hit[first : last + 1] = True
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                out["n_words"].append(len(words))
                out["n_hit"].append(int(hit.sum()))
                out["hits"].append([int(e) - i % 2 for i, e in enumerate(edges)])
                out["hit_items"].append(sorted({*before, *map(str, items)}))
            return out

        scanned = by_batch(scanned, keep, "n_words long, n_hit long, hits array<int>, hit_items array<string>", make)
    return scanned


def remove_spans(scanned: DataFrame, text: str = "text") -> DataFrame:
    """Cut the hit words (with what lies between them) out of the texts."""

    def cut(value: str | None, hits: list[int]) -> str | None:
        if not hits:
            return value
        raw = value.encode()
        places = [m.span() for m in WORD.finditer(raw.lower())]
        kept, at = [], 0
        for first, last in zip(hits[::2], hits[1::2]):
            kept.append(raw[at : places[first][0]])
            at = places[last][1]
        return b"".join([*kept, raw[at:]]).decode()

    @reads("hits")
    def make(batch: dict[str, list]) -> dict[str, list]:
        return {text: list(map(cut, batch[text], batch["hits"]))}

    keep = [c for c in scanned.columns if c != text]
    return by_batch(scanned, keep, f"`{text}` string", make).select(*scanned.columns)


def remove_documents(scanned: DataFrame, share: float = 0.0) -> DataFrame:
    """Drop the documents of whose words more than `share` are hit."""
    return scanned.filter(~(F.col("n_hit") > share * F.col("n_words")))
