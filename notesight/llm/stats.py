"""Statistics of whole texts, the inputs of the quality rules and the quality classifier."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from notesight.llm.common import SPACE, WORD, by_batch, reads

SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE, "n_chars_all", "n_lines", "n_upper", "n_digits", "n_punctuation", "n_exclaim", "n_pipes", "n_short",
          "n_title", "n_top", "n_line_ends")
UPPER, DIGIT = re.compile(r"[^\W\d_a-zß-öø-ÿ]"), re.compile(r"[0-9]")


def text_stats(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one text; all 0 for null. Time and memory grow with the text's length."""
    if not text:
        return (0,) * len(COUNTS)
    words = WORD.findall(text)
    n = len(words)
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    seen = Counter(words)
    letters = len(text) - sum(map(text.count, SPACE))
    return (
        n,
        letters,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(text),
        len(lines),
        sum(map(str.isupper, words)),
        len(DIGIT.findall(text)),
        sum(map(text.count, PUNCTUATION)),
        text.count("!"),
        text.count("|"),
        sum(c for w, c in seen.items() if len(w) <= 3),
        sum(c for w, c in seen.items() if w[0].isupper()),
        max(seen.values(), default=0),
        sum(line.rstrip(SPACE)[-1] in PUNCTUATION for line in lines),
    )


def repeated_words(words: list[str], width: int = 3) -> int:
    """Words that lie in a window of `width` words found twice or more."""
    windows = list(zip(*(words[i:] for i in range(width))))
    found = Counter(windows)
    if len(found) == len(windows):
        return 0
    covered, until = 0, 0
    for at, window in enumerate(windows):
        if found[window] > 1:
            covered += at + width - max(at, until)
            until = at + width
    return covered


RATIOS = {  # derived numbers that do not grow with the length of a text, each from a numerator and a denominator of COUNTS
    "word_length": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "word_chars"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "upper_ratio": ("n_upper", "n_words"),
    "digit_ratio": ("n_digits", "word_chars"),
    "punctuation_ratio": ("n_punctuation", "n_words"),
    "exclaim_ratio": ("n_exclaim", "n_words"),
    "pipe_ratio": ("n_pipes", "n_words"),
    "short_ratio": ("n_short", "n_words"),
    "title_ratio": ("n_title", "n_words"),
    "top_ratio": ("n_top", "n_words"),
    "line_end_ratio": ("n_line_ends", "n_lines"),
}
#: Ratios only: a count would learn the lengths of the sample.
FEATURES = tuple(RATIOS)


def with_stats(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add COUNTS (long) to the columns `keep` (default: all but those of the same names, which are
    replaced). One pass over whole texts, no shuffle."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in COUNTS]
    kept = docs.select(*keep, *([] if text in keep else [text]))

    @reads(text)
    def make(batch: dict[str, list]) -> dict[str, list]:
        return dict(zip(COUNTS, list(zip(*map(text_stats, batch[text]))) or [()] * len(COUNTS)))

    return by_batch(kept, keep, ", ".join(f"{c} long" for c in COUNTS), make)


def ratio(name: str) -> Column:
    """A number of FEATURES as a double column over COUNTS; 0 where the denominator is 0."""
    above, below = RATIOS[name]
    return F.when(F.col(below) > 0, F.col(above).cast("double") / F.col(below)).otherwise(F.lit(0.0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """FEATURES and 0/1 labels of at most `max_rows` labelled documents, the first by a hash of doc_id; what
    is sent to the driver is bounded by that, whatever the size of the corpus.

    Rows with a null id or a label other than 0 and 1 are left out; repeated rows count as often as they
    occur, within the bound."""
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .select("doc_id", F.col(label).cast("double").alias("label_of_sample"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label_of_sample")
        .limit(max_rows)
    )
    # texts stay where they are: rows of numbers are ordered and cut
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    stats = with_stats(texts, keep=["doc_id", "label_of_sample"])
    numbers = stats.select(*[ratio(f).alias(f) for f in FEATURES], "label_of_sample", "doc_id")
    rows = numbers.orderBy(F.xxhash64("doc_id"), *numbers.columns[::-1]).limit(max_rows).toPandas()
    rows = rows.sort_values(list(rows.columns), kind="stable")  # the same model however the rows arrive
    return rows[list(FEATURES)].to_numpy(float), rows["label_of_sample"].to_numpy(float)
