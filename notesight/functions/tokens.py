"""Words, sentences and n-grams of a text as array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from notesight.functions.words import REMOVER_STOP_WORDS


def word_tokens(text: Column) -> Column:
    """Runs of ASCII letters of the lower-cased text; an empty array for NULL."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+")
    return F.array_remove(split, "")


def letter_text(text: Column) -> Column:
    """The lower-cased text with a space for every run of other characters than ASCII letters."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+", " ")


def remove_stop_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda token: ~token.isin(REMOVER_STOP_WORDS))


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of `n` tokens joined by a space; an empty array if there are fewer than `n`."""
    grams = tokens
    for width in range(2, n + 1):
        rest = F.slice(tokens, F.lit(width), F.greatest(F.size(tokens) - (width - 1), F.lit(0)))
        heads = F.slice(grams, F.lit(1), F.greatest(F.size(tokens) - (width - 1), F.lit(0)))
        grams = F.zip_with(heads, rest, lambda left, right: F.concat_ws(" ", left, right))
    return grams


def sentences(text: Column) -> Column:
    """The text cut after every `.`, `!` or `?` that white space follows; empty pieces are dropped."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+"), "")
