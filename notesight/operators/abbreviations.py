"""Abbreviations learned from the texts, and sentences that do not end at them.

A word that nearly always has a period after it is more likely an abbreviation than a word that happens to end sentences.
The measure is the likelihood ratio of Kiss and Strunk (Unsupervised Multilingual Sentence Boundary Detection, 2006): how
much better the counts fit a period 99 times in 100 than the share of words with a period, times the number of
periods within the word and one, divided by e for each letter, and by the number of letters for each time without a period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from notesight.functions.tokens import sentences

#: Score from which a word counts as an abbreviation.
LEAST_SCORE = 0.3
#: Abbreviations that one expression can hold.
MAX_ABBREVIATIONS = 200_000
#: Share of an abbreviation's occurrences with a period.
SHARE = 0.99
WORD = r"[a-z]+(?:\.[a-z]+)*\.?"
#: The word before the last period, both read backwards.
LAST_WORD = r"\A\.([a-z]+(?:\.[a-z]+)*)"
#: Put between sentences while they are one text; one that a text has itself is a cut too.
BREAK = "\x01"


def period_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n, dotted): the lower-cased words of the texts, which may have periods within, how often they occur and how
    often with a period after them. Counts are combined before the shuffle."""
    words = df.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))).alias("found"))
    dotted = F.endswith("found", F.lit("."))
    word = F.when(dotted, F.regexp_replace("found", r"\.$", "")).otherwise(F.col("found"))
    return words.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n"), F.count_if(dotted).alias("dotted"))


def abbreviations(df: DataFrame, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """(word, n, dotted, score) of the words that score `least` or more."""
    counts = period_counts(df, text)
    total = counts.agg((F.sum("dotted") / F.sum("n")).alias("share"))
    share = total.scalar()
    bare = F.col("n") - F.col("dotted")
    ratio = 2 * (
        F.col("dotted") * F.log(F.lit(SHARE)) + bare * F.log(F.lit(1 - SHARE)) - F.col("dotted") * F.log(share) - bare * F.log(1 - share)
    )
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    periods = F.length("word") - letters
    score = ratio * (periods + 1) * F.exp(-letters.cast("double")) * F.pow(letters.cast("double"), -bare.cast("double"))
    # without a word with a period there is nothing to compare
    return counts.filter("dotted > 0").withColumn("score", score).filter(F.col("score") >= least)


def known_sentences(text: Column, known: Sequence[str]) -> Column:
    """The sentences of a text, those put together again by a space that were cut after an abbreviation."""
    # the piece before rides along: to look it up by number would cut the text again for each piece
    pieces = sentences(text)
    backwards = [word[::-1] for word in known]

    def ends_short(piece: Column) -> Column:
        # read from its end, the piece is looked at once
        return F.regexp_extract(F.reverse(F.lower(piece)), LAST_WORD, 1).isin(backwards) if known else F.lit(False)

    def led(piece: Column, before: Column) -> Column:
        lead = F.when(before.isNull(), "").when(ends_short(before), " ").otherwise(BREAK)
        return F.when(piece.isNotNull(), F.concat(lead, piece))

    moved = F.concat(F.array(F.lit(None).cast("string")), pieces)  # one longer: its last piece has none after it
    return F.array_remove(F.split(F.array_join(F.zip_with(pieces, moved, led), ""), BREAK), "")


def sentence_rows(df: DataFrame, keys: Sequence[str], text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """(keys, sentence_no from 0, sentence), with the abbreviations of the same texts."""
    words = [row["word"] for row in abbreviations(df, text, least).select("word").limit(MAX_ABBREVIATIONS + 1).collect()]
    if len(words) > MAX_ABBREVIATIONS:
        raise ValueError(f"more than {MAX_ABBREVIATIONS} abbreviations: ask for a higher score")
    found = known_sentences(F.col(text), sorted(words))
    return df.select(*keys, F.posexplode(found).alias("sentence_no", "sentence"))
