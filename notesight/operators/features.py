"""Bag-of-words features in long form: (keys, term, n) and (keys, feature, value).

Counts are combined before every shuffle, so a frequent word or a long text costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from notesight.functions.stemmer import stem_text
from notesight.functions.tokens import letter_text, ngrams, remove_stop_words, word_tokens
from notesight.operators.frequent import most_frequent

BROADCAST_VOCABULARY = 100_000


def term_counts(df: DataFrame, keys: Sequence[str], tokens: Column) -> DataFrame:
    """(keys, term, n)."""
    exploded = df.select(*keys, F.explode(tokens).alias("term"))
    return exploded.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))


def corpus_counts(df: DataFrame, column: str, n: int = 1, stem: bool = True) -> DataFrame:
    """(term, n): the n-grams of a text column over all rows, after stemming and stop words."""
    tokens = df.select(remove_stop_words(final_tokens(F.col(column), stem)).alias("tokens"))
    return gram_counts(tokens, [ngrams(F.col("tokens"), n)]).drop("block")


def gram_counts(df: DataFrame, blocks: Sequence[Column]) -> DataFrame:
    """(block, term, n) for several columns of terms, from one pass over the rows."""

    def grams(number: int, terms: Column) -> Column:
        name = F.lit(number).alias("block")
        return F.transform(terms, lambda term: F.struct(name, term.alias("term")))

    every = F.concat(*[grams(i, terms) for i, terms in enumerate(blocks)])
    return df.select(F.explode(every).alias("gram")).groupBy("gram.block", "gram.term").agg(F.count(F.lit(1)).alias("n"))


def block_vocabularies(counts: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(block, term, n): the most frequent terms of every block, ties by term. Other blocks are masked rather
    than filtered out, so that all branches read the one shuffle of `counts`."""

    def top(number: int, size: int) -> DataFrame:
        masked = F.when(F.col("block") == number, F.col("n"))
        first = counts.orderBy(masked.desc_nulls_last(), F.asc("term")).limit(size)
        return first.filter(masked.isNotNull())

    return reduce(DataFrame.unionByName, [top(i, size) for i, size in enumerate(sizes)])


def totals(counts: DataFrame) -> DataFrame:
    """(term, n) over all rows from (keys, term, n)."""
    return counts.groupBy("term").agg(F.sum("n").alias("n"))


def final_tokens(text: Column, stem: bool = True) -> Column:
    """The words of a text, stemmed or not, in order."""
    if not stem:
        return word_tokens(text)
    return F.array_remove(F.split(stem_text(letter_text(text)), " "), "")


def vocabulary(counts: DataFrame, size: int) -> DataFrame:
    """(feature, value, n): the `size` most frequent terms, numbered from 0; ties go by term. The window runs
    over at most `size` rows."""
    top = counts.orderBy(F.desc("n"), F.asc("term")).limit(size)
    number = F.row_number().over(Window.orderBy(F.desc("n"), F.asc("term"))) - 1
    return top.select(number.cast("bigint").alias("feature"), F.col("term").alias("value"), "n")


def join_vocabulary(counts: DataFrame, terms: DataFrame, size: int) -> DataFrame:
    """(keys, feature, n) for the terms of a vocabulary of at most `size` rows."""
    lookup = terms.select("feature", F.col("value").alias("term"))
    if size <= BROADCAST_VOCABULARY:
        lookup = F.broadcast(lookup)
    return counts.join(lookup, "term").drop("term")


def vocabulary_counts(df: DataFrame, keys: Sequence[str], terms: Column, size: int, summarized: bool = False) -> DataFrame:
    """(keys, feature, n) for the `size` most frequent terms. They are found first, from counts combined per
    task, so that only their counts, and not every pair of a key and a term, are shuffled by key. `summarized` finds
    them by bounded summaries, for n-grams, of which a task has too many distinct ones to count."""
    exploded = df.select(*keys, F.explode(terms).alias("term"))
    counts = most_frequent(df, terms, size) if summarized else exploded.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    found = join_vocabulary(exploded, vocabulary(counts, size), size)
    return found.groupBy(*keys, "feature").agg(F.count(F.lit(1)).alias("n"))


def idf_weights(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """(feature, idf) with idf = ln((N + 1) / (df + 1)) from (keys, feature, n) and the table of all N
    documents."""
    total = documents.agg(F.count(F.lit(1)).alias("documents")).scalar()
    # counting by n keeps the plan of `counts` as it is, so Spark reads its shuffle again instead of redoing it
    frequency = counts.groupBy("feature").agg(F.count_if(F.col("n") > 0).alias("df"))
    return frequency.select("feature", F.log((total + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def tfidf(counts: DataFrame, documents: DataFrame, size: int) -> DataFrame:
    """(keys, feature, n, value) from (keys, feature, n)."""
    weights = idf_weights(counts, documents)
    if size <= BROADCAST_VOCABULARY:
        weights = F.broadcast(weights)
    return counts.join(weights, "feature").withColumn("value", F.col("n") * F.col("idf")).drop("idf")
