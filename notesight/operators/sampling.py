"""Splits, samples, folds and bags, chosen by a hash of the row's key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from notesight.functions.hashing import (
    HASH_DIGITS, hash_fraction, hash_hex, hash_number, hex_fraction, least_drawn, poisson_copies,
)
from notesight.operators.ordered import with_sum_before

#: Bits of a hash that are counted in one round.
STEP_BITS = 12
#: Hexadecimal digits of a hash that say how often a row is in a bag: they fill a double.
BAG_DIGITS = 13


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 12345) -> DataFrame:
    """A sample without replacement that a rerun reproduces."""
    return df.filter(hash_fraction(F.lit(f"sample{seed}"), *keys) < fraction)


def random_sample(df: DataFrame, fraction: float, seed: int = 12345) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def split_ratio(
    df: DataFrame, keys: Sequence[str], ratio: float = 0.15, seed: int = 12345
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with about `ratio` of the keys in test; rows of one key stay together."""
    marked = df.withColumn("is_test", hash_fraction(F.lit(f"split{seed}"), *keys) < ratio)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")


def random_split(df: DataFrame, ratio: float = 0.15, seed: int = 12345) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([1.0 - ratio, ratio], seed=seed)
    return train, test


def assign_folds(df: DataFrame, keys: Sequence[str], folds: int = 5, seed: int = 12345) -> DataFrame:
    """Add an integer column `fold` for CrossValidator(foldCol=...)."""
    return df.withColumn("fold", F.floor(hash_fraction(F.lit(f"fold{seed}"), *keys) * folds).cast("int"))


def class_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


def negatives(df: DataFrame, distinct: bool = False) -> DataFrame:
    """The rows whose label is not 1. `distinct` removes the positives as a set instead, which also drops
    duplicate rows and keeps rows without a label."""
    positive = F.col("label") == 1
    return df.subtract(df.filter(positive)) if distinct else df.filter(~positive)


def balance(df: DataFrame, keys: Sequence[str], seed: int = 12345) -> DataFrame:
    """All positive rows and, by a hash of the key, about as many of the others. One pass over the labels
    for the two counts, one over the rows; no shuffle of the rows."""
    counts = df.agg(
        F.count_if(F.col("label") == 1).alias("positive"), F.count_if(F.col("label") != 1).alias("other")
    )
    share = counts.select(F.col("positive") / F.nullif(F.col("other"), F.lit(0))).scalar()
    drawn = hash_fraction(F.lit(f"balance{seed}"), *keys) < F.coalesce(share, F.lit(1.0))
    return df.filter((F.col("label") == 1) | ((F.col("label") != 1) & drawn))


def smallest(df: DataFrame, keys: Sequence[str], count: int, prefix: str) -> DataFrame:
    """Exactly `count` rows of `df` (all, if it has fewer): those with the smallest hashes of the keys, then keys.

    The largest hash taken is found digit by digit: each round counts the rows by the next three of the fifteen
    hexadecimal digits. Rows are not sorted; only those that share that one hash are ranked."""
    hashed = df.withColumn("chosen_by", hash_number(F.lit(prefix), *keys))
    low, left, bits = 0, count, 4 * HASH_DIGITS
    while bits:
        bits -= STEP_BITS
        within = hashed.filter(F.shiftright("chosen_by", bits + STEP_BITS) == low >> STEP_BITS)
        digit = F.shiftright("chosen_by", bits).alias("digit")
        # at most 2^STEP_BITS rows
        for number, n in sorted(map(tuple, within.groupBy(digit).agg(F.count(F.lit(1))).collect())):
            if left <= n:
                low = number
                break
            left -= n
        else:
            return df
        low = low << STEP_BITS if bits else low
    sure = hashed.filter(F.col("chosen_by") < low)
    ties = with_sum_before(hashed.filter(F.col("chosen_by") == low), ["chosen_by"], list(keys), F.lit(1), "place")
    return sure.select(*df.columns).unionByName(ties.filter(F.col("place") < left).select(*df.columns))


def balance_exact(df: DataFrame, keys: Sequence[str], seed: int = 12345) -> DataFrame:
    """All positive rows and exactly as many of the others (all, if there are fewer), by a hash of the key."""
    positive = df.filter(F.col("label") == 1)
    return positive.unionByName(smallest(df.filter(F.col("label") != 1), keys, positive.count(), f"balance{seed}"))


def bags(
    df: DataFrame,
    keys: Sequence[str],
    positives: int = 400,
    others: int = 1000,
    count: int = 20,
    seed: int = 12345,
) -> DataFrame:
    """Bootstrap bags in one pass: a row per bag it is drawn into, with the number of `copies`. A bag holds
    about `positives` rows of label 1 and `others` of the rest, drawn with replacement."""
    sizes = df.agg(
        F.count_if(F.col("label") == 1).alias("positive"), F.count_if(F.col("label") != 1).alias("other")
    ).first()

    # of a large table most rows are in no bag, which the digits of the hash tell; they are not made a number
    means = {1: positives / max(sizes["positive"], 1), 0: others / max(sizes["other"], 1)}
    of_label = lambda each: F.when(F.col("label") == 1, each[1]).when(F.col("label") != 1, each[0])
    hashes = [hash_hex(F.lit(f"bag{seed}"), F.lit(bag), *keys, digits=BAG_DIGITS) for bag in range(1, count + 1)]
    every = F.array(*[F.struct(F.lit(bag).alias("bag"), each.alias("hash")) for bag, each in enumerate(hashes, 1)])
    drawn = df.withColumn("drawn", F.explode(every)).filter(F.col("drawn.hash") >= of_label({c: least_drawn(m, BAG_DIGITS) for c, m in means.items()}))
    fraction = hex_fraction(F.col("drawn.hash"), BAG_DIGITS)
    copies = of_label({c: poisson_copies(fraction, m) for c, m in means.items()})
    return drawn.select(*df.columns, "drawn.bag", copies.alias("copies")).filter("copies > 0")
