"""Random choices that depend on the row's key alone, not on partitions, retries or Spark versions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def hash_hex(*parts: Column | str, digits: int = 8) -> Column:
    """The first `digits` hexadecimal digits of the MD5 of the parts joined by `|`."""
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    return F.substring(F.md5(F.concat_ws("|", *[column.cast("string") for column in columns])), 1, digits)


def hex_fraction(digest: Column, digits: int) -> Column:
    return F.conv(digest, 16, 10).cast("double") / F.lit(16.0**digits)


def hash_fraction(*parts: Column | str, digits: int = 8) -> Column:
    """A uniform number in [0, 1) from `digits` hexadecimal digits (13 fill a double) of the MD5 of the parts
    joined by `|`."""
    return hex_fraction(hash_hex(*parts, digits=digits), digits)


#: Hexadecimal digits of a `hash_number`, as many as a long holds.
HASH_DIGITS = 15


def hash_number(*parts: Column | str) -> Column:
    """A long from the first HASH_DIGITS digits of the same MD5."""
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    digest = F.md5(F.concat_ws("|", *[column.cast("string") for column in columns]))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")


def poisson_steps(mean: float) -> tuple[int, list[float]]:
    """The cumulative probabilities of a Poisson distribution from a first count on, about 17 standard deviations; what lies
    beyond on either side is less likely than the smallest step of a double."""
    width = 8.5 * math.sqrt(mean) + 20
    first = max(0, math.floor(mean - width))
    steps, below = [], 0.0
    for count in range(first, math.ceil(mean + width)):
        below += math.exp(count * math.log(mean) - mean - math.lgamma(count + 1)) if mean else 1.0
        steps.append(min(below, 1.0))
        if below >= 1.0:
            break
    return first, steps


def poisson_copies(fraction: Column, mean: float) -> Column:
    """How often a row is drawn in a sample with replacement: the Poisson quantile of `fraction`, for any
    mean. The cumulative probabilities go into one array literal."""
    first, steps = poisson_steps(mean)
    listed = F.split(F.lit(",".join(map(repr, steps))), ",").cast("array<double>")
    # an array of one binds the fraction, which would be worked out anew for each step otherwise
    counted = F.transform(F.array(fraction), lambda once: F.size(F.filter(listed, lambda step: (step <= once) & (step < 1.0))))
    return F.lit(first) + F.get(counted, F.lit(0))


def least_drawn(mean: float, digits: int) -> str:
    """The least `hash_hex` whose fraction has a `poisson_copies` above 0: digits compare as their numbers do."""
    first, steps = poisson_steps(mean)
    if first:
        return ""
    least = math.ceil(steps[0] * 16**digits)
    return f"{least:0{digits}x}" if least < 16**digits and steps[0] < 1.0 else "none"
