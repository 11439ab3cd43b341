"""The most frequent terms against exact counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from notesight.operators.frequent import Summary, candidates, most_frequent


def test_summaries_are_too_low_by_the_error_at_most():
    rng = random.Random(1)
    for width in (1, 3, 20, 1000):
        summary, exact = Summary(width), Counter()
        for _ in range(60):
            batch = Counter(str(int(rng.paretovariate(0.7))) for _ in range(rng.randint(0, 50)))
            exact += batch
            summary.add(list(batch), list(batch.values()))
        summary.cut()
        assert len(summary.counts) <= width
        assert all(n <= exact[t] <= n + summary.error for t, n in summary.counts.items())
        assert all(n <= summary.error for t, n in exact.items() if t not in summary.counts)
        assert width < 1000 or summary.error == 0


@pytest.mark.parametrize("width", [1, 40, None])
def test_most_frequent(spark, width):
    rng = random.Random(2)
    texts = [[str(int(rng.paretovariate(0.8))) for _ in range(rng.randint(0, 30))] for _ in range(400)]
    exact = Counter(t for text in texts for t in text)
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,), ([None, "1"],)], "terms array<string>").repartition(6)
    exact["1"] += 1
    got = [(r.term, r.n) for r in most_frequent(rows, F.col("terms"), 25, width).collect()]
    assert got == sorted(exact.items(), key=lambda x: (-x[1], x[0]))[:25]
    assert len(most_frequent(rows, F.col("terms"), 10**6, width).collect()) == len(exact)
    assert most_frequent(rows.filter("false"), F.col("terms"), 5, width).count() == 0


def test_few_candidates_are_counted(spark):
    texts = [([f"rare {i} {j}" for j in range(50)] + ["often"] * 20,) for i in range(200)]
    rows = spark.createDataFrame(texts, "terms array<string>").repartition(4)
    assert [r.term for r in candidates(rows, 1, 100).collect()] == ["often"]


def test_terms_beyond_the_bound_are_cut_before_they_are_added():
    import numpy as np
    import pyarrow as pa

    summary, taken = Summary(3), []
    plain = summary.add
    summary.add = lambda terms, counts: (taken.append(len(terms)), plain(terms, counts))
    rng, true = random.Random(3), Counter()
    for _ in range(20):
        counts = {f"t{i}": rng.randint(1, 9) + 40 * (i < 2) for i in rng.sample(range(50), 30)}
        true.update(counts)
        summary.add_counted(pa.array(list(counts)), np.array(list(counts.values())))
    assert max(taken) <= 3
    assert all(summary.counts.get(t, 0) <= n <= summary.counts.get(t, 0) + summary.error for t, n in true.items())
