"""Ordered scans over ranges against windows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from notesight.operators.ordered import with_next, with_sum_before


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(9)
    # one key has two thirds of the rows, on one moment
    made = [(None if i % 50 == 0 else 1 if i % 3 else rng.randint(2, 40), "x" if i % 3 else str(i % 4), 5 if i % 3 else rng.randint(1, 9), i,
             None if i % 11 == 0 else rng.random() < 0.1, rng.randint(0, 20)) for i in range(900)]
    return spark.createDataFrame(made, "a int, b string, moment int, id int, flag boolean, amount int").repartition(5)


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def same(one, other):
    key = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)
    assert key(one) == key(other)


@pytest.mark.parametrize("ranges", [1, 13])
def test_next_and_sum(rows, small_batches, ranges):
    known = rows.filter("a IS NOT NULL")
    w = Window.partitionBy("a", "b").orderBy("moment", "id")
    same(
        with_next(known, ["a", "b"], ["moment", "id"], F.struct("id", "amount"), F.col("flag"), "n", ranges),
        known.withColumn("n", F.first(F.when(F.col("flag"), F.struct("id", "amount")), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))),
    )
    same(
        with_sum_before(rows, ["a", "b"], ["moment", "id"], F.col("amount"), "n", ranges),
        rows.withColumn("n", F.coalesce(F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))),
    )


def test_empty_tables(rows):
    none = rows.filter("false")
    assert with_next(none, ["a"], ["id"], F.col("id"), F.lit(True), "n").count() == 0
    assert with_sum_before(none, ["a"], ["id"], F.col("id"), "n").count() == 0
