import pytest
from pyspark.sql import functions as F

from notesight.operators import sampling


def rows(spark, positives, others):
    return spark.range(positives + others).select("id", (F.col("id") < positives).cast("double").alias("label"))


def test_balance(spark):
    counts = {r.label: r["rows"] for r in sampling.class_counts(sampling.balance(rows(spark, 500, 5000), ["id"])).collect()}
    assert counts[1.0] == 500 and 400 < counts[0.0] < 600


def test_balance_with_more_positives(spark):
    assert sampling.balance(rows(spark, 50, 10), ["id"]).count() == 60
    assert sampling.balance(rows(spark, 5, 0), ["id"]).count() == 5


def test_split_does_not_depend_on_partitions(spark):
    df = rows(spark, 100, 900)
    parts = [sorted(r.id for r in sampling.split_ratio(df.repartition(n), ["id"])[1].collect()) for n in (1, 7)]
    assert parts[0] == parts[1] and 100 < len(parts[0]) < 200
    train, test = sampling.split_ratio(df, ["id"])
    assert train.count() + test.count() == 1000 and train.intersect(test).isEmpty()


def test_random_split_and_sample(spark):
    train, test = sampling.random_split(rows(spark, 10, 990))
    assert train.count() + test.count() == 1000
    assert 20 < sampling.random_sample(rows(spark, 10, 990), 0.05).count() < 90


def test_folds(spark):
    sizes = [r["count"] for r in sampling.assign_folds(rows(spark, 0, 1000), ["id"]).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 150


def test_negatives(spark):
    df = spark.createDataFrame([(1.0, "a"), (0.0, "b"), (0.0, "b"), (None, "c")], "label double, x string")
    assert sorted(r.x for r in sampling.negatives(df).collect()) == ["b", "b"]
    assert sorted(r.x for r in sampling.negatives(df, distinct=True).collect()) == ["b", "c"]


def test_bags_draw_about_the_wanted_rows_and_differ(spark):
    drawn = sampling.bags(rows(spark, 100, 5000), ["id"], positives=400, others=1000, count=4)
    sizes = drawn.groupBy("bag", "label").agg(F.sum("copies").alias("n")).collect()
    assert len(sizes) == 8
    for r in sizes:
        assert r.n == pytest.approx(400 if r.label == 1 else 1000, rel=0.2)
    ids = [frozenset(r.id for r in drawn.filter(f"bag = {b} and label = 0").collect()) for b in (1, 2)]
    assert len(ids[0] & ids[1]) < 0.5 * len(ids[0])


def test_bags_of_one_positive_row(spark):
    """Means of 400 copies and of a billionth of one."""
    drawn = sampling.bags(rows(spark, 1, 3000), ["id"], positives=400, others=1000, count=20)
    copies = [r.copies for r in drawn.filter("label = 1").collect()]
    assert len(copies) == 20 and 300 < min(copies) < max(copies) < 500 and sum(copies) / 20 == pytest.approx(400, rel=0.05)


@pytest.mark.parametrize("mean", [0.0, 1e-11, 0.5, 30.0, 400.0, 5000.0])
def test_poisson_quantiles(spark, mean):
    from notesight.functions.hashing import poisson_copies

    fractions = [0.0, 0.5, 1 - 1e-10, 1 - 2.0**-52]
    got = [r[0] for r in spark.createDataFrame([(f,) for f in fractions], "f double").select(poisson_copies(F.col("f"), mean)).collect()]
    assert got == sorted(got) and got[1] == pytest.approx(mean, abs=1 + mean**0.5 / 10) and got[-1] < mean + 9 * mean**0.5 + 20
    assert mean == 0 or got[-1] > 0


def test_smallest_takes_exactly_so_many(spark):
    from notesight.functions.hashing import hash_number
    from notesight.operators.sampling import balance_exact, smallest

    # one key has a third of the rows, so that the cut falls within it for some counts
    rows = spark.range(300).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id").repartition(5)
    order = [r.id for r in rows.withColumn("h", hash_number(F.lit("p"), "k")).orderBy("h", "k").collect()]
    hashes = {r.id: r.k for r in rows.collect()}
    for count in (0, 1, 50, 120, 200, 299, 300, 900):
        taken = [r.id for r in smallest(rows, ["k"], count, "p").collect()]
        assert len(taken) == len(set(taken)) == min(count, 300)
        assert sorted(hashes[i] for i in taken) == sorted(hashes[i] for i in order[:count])
    labelled = spark.range(1000).select("id", (F.col("id") % 5 == 0).cast("double").alias("label"))
    counts = {r.label: r["count"] for r in balance_exact(labelled, ["id"]).groupBy("label").count().collect()}
    assert counts == {1.0: 200, 0.0: 200}
    assert balance_exact(labelled.filter("label = 1"), ["id"]).count() == 200
    assert balance_exact(labelled.filter("false"), ["id"]).count() == 0


@pytest.mark.parametrize("mean", [0.0, 1e-17, 1e-9, 0.5, 3.0, 400.0])
def test_copies_by_steps(spark, mean):
    """The least digits with a copy are just those, and the hash is not worked out anew for each of the steps."""
    from notesight.functions.hashing import hash_fraction, hex_fraction, least_drawn, poisson_copies, poisson_steps

    first, steps = poisson_steps(mean)
    least = least_drawn(mean, 13)
    near = {0, 1, 2**51, 2**52 - 1, *(int(least, 16) + d for d in (-1, 0, 1) if least not in ("", "none"))}
    rows = spark.createDataFrame([(f"{n:013x}",) for n in near if 0 <= n < 2**52], "hash string")
    for r in rows.select("hash", poisson_copies(hex_fraction(F.col("hash"), 13), mean).alias("n")).collect():
        assert r.n == first + sum(step <= int(r.hash, 16) / 2**52 and step < 1 for step in steps)
        assert (r.n > 0) == (r.hash >= least)
    copies = poisson_copies(hash_fraction("id"), mean).alias("n")
    plan = spark.range(3).select(copies)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and plan.index("md5(") < plan.index("filter(")


def test_bags_with_null_keys_and_labels(spark):
    """As drawn row by row from the definition."""
    from notesight.functions.hashing import hash_fraction, poisson_copies

    rows = spark.range(400).select(
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("a"), F.when(F.col("id") % 5 > 0, F.lit("")).alias("b"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 3 == 0).cast("double")).alias("label"),
    )
    ones, noughts = rows.filter("label = 1").count(), rows.filter("label = 0").count()
    each = rows.withColumn("bag", F.explode(F.sequence(F.lit(1), F.lit(3))))
    fraction = hash_fraction(F.lit("bag12345"), "bag", "a", "b", digits=13)
    copies = F.when(F.col("label") == 1, poisson_copies(fraction, 40 / ones)).when(F.col("label") == 0, poisson_copies(fraction, 50 / noughts))
    expected = each.withColumn("copies", copies).filter("copies > 0")
    drawn = sampling.bags(rows, ["a", "b"], positives=40, others=50, count=3)
    assert drawn.columns == ["a", "b", "label", "bag", "copies"] and drawn.count() > 100
    assert sorted(map(str, drawn.collect())) == sorted(map(str, expected.collect()))
