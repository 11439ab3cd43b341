import pytest
from pyspark.sql import functions as F

from notesight.operators import metrics


def predictions(spark, cells):
    rows = [(float(label), float(guess), n) for (label, guess), n in cells.items()]
    return spark.createDataFrame(rows, "label double, prediction double, n int").select(
        "label", "prediction", F.explode(F.sequence(F.lit(1), F.col("n")))
    )


# published confusion matrices and the figures logged with them
PUBLISHED = [
    ((4174, 1951, 152, 265), 0.679, (0.965, 0.120), (0.681, 0.635), (0.799, 0.201), (0.911, 0.761)),
    ((4136, 1989, 211, 206), 0.664, (0.951, 0.094), (0.675, 0.494), (0.790, 0.158), (0.897, 0.750)),
    ((2114, 374, 537, 1932), 0.816, (0.797, 0.838), (0.850, 0.783), (0.823, 0.809), (0.818, 0.816)),
]


@pytest.mark.parametrize("cells, accuracy, precision, recall, f_score, weighted", PUBLISHED)
def test_published_figures(spark, cells, accuracy, precision, recall, f_score, weighted):
    df = predictions(spark, dict(zip([(0, 0), (0, 1), (1, 0), (1, 1)], cells)))
    rows = metrics.label_metrics(df).orderBy("label").collect()
    for i in (0, 1):
        assert (round(rows[i].precision, 3), round(rows[i].recall, 3), round(rows[i].f_score, 3)) == (
            precision[i], recall[i], f_score[i])
    overall = metrics.overall_metrics(df).first()
    assert round(overall.accuracy, 3) == accuracy
    assert (round(overall.precision, 3), round(overall.f_score, 3)) == weighted


def test_label_never_predicted(spark):
    rows = metrics.label_metrics(predictions(spark, {(0, 0): 3, (1, 0): 1})).orderBy("label").collect()
    assert rows[1].precision == 0.0 and rows[1].f_score == 0.0 and rows[1].rows == 1


def scored(spark, rows):
    return spark.createDataFrame([(float(l), float(s)) for s, l in rows], "label double, probability_1 double")


def test_auroc_with_ties(spark):
    df = scored(spark, [(0.9, 1), (0.9, 0), (0.1, 0), (0.8, 1)])
    assert metrics.auroc(df).first().auroc == pytest.approx(0.625)
    assert metrics.auroc(scored(spark, [(0.9, 1), (0.1, 1)])).first().auroc is None


def test_auroc_over_many_slices(spark):
    df = spark.range(5000).select(
        ((F.col("id") * 7919) % 5000 / 5000.0).alias("probability_1"), ((F.col("id") % 7) < 2).cast("double").alias("label")
    ).withColumn("probability_1", F.round("probability_1", 3))
    rows = df.collect()
    up = [r.probability_1 for r in rows if r.label == 1.0]
    down = [r.probability_1 for r in rows if r.label == 0.0]
    import bisect

    down.sort()
    wins = sum((bisect.bisect_left(down, s) + bisect.bisect_right(down, s)) / 2 for s in up)
    assert metrics.auroc(df).first().auroc == pytest.approx(wins / len(up) / len(down))


def test_vote_tie_goes_up(spark):
    rows = [(1, 1, 0.0, 1.0, 0.2, 0.8), (1, 1, 0.0, 0.0, 0.6, 0.4)]
    df = spark.createDataFrame(rows, "subject_id int, hadm_id int, label double, prediction double, probability_0 double, probability_1 double")
    row = metrics.ensemble_vote(df).first()
    assert (row.prediction, round(row.probability_0, 3), round(row.probability_1, 3)) == (1.0, 0.4, 0.6)
