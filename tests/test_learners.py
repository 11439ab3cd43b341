import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from notesight.functions.vectors import split_vector
from notesight.operators.metrics import auroc
from notesight.plans.learners import KEYS, importance_table, learner, name_importance, top_importance


@pytest.fixture(scope="module")
def data(spark):
    noise = lambda salt: F.rand(salt) - 0.5
    df = spark.range(600, numPartitions=4).select(
        F.col("id").alias("subject_id"), F.col("id").alias("hadm_id"), (F.col("id") % 4 == 0).cast("double").alias("label"),
    )
    df = df.withColumns({"a": F.col("label") + noise(1), "b": noise(2), "c": F.col("label") * 0.5 + noise(3)})
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).select(*KEYS, "label", "features")
    df = df.checkpoint() if spark.sparkContext.getCheckpointDir() else df.cache()
    return df.filter("hadm_id % 5 != 0"), df.filter("hadm_id % 5 = 0")


OPTIONS = {"lr_bagged": {"count": 3}, "gbt_bagged": {"count": 2, "options": {"maxIter": 3}}, "gbt_cv": {"folds": 2}, "gbt": {"options": {"maxIter": 4}}}


@pytest.mark.parametrize("name", ["lr", "gbt", "rf", "mlp", "lr_cv", "gbt_cv", "lr_bagged", "gbt_bagged"])
def test_train_predict_save_load(spark, data, tmp_path, name):
    train, test = data
    fitted = learner(name, **OPTIONS.get(name, {}))
    importance = fitted.train(train).collect()
    assert len(importance) == (0 if name == "mlp" else 3)
    if importance:
        assert max(importance, key=lambda row: abs(row.importance)).feature == 0
    predicted = fitted.predict(test)
    assert predicted.columns == [*KEYS, "label", "prediction", "probability_0", "probability_1"]
    assert auroc(predicted).first().auroc > 0.7
    path = str(tmp_path / name)
    fitted.save(path)
    fitted.save(path)  # a second save replaces the first
    loaded = learner(name).load(path).predict(test)
    assert sorted(loaded.collect()) == sorted(predicted.collect())


def test_same_seed_same_result(data):
    train, test = data
    results = []
    for _ in range(2):
        fitted = learner("rf")
        fitted.train(train)
        results.append(sorted(fitted.predict(test).collect()))
    assert results[0] == results[1]


def test_unknown_learner():
    with pytest.raises(ValueError, match="unknown learner"):
        learner("svm")
    assert learner("rfr").name == "rf"


def test_importance_tables(spark):
    importance = importance_table(spark, [0.5, -2.0, 1.0])
    named = name_importance(importance, spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "feature bigint, value string"))
    rows = top_importance(named, 2).orderBy("place").collect()
    assert [(r.high_value, r.low_value) for r in rows] == [("z", "y"), ("x", "x")]


def test_split_vector(spark, data):
    wide = split_vector(data[0], "features")
    assert wide.columns == [*KEYS, "label", "features_0", "features_1", "features_2"]
    assert split_vector(data[0].limit(0), "features", 3).count() == 0


@pytest.mark.parametrize("name", ["lr", "rf", "mlp", "lr_cv", "lr_bagged", "gbt", "gbt_bagged"])
def test_three_classes(spark, data, tmp_path, name):
    from notesight.operators.metrics import metrics_report

    train, test = (df.withColumn("label", (F.col("hadm_id") % 3).cast("double")) for df in data)
    fitted = learner(name, **OPTIONS.get(name, {}))
    importance = fitted.train(train)
    assert importance.count() == (0 if name == "mlp" else 3)
    predicted = fitted.predict(test)
    assert predicted.columns[-3:] == ["probability_0", "probability_1", "probability_2"]
    assert predicted.filter("abs(probability_0 + probability_1 + probability_2 - 1) > 1e-6").count() == 0
    assert {r.label for r in metrics_report(predicted).filter("metric = 'auroc'").collect()} == {0.0, 1.0, 2.0}
    fitted.save(str(tmp_path / "model"))
    assert sorted(learner(name).load(str(tmp_path / "model")).predict(test).collect()) == sorted(predicted.collect())


def test_a_task_of_a_fit_has_a_bounded_number_of_rows(spark):
    from notesight.plans.learners import ROWS_PER_TASK, sized

    for parts, count in ((2, 7 * ROWS_PER_TASK), (9, ROWS_PER_TASK + 1), (3, 10)):
        rows = sized(spark.range(0, count, 1, parts), count)
        sizes = rows.rdd.mapPartitions(lambda each: [sum(1 for _ in each)]).collect()
        assert sum(sizes) == count and max(sizes) <= 1.1 * ROWS_PER_TASK
