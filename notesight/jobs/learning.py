"""Queries that train a learner on the labelled documents and predict the held-out ones."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from notesight.config import stage
from notesight.jobs import QUERIES, query
from notesight.jobs.features import STOPS
from notesight.jobs.roles import document_notes, hash_fraction_sql, labelled_documents, table, words_sql
from notesight.operators.metrics import metrics_report
from notesight.operators.sampling import split_ratio
from notesight.plans.featurizers import Block, Featurizer, featurizer
from notesight.plans.learners import KEYS, learner, name_importance, top_importance


def _vectors(spark: SparkSession, sf_dir: str):
    """(train, test, feature map): bag-of-words vectors, computed once for all passes of the fit."""
    train, test = split_ratio(labelled_documents(spark, sf_dir), KEYS)
    fitted = featurizer("bag_of_words").fit(train)
    return stage(fitted.transform(train)), fitted.transform(test), fitted.feature_map(spark)


def _learner_query(name: str, learner_name: str) -> None:
    @query(name)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, test, _ = _vectors(spark, sf_dir)
        fitted = learner(learner_name)
        fitted.train(train)
        return fitted.predict(test)


QUERY_OF = {
    "lr_matched": "lr", "gbt_matched": "gbt", "rf_matched": "rf", "mlp_matched": "mlp", "lr_cv": "lr_cv", "gbt_cv": "gbt_cv",
    "lr_bagged": "lr_bagged", "gbt_bagged": "gbt_bagged",
}
IS_TEST = f"{hash_fraction_sql('split12345', 'doc_id', 'doc_id')} < CAST(0.15 AS DOUBLE)"

for _name, _learner in QUERY_OF.items():
    _learner_query(_name, _learner)


def _contract_query(name: str, run, classes: int, label: str) -> None:
    """What any prediction must hold, whatever the model: a row for each held-out document with its keys and label, probabilities
    from 0 to 1 that add up to one, and a class that is one of the model's."""

    @query(
        f"{name}_contract",
        f"""SELECT doc_id AS subject_id, doc_id AS hadm_id, {label} AS label, CAST(1 AS DOUBLE) AS probability_sum, true AS are_probabilities,
  true AS is_class FROM documents JOIN labels USING (doc_id) WHERE {IS_TEST}""",
    )
    def contract(spark: SparkSession, sf_dir: str) -> DataFrame:
        odds = [F.col(f"probability_{c}") for c in range(classes)]
        return run(spark, sf_dir).select(
            *KEYS, "label", F.round(sum(odds, F.lit(0.0)), 6).alias("probability_sum"),
            ((F.least(*odds) >= 0) & (F.greatest(*odds) <= 1)).alias("are_probabilities"),
            F.col("prediction").isin(*map(float, range(classes))).alias("is_class"),
        )


for _name in QUERY_OF:
    _contract_query(_name, QUERIES[_name], 2, "CAST(toxic AS DOUBLE)")


def _three_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees of three classes: poor, good and toxic documents."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("subject_id"), F.when(F.col("toxic") == 1, 2.0).otherwise(F.col("quality").cast("double")).alias("label")
    )
    rows = document_notes(spark, sf_dir).join(labels, "subject_id")
    train, test = split_ratio(rows, KEYS)
    fitted = featurizer("bag_of_words").fit(train)
    trees = learner("gbt")
    trees.train(stage(fitted.transform(train)))
    return trees.predict(fitted.transform(test))


_contract_query("gbt_three_classes", _three_classes, 3, "CASE WHEN toxic = 1 THEN CAST(2 AS DOUBLE) ELSE CAST(quality AS DOUBLE) END")


@query(
    "importance_class_means",
    f"""WITH labelled AS (SELECT doc_id, text, CAST(toxic AS DOUBLE) AS label FROM documents JOIN labels USING (doc_id)
), kept AS (
  SELECT doc_id, label, term, count(*) AS n FROM (SELECT doc_id, label, unnest({words_sql('text')}) AS term FROM labelled)
  WHERE term NOT IN {STOPS} GROUP BY ALL
), totals AS (SELECT term, CAST(sum(n) AS BIGINT) AS n FROM kept GROUP BY term
), vocabulary AS (SELECT term, n FROM totals ORDER BY n DESC, term LIMIT 3000
), sizes AS (SELECT count(*) FILTER (WHERE label = 1) AS ones, count(*) FILTER (WHERE label = 0) AS noughts FROM labelled
), weighed AS (
  SELECT v.term AS value, round(coalesce(sum(k.n) FILTER (WHERE label = 1), 0) / ones - coalesce(sum(k.n) FILTER (WHERE label = 0), 0) / noughts, 9) AS importance
  FROM vocabulary v JOIN kept k USING (term), sizes GROUP BY v.term, ones, noughts
), placed AS (
  SELECT *, row_number() OVER (ORDER BY importance DESC, value) AS high, row_number() OVER (ORDER BY importance, value) AS low FROM weighed
)
SELECT CAST(h.high AS INTEGER) AS place, h.value AS high_value, h.importance AS high_importance, l.value AS low_value, l.importance AS low_importance
FROM placed h JOIN placed l ON h.high = l.low WHERE h.high <= 20""",
)
def importance_class_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terms with the largest differences of mean counts between the classes, named by the feature map."""
    rows = labelled_documents(spark, sf_dir)
    fitted = Featurizer("plain", (Block("text", 1, 3000),), stem=False).fit(rows)
    counts = stage(fitted.transform(rows)).select("label", F.posexplode(vector_to_array("features")).alias("feature", "n"))
    means = counts.groupBy("feature").agg(*[F.avg(F.when(F.col("label") == c, F.col("n"))).alias(f"mean_{c}") for c in (0, 1)])
    importance = means.select(F.col("feature").cast("bigint").alias("feature"), F.round(F.col("mean_1") - F.col("mean_0"), 9).alias("importance"))
    return top_importance(name_importance(importance, fitted.feature_map(spark)))


@query("importance_top")
def importance_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, feature_map = _vectors(spark, sf_dir)
    return top_importance(name_importance(learner("lr").train(train), feature_map))


@query("lr_report")
def lr_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, _ = _vectors(spark, sf_dir)
    fitted = learner("lr")
    fitted.train(train)
    report = metrics_report(stage(fitted.predict(test)))
    return report.withColumn("value", F.round("value", 6))
