import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from notesight.operators import features
from notesight.plans.featurizers import Block, Featurizer, featurizer

ROWS = [(1, 1, 0.0, "a b b"), (2, 2, 1.0, "b c"), (3, 3, 1.0, "z")]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "subject_id int, hadm_id int, label double, text string")


def test_vocabulary_ties_go_by_term(spark):
    counts = spark.createDataFrame([("z", 1), ("b", 3), ("c", 1), ("a", 1)], "term string, n bigint")
    top = features.vocabulary(counts, 3).orderBy("feature").collect()
    assert [(row.feature, row.value) for row in top] == [(0, "b"), (1, "a"), (2, "c")]


def test_idf(spark, rows):
    counts = features.term_counts(rows, ["hadm_id"], F.split("text", " "))
    known = features.vocabulary(counts.groupBy("term").agg(F.sum("n").alias("n")), 4)
    joined = features.join_vocabulary(counts, known, 4)
    weights = {row.feature: row.idf for row in features.idf_weights(joined, rows).collect()}
    assert weights[0] == pytest.approx(math.log(4 / 3)) and weights[1] == pytest.approx(math.log(4 / 2))
    values = {(row.hadm_id, row.feature): row.value for row in features.tfidf(joined, rows, 4).collect()}
    assert values[(1, 0)] == pytest.approx(2 * math.log(4 / 3)) and len(values) == 5


def vectors(df):
    return {row.hadm_id: row.v for row in df.select("hadm_id", vector_to_array("features").alias("v")).collect()}


def test_bag_of_words(spark):
    df = spark.createDataFrame([(1, 1, 0.0, "Cats sing, cat!"), (2, 2, 1.0, "The dog"), (3, 3, 0.0, None)],
                               "subject_id int, hadm_id int, label double, text string")
    fitted = featurizer("bag_of_words").fit(df)
    assert [row.value for row in fitted.feature_map(spark).orderBy("feature").collect()] == ["cat", "dog", "sing"]
    out = fitted.transform(df)
    assert out.columns == ["subject_id", "hadm_id", "label", "features"]
    assert vectors(out) == {1: [2.0, 0.0, 1.0], 2: [0.0, 1.0, 0.0], 3: [0.0, 0.0, 0.0]}
    assert vectors(fitted.transform(df.limit(0))) == {}


def test_unseen_words_are_left_out(spark, rows):
    plan = Featurizer("small", (Block("text", 1, 2),), stem=False)
    fitted = plan.fit(rows)
    unseen = spark.createDataFrame([(9, 9, 0.0, "new words b")], rows.schema)
    assert vectors(fitted.transform(unseen)) == {9: [1.0, 0.0]}


WHOLE = [(1, 1, 0.0, 1, True, "red dog bites man"), (2, 2, 1.0, 1, True, "red dog red cat the end")]
PARTS = [(1, 1, 0.0, 1, True, "red dog bites man"), (2, 2, 1.0, 1, False, "red dog"), (2, 2, 1.0, 2, False, "the"),
         (2, 2, 1.0, 3, False, "red cat the end")]


@pytest.mark.parametrize("name", ["bag_of_words", "tf_idf", "ngrams", "trigrams", "word2vec"])
@pytest.mark.parametrize("fit_on_parts", [False, True])
def test_parts_of_an_admission_give_the_whole_vector(spark, name, fit_on_parts):
    schema = "subject_id int, hadm_id int, label double, part bigint, is_whole boolean, text string"
    times = [1] if name != "word2vec" else range(6)
    whole, parts = (spark.createDataFrame([(10 * i + r[0], *r[1:]) for i in times for r in rows], schema) for rows in (WHOLE, PARTS))
    plan = Featurizer("trigrams", tuple(Block("text", n, 100) for n in (1, 2, 3))) if name == "trigrams" else featurizer(name)
    fitted = plan.fit(parts if fit_on_parts and name != "word2vec" else whole)
    assert fitted.vocabularies == plan.fit(whole).vocabularies
    expected, ours = vectors(fitted.transform(whole)), vectors(fitted.transform(parts))
    assert expected.keys() == ours.keys()
    for key in expected:
        assert ours[key] == pytest.approx(expected[key], abs=1e-6)


def test_section_bow(spark):
    from notesight.functions.words import SECTION_HEADERS

    columns = ["text", *SECTION_HEADERS]
    schema = "subject_id int, hadm_id int, label double, " + ", ".join(f"{name} string" for name in columns)
    df = spark.createDataFrame([(1, 1, 0.0, "pain home", "good", None, "x ray", None, "rest well")], schema)
    fitted = featurizer("section_bow").fit(df)
    named = [row.value for row in fitted.feature_map(spark).collect()]
    assert "pain home" in named and "discharge_instructions:rest well" in named and fitted.size == len(named)
    assert sum(vectors(fitted.transform(df))[1]) == fitted.size


def test_complex_bow(spark):
    df = spark.createDataFrame([(1, 1, 0.0, "Paim is good. Not good!"), (2, 2, 1.0, "pain zzzzzz"), (3, 3, 1.0, "")],
                               "subject_id int, hadm_id int, label double, text string")
    plan = featurizer(
        "complex_bow", dictionary=spark.createDataFrame([("pain", 3), ("good", 1), ("is", 9), ("not", 2)], "term string, n int"),
        lexicon=spark.createDataFrame([("good", 1)], "term string, polarity int"), negators=("not",),
    )
    fitted = plan.fit(df)
    assert fitted.terms == ["good", "pain", "zzzzzz"]
    assert vectors(fitted.transform(df)) == {1: [2.0, 1.0, 0.0, 0.0], 2: [0.0, 1.0, 1.0, 0.0], 3: [0.0, 0.0, 0.0, 0.0]}


def test_words_the_fit_has_corrected_are_not_corrected_again(spark, monkeypatch):
    from notesight.plans import featurizers

    asked = []
    plain = featurizers.correct_spelling
    monkeypatch.setattr(featurizers, "correct_spelling", lambda words, *rest: asked.append(sorted(r.term for r in words.select("term").collect())) or plain(words, *rest))
    rows = lambda *texts: spark.createDataFrame(list(enumerate(texts)), "subject_id int, text string")
    plan = featurizer("complex_bow", dictionary=spark.createDataFrame([("pain", 3), ("good", 1)], "term string, n int"),
                      lexicon=spark.createDataFrame([("good", 1)], "term string, polarity int"))
    fitted = plan.fit(rows("paim good zz", "pain"))
    assert fitted.terms == ["pain", "good", "zz"]
    # a word unknown to the fit is corrected, also to a word the fit knows
    found = {r.subject_id: r.features.toArray().tolist() for r in fitted.transform(rows("pani paim", "good", None)).collect()}
    assert found == {0: [2.0, 0.0, 0.0, 0.0], 1: [0.0, 1.0, 0.0, 1.0], 2: [0.0, 0.0, 0.0, 0.0]}
    assert asked == [["good", "paim", "pain", "zz"], ["pani"]]


def test_counts_by_summaries(spark, monkeypatch):
    from notesight.operators import features

    rows = spark.createDataFrame([(i // 2, "a b c a b d a b" if i % 3 else f"x{i} c d") for i in range(40)] + [(7, None)], "id int, text string")
    grams = features.ngrams(F.split("text", " "), 2)
    counts = lambda **o: sorted(map(tuple, features.vocabulary_counts(rows, ["id"], grams, 4, **o).collect()))
    plain = counts()
    asked, found = [], features.most_frequent
    monkeypatch.setattr(features, "most_frequent", lambda *a: asked.append(a) or found(*a))
    assert counts(summarized=True) == plain and len(asked) == 1 and len({r[1] for r in plain}) == 4


def test_unknown_featurizer():
    with pytest.raises(ValueError, match="unknown featurizer"):
        featurizer("bow")
