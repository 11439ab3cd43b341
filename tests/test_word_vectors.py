"""Word vectors whose words and vectors stay off the driver."""

import heapq
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from notesight.operators import word_vectors
from notesight.plans.featurizers import Featurizer


def vectors_of(model, spark):
    rows = spark.read.parquet(model.folder).collect()
    assert len({r.term for r in rows}) == len(rows)
    return {r.term: np.frombuffer(r.vector, "<f4").astype(float) for r in rows}


def test_codes_are_as_short_as_they_can_be():
    for counts in ([7], [3, 3], [90, 20, 20, 9, 5, 5, 5], sorted((random.Random(1).randrange(5, 400) for _ in range(300)), reverse=True)):
        parent, bit = word_vectors.huffman(np.array(counts))
        codes = []
        for at in range(len(counts)):
            code = ""
            while at < len(parent):
                code, at = str(bit[at]) + code, parent[at]
            codes.append(code)
        assert not any(a != b and b.startswith(a) for a in codes for b in codes) and len(set(codes)) == len(counts)
        least, left = 0, list(counts)
        heapq.heapify(left)
        while len(left) > 1:
            both = heapq.heappop(left) + heapq.heappop(left)
            least += both
            heapq.heappush(left, both)
        assert sum(n * len(c) for n, c in zip(counts, codes)) == least


def test_words_and_vectors_do_not_come_to_the_driver(spark, monkeypatch):
    """The driver sees a row for each distinct count and task, and the library that collects all vectors has no part in it."""
    import pyspark.ml.feature as library

    names = ["".join(chr(97 + i // 26**k % 26) for k in range(3)) + "q" for i in range(3000)]
    rows = [(i, i, " ".join(names[(200 * i + j) % 3000] for j in range(200))) for i in range(90)]
    df = spark.createDataFrame(rows, "subject_id int, hadm_id int, text string").repartition(3)
    monkeypatch.setattr(library.Word2Vec, "_fit", lambda *_: pytest.fail("collects vectors"))
    collect, seen = type(df).collect, []
    monkeypatch.setattr(type(df), "collect", lambda self: seen.append(len(found := collect(self))) or found)
    fitted = Featurizer("word2vec", word2vec=True, stem=False).fit(df)
    assert sum(seen) < 100
    monkeypatch.undo()
    assert len(vectors_of(fitted.word_vectors, spark)) == 3000


def test_words_used_alike_have_like_vectors(spark):
    rng = random.Random(4)
    groups = [[f"{g}{chr(97 + i)}x" for i in range(12)] for g in "abcd"]
    rows = [(" ".join(rng.choice(groups[i % 4]) for _ in range(60)) + " seldom",) for i in range(2400)]
    df = spark.createDataFrame(rows + [(None,), ("",)], "text string").select(F.split("text", " ").alias("tokens")).repartition(2)
    vectors = vectors_of(word_vectors.fit(df, 20, 5, 3, 2), spark)
    cosine = lambda a, b: vectors[a] @ vectors[b] / np.linalg.norm(vectors[a]) / np.linalg.norm(vectors[b])
    same = np.mean([cosine(g[0], g[i]) for g in groups for i in range(1, 12)])
    other = np.mean([cosine(g[0], h[0]) for g in groups for h in groups if g is not h])
    assert set(vectors) == {w for g in groups for w in g} | {"seldom"} and same > 0.8 and same > other + 0.4


def test_a_row_is_the_mean_of_its_words(spark, monkeypatch):
    """Also where a text is summed in several pieces; words without a vector count as nothing."""
    monkeypatch.setattr(word_vectors, "ROWS", 2)
    df = spark.createDataFrame([(i, ["red", "dog", "cat"][: 1 + i % 3] + ["rare"] * (i == 0)) for i in range(30)], "id int, tokens array<string>")
    model = word_vectors.fit(df, 8, 5, 1, df.rdd.getNumPartitions())
    vectors = vectors_of(model, spark)
    assert set(vectors) == {"red", "dog", "cat"}
    rows = spark.createDataFrame([(1, ["dog", "red", "dog", "rare"]), (2, []), (3, ["rare"]), (4, ["cat"]), (5, None)], "id int, tokens array<string>")
    found = {r.id: (r.n_tokens, r.v) for r in model.transform(rows).select("id", "n_tokens", vector_to_array("features").alias("v")).collect()}
    assert found[1] == (4, pytest.approx((2 * vectors["dog"] + vectors["red"]) / 4)) and found[4] == (1, pytest.approx(vectors["cat"]))
    assert found[2] == (0, [0.0] * 8) and found[3] == (1, [0.0] * 8) and found[5] == (0, [0.0] * 8)


def test_no_word_is_frequent_enough(spark):
    with pytest.raises(ValueError):
        word_vectors.fit(spark.createDataFrame([(["a", "b"],)], "tokens array<string>"), 8, 5, 1, 1)
