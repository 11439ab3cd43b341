"""Abbreviations and the sentences they do not end."""

import math
import time

from pyspark.sql import functions as F

from notesight.operators import abbreviations as ab


def test_scores_by_hand(spark):
    texts = ["pt. seen b.i.d. daily. well done. the end", "Pt. is well. done b.i.d. again"] * 20 + ["well", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = {r.word: (r.n, r.dotted) for r in ab.period_counts(df).collect()}
    assert counts["pt"] == (40, 40) and counts["b.i.d"] == (40, 40) and counts["well"] == (41, 20) and counts["done"] == (40, 20)
    n, dotted = (sum(c[i] for c in counts.values()) for i in (0, 1))
    share = dotted / n
    found = {r.word: r.score for r in ab.abbreviations(df, least=-1e9).collect()}
    for word, (n, dotted) in counts.items():
        if dotted:
            ratio = 2 * (dotted * math.log(0.99 / share) + (n - dotted) * math.log(0.01 / (1 - share)))
            letters = len(word.replace(".", ""))
            wanted = ratio * (word.count(".") + 1) * math.exp(-letters) * letters ** -(n - dotted)
            assert math.isclose(found[word], wanted, rel_tol=1e-9)
    assert {r.word for r in ab.abbreviations(df).collect()} == {"pt", "b.i.d"}
    assert ab.abbreviations(df.filter("false")).count() == 0


def test_sentences(spark):
    df = spark.createDataFrame([(1, "Pt. seen b.i.d. daily. Well! pt."), (2, None), (3, ""), (4, "a. b")], "id int, text string")
    rows = df.select("id", F.posexplode(ab.known_sentences(F.col("text"), ["b.i.d", "pt"]))).collect()
    assert [tuple(r) for r in rows] == [(1, 0, "Pt. seen b.i.d. daily."), (1, 1, "Well!"), (1, 2, "pt."), (4, 0, "a."), (4, 1, "b")]
    none = df.select("id", F.posexplode(ab.known_sentences(F.col("text"), []))).collect()
    assert [r[2] for r in none if r.id == 1] == ["Pt.", "seen b.i.d.", "daily.", "Well!", "pt."]


def test_a_long_text_is_cut_once_not_for_each_sentence(spark):
    text = "Seen by pt. daily. " * 15_000
    df = spark.createDataFrame([(text,)], "text string")
    start = time.monotonic()
    found = df.select(F.explode(ab.known_sentences(F.col("text"), ["pt"])).alias("s")).groupBy("s").count().collect()
    assert [tuple(r) for r in found] == [("Seen by pt. daily.", 15_000)]
    assert time.monotonic() - start < 20  # minutes, if each sentence cuts the text again


def test_the_word_before_the_last_period(spark):
    texts = ["1a.b. x", "a..pt. x", "\u00e9pt. x", "pt.! x", "Pt. x", ".pt. x", "ptt. x", "t. x", "A.B. x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = df.select("id", F.size(ab.known_sentences(F.col("text"), ["pt", "a.b"])).alias("n")).orderBy("id").collect()
    assert [r.n for r in rows] == [1, 1, 1, 2, 1, 1, 2, 2, 1]
