import random
import re

import pytest
from pyspark.sql import functions as F

from notesight.operators import terms


def table(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def word_list(spark, *items):
    return spark.createDataFrame([(item,) for item in items], "term string")


def matched(df, listed, **options):
    return [row.terms for row in terms.match_terms(df, listed, ["id"], **options).orderBy("id").collect()]


@pytest.mark.parametrize("limit", [0, 1000])  # joined, or made a pattern
def test_overlapping_terms(spark, limit):
    listed = word_list(spark, "he", "she", "her", "hers")
    df = table(spark, "ushers", "", None, "xyz", "he")
    assert matched(df, listed, max_pattern=limit) == ["she he her hers", "", "", "", "he"]


@pytest.mark.parametrize("limit", [0, 1000])
def test_whole_words_and_edges(spark, limit):
    df = table(spark, "he is here, the he", "aaa")
    assert matched(df, word_list(spark, "he", "aaaa"), whole_words=True, max_pattern=limit) == ["he he", ""]
    assert matched(df, word_list(spark, "aa"), max_pattern=limit) == ["", "aa aa"]
    assert matched(df, word_list(spark).limit(0), max_pattern=limit) == ["", ""]


@pytest.mark.parametrize("limit", [0, 10_000])
def test_terms_across_pieces_and_repeated_keys(spark, limit):
    rng = random.Random(4)
    texts = ["".join(rng.choices("abé ", k=n)) for n in (0, 1, 255, 256, 257, 258, 511, 1500)]
    listed = ["a", "ab", "bé a", "".join(texts[-1][250:262]), texts[-1][100:500]]
    rows = [(i // 2, text) for i, text in enumerate(texts)]
    found = terms.match_terms(spark.createDataFrame(rows, "id int, text string"), word_list(spark, *listed, "ab"), ["id"], max_pattern=limit)
    expected = []
    for key, text in rows:
        hits = sorted((i + len(t), -len(t), t) for t in set(listed) for i in range(len(text)) if text.startswith(t, i))
        expected.append((key, " ".join(t for _, _, t in hits)))
    assert sorted(map(tuple, found.collect())) == sorted(expected)


@pytest.mark.parametrize("whole", [False, True])
def test_odd_terms_alike_by_pattern_and_join(spark, whole):
    rng = random.Random(5)
    letters = "ab.$\\(|[ \n\u00e9\U0001f600-1"
    texts = ["".join(rng.choices(letters, k=n)) for n in (0, 1, 2, 40, 300, 900)]
    listed = {"".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(60)}
    df = table(spark, *texts)
    expected = []
    for text in texts:
        hits = [(i + len(t), -len(t), t) for t in listed for i in range(len(text)) if text.startswith(t, i)]
        near = lambda at: 0 <= at < len(text) and text[at].isalnum()
        expected.append(" ".join(t for end, size, t in sorted(hits) if not whole or not (near(end) or near(end + size - 1))))
    for limit in (0, 10_000):
        assert matched(df, word_list(spark, *listed), whole_words=whole, max_pattern=limit) == expected
    assert matched(table(spark, "xa\x01b"), word_list(spark, "a\x01b", "b")) == ["a\x01b b"]


@pytest.mark.parametrize("most", [0, 100])  # joined, or looked up within the row
def test_dictionary_words(spark, most):
    df = table(spark, "b a b c", "z", None)
    found = terms.dictionary_words(df, word_list(spark, "a", "b", None), ["id"], max_terms=most).orderBy("id")
    assert [row.words for row in found.collect()] == ["a b", "", ""]
    twice = df.union(df).withColumn("id", F.lit(1))
    assert sorted(r.words for r in terms.dictionary_words(twice, word_list(spark, "a"), ["id"], max_terms=most).collect()) == ["", "", "", "", "a", "a"]
    assert terms.dictionary_words(df, word_list(spark).limit(0), ["id"], max_terms=most).filter("words = ''").count() == 3


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("limit", [1, 2])
def test_spelling_against_brute_force(spark, limit):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 7)))
    known = {word(): rng.randint(1, 5) for _ in range(40)}
    tokens = sorted({word() for _ in range(300)} | {"cccccccccccccccccccc"})
    corrected = terms.correct_spelling(
        spark.createDataFrame([(t,) for t in tokens], "term string"),
        spark.createDataFrame(list(known.items()), "term string, n int"), limit,
    )
    ours = {row.term: (row.corrected, row.distance) for row in corrected.collect()}
    for token in tokens:
        near = [(distance(token, k), -n, k) for k, n in known.items() if distance(token, k) <= limit]
        best = min(near) if near and token not in known else (0, 0, token) if token in known else None
        assert ours[token] == ((best[2], best[0]) if best else (token, None))


def test_sentiment(spark):
    lexicon = spark.createDataFrame([("good", 1), ("bad", -2)], "term string, polarity int")
    df = table(spark, "Good day. Not good! Bad, good. Plain.", "")
    scored = terms.sentence_sentiment(df, lexicon, ["not"], ["id"]).orderBy("sentence_no")
    assert [(row.id, row.score) for row in scored.collect()] == [(0, 1.0), (0, -1.0), (0, -1.0), (0, 0.0)]


def test_long_lists_by_join(spark):
    rng = random.Random(6)
    listed = {"".join(rng.choices("abcd", k=rng.choice([1, 2, 3, 5, 9, 9, 12, 40]))) for _ in range(3000)}
    texts = ["".join(rng.choices("abcd .", weights=[4, 4, 4, 4, 1, 1], k=n)) for n in (0, 3, 200, 900)] + ["".join(rng.sample(sorted(listed), 40))]
    expected = []
    for text in texts:
        hits = sorted((i + len(t), -len(t), t) for t in listed for i in range(len(text)) if text.startswith(t, i))
        expected.append(" ".join(t for _, _, t in hits))
    assert matched(table(spark, *texts), word_list(spark, *listed), max_pattern=0) == expected


def test_a_term_is_known_by_its_rarest_letters(spark):
    keyed = {r.term: r.offset for r in terms.rare_grams(word_list(spark, "the one", "the two", "the", "t"), 4).collect()}
    assert keyed["the one"] >= 1 and keyed["the two"] >= 1 and keyed["the"] == 0 and keyed["t"] == 0


def test_words_of_a_long_list_are_sent_once_for_each_chunk(spark, monkeypatch):
    """What the join of words shuffles for an occurrence does not grow with the longest term."""
    rng = random.Random(7)
    rows = [(i // 2 or None, rng.choice(["2020-01-01", None]), None if i % 9 == 4 else " ".join(rng.choices(["aé1", "bb", "c", "d_e", "x-y", "."], k=i % 40))) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, day string, text string").withColumn("day", F.to_date("day")).repartition(3)
    listed = ["aé1", "c", "d", "y", "z" * 5000]
    monkeypatch.setattr(terms, "_gram_hits", None)  # the letters around a place are not sent
    taken = lambda text: " ".join(w for w in re.findall(r"[^\W_]+", text or "") if w in listed)
    expected = sorted((str(i), str(day), taken(text)) for i, day, text in rows)
    of_list = word_list(spark, *listed)
    found = [terms.match_terms(df, of_list, ["id", "day"], whole_words=True, max_pattern=0)]
    found += [terms._match_words(df, of_list, ["id", "day"], "text", len(listed), chunk_words=n) for n in (1, 100)]
    for each in found:
        assert sorted((str(r.id), str(r.day), r.terms) for r in each.collect()) == expected


def test_whole_words_of_a_short_list_are_looked_up(spark, monkeypatch):
    """A word costs one look into the list, not a pattern tried at each letter."""
    rng = random.Random(8)
    texts = [None, "", *("".join(rng.choices("ab\u00e91 ._-\n\U0001f600\u0301", k=n)) for n in (1, 5, 80, 400))]
    listed = ["a", "ab", "b1", "\u00e9", "1", "aaa"]
    taken = lambda text: " ".join(w for w in re.findall(r"[^\W_]+", text or "") if w in listed)
    monkeypatch.setattr(terms, "terms_in", None)
    assert matched(table(spark, *texts), word_list(spark, *listed), whole_words=True) == [taken(text) for text in texts]
