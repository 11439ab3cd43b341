"""Statistics by brute force; rules and trees by held-out accuracy and on odd rows."""

import zlib
from collections import Counter

import corpus
import numpy as np

from notesight.llm import boosting, decision_list
from notesight.llm.queries import QUERIES
from notesight.llm.stats import FEATURES, labelled_sample, repeated_words


def base(text):
    words = corpus.ASCII_WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if corpus.ASCII_WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def check(rows, texts):
    assert len(rows) == len(texts)
    left = list(texts)
    for r in rows:
        numbers = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        left.remove((r.doc_id, next(t for d, t in left if d == r.doc_id and base(t) == numbers)))
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (r.kept and failed)


def test_rules_query(spark, sf, texts):
    rows = QUERIES["op4_decision_list"](spark, sf).collect()
    check(rows, list(texts.items()))
    kept = {r.doc_id: r.kept for r in rows if not r.base_failed}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [(kept[d], q == 1) for d, q in labels.items() if d in kept]
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)


def test_rules_on_odd_rows(spark, odd):
    none = decision_list.DecisionList(())
    judged = decision_list.judge(odd, none)
    assert judged.schema["odd name, 1"].dataType == odd.schema["odd name, 1"].dataType
    check(judged.collect(), corpus.odd_texts())
    assert decision_list.judge(odd.filter("false"), none).count() == 0


def test_repeated_words():
    assert repeated_words("a b c a b c".split()) == 6
    assert repeated_words("a a a a".split()) == 4
    assert repeated_words("a b c d a b x".split()) == repeated_words(["a"]) == repeated_words([]) == 0


def planted(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(FEATURES)))
    return x, 1.0 - (((x[:, 1] > 0.7) & (x[:, 3] <= 0.5)) | (x[:, 4] > 0.9))


def test_rules_find_planted_conditions(spark):
    x, y = planted(4000, 1)
    rules = decision_list.learn(x, y)
    other, truth = planted(4000, 2)
    assert (rules.keeps(other) == truth).mean() > 0.97
    assert "and" in str(rules)
    assert str(decision_list.learn(x, np.ones(len(x)))) == str(decision_list.learn(x[:0], y[:0])) == "keep all"


def test_trees_learn_and_walk_alike():
    x, y = planted(4000, 1)
    trees = boosting.train(x, y)
    other, truth = planted(4000, 2)
    score = trees.score(other)
    assert ((score >= 0.5) == truth).mean() > 0.97

    def walk(row):
        total = trees.base
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
            total += trees.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(score[:50], [walk(row) for row in other[:50]])
    assert boosting.train(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3
    assert (boosting.train(x, np.ones(len(x))).score(x) > 0.9).all()


def test_scores_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op9_boosted_quality"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_labels_are_not_seen_when_held_out(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    x, y = labelled_sample(docs, labels.filter("doc_id % 2 = 0"), "quality", 1000)
    assert len(x) == len(y) == labels.filter("doc_id % 2 = 0").count()
    assert len(labelled_sample(docs, labels, "quality", 10)[0]) == 10


def test_scores_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(6, 1), (9, 1), (10, 0), (12, 0), (None, 0), (14, None)], "doc_id long, quality int")
    rows = boosting.score(odd, boosting.fit(odd, labels)).collect()
    assert len(rows) == len(corpus.odd_texts()) and all(0 <= r.score <= 1 for r in rows)
    assert boosting.score(odd.filter("false"), boosting.fit(odd, labels.filter("false"))).count() == 0
