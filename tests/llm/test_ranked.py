"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import corpus
import pytest

from notesight.llm import ranked

ITEMS = "item_id long, text string, rank int"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_scoring_all(documents, items, k=10):
    """(item, rank, doc_id, score) rows."""
    counted = [(d, Counter(words), len(words)) for d, words in ((d, terms(t)) for d, t in documents) if words]
    n, total = len(counted), sum(c for _, _, c in counted)
    df = Counter(t for _, words, _ in counted for t in words)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
    rows = []
    for item, text in items:
        scored = []
        for doc_id, words, length in counted:
            m = 100 - 75 + (75 * length * n) // total
            score = sum(weight[t] * ((10**9 * words[t]) // (1000 * words[t] + 8 * m)) for t in terms(text) if t in words)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        rows += [(item, i, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return rows


def answered(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes, postings, wave", [(1 << 20, 1 << 18, 64), (300, 40, 1)])
def test_odd_rows(spark, odd, block_bytes, postings, wave, monkeypatch):
    monkeypatch.setattr(ranked, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(ranked, "WAVE", wave)
    words = corpus.prose(200, 1).split()
    items = [(1, " ".join(words[20:60]).upper(), 1), (2, None, 1), (3, "", 1), (4, "not there"), (None, words[3]), (5, "one One ONE"), (5, "one"),
             (6, "a " + "s ll endoftext"), (7, corpus.prose(80, 3))]
    items = [(*i, 1)[:3] for i in items]
    got = ranked.top(odd, spark.createDataFrame(items, ITEMS), k=3, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert answered(got) == sorted(by_scoring_all(corpus.odd_texts(), [i[:2] for i in items], 3), key=repr)
    none = spark.createDataFrame([], ITEMS)
    assert ranked.top(odd, none).count() == 0
    assert ranked.top(odd.filter("false"), spark.createDataFrame(items, ITEMS)).count() == 0


def test_random_texts_with_many_ties(spark, monkeypatch):
    monkeypatch.setattr(ranked, "SHARD_DOCS", 150)
    rng = random.Random(4)
    letters = [chr(97 + i) for i in range(12)]
    documents = [(i // 2 if i % 7 else i, " ".join(rng.choices(letters, weights=range(1, 13), k=rng.choice([1, 3, 3, 8, 40])))) for i in range(1500)]
    rng.shuffle(documents)
    items = [(i, " ".join(rng.choices(letters, k=rng.randint(1, 9))), 0) for i in range(40)]
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(4)
    got = ranked.top(docs, spark.createDataFrame(items, ITEMS))
    assert answered(got) == sorted(by_scoring_all(documents, [i[:2] for i in items]), key=repr)


def test_few_documents_are_scored():
    """Of a shard in which one document answers the query, few others are looked at."""
    rng = random.Random(5)
    import numpy as np

    n, lists = 4000, 8
    held = [sorted(rng.sample(range(n), 1000)) for _ in range(lists)]
    held = [sorted({*docs, 1234}) for docs in held]
    counts = [[50 if d == 1234 else 1 for d in docs] for docs in held]
    row = {
        "doc_ids": np.arange(n), "known": n, "lengths": np.full(n, 100), "terms": np.arange(lists), "sizes": np.array([len(d) for d in held]),
        "docs": np.concatenate(held), "counts": np.concatenate(counts),
    }
    best = ranked.Best(1)
    scored = ranked.search(ranked.Shard(row, n, 100 * n), dict.fromkeys(range(lists), 1000), best)
    assert best.documents()[0][1] == 1234 and scored < 200
