"""Periodic runs against all lags."""

import hashlib
import random
import re
import zlib

import corpus
import numpy as np
import pytest

from notesight.llm import runs
from notesight.llm.queries import QUERIES


def by_all_lags(words):
    """(start, length, period) of every run."""
    numbers = {}
    a = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found = {}
    for q in range(1, len(a) // 2 + 1):
        equal = np.flatnonzero(a[q:] == a[:-q])
        if len(equal) < max(12, 2 * q) - q:
            continue
        cuts = np.flatnonzero(np.diff(equal) > 1)
        starts, stops = equal[np.r_[0, cuts + 1]].tolist(), (equal[np.r_[cuts, len(equal) - 1]] + 1 + q).tolist()
        for start, stop in zip(starts, stops):
            smaller = any(q % p == 0 and s <= start and stop <= e for (s, e), p in found.items())
            if stop - start >= max(12, 2 * q) and not smaller:
                found[start, stop] = q
    return sorted((s, e - s, q) for (s, e), q in found.items())


def without_repetitions(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def cases():
    rng = random.Random(3)
    yield from (list("a" * 500), fibonacci(900), [str(i.bit_count() % 2) for i in range(900)], [], ["x"], list("ab" * 200 + "a" + "ab" * 200),
                list("abc" * 100 + "ab" + "abc" * 90 + "c" + "abc" * 80), list(("ab" * 30 + "c") * 5 + ("ab" * 30 + "d") * 3))
    for _ in range(250):
        letters, n = [str(i) for i in range(rng.choice([1, 2, 2, 3, 5, 50]))], rng.randint(0, 500)
        words = [rng.choice(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 4) if n > 20 else 0):
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 2))
            for i in range(a, min(n, a + rng.randint(p, 5 * p))):
                words[i] = words[a + (i - a) % p]
        yield words
    for _ in range(40):  # repetitions of repetitions, cut and joined
        unit = "".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) * rng.randint(1, 30)
        joined = (unit[: rng.randint(1, len(unit))] * rng.randint(1, 8) + rng.choice(["", "c", "a"])) * rng.randint(1, 4)
        yield list(joined[:1200])


def test_all_runs_are_found():
    every = list(cases())
    for at in range(0, len(every), 9):
        group = every[at : at + 9]
        for words, found in zip(group, runs.group_runs(group)):
            assert [(s, e - s, q) for s, e, q in found.tolist()] == by_all_lags(words)


def test_long_texts_take_time_in_proportion():
    found = runs.group_runs([["a"] * 300_000])[0]
    assert found.tolist() == [[0, 300_000, 1]]
    words = [str(i) for i in range(50_000)] * 3 + ["end"]
    assert runs.group_runs([words])[0].tolist() == [[0, 150_000, 50_000]]


def test_query(spark, sf, texts):
    rows = {r.doc_id: r for r in QUERIES["op11_minimizer_runs"](spark, sf).collect()}
    assert sorted(rows) == sorted(texts)
    planted = 0
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        found = by_all_lags(words)
        best = min(((-length, start, period) for start, length, period in found), default=None)
        row = rows[doc_id]
        assert row.n_runs == len(found)
        assert (row.start, row.length, row.period) == ((best[1], -best[0], best[2]) if best else (None,) * 3)
        assert row.exponent_milli == (1000 * -best[0] // best[2] if best else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(without_repetitions(words, found).encode()).hexdigest()
    assert planted > 5


@pytest.mark.parametrize("group", [1, 1 << 16])
def test_odd_rows(spark, odd, group, monkeypatch):
    monkeypatch.setattr(runs, "GROUP_WORDS", group)
    repeated = spark.createDataFrame([(50, "x y " * 40), (51, None)], "doc_id long, text string")
    table = odd.unionByName(repeated, allowMissingColumns=True).withColumnRenamed("hits", "runs")
    key = lambda r: (str(r[0]), str(r[1]), *map(str, r[2:]))
    wanted = []
    for doc_id, text in [*corpus.odd_texts(), (50, "x y " * 40), (51, None)]:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found = by_all_lags(words)
        wanted.append((doc_id, len(words), found, None if text is None else without_repetitions(words, found)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept_text) for r in runs.detect(table).collect()]
    assert sorted(got, key=key) == sorted(wanted, key=key)
    assert set(runs.detect(table).columns) == set(table.columns) | {"n_words", "runs", "kept_text"}
    assert runs.detect(odd.filter("false")).count() == 0
