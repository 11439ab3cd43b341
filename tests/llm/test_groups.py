"""Near-duplicates, shared passages, shards and the pipeline."""

import random
import re
import tempfile
import time
from collections import defaultdict
from pathlib import Path

import corpus
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from notesight.llm import forest, passages, ring
from notesight.llm.common import sliced
from notesight.llm.components import connect
from notesight.llm.queries import QUERIES


def shingles(text, width):
    words = corpus.ASCII_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def linked(sets):
    by = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            by[x].add(d)
    pairs = {(a, b) for group in by.values() if len(group) > 1 for a in group for b in group if a < b}
    return [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]


def test_near_duplicates_query(spark, sf, texts):
    sets = {d: shingles(t, 2) for d, t in texts.items()}
    root = corpus.roots(linked(sets), texts)
    rows = QUERIES["op7_lsh_forest"](spark, sf).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows) == [(d, len(sets[d]), root[d], root[d] == d) for d in sorted(texts)]


def test_a_large_group_of_near_copies(spark):
    """Regions beyond any size that is compared in full, next to small groups and lonely documents."""
    rng, rows, base = random.Random(1), [], corpus.prose(150, 1).split()
    for i in range(1200):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(150)] = f"w{rng.random()}"
        rows.append((5000 + i, " ".join(words)))
    for i in range(60):
        text = corpus.prose(120, 100 + i // 2)
        rows.append((i, text if i % 2 else text.replace(text.split()[60], "other")))
    found = forest.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), width=2).collect()
    assert {r.doc_id: r.component_id for r in found} == {d: 5000 if d >= 5000 else d - d % 2 for d, _ in rows}


def test_few_links_in_a_large_group(spark, monkeypatch):
    """Copies most of which are just below the similarity: each true link counts, in one part or several."""
    rng, rows, base = random.Random(2), [], corpus.prose(150, 1).split()
    for i in range(1000):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(5, 7)):
            words[at] = f"w{rng.random()}"
        rows.append((i, " ".join(words)))
    sets = {d: shingles(t, 2) for d, t in rows}
    links = [(a, b) for a in sets for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = corpus.roots(links, sets)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for size in (1024, 150):
        monkeypatch.setattr(forest, "PART_NODES", size, raising=False)
        assert {r.doc_id: r.component_id for r in forest.groups(docs, width=2).collect()} == root
    assert 100 < len(set(root.values())) < 1000


def test_near_duplicates_of_odd_rows(spark, odd):
    rows = sorted(((r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in forest.groups(odd).collect()), key=repr)
    empty, alone, base = (1, 2, 3), (9, 10, 11, 12, 13, 14, 15, 16), (6, 7, 8, 8, None)
    wanted = [(d, False, d, True) for d in empty] + [(None, False, None, False), (4, True, 4, True), (5, True, 4, False)]
    wanted += [(d, True, d, True) for d in alone if d != 15] + [(15, True, 6, False)] + [(d, True, 6, d == 6) for d in base]
    assert rows == sorted(wanted, key=repr)
    left = forest.keep_one(odd, width=2)
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 2, 3, 4, 6, *[d for d in alone if d != 15]]
    assert forest.groups(odd.filter("false")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    n = 300
    links = [(i, i + 1) for i in range(n)] + [(1000, i) for i in range(1001, 1400)] + [(2000, 2000)]
    nodes = spark.createDataFrame([(f"{i:05d}".encode(), None if i == 7 else i) for i in [*range(n + 1), *range(1000, 1400), 2000]], "node binary, rank long")
    pairs = spark.createDataFrame([(f"{a:05d}".encode(), f"{b:05d}".encode()) for a, b in links], "a binary, b binary")
    roots = {int(bytes(r.node)): r.root_rank for r in connect(pairs, nodes).collect()}
    assert all(root == (0 if i <= n else 1000 if i < 2000 else 2000) for i, root in roots.items())


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def test_shared_passages_query(spark, sf, texts):
    words = {d: words_of(t) for d, t in texts.items()}
    holders = defaultdict(set)
    for d, w in words.items():
        for i in range(len(w) - 49):
            holders[tuple(w[i : i + 50])].add(d)
    exact = {d for group in holders.values() if len(group) > 1 for d in group}
    rows = QUERIES["op3_collinear_chains"](spark, sf).collect()
    assert exact <= {r.doc_id for r in rows}
    for r in rows:
        assert r.doc_id != r.partner_id and r.n_words >= 50 and 5 * r.equal_words >= 4 * (max(r.n_words, r.partner_n_words) - 1)
        if r.equal_words == r.n_words == r.partner_n_words:
            assert words[r.doc_id][r.first_word :][: r.n_words] == words[r.partner_id][r.partner_first_word :][: r.n_words]
    assert {(r.doc_id, r.partner_id) for r in rows} == {(r.partner_id, r.doc_id) for r in rows}


def test_planted_passages(spark):
    """Fuzzy passages are found in every holder, whatever the partitions; short ones and clean documents are not."""
    rng = random.Random(3)
    passage, short = corpus.prose(70, 1).replace(".", "").split(), corpus.prose(30, 2).replace(".", "").split()
    rows, holders = [], set()
    for d in range(300):
        words = corpus.prose(100, 1000 + d).replace(".", "").split()
        own = list(passage)
        for at in rng.sample(range(5, 65), 3):
            own[at : at + 1] = rng.choice([[], [f"x{d}"], [own[at], f"y{d}"]])
        if d % 3 == 0:
            words[50:50] = own
            holders.add(d)
        elif d % 3 == 1:
            words[20:20] = short
        rows.append((d, " ".join(words)))
    for parts in (1, 7):
        found = passages.shared(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        assert {r.doc_id for r in found} == holders
        root = corpus.roots([(r.doc_id, r.partner_id) for r in found], holders)
        assert set(root.values()) == {0}
        assert all(45 <= r.first_word and r.first_word + r.n_words <= 135 and r.n_words >= 50 for r in found)


def test_a_chain_within_another_partners(spark):
    """A short exact match with the first document does not hide the longer fuzzy passage around it."""
    words = lambda n, seed: corpus.prose(n, 15 + seed).replace(".", "").split()  # noqa: E731  (the outer words give no common seed)
    middle, outer, own = words(30, 0), words(32, 1), [words(60, 10 + i) for i in range(3)]
    changed = [f"c{i}" if i in (7, 15, 16, 24) else w for i, w in enumerate(outer)]
    parts = [middle, outer[:16] + middle + outer[16:], changed[:16] + middle + changed[16:]]
    rows = [(i, " ".join(own[i][:30] + parts[i] + own[i][30:])) for i in range(3)]
    found = passages.shared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.partner_id) for r in found} == {(1, 2), (2, 1)} and all(r.n_words > 50 for r in found)


def test_links_of_passages_made_of_frequent_fragments(spark, monkeypatch):
    """Fragments that others hold too, few or many, do not take the link of two documents that share them side by side."""
    words = lambda n, seed: corpus.prose(n, 400 + seed).replace(".", "").split()
    for others in (2, 40):
        monkeypatch.setattr(passages, "COMMON", 64 if others == 2 else 8)
        parts = [words(30, 0), words(30, 1)]
        near = [parts[0][:22] + ["x"] + parts[0][23:], parts[1][:9] + ["y"] + parts[1][10:]]
        holders = [parts[i % 2] for i in range(others)] + [parts[0] + parts[1]] + [parts[i % 2] for i in range(others)]
        holders += [parts[0] + parts[1], near[0] + near[1]]
        own = [words(50, 10 + i) for i in range(len(holders))]
        rows = [(i, " ".join(own[i][:25] + p + own[i][25:])) for i, p in enumerate(holders)]
        whole = {others, 2 * others + 1, 2 * others + 2}
        for tasks in (1, 5):
            found = passages.shared(spark.createDataFrame(rows, "doc_id long, text string").repartition(tasks)).collect()
            assert {(r.doc_id, r.partner_id) for r in found} == {(a, b) for a in whole for b in whole if a != b}


def test_links_of_many_versions(spark):
    """Each two of 30 versions of a text that are alike in a passage are linked, not only with the first and the one before."""
    words = corpus.prose(90, 77).replace(".", "").split()
    changed = [{(7 * i + 13 * j) % 90 for j in range(3)} for i in range(30)]
    rows = [(i, " ".join(f"v{i}" if at in changed[i] else w for at, w in enumerate(words))) for i in range(30)]
    found = passages.shared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.partner_id) for r in found} == {(a, b) for a in range(30) for b in range(30) if a != b}


def test_links_of_versions_that_are_many(spark, monkeypatch):
    """Each two versions are linked if more have their pairs of seeds than are matched at once, in blocks, a part of the matches and
    a round at a time."""
    words = corpus.prose(90, 77).replace(".", "").split()
    changed = [{(7 * i + 13 * j) % 90 for j in range(3)} for i in range(24)]
    rows = [(i, " ".join(f"v{i}" if at in changed[i] else w for at, w in enumerate(words))) for i in range(24)]
    docs, every = spark.createDataFrame(rows, "doc_id long, text string"), {(a, b) for a in range(24) for b in range(24) if a != b}
    plain = {tuple(r) for r in passages.shared(docs).collect()}
    monkeypatch.setattr(passages, "COMMON", 4)
    for block, matches, least in ((256, 1 << 19, 1 << 24), (5, 20, 1500)):
        for name, value in (("BLOCK", block), ("MATCHES", matches), ("ROUND", least)):
            monkeypatch.setattr(passages, name, value, raising=False)
        found = passages.shared(docs).collect()
        assert {(r.doc_id, r.partner_id) for r in found} == every and {tuple(r) for r in found} == plain


def test_every_two_documents_at_a_key(spark, monkeypatch):
    """All places of two documents with few, and a match at least for each place where they have many; whatever the blocks and rounds."""
    rng = random.Random(5)
    rows = sorted({(k, d, 10 * rng.randrange(1, 40), 0) for k in range(2) for d in range(30) for _ in range(1 + (d % 5) * (d % 3))})
    rows = [(k, d, p, p + 4) for k, d, p, _ in rows]
    keys, found = spark.createDataFrame(rows, "key long, doc long, place int, last int"), []
    for block, matches, rounds in ((256, 1 << 19, 1), (4, 30, 3)):
        monkeypatch.setattr(passages, "BLOCK", block)
        monkeypatch.setattr(passages, "MATCHES", matches)
        held = passages.by_key(keys)
        found.append(sorted(tuple(r) for number in range(rounds) for r in passages.every(held, number, rounds).collect()))
    assert found[0] == found[1]
    places, made = {}, {}
    for k, d, p, _ in rows:
        places.setdefault((k, d), set()).add(p)
    for d, p, p2, other, q, q2 in found[0]:
        assert d > other and (p2, q2) == (p + 4, q + 4)
        made.setdefault((d, other), set()).add((p, q))
    assert set(made) == {(a, b) for a in range(30) for b in range(a)}
    for (a, b), got in made.items():
        of = [(places[k, a], places[k, b]) for k in range(2)]
        few = [len(x) * len(y) <= passages.PLACES for x, y in of]
        assert got <= {(p, q) for x, y in of for p in x for q in y} and all((p, q) in got for (x, y), f in zip(of, few) if f for p in x for q in y)
        assert all({p for p, _ in got} >= x and {q for _, q in got} >= y for x, y in of)


def test_matches_against_all_pairs(spark, monkeypatch):
    """Whatever the tasks: all pairs at rare keys, the first and the previous document at others."""
    monkeypatch.setattr(passages, "COMMON", 5)
    rng = random.Random(2)
    rows = [(10 * k, d, p, p + 5) for k, n in enumerate([1, 2, 3, 5, 6, 300, 20, 1, 4]) for d, p in ((rng.randrange(90), rng.randrange(500)) for _ in range(n))]
    pairs, occurrences = set(), set()
    for key in {r[0] for r in rows}:
        run = sorted({r[1:] for r in rows if r[0] == key})
        for b in run:
            before = [a for a in run if a[0] < b[0]]
            pairs |= {(*b, *a) for a in (before if len(run) <= 5 else before[:1] + before[-1:])}
        if run[0][0] != run[-1][0]:
            occurrences |= {(key, *a, len(run) > 5) for a in run}
    keys = spark.createDataFrame(rows + rows[::7], "key long, doc long, place int, last int")
    for tasks in (1, 9):
        monkeypatch.setattr(type(keys), "repartitionByRange", lambda df, *by, n=tasks, plain=type(keys).repartitionByRange: plain(df, n, *by))
        found, held = passages.matched(keys, "matches")
        assert {tuple(r) for r in found.collect()} == pairs and occurrences <= {tuple(r) for r in held.collect()}
        monkeypatch.undo()
        monkeypatch.setattr(passages, "COMMON", 5)


def test_copies_are_one_document(spark):
    """Copies are linked to the first one, which has the links to other texts; ids with several texts lose no link."""
    words = corpus.prose(120, 91).replace(".", "").split()
    text, other = " ".join(words), " ".join(words[:70])
    rows = [(5, text), (3, text), (4, text), (4, text), (3, other)]
    found = passages.shared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.partner_id, r.n_words) for r in found if r.doc_id > r.partner_id} == {(4, 3, 120), (5, 3, 120), (5, 3, 70)}


def test_shuffled_files_are_deleted_after_each_step(spark):
    """What a step of the search for passages has shuffled does not stay on the disk for the next ones."""
    local = Path(spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir()))
    shuffled = lambda: {f for f in local.glob("blockmgr-*/*/shuffle_*.data")}
    words = corpus.prose(300, 61).replace(".", "").split()
    rows = [(i, " ".join(words[5 * i : 5 * i + 100])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = shuffled()
    found = passages.shared(docs)
    for _ in range(50):
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and found.count() > 0


def test_chains_whatever_the_batches(spark):
    """A document whose matches come in several batches has the chains of all of them."""
    rng = random.Random(8)
    rows = [(d, 20 * i, 20 * i, 90 + o, 20 * i + o, 20 * i + o, False) for d in range(4) for o in range(2) for i in range(9)]
    rows += [(d, 500 + 3 * i, 500 + 3 * i + 7, 91, 600 + 3 * i, 600 + 3 * i + 7, False) for d in (1, 3) for i in range(6)]
    rng.shuffle(rows)
    pairs = spark.createDataFrame(rows, "doc long, place int, last int, other long, other_place int, other_last int, exact boolean")
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, found = spark.conf.get(batch), []
    for size in (10000, 5):
        spark.conf.set(batch, size)
        found.append(sorted(tuple(map(str, r)) for r in passages.chained(pairs).collect()))
    spark.conf.set(batch, before)
    assert found[0] == found[1] and len(found[0]) == 10 and sum("500, 600, 27" in r[2] for r in found[0]) == 2


def test_a_segment_cut_short_in_its_chain():
    """A run of equal words of which a chain takes the beginning to another diagonal is a chain of its own, too."""
    places = [(10 + 5 * i, 200 + 5 * i) for i in range(4)] + [(20 + 5 * i, 212 + 5 * i) for i in range(11)]
    at = np.array([p << 32 | q for p, q in places])
    n = len(places)
    found = passages.chains_in([np.full(n, 9), np.full(n, 3), at, at, np.zeros(n, bool)])
    anchors = found.column("anchors").to_pylist()
    assert [10, 200, 20, 20, 212, 55] in anchors and [20, 212, 55] in anchors


def test_words_of_passages():
    pattern = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for text in ["", " a", "A-b\x85C\xa0d 9Z@[`{", "É İstanbul ß.ß\u2003x", *corpus.odd_texts()]:
        text = text if isinstance(text, str) else text[1] or ""
        words = pattern.findall(text.encode().lower())
        assert passages.words_of(text).tolist() == [passages.xxhash.xxh3_64_intdigest(w) for w in words]


def test_seeds_of_texts_side_by_side():
    """Seeds are those of each text by itself: the first least one of each window of k-mers."""
    rng = np.random.default_rng(6)
    for _ in range(60):
        texts = [rng.integers(0, 9, n).astype(np.uint64) for n in rng.integers(0, 40, 5)]
        sizes = np.array([len(t) for t in texts])
        key, at = passages.seeds_of(np.concatenate(texts), sizes)
        expected = []
        for text, begin in zip(texts, sizes.cumsum() - sizes):
            own, n = {}, len(text) - passages.K + 1
            for i in range(n):  # of a k-mer by itself
                own[i] = int(passages.seeds_of(text[i : i + passages.K], np.array([passages.K]))[0][0])
            width = min(passages.WINDOW, n)
            least = {min(range(i, i + width), key=lambda j: (own[j], j)) for i in range(n - width + 1)} if n > 0 else set()
            expected += [(own[j], int(begin) + j) for j in sorted(least)]
        assert list(zip(key.tolist(), at.tolist())) == expected


def test_best_chains_by_hand():
    rng = np.random.default_rng(5)
    for _ in range(100):
        parts = np.stack([rng.choice(200, 8, replace=False), rng.choice(200, 8, replace=False), rng.integers(5, 20, 8)], 1)
        order = sorted(range(8), key=lambda i: tuple(parts[i]))
        best = {}
        for n, j in enumerate(order):
            p, q, length = map(int, parts[j])
            before = [best[i] - passages.GAP * (p + q - int(parts[i][0] + parts[i][1] + 2 * parts[i][2])) for i in order[:n] if parts[i][0] < p and parts[i][1] < q]
            best[j] = length + max([0.0, *before])
        assert passages.chains(parts)[0][0] == pytest.approx(max(best.values()))


def by_cells(d, e):
    """The costs of all cells, and back through them as `_fewest` goes."""
    cost = [[i + j for j in range(len(e) + 1)] for i in range(len(d) + 1)]
    for i in range(1, len(d) + 1):
        for j in range(1, len(e) + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (d[i - 1] != e[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    out, i, j = "", len(d), len(e)
    while i and j:
        if d[i - 1] == e[j - 1]:
            step, i, j = "=", i - 1, j - 1
        elif cost[i - 1][j - 1] == cost[i][j] - 1:
            step, i, j = "x", i - 1, j - 1
        elif cost[i - 1][j] == cost[i][j] - 1:
            step, i = "d", i - 1
        else:
            step, j = "e", j - 1
        out = step + out
    return ("d" * i + "e" * j + out).encode()


@pytest.mark.parametrize("kinds", [2, 4, 30])
def test_fewest_changes_against_all_cells(kinds):
    rnd = random.Random(kinds)
    for _ in range(200):
        d, e = ([rnd.randrange(kinds) for _ in range(rnd.choice([1, 2, 7, 40, 70]))] for _ in range(2))
        if not set(d).isdisjoint(e):
            assert passages._fewest(np.array(d, np.uint64).tobytes(), np.array(e, np.uint64).tobytes()) == by_cells(d, e)


def test_gaps_that_no_passage_crosses_are_not_aligned(monkeypatch):
    """The passages are those that all gaps aligned give, for the fewer alignments."""
    rnd, calls, fewest, given = random.Random(3), [], passages._fewest, []
    monkeypatch.setattr(passages, "_fewest", lambda d, e: calls.append(1) or fewest(d, e))
    for _ in range(300):
        sides, anchors = ([], []), []
        for _ in range(rnd.randrange(2, 5)):
            for words in sides:
                words += [rnd.randrange(rnd.choice([4, 100])) for _ in range(rnd.choice([1, 3, 30]))]
            same = [rnd.randrange(100) for _ in range(rnd.choice([6, 20, 60]))]
            anchors.append((len(sides[0]), len(sides[1]), len(same)))
            for words in sides:
                words += same
        given.append((*(np.array(words, np.uint64) for words in sides), anchors, rnd.choice([1, 5, 20, 50])))
    found = [sorted(passages.align(*row)) for row in given]
    fewer = len(calls)
    monkeypatch.setattr(passages, "_apart", lambda *_: False, raising=False)
    assert found == [sorted(passages.align(*row)) for row in given] and any(found)
    assert fewer < 0.6 * (len(calls) - fewer)


def test_passages_of_odd_rows(spark, odd):
    pairs = {(r.doc_id, r.partner_id) for r in passages.shared(odd).collect()}
    assert {d for d, _ in pairs} == {6, 7, 8, 15} and (8, 8) not in pairs
    assert passages.shared(odd.filter("false")).count() == 0


def test_shards_query(spark, sf, texts):
    import zlib

    by_shard = defaultdict(list)
    for r in QUERIES["op5_bounded_ring"](spark, sf).collect():
        raw = texts.pop(r.doc_id, "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        by_shard[r.shard].append(r.slot)
    assert sorted(by_shard) == list(range(8)) and not texts
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


@pytest.fixture
def texts(texts):
    return dict(texts)


def test_loads_are_bounded_and_few_keys_move(spark):
    keys = spark.range(4000).repartition(4).withColumn("shard", F.lit("taken"))
    placed = {n: {r.id: r.shard for r in ring.assign(keys, F.col("id"), n, slack=0.25).collect()} for n in (8, 9)}
    for n, shard_of in placed.items():
        loads = np.bincount(list(shard_of.values()), minlength=n)
        assert len(shard_of) == 4000 and loads.max() <= np.ceil(4000 * 1.25 / n)
    moved = sum(placed[8][k] != placed[9][k] for k in placed[8])
    assert moved < 0.35 * 4000  # a modulus moves 8 of 9


def test_walk_places_every_key_once():
    rng = np.random.default_rng(2)
    for _ in range(50):
        owners = rng.integers(0, 4, 20)
        owners[:4] = range(4)
        counts = rng.integers(0, 30, 20) * (rng.random(20) < 0.5)
        counts[3] += 500
        room = ring.capacities(int(counts.sum()), 4, 0)
        blocks = ring.walk(counts, owners, room)
        for arc, n in enumerate(counts):
            ranks = sorted(r for a, low, high, _, _ in blocks if a == arc for r in range(low, high))
            assert ranks == list(range(n))
        slots = defaultdict(list)
        for _, low, high, shard, base in blocks:
            slots[shard] += range(base, base + high - low)
        assert all(sorted(slots[s]) == list(range(room[s])) for s in range(4))


def test_shards_of_odd_rows(spark, odd):
    hot = odd.select("doc_id", "text", "arc", "split", "rank").union(spark.range(500).selectExpr("7L", "'hot'", "0.0D", "'s'", "1"))
    rows = ring.assign(hot, F.col("text"), 4).collect()
    assert sorted(len([r for r in rows if r.shard == s]) for s in range(4)) == sorted(ring.capacities(hot.count(), 4, 0))
    assert ring.assign(hot.filter("false"), F.col("text"), 4).count() == 0


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    now, kept = docs, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf).cache()
        assert now.schema.simpleString() == docs.schema.simpleString()
        assert 0 < now.count() <= kept
        kept = now.count()
    assert now.filter("n_chars <> length(text)").count() == 0 and now.filter("text like '%[EMAIL]%'").count() > 0
    pieces = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in now.select("doc_id").collect()}


def test_packing_after_other_stages_remembers_less(monkeypatch):
    most = []
    monkeypatch.setattr(corpus_pipeline.packing, "pack", lambda *_, most_chunks, **__: most.append(most_chunks))
    corpus_pipeline.packed(None, None, "")
    assert most[0] < corpus_pipeline.packing.MOST_CHUNKS / 2


def test_rows_are_made_values_a_slice_at_a_time():
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500))], ["n"])
    parts = list(sliced([batch, batch.slice(0, 0)]))
    assert max(p.num_rows for p in parts) <= 1000 and [n for p in parts for n in p["n"].to_pylist()] == list(range(2500))


def test_pipeline_stages_on_odd_rows(spark, odd, sf):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, sf).columns == odd.columns
        assert stage(spark, odd.filter("false"), sf).count() == 0
        stage(spark, odd, sf).count()


@pytest.mark.parametrize("slack", [0, 0.2])
def test_shards_do_not_depend_on_files(spark, slack):
    rows = [(i, str(i % 70 if i % 3 else 1), {"a": i}) for i in range(900)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank map<string,int>")
    placed = [
        sorted((r.doc_id, r.shard, r.slot, r["rank"]["a"]) for r in ring.assign(d, F.col("text"), shards=5, slack=slack, ties=["doc_id"]).collect())
        for d in (docs.repartition(7), docs.orderBy("doc_id").coalesce(1))
    ]
    assert placed[0] == placed[1]
