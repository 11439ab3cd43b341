"""Decontamination, personal data and archives."""

import gzip
import hashlib
import re

import corpus
import pytest
from pyspark.sql import functions as F

from notesight.llm import decontaminate, pii, warc
from notesight.llm.queries import QUERIES

ITEMS = "item_id long, text string"


def scan_by_hand(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    own, hit, found = words(text), set(), set()
    for item_id, item in items:
        theirs = words(item)
        n = min(10, len(theirs))
        for i in range(len(theirs) - n + 1 if n else 0):
            for j in range(len(own) - n + 1):
                if own[j : j + n] == theirs[i : i + n]:
                    hit |= set(range(j, j + n))
                    found |= {str(item_id)} - {"None"}
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [500, 1 << 20])
def test_scan_by_hand(spark, odd, block_bytes):
    words = corpus.prose(200, 1).split()
    items = [(1, " ".join(words[20:40]).upper()), (1, "ONE"), (2, None), (3, ""), (None, " ".join(words[100:111])), (4, "not there at all"),
             (12, " ".join(words[35:60])), (12, " ".join(words[35:60]))]
    got = decontaminate.scan(odd, spark.createDataFrame(items, ITEMS), block_bytes=block_bytes).collect()
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r.hit_items) for r in got], key=key) == sorted(
        [(d, *scan_by_hand(t, items)) for d, t in corpus.odd_texts()], key=key
    )


def test_removal(spark, odd):
    words = corpus.prose(200, 1).split()
    items = spark.createDataFrame([(1, " ".join(words[20:40]))], ITEMS)
    scanned = decontaminate.scan(odd, items)
    left = decontaminate.remove_documents(scanned)
    assert {r.doc_id for r in left.collect()} == {d for d, t in corpus.odd_texts() if words[25] not in (t or "")} | {None}
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(scanned).collect() if r.doc_id}
    text = dict(corpus.odd_texts())[6]
    places = [m.span() for m in re.finditer("[a-z]+", text)]
    assert cut[6] == text[: places[20][0]] + text[places[39][1] :]
    assert decontaminate.scan(spark.createDataFrame([(6, cut[6])], "doc_id long, text string"), items).first().n_hit == 0
    assert cut[14] == dict(corpus.odd_texts())[14]
    for table, benchmark in ((odd.filter("false"), items), (odd, items.filter("false"))):
        assert decontaminate.scan(table, benchmark).filter("n_hit > 0").count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_by_hand(text):
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])]
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                    "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]:
                yield kind, *m.span()


def test_personal_data_query(spark, sf, texts):
    for r in QUERIES["op8_deobfuscate"](spark, sf).collect():
        spans = ",".join(f"{k}:{s}:{e}" for k, s, e in base_by_hand(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(spans.split(",")) <= set(r.spans.split(","))
        for kind in pii.KINDS:
            assert r[f"n_{kind}"] == sum(s.startswith(kind) for s in r.spans.split(","))


@pytest.mark.parametrize("text", [
    "a@b.c @x.y a.b@c.d.e@f.g --@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "4111 1111-1111 1111 4111111111111112 41111111111111114",
    "+1 (482) 555-7163 +123 +12345678901234567 +1--------", "x@y", "1." * 3000, "é@a.b ü+1@c.d", "a@b.c@d.e",
])
def test_base_spans_by_hand(text):
    assert [s[:3] for s in pii.find(text) if not s[3]] == list(base_by_hand(text))


@pytest.mark.parametrize("text,kind,found", [
    ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("john at mail dot example dot co dot uk!", "email", "john at mail dot example dot co dot uk"),
    ("é jane(at)example.org.", "email", "jane(at)example.org"),
    ("x&#64;example&#46;com", "email", "x&#64;example&#46;com"),
    ("jоhn＠exаmple．com x", "email", "jоhn＠exаmple．com"),
    ("jo​hn​＠example.com", "email", "jo​hn​＠example.com"),
    ("call plus one five five five one two three four five six seven now", "phone", "plus one five five five one two three four five six seven"),
    ("card four" + " one" * 15 + " end", "card", "four" + " one" * 15),
    ("at one nine two dot one six eight dot one dot one ok", "ip", "one nine two dot one six eight dot one dot one"),
    ("192[.]168[.]1[.]20 ok", "ip", "192[.]168[.]1[.]20"),
    ("１９２.168.1.20 ok", "ip", "１９２.168.1.20"),
])
def test_disguises(text, kind, found):
    spans = pii.find(text)
    assert [(k, text[s:e]) for k, s, e, disguised in spans if disguised] == [(kind, found)]


@pytest.mark.parametrize("text", [
    "we met at example.com today", "look at the dot com boom", "one two three four five six seven eight nine", "at dot at dot",
    "привет мир", "arr[at] = x (dot) y", "",
])
def test_clean_texts_have_no_spans(text):
    assert pii.find(text) == []


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 200_000, "1." * 100_000, "+1" * 100_000, "+1" + " " * 200_000, "a@" * 100_000, "[at]" * 50_000, "one " * 50_000, " at " * 50_000):
        pii.find(text)


def test_redaction(spark, odd):
    docs = spark.createDataFrame([(1, "to a@b.c and +1 (482) 555-7163", "x"), (2, None, None), (3, "", "y")], "doc_id long, text string, spans string")
    assert {r.doc_id: (r.text, r.spans) for r in pii.redact(docs).collect()} == {1: ("to [EMAIL] and [PHONE]", "x"), 2: (None, None), 3: ("", "y")}
    assert pii.redact(odd).columns == odd.columns and pii.redact(odd).count() == odd.count()
    assert pii.detect(odd).count() == odd.count() and pii.detect(odd.filter("false")).count() == 0


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(2)


ODD_PAGES = [(3, "http://a/\r\nX: y", "same", "q"), (1, None, "same", None), (2, "http://ü/ %41", "same", ""), (2, "u", "same", ""), (None, "n", "same", ""),
             (5, "e", "", ""), (6, "e", None, ""), (7, "c", "WARC/1.1\r\n\r\n" * 3, ""), (8, "l", "x" * 300_000, ""), (None, "z", "alone", "")]


@pytest.mark.parametrize("compress", ["true", "false"])
def test_archive_round_trip(spark, tmp_path, compress):
    folder = f"file://{tmp_path}/warc"
    warc.write(warc.archived(pages(spark, ODD_PAGES), "page_id", "url", "html"), folder, compress=compress, file_bytes=2000)
    rows = warc.read(spark, folder).withColumn("page_id", warc.page_of("record_id")).withColumn("first", warc.page_of("refers_to")).collect()
    firsts = {}
    for page_id, _, html, _ in ODD_PAGES:
        if page_id is not None:
            firsts[html or ""] = min(firsts.get(html or "", page_id), page_id)
    wanted = []
    for page_id, url, html, _ in ODD_PAGES:
        payload = (html or "").encode()
        first = firsts.get(html or "")
        response = first is None or page_id == first
        wanted.append((page_id, url, "response" if response else "revisit", None if response else first, len(payload), warc.payload_digest(payload), payload if response else None))
    got = [(r.page_id, r.target_uri, r.record_type, r.first, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload)) for r in rows]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    light = warc.read(spark, folder, payload="false")
    assert light.filter("payload is not null").count() == 0
    assert light.filter("record_type = 'revisit'").count() == sum(w[2] == "revisit" for w in wanted)
    assert light.filter(F.col("target_uri").isin("c", "l")).count() == 2
    assert light.filter("record_type = 'response' and payload_bytes > 1000").count() == 1
    plan = light.filter("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan  # evaluated by the source
    if compress == "true":  # other tools read it too
        every = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").glob("*.warc.gz"))
        assert every.count(b"WARC-Type: ") == len(ODD_PAGES)


def test_foreign_members_and_least_bytes(spark, tmp_path):
    rows = warc.archived(pages(spark, ODD_PAGES), "page_id", "url", "html", least=5).collect()
    assert all(r.record_type == "response" for r in rows if r.payload_bytes < 5)
    (tmp_path / "w").mkdir()
    data = b"".join(gzip.compress(warc.record(r.asDict())) for r in rows)  # no lengths in the members
    (tmp_path / "w" / "x.warc.gz").write_bytes(data)
    assert warc.read(spark, f"file://{tmp_path}/w", payload="false").filter("target_uri = 'l'").first().payload_bytes == 300_000
    assert warc.read(spark, f"file://{tmp_path}/w").count() == len(rows)
    (tmp_path / "w" / "x.warc.gz").write_bytes(data[:-20])
    with pytest.raises(Exception, match="cut off|end of its headers|gzip"):
        warc.read(spark, f"file://{tmp_path}/w").count()


def test_no_pages(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    warc.write(warc.archived(pages(spark, ODD_PAGES).filter("false"), "page_id", "url", "html"), folder)
    assert warc.read(spark, folder).count() == 0


@pytest.mark.parametrize("cuts", [[0, 5], [0, 2, 5], [0, 1, 2, 3, 4, 5]])
def test_every_record_of_a_member_is_read(spark, tmp_path, cuts):
    rows = [dict(record_id=f"urn:page:{i}", record_type="response", target_uri="u", refers_to=None, payload_digest=None, payload_bytes=None,
                 payload=b"x" * (i * 40_000)) for i in range(5)]
    made = [warc.record(r) for r in rows]
    members = [gzip.compress(b"".join(made[a:b]) + b"\r\n" * (a == 0)) for a, b in zip(cuts, cuts[1:])]
    (tmp_path / "one.warc.gz").write_bytes(b"".join(members))
    got = {r.record_id: (r.payload_bytes, bytes(r.payload)) for r in warc.read(spark, str(tmp_path)).collect()}
    assert got == {r["record_id"]: (len(r["payload"]), r["payload"]) for r in rows}
    light = warc.read(spark, str(tmp_path), payload=False).select("record_id", "payload_bytes").collect()
    assert {r.record_id: r.payload_bytes for r in light} == {k: v[0] for k, v in got.items()}


@pytest.mark.parametrize("text, spans", [
    ("write jane at mail dot ca now", [(6, 25)]), ("jane dot doe at example dot com", [(0, 31)]), ("see a dot b dot c at mail dot co dot jp", [(4, 39)]),
    ("we looked at the dot com", []), ("she is at home . then", []), ("bob at mail . com", [(0, 17)]), ("bob at mail dot c3", []),
])
def test_names_and_endings_of_bare_addresses(spark, text, spans):
    found = pii.detect(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans
    assert [(s.start, s.end) for s in found if s.kind == "email"] == spans


def test_windows_of_many_items(spark):
    shared = " ".join(f"w{i}" for i in range(12))
    items = [(i, shared + f" end{i}") for i in range(50)] + [(None, "w3"), (99, "w5")]
    docs = spark.createDataFrame([(1, "x " + shared + " " + shared), (2, "w3 w4"), (3, "y")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.hit_items) for r in decontaminate.scan(docs, spark.createDataFrame(items, ITEMS), block_bytes=700).collect()}
    assert got == {1: (24, sorted(map(str, [*range(50), 99]))), 2: (1, []), 3: (0, [])}
