"""Packing and packed files against the tokenizer itself."""

import json
import zlib
from collections import defaultdict
from pathlib import Path

import corpus
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from notesight.llm import bitpack, common, dominance, packing
from notesight.llm.common import Chunks, WordChunks, chunks, word_chunks
from notesight.llm.queries import QUERIES, tokenizer


@pytest.fixture(scope="module")
def encode():
    whole = Tokenizer.from_file(tokenizer())
    return lambda text: whole.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("most", [0, 3, 1_000_000])
def test_chunks_give_the_tokenizers_ids(encode, most, monkeypatch):
    encoder = chunks(tokenizer())
    monkeypatch.setattr(encoder, "most", most)
    encoder.clear()
    odd = ["a <|endoftext|> b<|endoftext|>", "a <|endoftex b", "  a  b", "a\n b", " ", "x y z", "a 　 b", "it's we'll don't 12ab", "\0 a b", "a\x1c b", "a\x85 b", "a\n\nb  c\t d 's"]
    for text in odd + [t for _, t in corpus.odd_texts() if t]:
        assert np.frombuffer(encoder.encode(text), encoder.width).tolist() == encode(text)


def test_chunks_that_come_again_are_remembered():
    """Chunks that come once do not take the places of those that come again."""
    encoder = Chunks(tokenizer(), most=20)
    encoder.encode(" ".join(f"once{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(500)))
    encoder.encode("again " * 3 + "again")
    calls, plain = [], encoder._piece
    encoder._piece = lambda piece: calls.append(piece) or plain(piece)
    encoder.encode("not again again")
    assert " again" not in calls


def test_a_worker_remembers_as_many_chunks_as_it_is_told():
    few = chunks(tokenizer(), 5)
    few.encode("one two three four five six seven eight " * 4)
    assert 0 < len(few) <= 5 and chunks(tokenizer(), 5) is few
    assert chunks(tokenizer()).most == common.MOST_CHUNKS and not chunks(tokenizer())


@pytest.fixture(scope="module")
def encode_words():
    whole = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    return lambda text: whole.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("most", [0, 3, 1_000_000])
def test_word_chunks_give_the_tokenizers_ids(encode_words, most, monkeypatch):
    encoder = word_chunks(tokenizer("word_bpe_49k.json"))
    monkeypatch.setattr(encoder, "most", most)
    encoder.clear()
    odd = ["a <|endoftext|> b<|EndOfText|>c", "x\x1cy\x85z w\u3000q\u00a0r", "ΣΑΣ ΣΑΣ. İstanbul e\u0301 \u0301x", "'LL it'S don't 12ab34 9²½", "\t\r\n  ",
           "\U0001f600x\x00y", "ﬁ ǅ ßẞ ªº Å", "e\n\u0301 \u1100\u1161"]
    for text in odd + [t for _, t in corpus.odd_texts() if t]:
        assert np.frombuffer(encoder.encode(text), encoder.width).tolist() == encode_words(text)


@pytest.mark.parametrize("name, make", [("byte_bpe_50k.json", Chunks), ("word_bpe_49k.json", WordChunks)])
def test_files_that_split_otherwise_are_encoded_whole(tmp_path, name, make):
    file = json.loads(Path(tokenizer(name)).read_text())
    file["normalizer"], file["pre_tokenizer"] = {"type": "NFC"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(file))
    encoder, whole = make(str(path)), Tokenizer.from_file(str(path))
    for text in ("a b  c's", corpus.prose(50, 3)):
        assert np.frombuffer(encoder.encode(text), encoder.width).tolist() == whole.encode(text, add_special_tokens=False).ids


def fewest(sizes, capacity):
    """The number of bins of an optimal packing, by search."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for room in sorted(set(b for b in bins if b >= sizes[i])):
            left = list(bins)
            left.remove(room)
            place(i + 1, left + [room - sizes[i]])
        place(i + 1, bins + [capacity - sizes[i]])

    place(0, [])
    return best


def test_fixed_sets_keep_an_optimal_packing():
    rng = np.random.default_rng(7)
    fixed_some = 0
    for _ in range(400):
        capacity = int(rng.integers(4, 40))
        sizes = rng.integers(1 if rng.random() < 0.5 else max(1, capacity // 4), capacity + 1, rng.integers(1, 10)).tolist()
        counts = np.bincount(sizes, minlength=capacity + 1)
        left = counts.copy()
        fixed = dominance.fix_dominating(left, capacity)
        fixed_some += bool(fixed)
        assert all(sum(size * n for size, n in used.items()) <= capacity for _, used in fixed)
        rest = np.repeat(np.arange(capacity + 1), left).tolist()
        assert sum(times for times, _ in fixed) + fewest(rest, capacity) == fewest(sizes, capacity)
    assert fixed_some > 200


def test_best_fit_puts_each_where_one_by_one_would():
    rng = np.random.default_rng(8)
    for _ in range(300):
        capacity = int(rng.integers(3, 60))
        counts = np.bincount(rng.integers(1, capacity + 1, rng.integers(0, 80)), minlength=capacity + 1)
        bins = []
        for size in np.repeat(np.arange(capacity + 1), counts)[::-1].tolist():
            fits = [i for i, b in enumerate(bins) if capacity - sum(b) >= size]
            if fits:
                bins[min(fits, key=lambda i: capacity - sum(bins[i]))].append(size)
            else:
                bins.append([size])
        made = dominance.best_fit(counts.copy(), capacity)
        # bins of equal room may change places
        ours = sorted(sum(s * n for s, n in used.items()) for times, used in made for _ in range(times))
        assert ours == sorted(map(sum, bins))
        assert sum((times * np.bincount(np.repeat(list(used), list(used.values())), minlength=capacity + 1) for times, used in made), 0 * counts).tolist() == counts.tolist()


def check_whole_pieces(rows, documents, capacity):
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_document[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
    wanted = {
        doc_id: sorted(
            (i, at, len(ids[at : at + capacity]), crc(ids[at : at + capacity]))
            for ids in each for i, at in enumerate(range(0, len(ids), capacity))
        )
        for doc_id, each in documents.items()
    }
    assert {doc_id: sorted(pieces) for doc_id, pieces in by_document.items()} == wanted
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence)


def test_dominance_packing_query(spark, sf, texts, encode_words):
    documents = {d: [encode_words(t) + [0]] for d, t in texts.items()}
    rows = QUERIES["op12_dominance_packing"](spark, sf).collect()
    n = check_whole_pieces(rows, documents, 2048)
    assert n <= 1.01 * -(-sum(r.length for r in rows) // 2048) + 1


def test_dominance_packing_of_odd_rows(spark, odd, encode_words):
    documents = defaultdict(list)
    for doc_id, text in corpus.odd_texts():
        documents[doc_id].append(encode_words(text) + [7])
    path = tokenizer("word_bpe_49k.json")
    for capacity in (1, 5, 64, 2048):
        check_whole_pieces(dominance.pack(odd, path, end_id=7, capacity=capacity).collect(), documents, capacity)
    rows = dominance.pack(odd, path, end_id=7).collect()
    assert all(crc(np.frombuffer(r.ids, "<u2")) == r.ids_crc32 for r in rows)
    assert dominance.pack(odd.filter("false"), path, end_id=7).count() == 0


def check_pieces(rows, documents, capacity):
    """Every document's pieces make its ids once; sequences are gapless; what is padded."""
    by_sequence, by_document, padding = defaultdict(list), defaultdict(list), 0
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_document[r.doc_id].append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    for doc_id, pieces in by_document.items():
        lengths = defaultdict(int)
        for r in pieces:
            lengths[r.doc_tokens] += r.length
        wanted = documents[doc_id]
        assert sorted(lengths.items()) == sorted({len(i): sum(len(j) for j in wanted if len(j) == len(i)) for i in wanted}.items())
        for r in pieces:
            assert any(len(ids) == r.doc_tokens and crc(ids[r.start : r.start + r.length]) == r.ids_crc32 for ids in wanted)
    assert set(by_document) == set(documents)
    return padding


def test_packing_query(spark, sf, texts, encode):
    rows = QUERIES["op2_bin_slack"](spark, sf).collect()
    assert check_pieces(rows, {d: [encode(t) + [0]] for d, t in texts.items()}, 1024) == 0


def test_packing_of_odd_rows_and_small_pools(spark, odd, encode):
    documents = defaultdict(list)
    for doc_id, text in corpus.odd_texts():
        documents[doc_id].append(encode(text) + [7])
    for pool in (1, 300, 1 << 22):
        rows = packing.pack(odd, tokenizer(), end_id=7, capacity=64, pool_ids=pool).collect()
        assert check_pieces(rows, documents, 64) == 0
    assert packing.pack(odd.filter("false"), tokenizer(), end_id=7).count() == 0


def test_closest_against_all_multisets():
    rng = np.random.default_rng(1)
    for _ in range(200):
        counts = rng.integers(0, 4, 12)
        counts[0] = 0
        capacity = int(rng.integers(1, 25))
        sums = {0}
        for length, n in enumerate(counts):
            sums = {s + length * k for s in sums for k in range(n + 1)}
        used = packing.closest(counts, capacity)
        assert sum(length * n for length, n in used.items()) == max(s for s in sums if s <= capacity)
        assert all(n <= counts[length] for length, n in used.items())


def test_many_equal_lengths_that_do_not_fit_together():
    packer = packing.Packer(100)
    for document in range(999):
        packer.add(document, 70)
    packer.finish()
    sizes = defaultdict(int)
    for _, _, length, sequence, _ in packer.placed:
        sizes[sequence] += length
    assert sum(sizes.values()) == 999 * 70
    assert sum(size != 100 for size in sizes.values()) <= 7 and all(size == 100 or size & (size - 1) == 0 for size in sizes.values())


@pytest.mark.parametrize("bits", [8, 16, 32])
def test_whole_bytes_are_packed_without_bits(bits, monkeypatch):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, np.uint32)
    data = bitpack.pack(ids, bits)
    calls = []
    monkeypatch.setattr(bitpack.np, "unpackbits", lambda *a, **k: calls.append(a))
    assert (bitpack.unpack(data, bits, 1000) == ids).all() and not calls
    monkeypatch.undo()
    monkeypatch.setattr(bitpack, "LANES", {})
    assert bitpack.pack(ids, bits) == data and (bitpack.unpack(data, bits, 1000) == ids).all()


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_bits_round_trip(bits):
    rng = np.random.default_rng(bits)
    documents = [(None if i == 3 else i, rng.integers(0, 1 << bits, n, np.uint64).astype(np.uint32)) for i, n in enumerate([0, 1, 7, 5000, 9001, 0, 64])]
    sink = pa.BufferOutputStream()
    writer = bitpack.FileWriter(sink, bits, block=1000)

    for doc_id, ids in documents:
        writer.add(doc_id, ids)
    writer.close()
    reader = bitpack.FileReader(pa.BufferReader(sink.getvalue()))
    every = np.concatenate([ids for _, ids in documents])
    assert reader.n_ids == len(every) and reader.tokens(1234, 1301).tolist() == every[1234:1301].tolist()
    assert reader.tokens(5, 5).size == 0 and reader.tokens(0, len(every)).tolist() == every.tolist()
    for group in (1, 6000):
        read = list(reader.documents(group))
        assert [d for d, _, _ in read] == [d for d, _ in documents]
        assert all(a.tolist() == b.tolist() for (_, _, a), (_, b) in zip(read, documents))


def test_files_query(spark, sf, texts, encode):
    at = 0
    rows = {r.doc_id: r for r in QUERIES["op10_bit_packing"](spark, sf).collect()}
    assert sorted(rows) == sorted(texts)
    for doc_id in sorted(texts):
        ids = encode(texts[doc_id]) + [2]
        assert (rows[doc_id].start, rows[doc_id].n_tokens, rows[doc_id].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)


def test_files_of_odd_rows(spark, odd, encode):
    rows = sorted(bitpack.read(bitpack.write(odd, tokenizer(), end_id=2, file_ids=500)).collect(), key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == sorted((d is not None, d or 0) for d, _ in corpus.odd_texts())
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    assert sorted(tuple(r.ids) for r in rows) == sorted(tuple(encode(t) + [2]) for _, t in corpus.odd_texts())
    assert bitpack.read(bitpack.write(odd.filter("false"), tokenizer(), end_id=2)).count() == 0
