"""Ranked lexical search: the best documents for each query text, exactly, by intervals of documents.

Documents are indexed in shards where they lie: posting lists of the terms that some query has, in order of doc_id, with
the number of occurrences. A shard is one row of a table in the shared folder; counts of all shards give the weights of the
terms. Then each shard is searched. Every posting list has its impacts in a range-maximum sparse table, which answers in two
look-ups what the highest impact between two places is, and at which document. The sum of these answers, times the weights,
bounds the score of all documents of an interval. From all documents on, the intervals with the highest bounds are taken
first, some at a time: the document with the highest single weighted impact is scored in full, and the interval is split
there. Intervals that cannot hold a better document than the worst of the best ones so far are dropped; a task
keeps its best ones from shard to shard. What each task found is ranked once more over all tasks.

Queries go to the executors in blocks of at most `block_bytes` of text, one block at a time with an index of its own.

Terms are maximal runs of digits, letters and anything beyond ASCII, with A-Z lower-cased. Null or empty texts and texts
without terms match nothing and are no documents in the counts. Equal scores go by doc_id, null last; repeated rows are
documents of their own, and repeated queries are answered each. An empty table gives no rows. Other columns are not read."""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from notesight.llm.common import query_blocks, staged

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BLOCK_BYTES = 8 << 20
#: A shard is closed beyond these, so that it fits in memory with its tables.
SHARD_POSTINGS, SHARD_DOCS = 1 << 18, 1 << 16
#: Intervals taken at a time.
WAVE = 64
#: Fixed values of the score.
WEIGHT, SCALE, TF, NORM, SATURATION = 1000, 1_000_000_000, 1000, 8, 75
DOC_BITS = np.int64(32)
DOC_MASK = np.int64((1 << 32) - 1)

SHARD = (
    "n_docs long, n_terms long, known int, doc_ids array<long>, lengths array<int>, terms array<int>, sizes array<int>, "
    "docs array<int>, counts array<int>"
)


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall(text.encode().lower()) if text else []


def index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """SHARD rows of `docs` (doc_id, text) for the terms of `vocabulary`. `docs` in a shard are numbered in order of doc_id; of
    `doc_ids` the first `known` are not null. Documents without one of the terms only count."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        ids: list[int | None] = []
        lengths: list[int] = []
        found: list[np.ndarray] = []
        n_docs = n_terms = postings = 0

        def closed() -> pa.RecordBatch:
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            owner = np.repeat(place, [len(f) for f in found]) if found else place
            every = np.concatenate(found) if found else np.zeros(0, np.int64)
            pairs, counts = np.unique(every << DOC_BITS | owner, return_counts=True)
            terms, sizes = np.unique(pairs >> DOC_BITS, return_counts=True)
            known = sum(i is not None for i in ids)
            row = [n_docs, n_terms, known, [ids[i] or 0 for i in order], [lengths[i] for i in order], terms, sizes, pairs & DOC_MASK, counts]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], schema=arrow)

        for batch in batches:
            texts = batch.column("text")
            for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                words = terms_of(texts[row].as_py())
                if not words:
                    continue
                n_docs += 1
                n_terms += len(words)
                numbers = [n for n in map(get, words) if n is not None]
                if numbers:
                    ids.append(doc_id)
                    lengths.append(len(words))
                    found.append(np.array(numbers, np.int64))
                    postings += min(len(numbers), len(sent.value))
                if postings >= SHARD_POSTINGS or len(ids) >= SHARD_DOCS:
                    yield closed()
                    ids, lengths, found, n_docs, n_terms, postings = [], [], [], 0, 0, 0
        yield closed()

    long, ints = pa.int64(), pa.list_(pa.int32())
    kinds = [long, long, pa.int32(), pa.list_(long), ints, ints, ints, ints, ints]
    arrow = pa.schema([pa.field(f.split()[0], t) for f, t in zip(SHARD.split(", "), kinds)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(shards, SHARD)


class Shard:
    """Posting lists of a shard, one after the other, with one sparse table over all of them: entry i of level j is the
    maximum of places i to i + 2^j - 1 and is only asked for within a list. A value is an impact and the complement of its
    document, so that the first of equal ones counts."""

    def __init__(self, row: dict[str, np.ndarray], total_docs: int, total_terms: int):
        self.doc_ids, self.known = row["doc_ids"], row["known"]
        self.size = len(self.doc_ids)
        norm = 100 - SATURATION + SATURATION * row["lengths"].astype(np.int64) * total_docs // max(total_terms, 1)
        docs, counts = row["docs"].astype(np.int64), row["counts"].astype(np.int64)
        impacts = SCALE * counts // (TF * counts + NORM * norm[docs])
        ends = row["sizes"].astype(np.int64).cumsum()
        self.bounds = {t: (i, b - n, b) for i, (t, n, b) in enumerate(zip(row["terms"].tolist(), row["sizes"].tolist(), ends.tolist()))}
        self.keys = np.repeat(np.arange(len(ends)), row["sizes"]) << DOC_BITS | docs
        self.impacts = impacts
        self.levels = [impacts << DOC_BITS | (DOC_MASK - docs)]
        half = 1
        while 2 * half <= int(row["sizes"].max(initial=0)):
            below = self.levels[-1]
            self.levels.append(np.maximum(below[:-half], below[half:]))
            half *= 2
        # all levels in one array, so that one look-up can ask different levels
        self.starts = np.concatenate([[0], np.cumsum([len(v) for v in self.levels])[:-1]])
        self.table = np.concatenate(self.levels)

    def maxima(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The maximum of each range of places that is not empty, 0 of others."""
        length = high - low
        some = length > 0
        level = np.frexp(np.maximum(length, 1).astype(np.float64))[1].astype(np.int64) - 1
        at = self.starts[level]
        first = np.where(some, at + low, 0)
        second = np.where(some, at + high - (np.int64(1) << level), 0)
        return np.where(some, np.maximum(self.table[first], self.table[second]), 0)

    def known_id(self, doc: int) -> int | None:
        return int(self.doc_ids[doc]) if doc < self.known else None


class Best:
    """The k best documents of a query so far, as a heap with the worst in front."""

    def __init__(self, k: int):
        self.k = k
        self.heap: list[tuple[int, float, int]] = []

    @staticmethod
    def order(doc_id: int | None) -> int:
        return -(1 << 63) if doc_id is None else -doc_id  # higher is better

    def add(self, score: int, doc_id: int | None) -> None:
        entry = (score, self.order(doc_id), doc_id is not None)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    def worst(self) -> tuple[int, int]:
        """Score and order that an interval must pass."""
        return self.heap[0][:2] if len(self.heap) == self.k else (0, 0)

    def documents(self) -> list[tuple[int, int | None]]:
        return [(score, -order if known else None) for score, order, known in self.heap]


def search(shard: Shard, query: dict[int, int], best: Best) -> int:
    """Take the documents of a shard into `best`. `query` has the weight of each term. Returns how many were scored."""
    parts = [(*shard.bounds[t], w) for t, w in query.items() if w > 0 and t in shard.bounds]
    if not parts:
        return 0
    lists, begin, end, weights = (np.array(c, np.int64) for c in zip(*parts))
    row_keys = lists << DOC_BITS
    scored = 0

    def bounded(low: np.ndarray, high: np.ndarray, from_: np.ndarray, to: np.ndarray):
        tops = shard.maxima(from_, to)
        values = (tops >> DOC_BITS) * weights
        term = values.argmax(axis=1)
        split = DOC_MASK - (tops[np.arange(len(term)), term] & DOC_MASK)
        return low, high, from_, to, values.sum(axis=1), split

    def promising(state):
        """Without the intervals that hold nothing better than the worst of the best: of equal scores the lower id wins,
        and the first document of an interval has its lowest."""
        score, order = best.worst()
        bounds, full = state[4], len(best.heap) == best.k
        keep = (bounds > score) if not full else (bounds >= score)
        if full:
            for i in np.flatnonzero(bounds == score):
                keep[i] = best.order(shard.known_id(int(state[0][i]))) > order
        return tuple(a[keep] for a in state)

    one = np.zeros(1, np.int64)
    frontier = promising(bounded(one, one + shard.size, begin[None, :], end[None, :]))
    while len(frontier[0]):
        order = np.argsort(-frontier[4], kind="stable")
        now, later = order[:WAVE], order[WAVE:]
        low, high, from_, to, _, split = (a[now] for a in frontier)
        at = np.searchsorted(shard.keys, row_keys[None, :] + split[:, None])
        at = np.clip(at, from_, to)
        inside = at < to
        has = inside & (shard.keys[np.where(inside, at, 0)] == row_keys[None, :] + split[:, None])
        scores = (np.where(has, shard.impacts[np.where(has, at, 0)], 0) * weights).sum(axis=1)
        scored += len(scores)
        for score, doc in zip(scores.tolist(), split.tolist()):
            if score > 0:
                best.add(score, shard.known_id(doc))
        children = bounded(
            np.concatenate([low, split + 1]), np.concatenate([split, high]),
            np.concatenate([from_, at + has]), np.concatenate([at, to]),
        )
        frontier = promising(tuple(np.concatenate([a[later], b]) for a, b in zip(frontier, children)))
    return scored


def top(
    docs: DataFrame, queries: DataFrame, k: int = 10, item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """`item`, rank (int from 1), doc_id and score (long) of the `k` best documents with a score above 0 of each row of `queries`.

    The index of a block and the answers to it are staged. A query's terms, not its documents, pass through the driver."""
    asked = queries.select(item, text)
    answers = [_block(docs, rows, k, asked.schema[item]) for rows in query_blocks(asked, text, block_bytes)]
    return reduce(DataFrame.unionByName, answers)


def _block(docs: DataFrame, rows: list[tuple[object, str | None]], k: int, item: StructField) -> DataFrame:
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    queries: list[dict[int, int]] = []
    for _, value in rows:
        wanted: dict[int, int] = {}
        for term in terms_of(value):
            number = vocabulary.setdefault(term, len(vocabulary))
            wanted[number] = wanted.get(number, 0) + 1
        queries.append(wanted)
    shards = staged(index(docs, vocabulary), "shards")
    n, total = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, total = n or 0, total or 0
    pair = F.explode(F.arrays_zip("terms", "sizes")).alias("pair")
    frequency = shards.select(pair).groupBy(F.col("pair.terms").alias("term")).agg(F.sum("pair.sizes").alias("df"))
    weight = {t: math.floor(WEIGHT * math.log((2 * n + 2) / (2 * df + 1))) for t, df in frequency.collect()}
    weighted = [{t: times * weight.get(t, 0) for t, times in q.items()} for q in queries]
    sent = spark.sparkContext.broadcast((weighted, [i for i, _ in rows]))
    item_type = to_arrow_type(item.dataType)

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, items = sent.value
        best = [Best(k) for _ in asked]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                shard = Shard({c: v.as_py() if c == "known" else v.values.to_numpy() for c, v in row.items()}, n, total)
                for query, documents in zip(asked, best):
                    search(shard, query, documents)
        out = [(number, items[number], d, s) for number, documents in enumerate(best) for s, d in documents.documents()]
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.int32(), item_type, pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query", item.name, "doc_id", "score"])

    schema = StructType([StructField("query", IntegerType()), item, StructField("doc_id", LongType()), StructField("score", LongType())])
    lists = shards.filter(F.size("terms") > 0).select("known", "doc_ids", "lengths", "terms", "sizes", "docs", "counts")
    first = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = lists.mapInArrow(found, schema).withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    return staged(ranked.select(item.name, "rank", "doc_id", "score"), "answers")
