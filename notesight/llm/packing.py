"""Sequence packing by minimum bin slack.

Every task packs the documents of its input split, in pools of a bounded number of ids. A document gives whole
windows and a remainder; remainders are counted by length, and for the longest one left a subset-sum bitset over
those counts finds the multiset that fills its window closest to capacity, read back by backtracking and used
as often as the counts allow. Remainders whose window cannot be filled exactly wait for the next pool; after
the last one, the slack is filled by cutting a waiting remainder, and what is left in the end (less than a window) is
cut into sequences of powers of two, which need no padding. No row leaves its task; tasks' sequences get
gapless numbers from one count per split.

Null or empty texts are a document of the end id alone. Repeated rows are documents of their own. An empty table
gives no pieces. A text of any length gives whole windows as it is cut. Other columns are not read."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from notesight.llm.common import MOST_CHUNKS, chunks, staged

CAPACITY = 1024
#: Ids of remainders held at a time by a task.
POOL_IDS = 1 << 22

Piece = tuple[int, int, int]  # document (of the task), start, length
Placed = tuple[int, int, int, int, int]  # and sequence, offset


def closest(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths (as length -> how many) with the largest sum of at most `capacity`.

    Bit s of `reach` says that the lengths seen so far can sum to s; counts go in as powers of two, longest
    lengths first, and the states before each step lead back from the best sum to its multiset."""
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in np.flatnonzero(counts[: capacity + 1])[::-1].tolist():
        left, times = min(int(counts[length]), capacity // length), 1
        while left > 0:
            taken = min(times, left)
            more = (reach | reach << (length * taken)) & full
            if more != reach:
                steps.append((length, taken, reach))
                reach = more
            left -= taken
            times *= 2
        if reach >> capacity:
            break
    need, used = reach.bit_length() - 1, {}
    for length, taken, before in reversed(steps):
        if not before >> need & 1:
            used[length] = used.get(length, 0) + taken
            need -= length * taken
    return used


class Packer:
    """Places the pieces of one task. `full` sequences come out as they are filled."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.sequences = 0
        self.pool: list[list[Piece]] = [[] for _ in range(capacity + 1)]
        self.pooled = 0
        self.placed: list[Placed] = []

    def add(self, document: int, length: int) -> None:
        for start in range(0, length - self.capacity + 1, self.capacity):
            self._sequence([(document, start, self.capacity)])
        rest = length % self.capacity
        if rest:
            self.pool[rest].append((document, length - rest, rest))
            self.pooled += rest

    def _sequence(self, pieces: Iterable[Piece]) -> None:
        offset = 0
        for document, start, length in pieces:
            self.placed.append((document, start, length, self.sequences, offset))
            offset += length
        self.sequences += 1

    def fill(self) -> None:
        """Fill all windows that can be filled exactly; the rest stays in the pool."""
        counts = np.array([len(p) for p in self.pool])
        for anchor in range(self.capacity - 1, 0, -1):
            while counts[anchor]:
                counts[anchor] -= 1
                used = closest(counts, self.capacity - anchor)
                counts[anchor] += 1
                used[anchor] = used.get(anchor, 0) + 1
                if sum(length * n for length, n in used.items()) < self.capacity:
                    break
                times = min(int(counts[length]) // n for length, n in used.items())
                for _ in range(times):
                    self._sequence([self.pool[length].pop() for length, n in used.items() for _ in range(n)])
                for length, n in used.items():
                    counts[length] -= n * times
                self.pooled -= self.capacity * times

    def finish(self) -> None:
        """Close the task: fill the slack of the remaining windows by cuts, then powers of two."""
        self.fill()
        left = [piece for pieces in reversed(self.pool) for piece in pieces]  # longest first
        self.pool = [[] for _ in range(self.capacity + 1)]
        total = sum(length for _, _, length in left)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in range(self.capacity.bit_length(), -1, -1) if (total % self.capacity) >> b & 1]
        self.pooled = 0
        left.reverse()
        for size in sizes:
            pieces, room = [], size
            while room:
                document, start, length = left.pop()
                pieces.append((document, start, min(length, room)))
                if length > room:
                    left.append((document, start + room, length - room))
                room -= min(length, room)
            self._sequence(pieces)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, pool_ids: int = POOL_IDS, most_chunks: int = MOST_CHUNKS
) -> DataFrame:
    """doc_id, start, length, ids (binary: little-endian, 2 bytes each, 4 for a vocabulary beyond 65,536),
    ids_crc32 (of them in 4 bytes each), doc_tokens, sequence_id, offset: one row per piece. The pieces are
    staged; sequence ids are gapless from 0. A Python worker remembers the ids of `most_chunks` chunks of text."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunks(tokenizer, most_chunks)
        last = np.array([end_id], encoder.width).tobytes()
        width = np.dtype(encoder.width).itemsize
        split = TaskContext.get().partitionId()
        packer = Packer(capacity)
        held: dict[int, tuple[int | None, bytes]] = {}
        number = 0

        def ready() -> pa.RecordBatch:
            rows = []
            for document, start, length, sequence, offset in packer.placed:
                doc_id, ids = held[document]
                own = ids[start * width : (start + length) * width]
                crc = zlib.crc32(np.frombuffer(own, encoder.width).astype("<u4").tobytes())
                rows.append((doc_id, start, length, own, crc, len(ids) // width, split, sequence, offset))
            packer.placed = []
            columns = list(zip(*rows)) or [()] * 9
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        def waiting() -> dict[int, tuple[int | None, bytes]]:
            return {piece[0]: held[piece[0]] for of_length in packer.pool for piece in of_length}

        since = 0
        for batch in batches:
            texts = batch.column("text")
            for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                ids = encoder.encode(texts[row].as_py() or "") + last
                held[number] = (doc_id, ids)
                packer.add(number, len(ids) // width)
                number += 1
                since += len(ids) // width
                if since >= pool_ids:
                    packer.fill()
                    if packer.pooled > pool_ids // 2:  # lengths that do not complement each other
                        packer.finish()
                    yield ready()
                    held = waiting()
                    since = packer.pooled
        packer.finish()
        yield ready()

    names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "split", "in_split", "offset"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    schema = ("doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, split int, "
              "in_split long, offset long")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = staged(texts.mapInArrow(pieces, schema), "packed")
    before = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("split").agg((F.max("in_split") + 1).alias("n"))
    firsts = counts.select("split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return rows.join(F.broadcast(firsts), "split").select(  # one row for each input split
        "doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", (F.col("first") + F.col("in_split")).alias("sequence_id"), "offset"
    )
