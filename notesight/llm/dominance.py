"""Sequence packing into few bins: dominance reduction, then best fit.

Documents are tokenized where they are and cut into pieces only if they are longer than a sequence; pieces stay in their
rows. How many pieces there are of each length (a table of at most `capacity` rows, whatever the corpus) decides the whole
packing, so it is solved once, for all pieces together:

* Reduction. For the longest piece left, some set of pieces with it may dominate all others: whatever else an optimal
  packing puts with that piece can trade places with the set, without another bin. Such sets are fixed for good, as
  often as the counts allow: the piece alone if nothing fits; with the one that fills the bin exactly; with the largest
  that fits if no two others fit or no pair is larger than it; with the best pair if all pairs that fit are smaller in both.
  This is repeated until nothing more is fixed.
* Best fit, decreasing, for what is left: a piece goes to the fullest bin that takes it. Equal bins are
  one entry with a number of times; each length splits few entries, so that there are at most about three for each length.

Every piece then finds its bin by its rank among the pieces of its length: tasks number their own, and only counts by
task and length are added up. No rows of one length are brought together.

Null or empty texts are a document of the end id alone. Repeated rows are documents of their own. An empty table
gives no pieces. A text of any length gives whole sequences as it is cut. Other columns are not read."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from notesight.llm.common import by_batch, reads, staged, word_chunks

CAPACITY = 2048
#: Ids put into one Arrow batch of pieces, about.
BATCH_IDS = 1 << 20

Bin = tuple[int, dict[int, int]]  # how often, and how many pieces of each length


def dominating(counts: np.ndarray, length: int, capacity: int) -> dict[int, int] | None:
    """The set with a piece of `length` (of which there is one at least) that dominates all others, or None.
    `counts` are by length and are left as they are."""
    room = capacity - length
    others = counts[: room + 1].copy()
    if length <= room:
        others[length] -= 1
    fits = np.flatnonzero(others)
    if not len(fits):
        return {length: 1}
    largest = int(fits[-1])

    def with_piece(*more: int) -> dict[int, int]:
        used = {length: 1}
        for size in more:
            used[size] = used.get(size, 0) + 1
        return used

    if largest == room:
        return with_piece(largest)
    smallest = np.repeat(fits[:3], np.minimum(others[fits[:3]], 3))[:3].tolist()
    if len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return with_piece(largest)
    if len(smallest) == 3 and sum(smallest) <= room:
        return None
    # two others fit at most: the best pair
    partner = np.searchsorted(fits, np.minimum(fits, room - fits), side="right") - 1
    alone = (partner >= 0) & (fits[np.maximum(partner, 0)] == fits) & (others[fits] < 2)
    partner -= alone
    sums = np.where(partner >= 0, fits + fits[np.maximum(partner, 0)], -1)
    best = len(sums) - 1 - int(sums[::-1].argmax())
    larger, smaller = int(fits[best]), int(fits[partner[best]])
    if largest >= larger + smaller:
        return with_piece(largest)
    if largest == larger:
        above = fits[fits > smaller]
        two = np.repeat(above[:2], np.minimum(others[above[:2]], 2))[:2]
        if len(two) < 2 or int(two.sum()) > room:
            return with_piece(larger, smaller)
    return None


def fix_dominating(counts: np.ndarray, capacity: int) -> list[Bin]:
    """Bins that are fixed for good; their pieces are taken off `counts`."""
    fixed: list[Bin] = []
    while True:
        before = len(fixed)
        for length in np.flatnonzero(counts)[::-1].tolist():
            while counts[length] and (used := dominating(counts, length, capacity)) is not None:
                times = min(int(counts[size]) // n for size, n in used.items())
                for size, n in used.items():
                    counts[size] -= n * times
                fixed.append((times, used))
        if len(fixed) == before:
            return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[Bin]:
    """Bins of best fit decreasing, equal ones together."""
    open_bins: dict[int, list[Bin]] = {}
    rooms = np.zeros(capacity + 1, bool)  # rooms for which there are open bins
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            place = int(rooms[length:].argmax()) + length
            if rooms[place]:
                times, used = open_bins[place].pop()
                rooms[place] = bool(open_bins[place])
            else:
                place, times, used = capacity, -(-left // (capacity // length)), {}
            each = place // length
            full = min(times, left // each)
            parts = [(full, each)]
            left -= full * each
            if full < times and left:
                parts.append((1, left))
                left = 0
            parts.append((times - sum(n for n, _ in parts), 0))
            for n, more in parts:
                if n:
                    room = place - more * length
                    open_bins.setdefault(room, []).append((n, used | {length: more} if more else used))
                    rooms[room] = True
    return [entry for entries in open_bins.values() for entry in entries]


def fewest_bins(counts: np.ndarray, capacity: int) -> list[Bin]:
    """All pieces of `counts` (by length, up to `capacity`) in bins."""
    left = counts.astype(np.int64)
    return fix_dominating(left, capacity) + best_fit(left, capacity)


class Plan:
    """Where the piece of a length and a rank goes, as sorted arrays."""

    def __init__(self, bins: list[Bin], capacity: int):
        blocks, ranks, first = [], [0] * (capacity + 1), 0
        for times, used in bins:
            offset = 0
            for length, n in sorted(used.items(), reverse=True):
                blocks.append((length, ranks[length], n, first, offset))
                ranks[length] += times * n
                offset += length * n
            first += times
        self.sequences = first
        table = np.array(sorted(blocks), np.int64).reshape(-1, 5).T
        self.lengths, self.ranks, self.each, self.firsts, self.offsets = table
        self.keys = self.key(self.lengths, self.ranks)

    @staticmethod
    def key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return length << 48 | rank

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences and offsets."""
        block = np.searchsorted(self.keys, self.key(length, rank), side="right") - 1
        turn, within = np.divmod(rank - self.ranks[block], self.each[block])
        return self.firsts[block] + turn, self.offsets[block] + within * length


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids (binary: little-endian, 2 bytes each, 4 for a vocabulary beyond
    65,536), ids_crc32 (of them in 4 bytes each), split and place (rank among the pieces of that length and split)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_chunks(tokenizer)
        width = np.dtype(encoder.width).itemsize
        last = np.array([end_id], encoder.width).tobytes()
        split = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        rows, held = [], 0

        def ready() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 8, types)], names)

        for batch in batches:
            texts = batch.column("text")
            for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                ids = encoder.encode(texts[row].as_py() or "") + last
                n = len(ids) // width
                for piece, start in enumerate(range(0, n, capacity)):
                    own = ids[start * width : (start + capacity) * width]
                    length = len(own) // width
                    crc = zlib.crc32(np.frombuffer(own, encoder.width).astype("<u4").tobytes())
                    rows.append((doc_id, piece, start, length, own, crc, split, seen[length]))
                    seen[length] += 1
                held += n
                if held >= BATCH_IDS:
                    yield ready()
                    rows, held = [], 0
        yield ready()

    names = ["doc_id", "piece", "start", "length", "ids", "ids_crc32", "split", "place"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
    schema = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long, split int, place long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids (unless `with_ids` is false), ids_crc32, sequence_id (gapless from 0) and
    offset: one row per piece. The pieces are staged; counts by length (`capacity` rows) go to the driver, and
    the packing of those counts back."""
    rows = staged(pieces(docs, tokenizer, end_id, capacity), "pieces")
    by_split = rows.groupBy("split", "length").agg((F.max("place") + 1).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in by_split.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    plan = docs.sparkSession.sparkContext.broadcast(Plan(fewest_bins(counts, capacity), capacity))

    earlier = Window.partitionBy("length").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = by_split.select("split", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = rows.join(before, ["split", "length"]).withColumn("rank", F.col("place") + F.col("before"))
    kept = ["doc_id", "piece", "start", "length", *(["ids"] if with_ids else []), "ids_crc32"]

    @reads("length")
    def place(batch: dict[str, list]) -> dict[str, np.ndarray]:
        sequences, offsets = plan.value.place(np.array(batch["length"], np.int64), np.array(batch["rank"], np.int64))
        return {"sequence_id": sequences, "offset": offsets}

    return by_batch(ranked.select(*kept, "rank"), kept, "sequence_id long, offset long", place)
