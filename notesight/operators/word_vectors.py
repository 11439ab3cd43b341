"""Word vectors by skip-gram with hierarchical softmax: one pass over the texts, as Spark ML's Word2Vec makes it.

Every task begins with the same first vectors, trains on its own split in order, and a word's vector is the mean of those of the
tasks that have trained it. The driver holds how many words have each count, and the Huffman tree of the counts while it is
made (24 bytes a word, of which 10 go to the tasks); the words and their vectors stay in tables of the shared folder. A task holds the vectors
of its own words and of the tree's nodes above them, and reads the tables in small batches. A few words in a row are trained
together, against the same state."""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from notesight.config import new_path

#: The library's defaults: words on either side at most, first and least rate, words of a sentence, and where a score is left alone.
WINDOW, RATE, LEAST_RATE, SENTENCE, MOST = 5, 0.025, 0.025e-4, 1000, 6.0
#: Words after which a task lowers its rate.
UPDATE = 10_000
#: Places beside a word, and words of a sentence trained against the same state.
BESIDE, TOGETHER = np.concatenate([np.arange(-WINDOW, 0), np.arange(1, WINDOW + 1)]), 8
#: Rows of a table read at a time, and words of a text summed at a time.
ROWS, WORDS = 1 << 14, 1 << 16


def read(folder: str) -> Iterator[pa.RecordBatch]:
    """The rows of a Parquet folder, a few at a time."""
    system, root = pyarrow.fs.FileSystem.from_uri(folder)
    for path in sorted(pyarrow.dataset.dataset(root, filesystem=system, format="parquet").files):
        with system.open_input_file(path) as file:
            yield from pq.ParquetFile(file).iter_batches(ROWS, use_threads=False)


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parent and the bit of every node but the root: first the leaves, of falling `counts`, then the inner nodes as they are made."""
    n = len(counts)
    leaves, made = array("q", counts.astype(np.int64).tobytes()), array("q")
    parent, bit = array("i", bytes(4 * max(2 * n - 2, 0))), bytearray(max(2 * n - 2, 0))
    leaf, inner = n - 1, 0
    for k in range(n - 1):
        weight = 0
        for b in (0, 1):
            if leaf >= 0 and (inner == len(made) or leaves[leaf] < made[inner]):
                node, leaf = leaf, leaf - 1
                weight += leaves[node]
            else:
                node, inner = n + inner, inner + 1
                weight += made[node - n]
            parent[node], bit[node] = n + k, b
        made.append(weight)
    return np.frombuffer(parent, np.int32), np.frombuffer(bit, np.uint8)


def first_vectors(ranks: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """Vectors of even numbers within half a `dimensions`th of zero, the same in every task."""
    x = (ranks.astype(np.uint64)[:, None] * np.uint64(dimensions) + np.arange(dimensions, dtype=np.uint64)) + np.uint64(seed * 0xD1342543DE82EF95 % (1 << 64))
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (((x ^ (x >> np.uint64(31))) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / np.float32(dimensions)


class Trainer:
    """The vectors and paths of the words that a task has seen."""

    def __init__(self, vocabulary: str, parent: np.ndarray, bit: np.ndarray, dimensions: int, seed: int):
        self.vocabulary, self.parent, self.bit, self.dimensions, self.seed = vocabulary, parent, bit, dimensions, seed
        self.places: dict[str, int] = {}
        self.words = np.zeros((0, dimensions), np.float32)
        self.nodes = np.zeros((0, dimensions), np.float32)
        self.moved = np.zeros(0, bool)
        inner = (len(parent) + 2) // 2 - 1  # nodes above n leaves
        self.node_places = np.full(inner, -1, np.int32)
        # the nodes above a word, and what each should say of it
        self.starts, self.path, self.wanted = np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)

    def ids(self, terms: pa.Array) -> np.ndarray:
        """Places of words, -1 for those not in the vocabulary."""
        coded = terms.dictionary_encode()
        names = coded.dictionary.to_pylist()
        new = [name for name in names if name not in self.places]
        if new:
            wanted, ranks = pa.array(new, pa.string()), []
            for batch in read(self.vocabulary):
                found = pc.is_in(batch.column("term"), value_set=wanted)
                ranks += [batch.filter(found)]
            known = [(term, rank) for batch in ranks for term, rank in zip(batch.column("term").to_pylist(), batch.column("rank").to_pylist())]
            self._add(known)
        places = np.array([self.places.get(name, -1) for name in names], np.int32)
        return places[coded.indices.to_numpy(zero_copy_only=False)] if len(names) else np.zeros(0, np.int32)

    def _add(self, known: list[tuple[str, int]]) -> None:
        if not known:
            return
        for term, _ in known:
            self.places[term] = len(self.places)
        ranks = np.array([rank for _, rank in known], np.int64)
        self.words = np.concatenate([self.words, first_vectors(ranks, self.dimensions, self.seed)])
        self.moved = np.concatenate([self.moved, np.zeros(len(ranks), bool)])
        n, owners, above, wanted = len(self.node_places) + 1, [], [], []
        here, at = np.arange(len(ranks)), ranks
        while len(at := at[below := at < len(self.parent)]):  # the root has no parent
            here = here[below]
            owners.append(here)
            wanted.append(1 - self.bit[at].astype(np.float32))
            at = self.parent[at].astype(np.int64)
            above.append(at - n)
        if owners:
            owner, above, wanted = (np.concatenate(c) for c in (owners, above, wanted))
            order = np.argsort(owner, kind="stable")
            above, wanted = above[order], wanted[order]
            new = np.unique(above[self.node_places[above] < 0])
            self.node_places[new] = np.arange(len(self.nodes), len(self.nodes) + len(new), dtype=np.int32)
            self.nodes = np.concatenate([self.nodes, np.zeros((len(new), self.dimensions), np.float32)])
            sizes = np.bincount(owner, minlength=len(ranks))
            self.path = np.concatenate([self.path, self.node_places[above]])
            self.wanted = np.concatenate([self.wanted, wanted])
        else:
            sizes = np.zeros(len(ranks), np.int64)
        self.starts = np.concatenate([self.starts, self.starts[-1] + sizes.cumsum()])

    def sentence(self, ids: np.ndarray, reach: np.ndarray, rate: float) -> None:
        """Every word is told from the others by each word up to `reach` places beside it."""
        n = len(ids)
        places = np.arange(n)[:, None] + BESIDE
        near = (places >= 0) & (places < n) & (np.abs(BESIDE) <= reach[:, None])
        beside = ids[np.where(near, places, 0)]
        starts, sizes = self.starts[ids], self.starts[ids + 1] - self.starts[ids]
        steps = np.arange(int(sizes.max()))
        if n < 2 or not len(steps):
            return
        inside = steps < sizes[:, None]
        at = np.where(inside, starts[:, None] + steps, 0)
        paths, wanted = self.path[at], self.wanted[at][:, None, :]
        factor = (near[:, :, None] & inside[:, None, :]) * np.float32(rate)
        for i in range(0, n, TOGETHER):
            some = slice(i, i + TOGETHER)
            context, above = self.words[beside[some]], self.nodes[paths[some]]
            scores = context @ above.transpose(0, 2, 1)
            change = (wanted[some] - 1 / (1 + np.exp(-scores))) * factor[some]
            change[np.abs(scores) >= MOST] = 0
            _add(self.nodes, paths[some], change.transpose(0, 2, 1) @ context)
            _add(self.words, beside[some], change @ above)
        self.moved[beside[near]] = True


def _add(rows: np.ndarray, places: np.ndarray, more: np.ndarray) -> None:
    """Adds to rows, of which some may come several times."""
    places, more = places.ravel(), more.reshape(-1, more.shape[-1])
    order = places.argsort(kind="stable")
    places = places[order]
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    rows[places[first]] += np.add.reduceat(more[order], first)


def fit(tokens: DataFrame, dimensions: int, min_count: int, seed: int, partitions: int) -> "WordVectors":
    """The vectors of all words of the column `tokens` that occur `min_count` times."""
    spark = tokens.sparkSession
    counts = tokens.select(F.explode("tokens").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    sorted_words, vocabulary = new_path(spark, "words"), new_path(spark, "vocabulary")
    ordered = counts.repartitionByRange(F.desc("n"), F.asc("term")).sortWithinPartitions(F.desc("n"), F.asc("term"))
    ordered.withColumn("at", F.monotonically_increasing_id()).write.parquet(sorted_words)
    words = spark.read.schema("term string, n long, at long").parquet(sorted_words)
    sizes = words.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count(F.lit(1)).alias("size")).orderBy("part").collect()
    if not sizes:
        raise ValueError(f"no word occurs {min_count} times")
    before, offsets = 0, []
    for row in sizes:
        offsets.append((row["part"], before))
        before += row["size"]
    # where a task's words begin, a row a task
    begins = F.broadcast(spark.createDataFrame(offsets, "part long, before long"))
    rank = (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).cast("int").alias("rank")
    words.join(begins, F.shiftright("at", 33) == F.col("part")).select("term", rank).write.parquet(vocabulary)
    # distinct counts number at most the root of twice all words
    held = words.groupBy("n").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("n")).collect()
    parent, bit = huffman(np.repeat([row["n"] for row in held], [row["size"] for row in held]))
    total = sum(row["n"] * row["size"] for row in held) + 1

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        trainer = Trainer(vocabulary, parent, bit, dimensions, seed)
        chance = np.random.default_rng([seed % (1 << 32), task])
        done = lowered = 0
        rate = RATE
        for batch in batches:
            texts = batch.column("tokens")
            ids = trainer.ids(texts.flatten())
            ends = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False).cumsum().tolist()
            for begin, end in zip([0, *ends], ends):
                known = ids[begin:end]
                known = known[known >= 0]
                for start in range(0, len(known), SENTENCE):
                    if done - lowered > UPDATE:
                        rate, lowered = max(LEAST_RATE, RATE * (1 - partitions * done / total)), done
                    sentence = known[start : start + SENTENCE]
                    trainer.sentence(sentence, chance.integers(1, WINDOW + 1, len(sentence)), rate)
                    done += len(sentence)
        names = list(trainer.places)
        for start in range(0, len(names), ROWS):
            some, vectors = names[start : start + ROWS], trainer.words[start : start + ROWS].astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.string()), pa.array([task] * len(some), pa.int32()), pa.array(trainer.moved[start : start + ROWS]), _binary(vectors)],
                ["term", "task", "moved", "vector"],
            )

    def mean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, weight, first = None, None, 0, None  # of a word that may go on
        for batch in batches:
            terms, moved = batch.column("term").to_pylist(), batch.column("moved").to_pylist()
            vectors = _matrix(batch.column("vector"), dimensions)
            names, found = [], []
            for term, has_moved, vector in zip(terms, moved, vectors):
                if term != last:
                    if last is not None:
                        names.append(last)
                        found.append(held / weight if weight else first)
                    last, held, weight, first = term, np.zeros(dimensions), 0, vector
                if has_moved:
                    held += vector
                    weight += 1
            first = first if first is None else first.copy()
            yield rows(names, found)
        if last is not None:
            yield rows([last], [held / weight if weight else first])

    def rows(names: list[str], found: list[np.ndarray]) -> pa.RecordBatch:
        vectors = np.array(found, "<f4").reshape(len(names), dimensions)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), _binary(vectors)], ["term", "vector"])

    trained = tokens.select("tokens").mapInArrow(train, "term string, task int, moved boolean, vector binary")
    means = trained.repartition("term").sortWithinPartitions("term", "task").mapInArrow(mean, "term string, vector binary")
    folder = new_path(spark, "word_vectors")
    means.write.parquet(folder)
    return WordVectors(folder, dimensions)


def _binary(vectors: np.ndarray) -> pa.Array:
    n, size = len(vectors), vectors.shape[1] * 4
    offsets = np.arange(0, (n + 1) * size, size, dtype=np.int32)[: n + 1]
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(vectors))])


def _matrix(vectors: pa.Array, dimensions: int) -> np.ndarray:
    joined = b"".join(vectors.to_pylist())
    return np.frombuffer(joined, "<f4").reshape(len(vectors), dimensions)


@dataclass
class WordVectors:
    """The folder of a table (term, vector)."""

    folder: str
    dimensions: int

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows with `features` in place of `tokens`, the mean of their words' vectors (nothing for words that have none), and
        the number `n_tokens` of words."""
        folder, dimensions = self.folder, self.dimensions
        keep = [name for name in df.columns if name != "tokens"]
        schema = StructType([df.schema[name] for name in keep]).add("n_tokens", IntegerType()).add("sums", ArrayType(DoubleType()))
        types = [to_arrow_type(field.dataType) for field in schema]

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("tokens")
                coded = texts.flatten().dictionary_encode()
                vectors, places = known(coded.dictionary)
                ids = places[coded.indices.to_numpy(zero_copy_only=False)] if len(places) else np.zeros(0, np.int64)
                sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
                ends = sizes.cumsum().tolist()
                means = np.zeros((batch.num_rows, dimensions))
                for row, (begin, end) in enumerate(zip([0, *ends], ends)):
                    for start in range(begin, end, WORDS):
                        found, n = np.unique(ids[start : min(end, start + WORDS)], return_counts=True)
                        n = n[found >= 0]
                        means[row] += n @ vectors[found[found >= 0]].astype(np.float64)
                    if end > begin:
                        means[row] /= end - begin
                flat = pa.array(means.ravel())
                offsets = pa.array(np.arange(0, means.size + 1, dimensions, dtype=np.int32)[: batch.num_rows + 1])
                columns = [batch.column(name) for name in keep] + [pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(offsets, flat)]
                yield pa.RecordBatch.from_arrays([c.cast(t) if c.type != t else c for c, t in zip(columns, types)], schema.names)

        def known(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            """The vectors of those words that have one, and the place there of each word, -1 for others."""
            places, vectors = np.full(len(terms), -1, np.int64), [np.zeros((0, dimensions), np.float32)]
            n = 0
            for batch in read(folder) if len(terms) else ():
                at = pc.index_in(batch.column("term"), value_set=terms)
                some = batch.filter(at.is_valid())
                places[at.drop_null().to_numpy(zero_copy_only=False)] = np.arange(n, n + some.num_rows)
                vectors.append(_matrix(some.column("vector"), dimensions))
                n += some.num_rows
            return np.concatenate(vectors), places

        return df.mapInArrow(run, schema).withColumn("features", array_to_vector("sums")).drop("sums")
