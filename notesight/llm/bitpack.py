"""Token ids in binary files of fixed-width packed ids, written in ascending order of the documents.

A file has blocks of `BLOCK` ids, each id in the fewest bits that hold the vocabulary, then a footer with
the offset of each block, and the id, null mark and first token of each document, and a trailer that says where the footer is.
A reader unpacks any run of tokens with numpy from the blocks that hold it.

Writing range-partitions the documents by id (texts move once; ties and repeated ids may be split between
tasks), sorts within tasks, and encodes and writes there. Each file has a name of its own; the
manifest, a table that Spark commits, lists the files of the attempts that succeeded, so lost executors
and repeated tasks leave nothing that is read.

Null texts are empty and get only the end id. Null ids come first. Rows with the same id keep an order of their
own in the files. An empty table gives no files and no rows."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from notesight.llm.common import chunks, shared_folder

MAGIC = b"NSPACK01"
TRAILER = struct.Struct("<QQQIII8s")  # footer position, ids, documents, bits, ids a block, unused, magic
BLOCK = 4096
#: Ids after which a task begins another file; a file ends with a whole document.
FILE_IDS = 1 << 24
#: Widths of whole bytes, whose ids lie in a file as numpy has them.
LANES = {8: "<u1", 16: "<u2", 32: "<u4"}


def pack(ids: np.ndarray, bits: int) -> bytes:
    """`bits` bits for each id, least significant first."""
    if bits in LANES:
        return ids.astype(LANES[bits]).tobytes()
    return np.packbits(((ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1).astype(np.uint8), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in LANES:
        return np.frombuffer(data, LANES[bits], n).astype(np.uint32)
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    out = np.zeros((n, -(-bits // 8) * 8), np.uint8)
    out[:, :bits] = each
    lanes = np.packbits(out, axis=1, bitorder="little")
    wide = np.zeros((n, 4), np.uint8)
    wide[:, : lanes.shape[1]] = lanes
    return wide.view("<u4").ravel()


class FileWriter:
    """Packs documents into one file, a block at a time; only offsets stay in memory."""

    def __init__(self, out, bits: int, block: int = BLOCK):
        self.out, self.bits, self.block = out, bits, block
        self.at = self.ids = 0
        self.offsets: list[int] = []
        self.starts: list[int] = []
        self.doc_ids: list[int | None] = []
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.ids)
        self.ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 64 * self.block:
            self._write(self.held - self.held % self.block)

    def _write(self, n: int) -> None:
        every = np.concatenate(self.waiting)
        for start in range(0, n, self.block):
            packed = pack(every[start : min(start + self.block, n)], self.bits)
            self.offsets.append(self.at)
            self.out.write(packed)
            self.at += len(packed)
        self.waiting, self.held = [every[n:]], len(every) - n

    def close(self) -> None:
        if self.held:
            self._write(self.held)
        known = [d is not None for d in self.doc_ids]
        self.out.write(np.array(self.offsets + [self.at], "<u8").tobytes())
        self.out.write(np.array(self.starts + [self.ids], "<u8").tobytes())
        self.out.write(np.array([d if d is not None else 0 for d in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array(known, np.uint8).tobytes())
        self.out.write(TRAILER.pack(self.at, self.ids, len(self.doc_ids), self.bits, self.block, 0, MAGIC))
        self.out.close()


class FileReader:
    """Random access to the documents and tokens of one file."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        end, self.n_ids, self.n_docs, self.bits, self.block, _, magic = TRAILER.unpack(self._at(size - TRAILER.size, TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        blocks = -(-self.n_ids // self.block)
        footer = self._at(end, size - TRAILER.size - end)
        self.offsets = np.frombuffer(footer, "<u8", blocks + 1)
        self.starts = np.frombuffer(footer, "<u8", self.n_docs + 1, 8 * (blocks + 1))
        at = 8 * (blocks + 1 + self.n_docs + 1)
        ids = np.frombuffer(footer, "<i8", self.n_docs, at)
        known = np.frombuffer(footer, np.uint8, self.n_docs, at + 8 * self.n_docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end) of the file."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        data = self._at(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        whole = min((last + 1) * self.block, self.n_ids) - first * self.block
        if self.block * self.bits % 8 == 0:
            ids = unpack(data, self.bits, whole)
        else:  # blocks end at whole bytes
            cut = np.diff(self.offsets[first : last + 2]).astype(int)
            parts, at = [], 0
            for i, n in enumerate(cut):
                parts.append(unpack(data[at : at + n], self.bits, min(self.block, whole - i * self.block)))
                at += n
            ids = np.concatenate(parts)
        return ids[start - first * self.block : end - first * self.block]

    def documents(self, group: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first token, ids) in order, reading about `group` ids at a time."""
        at = 0
        while at < self.n_docs:
            until = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + group, side="right")) - 1)
            base = int(self.starts[at])
            ids = self.tokens(base, int(self.starts[until]))
            for d in range(at, until):
                start, end = int(self.starts[d]), int(self.starts[d + 1])
                yield self.doc_ids[d], start, ids[start - base : end - base]
            at = until


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Write every document of (doc_id, text) and return the manifest: path, part, number, n_ids, n_docs and
    `start`, the ids in all files before. `folder` must be shared; its default is under `spark.checkpoint.dir`."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "packed")
    spark.createDataFrame([], "made long").write.mode("append").parquet(f"{folder}/files")  # creates the folder
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )

    def files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(f"{folder}/files")
        encoder = chunks(tokenizer)
        bits = max(1, (max(encoder.whole.get_vocab_size() - 1, end_id)).bit_length())
        part, number = TaskContext.get().partitionId(), 0
        last = np.array([end_id], np.uint32)
        writer, path, done = None, "", []

        def finish() -> None:
            writer.close()
            done.append((path, part, number, writer.ids, len(writer.doc_ids)))

        for batch in batches:
            texts = batch.column("text")
            for row, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                if writer is None:
                    path = f"{root}/{part:06d}-{number:04d}-{uuid.uuid4().hex}.bin"
                    writer = FileWriter(system.open_output_stream(path), bits)
                ids = np.frombuffer(encoder.encode(texts[row].as_py() or ""), encoder.width).astype(np.uint32)
                writer.add(doc_id, np.concatenate([ids, last]))
                if writer.ids >= file_ids:
                    finish()
                    writer, number = None, number + 1
        if writer is not None:
            finish()
        columns = list(zip(*done)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
            ["path", "part", "number", "n_ids", "n_docs"],
        )

    listed = ordered.mapInArrow(files, "path string, part int, number int, n_ids long, n_docs long")
    listed.write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark, folder: str) -> DataFrame:
    """The files of `folder` with their places among all ids; a row per file."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    listed = spark.read.schema("path string, part int, number int, n_ids long, n_docs long").parquet(f"{folder}/manifest")
    return listed.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).withColumn("folder", F.lit(folder))


def read(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, `start` (ids of all documents before), n_tokens, ids_crc32 and, if asked for, the ids of every
    document of the files. A file is read in groups of blocks."""

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, _ = pyarrow.fs.FileSystem.from_uri(row["folder"])
                with system.open_input_file(row["path"]) as file:
                    rows: list[tuple] = []
                    held = 0
                    for doc_id, start, ids in FileReader(file).documents():
                        crc = zlib.crc32(ids.astype("<u4", copy=False))
                        rows.append((doc_id, row["start"] + start, len(ids), crc, ids))
                        held += len(ids)
                        if held >= 1 << 21:
                            yield batch_of(rows)
                            rows, held = [], 0
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        arrays = [pa.array(c, pa.int64()) for c in columns[:4]]
        if with_ids:
            arrays.append(pa.array(columns[4], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(arrays)])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    # a file a task: the manifest is small, and its rows stand for much work. Only a stated number of
    # partitions is left as it is by adaptive execution, which would else merge such small rows into one task
    return files.select("folder", "path", "start").repartition(max(1, files.count())).mapInArrow(documents, schema)
