"""Shared folders, staged tables, gapless numbering and the tokenizer cache of the operators."""

from __future__ import annotations

import json
import re
import sys
import tempfile
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Words of the statistics and shingle operators: runs of anything but ASCII white space.
SPACE = " \t\n\v\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
little = sys.byteorder == "little"
LOWER = {c: c + 32 for c in range(65, 91)}  # A-Z only, not Unicode case


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path under the folder the cluster names in `spark.checkpoint.dir`. Only a session of one
    machine may leave it unset; it then gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="notesight-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Whether a session deletes the shuffle files of a query when it is over, not when the JVM happens to collect it.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str, free: bool = False, onto: str | None = None) -> DataFrame:
    """`df` written to the shared folder and read back, which cuts its lineage and fixes its rows. With `free`, the files
    shuffled for it are deleted then. The folder `onto` keeps the rows it has."""
    spark = df.sparkSession
    path, before = onto or shared_folder(spark, label), spark.conf.get(FREE, "false")
    try:
        if free:
            spark.conf.set(FREE, "true")
        df.write.mode("append" if onto else "error").option("compression", "zstd").parquet(path)
    finally:
        if free:
            spark.conf.set(FREE, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch that are made Python values at a time.
BATCH_ROWS = 1000


def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(start, BATCH_ROWS)


def by_batch(
    df: DataFrame, keep: list[str], made: str, make: Callable[[dict[str, list]], dict[str, Sequence]]
) -> DataFrame:
    """Map Arrow batches of `df`: the columns `keep` pass as they are, of any type, and `make` turns the
    lists of the others into the columns `made` (DDL). No shuffle, one batch in memory, BATCH_ROWS of it as lists."""
    schema = StructType([df.schema[c] for c in keep] + StructType.fromDDL(made).fields)
    types = [to_arrow_type(schema[i].dataType) for i in range(len(keep), len(schema))]
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = make({c: batch.column(c).to_pylist() for c in batch.schema.names if c not in keep or c in inputs})
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(out[c], t) for c, t in zip(names[len(keep) :], types)]
            yield pa.RecordBatch.from_arrays(columns, names)
        pa.default_memory_pool().release_unused()  # the worker goes on to other stages

    inputs = getattr(make, "inputs", ())
    return df.mapInArrow(run, schema)


def reads(*columns: str) -> Callable:
    """Name the passed-on columns that a function for `by_batch` also reads."""

    def mark(make: Callable) -> Callable:
        make.inputs = columns
        return make

    return mark


def query_blocks(queries: DataFrame, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The rows of `queries` in blocks with at most `block_bytes` of their column `text` (plus one row), each sent to the driver
    when the one before it is done. Rows are dealt by a hash."""
    total = queries.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 16)).first()[0] or 0
    n = 1 if total <= block_bytes else -(-2 * total // block_bytes)
    dealt = queries.withColumn("dealt", F.pmod(F.xxhash64(*queries.columns), F.lit(n)))
    at = queries.columns.index(text)
    for block in range(n):
        rows, size = [], 0
        for row in dealt.filter(F.col("dealt") == block).toLocalIterator():
            rows.append(tuple(row)[:-1])
            size += len((row[at] or "").encode()) + 16
            if size >= block_bytes:
                yield rows
                rows, size = [], 0
        if rows or n == 1 and size == 0:
            yield rows


def numbered(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Stage `df` and add `rank` (from 0, gapless within `keys`) without bringing the rows of a key
    together: each input split counts its own rows, and only the counts (a row per split and key) meet.

    Ranks follow the splits of the staged table, so they hold still once it is written. `keys` must not be
    null. Columns of `df` named split, place, local_rank or ranks_before are in the way."""
    local = Window.partitionBy("split", *keys).orderBy("place")
    rows = staged(
        df.withColumn("split", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), label
    )
    counts = rows.groupBy("split", *keys).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*keys).orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("split", *keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before"))
    ranked = rows.withColumn("local_rank", F.row_number().over(local) - 1).join(offsets, ["split", *keys])
    return ranked.select(*df.columns, (F.col("local_rank") + F.col("ranks_before")).cast("long").alias("rank"))


#: Chunks a worker remembers, about 140 bytes each.
MOST_CHUNKS = 1_000_000


class Chunks(dict):
    """Token ids of text chunks, as little-endian bytes, remembered by each Python worker.

    A chunk is a run between spaces with the space before it, where a byte-level pattern always starts a
    new token, so that its ids do not depend on its surroundings. A chunk next to other white space has no
    ids of its own (None), and its text is encoded whole. The memory is bounded: once `most` chunks are
    kept, further ones are encoded anew each time. A chunk is kept when it comes again, as far as a hash tells: most never do.
    Keys leave out the space before a chunk; those of chunks without one begin with a zero character, which no other has.

    Ids are those of the library's plain call. A text with the string of an added token, and every text if the file
    splits texts by another pattern, is encoded whole by the library."""

    def __init__(self, path: str, most: int = MOST_CHUNKS):
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.added = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        self.known = _is_byte_level(json.loads(self.whole.to_str()))
        self.width = "<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = "H" if self.width == "<u2" else "I"
        self.most = most
        self.came = bytearray(1 << 22)
        self.pieces = regex.compile(PIECES)
        self.bytes = {b: chr(c) for b, c in _byte_letters()}

    def __missing__(self, key: str) -> bytes | None:
        rest, chunk = (key[1:], key[1:]) if key[:1] == "\0" else (key, " " + key)
        if not rest or rest[0].isspace() or rest[-1].isspace():
            ids = None
        elif rest.isalpha() and SIMPLE.fullmatch(rest):
            ids = self._piece(chunk)
        elif rest[-1] in ENDS and rest[:-1].isalpha() and SIMPLE.fullmatch(rest):  # a word and one mark: two pieces
            ids = self._of(chunk[:-1]) + self._of(rest[-1])
        else:
            found = self.pieces.findall(chunk)
            ids = self._piece(chunk) if len(found) == 1 else b"".join(map(self._of, found))
        self._keep(key, ids)
        return ids

    def _keep(self, key: str, ids: bytes | None) -> None:
        if len(self) < self.most:
            place = hash(key) & (len(self.came) - 1)
            if self.came[place]:
                self[key] = ids
            else:
                self.came[place] = 1

    def _of(self, piece: str) -> bytes:
        key = piece[1:] if piece[0] == " " else "\0" + piece
        ids = self.get(key)
        if ids is None:
            ids = self._piece(piece)
            if not piece.isspace():
                self._keep(key, ids)
        return ids

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():  # such letters but the space stand for themselves
            letters = piece.replace(" ", self.bytes[32])
        else:
            letters = piece.encode().decode("latin-1").translate(self.bytes)
        return self.pack([token.id for token in self.model.tokenize(letters)])

    def pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes() if little else np.array(ids, self.width).tobytes()

    def encode(self, text: str) -> bytes:
        if self.known and "\0" not in text and not any(content in text for content in self.added):
            try:
                first, *rest = text.split(" ")
                return b"".join([self["\0" + first], *map(self.__getitem__, rest)])
            except TypeError:  # a chunk without ids of its own
                pass
        return self.pack(self.whole.encode(text, add_special_tokens=False).ids)


#: Marks after a word that are a piece by themselves.
ENDS = frozenset(".,;:!?")
# The split pattern of byte-level vocabularies of this family, and the letters that stand for bytes.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _is_byte_level(file: dict) -> bool:
    """Whether a tokenizer file splits texts as `Chunks` does, and does nothing else to them."""
    splits = file["pre_tokenizer"] or {}
    plain = splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")
    return plain and file["normalizer"] is None and file["model"]["type"] == "BPE" and not file["model"].get("ignore_merges")


def _byte_letters() -> Iterator[tuple[int, int]]:
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = 256
    for byte in range(256):
        if byte in printable:
            yield byte, byte
        else:
            yield byte, others
            others += 1


_CHUNKS: dict[str, Chunks] = {}


def chunks(path: str, most: int = MOST_CHUNKS) -> Chunks:
    """The worker's encoder for the tokenizer file at `path`, which remembers at most that many chunks."""
    if path not in _CHUNKS or _CHUNKS[path].most != most:
        _CHUNKS[path] = Chunks(path, most)
    return _CHUNKS[path]


class WordChunks(Chunks):
    """Token ids of lower-cased words, as little-endian bytes, remembered by each Python worker.

    For vocabularies with word ends, whose pattern drops white space, the text between two spaces or line feeds has ids of
    its own. Words of letters below U+0300, where composing changes nothing, are cut by the file's pattern and
    given to the model; other ones, and those that may hold an added token, are encoded by the library. If
    the file prepares texts otherwise, they are encoded whole. Memory is bounded as in `Chunks`."""

    def __init__(self, path: str, most: int = 500_000):
        super().__init__(path, most)
        pattern = _word_pattern(json.loads(self.whole.to_str()))
        self.pieces = pattern and regex.compile(pattern)
        first = "".join({content[:1] for content in self.added})
        self.marked = re.compile(f"[{re.escape(first)}]") if first else re.compile("(?!)")

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            ids = self.pack([token.id for token in self.model.tokenize(chunk.lower())])
        elif SIMPLE.fullmatch(chunk) and not self.marked.search(chunk):
            found = self.pieces.findall(chunk.lower())
            # a piece is a chunk of its own, with the same ids
            ids = b"".join([self.get(piece) or self._kept(piece) for piece in found])
        else:
            ids = self.pack(self.whole.encode(chunk, add_special_tokens=False).ids)
        if len(self) < self.most:
            self[chunk] = ids
        return ids

    def _kept(self, piece: str) -> bytes:
        ids = self._piece(piece)
        if len(self) < self.most and not piece.isspace():
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.pieces is None:
            return self.pack(self.whole.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


#: Letters that composing leaves as they are and that are lower-cased one by one.
SIMPLE = re.compile("[\x00-\u02ff]*")


def _word_pattern(file: dict) -> str | None:
    """The pattern of a tokenizer file that composes, lower-cases and drops white space, as `WordChunks` does."""
    steps = (file["normalizer"] or {}).get("normalizers") or []
    splits = (file["pre_tokenizer"] or {}).get("pretokenizers") or []
    if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in splits] != ["Split", "ByteLevel"]:
        return None
    split, letters = splits
    if (steps[1]["pattern"], steps[1]["content"]) != ({"Regex": r"\s+"}, " ") or file["model"].get("ignore_merges"):
        return None
    # what the pattern matches are the pieces, and none has white space in it
    if not split["invert"] or split["behavior"] != "Removed" or letters["use_regex"] or letters["add_prefix_space"]:
        return None
    pattern = split["pattern"].get("Regex")
    return pattern if pattern and not regex.search(pattern, " \n") else None


_WORD_CHUNKS: dict[str, WordChunks] = {}


def word_chunks(path: str) -> WordChunks:
    """The worker's encoder of that kind for the tokenizer file at `path`."""
    if path not in _WORD_CHUNKS:
        _WORD_CHUNKS[path] = WordChunks(path)
    return _WORD_CHUNKS[path]
