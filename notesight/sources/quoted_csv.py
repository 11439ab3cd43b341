"""CSV files with line breaks inside fields, read by as many tasks as they have ranges.

The text source cuts a file into ranges of whole lines. Whether a range begins inside a quoted field is not known from the
range alone, so it is worked out in two steps: a first pass reads each range under both assumptions and keeps one row, the
state it ends in for each of them; the states are then followed from range to range of a file, which is a running
sum over one narrow row a range. The second pass cuts the records. One that goes on beyond its range is put together from
the pieces that each range it touches has of it. Records are parsed by Spark's own CSV functions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

RANGE = ["file", "block"]
STATES = "file long, block long, " + ", ".join(f"ends_inside_{s} boolean, has_start_{s} boolean" for s in (0, 1)) + ", crlf boolean"
PIECES = "file long, block long, owner long, whole boolean, is_first boolean, record string"


class Quoting:
    """How fields are quoted: which lines end inside a quoted field."""

    def __init__(self, quote: str = '"', escape: str = '"', sep: str = ","):
        self.quote, self.sep = quote, sep
        q, e = re.escape(quote), re.escape(escape)
        # from inside a field up to its closing quote
        body = f"(?:[^{q}]++|{q}{q})*+{q}" if escape == quote else f"(?:[^{q}{e}]++|{e}.)*+{q}"
        self.closing = re.compile(body, re.DOTALL)

    def ends_inside(self, line: str, inside: bool) -> bool:
        """A quote opens a field only at its beginning; elsewhere in an unquoted field it is a letter."""
        at = 0
        while True:
            if inside or line.startswith(self.quote, at):
                close = self.closing.match(line, at if inside else at + len(self.quote))
                if close is None:
                    return True
                at, inside = close.end(), False
            at = line.find(self.sep, at)
            if at < 0:
                return False
            at += len(self.sep)


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The batches cut where a new range begins."""
    for batch in batches:
        file, block = (batch.column(c).to_numpy() for c in RANGE)
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for low, high in zip([0, *cuts], [*cuts, len(file)]):
            if low < high:
                yield (int(file[low]), int(block[low])), batch.slice(low, high - low)


def _end_states(quoting: Quoting):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[tuple[int, int], list[bool]] = {}
        for key, part in _ranges(batches):
            # ends inside, has a record start; assuming a start outside, then inside
            values = part.column("value")
            crlf = key[1] == 0 and (values[0].as_py() or "").endswith("\r")
            state = rows.setdefault(key, [False, False, True, False, crlf])
            at = 0
            for i in pc.indices_nonzero(pc.match_substring(values, quoting.quote)).to_pylist():
                for s in (0, 2):
                    state[s + 1] |= not state[s]  # a record starts here or on a line before
                line = values[i].as_py()
                state[0], state[2] = quoting.ends_inside(line, state[0]), quoting.ends_inside(line, state[2])
                at = i + 1
            if at < len(values):
                for s in (0, 2):
                    state[s + 1] |= not state[s]
        if rows:
            made = [(*key, *state) for key, state in rows.items()]
            names = [f.split()[0] for f in STATES.split(", ")]
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*made)))))

    return run


def _follow(states: DataFrame) -> DataFrame:
    """file, block, inside (the range begins inside a field), owner (the block where the record began that
    is not over when the range begins) and crlf (lines of the file end with a carriage return, as its first one does)."""
    first, second = F.col("ends_inside_0"), F.col("ends_inside_1")
    turns = (first & ~second).cast("int")  # else the range keeps the state, or ends in the same one from both
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    turned = F.sum(turns)
    # a state that is known, turned back by the turns up to there
    known = F.when(first == second, (first.cast("int") + F.col("turned_upto")) % 2)
    followed = (
        states.withColumn("turned_upto", turned.over(upto))
        .withColumn("known", known)
        .withColumn("start", F.coalesce(F.last("known", ignorenulls=True).over(before), F.lit(0)))
        .withColumn("inside", (F.col("start") + F.coalesce(turned.over(before), F.lit(0))) % 2 == 1)
    )
    has_start = F.when(F.col("inside"), F.col("has_start_1")).otherwise(F.col("has_start_0"))
    owner = F.last(F.when(has_start, F.col("block")), ignorenulls=True).over(before)
    crlf = F.max("crlf").over(Window.partitionBy("file"))
    return followed.select(*RANGE, "inside", F.coalesce(owner, F.lit(-1)).cast("long").alias("owner"), crlf.alias("crlf"))


def _cut(quoting: Quoting):
    """PIECES: whole records, and for those that cross into another range their pieces with the block they began in."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PIECES.split(", ")]
        key, inside, owner, whole, first, lines = None, False, -1, True, False, []
        rows: list[tuple] = []

        def close(is_whole: bool) -> None:
            rows.append((*key, owner, is_whole, first, "\n".join(lines)))
            lines.clear()

        for here, part in _ranges(batches):
            if here != key:
                if lines:
                    close(whole and not inside)
                key, inside = here, bool(part.column("inside")[0].as_py())
                first = key[1] == 0
                # what a range begins with inside a field belongs to the record of an earlier one
                owner, whole = (int(part.column("owner")[0].as_py()), False) if inside else (key[1], True)
            quoted = set(pc.indices_nonzero(pc.match_substring(part.column("value"), quoting.quote)).to_pylist())
            for i, line in enumerate(part.column("value").to_pylist()):
                lines.append(line)
                if i in quoted:
                    inside = quoting.ends_inside(line, inside)
                if not inside:
                    close(whole)
                    owner, whole, first = key[1], True, False
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))
                rows = []
        if lines:
            close(whole and not inside)
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))

    return run


def csv_records(spark: SparkSession, path: str, quoting: Quoting) -> DataFrame:
    """(record, is_first): the text of every record, however many lines it has, and whether it is the first of its file."""
    block = F.col("_metadata.file_block_start")
    # one text per line feed; a carriage return before it goes with it if the file's first line has one
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), block.alias("block"), "value"
    )
    # a row for each range: as many as the text has input splits
    starts = _follow(lines.mapInArrow(_end_states(quoting), STATES))
    value = F.when(F.col("crlf"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")).alias("value")
    pieces = lines.join(F.broadcast(starts), RANGE).select(*RANGE, "inside", "owner", value).mapInArrow(_cut(quoting), PIECES)
    whole = pieces.filter("whole").select("record", "is_first")
    parts = F.array_sort(F.collect_list(F.struct("block", "record", "is_first")))
    crossing = (
        pieces.filter("NOT whole").groupBy("file", "owner").agg(parts.alias("parts"))
        .select(F.array_join("parts.record", "\n").alias("record"), F.col("parts")[0]["is_first"].alias("is_first"))
    )
    return whole.unionByName(crossing)


def read_quoted_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True,
    quote: str = '"', escape: str = '"', sep: str = ",", **options: str,
) -> DataFrame:
    """The rows of CSV files with quoted line breaks; without a schema all columns are strings named by the first record.

    Lines end with a line feed, in files whose first line has one with a carriage return before it; fields have line feeds only
    then. Each file has its own header. Blank lines are no records. Further options are those of Spark's CSV parser."""
    settings = {"quote": quote, "escape": escape, "sep": sep, "multiLine": "true", **options}
    if schema is None:
        named = spark.read.options(**settings).option("header", header).csv(path)
        # a line break within the header can leave the carriage return of its end with the last name
        schema = StructType([StructField(name.removesuffix("\r"), StringType()) for name in named.columns])
    if isinstance(schema, StructType):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    records = csv_records(spark, path, Quoting(quote, escape, sep))
    text = F.regexp_replace("record", "\r$", "")
    rows = records.filter(text != "")
    if header:
        rows = rows.filter(~F.col("is_first"))
    parsed: Column = F.from_csv(text, schema, settings)
    return rows.select(parsed.alias("row")).select("row.*")
