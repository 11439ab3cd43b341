"""Values of following rows and sums of earlier ones, in order within a key, for keys of any size.

The rows are cut into ranges by key and order, so that a key with many rows lies in many ranges. Each range is sorted and
read once, with nothing held but the state of the current key; what a range owes to its neighbours is one row, and these
rows, one a range, are followed over the table. No key is brought together, whatever its share of the rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from notesight.config import stage

#: Columns added for the way through the ranges.
RANGE, EDGE, VALUE = "range_number", "is_range_edge", "scanned_value"
AMOUNT, FLAG = "scanned_amount", "scanned_flag"


def _key_starts(batch: pa.RecordBatch, keys: Sequence[str], carried: tuple | None) -> np.ndarray:
    """Whether each row has another key than the one before it, the first one than `carried`."""
    n = batch.num_rows
    starts = np.zeros(n, bool)
    starts[0] = carried != tuple(batch.column(k)[0].as_py() for k in keys)
    for key in keys:
        here, before = batch.column(key).slice(1), batch.column(key).slice(0, n - 1)
        other = pc.fill_null(pc.not_equal(here, before), False)
        other = pc.or_(other, pc.xor(pc.is_null(here), pc.is_null(before)))
        starts[1:] |= np.asarray(other.to_numpy(zero_copy_only=False), bool)
    return starts


def _key_at(batch: pa.RecordBatch, keys: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(k)[row].as_py() for k in keys)


def _as(column: pa.Array, kind: pa.DataType) -> pa.Array:
    return column if column.type == kind else column.cast(kind)


def _edge(schema: StructType, arrow: pa.Schema, keys: Sequence[str], number: int, key: tuple, value: object) -> pa.RecordBatch:
    """One row that holds only the key, the number of the range and what it hands on."""
    known = dict(zip(keys, key)) | {RANGE: number, EDGE: True, VALUE: value}
    return pa.RecordBatch.from_arrays([pa.array([known.get(f.name)], f.type) for f in arrow], schema=arrow)


def _staged_ranges(df: DataFrame, order: list[Column], schema: StructType, run, ranges: int | None) -> DataFrame:
    """`run` over each range, in order; written once, so that both uses see the same ranges."""
    nullable = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
    cut = df.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
    return stage(cut.mapInArrow(run, nullable))


def with_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, flag: Column, name: str, ranges: int | None = None
) -> DataFrame:
    """Add `name`: the `value` of the next row of the same key, by `order`, for which `flag` holds; null if there is none.

    `ranges` is the number of ranges, by default that of a shuffle. Keys must not be null and the order should be unique."""
    rows = df.withColumn(VALUE, value).withColumn(FLAG, F.coalesce(flag, F.lit(False)))
    value_field = rows.schema[VALUE]
    schema = StructType([*df.schema.fields, StructField(RANGE, IntegerType()), StructField(EDGE, BooleanType()), value_field])
    arrow = to_arrow_schema(StructType([StructField(f.name, f.dataType, True) for f in schema.fields]))
    keys, kept = list(keys), df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in descending order: the value of the last flagged row of the key goes to the rows after it."""
        number, key, carried = TaskContext.get().partitionId(), None, None
        kind = arrow.field(VALUE).type
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = _key_starts(batch, keys, key)
            place = np.arange(n)
            began = np.maximum.accumulate(np.where(starts, place, -1))
            flagged = np.asarray(batch.column(FLAG).to_numpy(zero_copy_only=False), bool)
            last = np.maximum.accumulate(np.where(flagged, place, -1))
            before = np.concatenate([[-1], last[:-1]])
            # -1 stands for what was carried into this batch
            source = np.where(before >= np.maximum(began, 0), before, -1)
            known = (source >= 0) | (began < 0)
            values = _as(batch.column(VALUE), kind)
            pool = pa.concat_arrays([pa.array([carried], kind), values])
            taken = pool.take(pa.array(np.where(known, source + 1, 0), mask=~known))
            columns = [batch.column(c) for c in kept] + [pa.array([number] * n, pa.int32()), pa.array([False] * n), taken]
            yield pa.RecordBatch.from_arrays([_as(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
            key = _key_at(batch, keys, n - 1)
            if last[-1] >= max(began[-1], 0):
                carried = values[int(last[-1])].as_py()
            elif began[-1] >= 0:
                carried = None
        if key is not None:
            yield _edge(schema, arrow, keys, number, key, carried)

    ordered = [F.col(c).desc() for c in (*keys, *order)]
    scanned = _staged_ranges(rows, ordered, schema, run, ranges)
    # ranges are numbered downwards too: what lies after a range is in those of lower numbers
    edges = scanned.filter(EDGE).select(RANGE, *keys, VALUE)
    later = Window.partitionBy(*keys).orderBy(F.desc(RANGE)).rowsBetween(0, Window.unboundedFollowing)
    found = _handed_on(edges.withColumn("handed", F.first(VALUE, ignorenulls=True).over(later)), keys)
    out = scanned.filter(~F.col(EDGE)).join(F.broadcast(found), [RANGE, *keys], "left")
    return out.select(*kept, F.coalesce(VALUE, "handed").alias(name))


def _handed_on(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(range_number, keys, handed): what each range gets from the one before it in reading order. One row a range."""
    following = F.lead(RANGE).over(Window.orderBy(RANGE))
    return edges.withColumn("to_range", following).filter("to_range IS NOT NULL").select(
        F.col("to_range").alias(RANGE), *keys, "handed"
    )


def with_sum_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, name: str, ranges: int | None = None
) -> DataFrame:
    """Add `name` (long): the sum of `amount` over the rows of the same key that come before by `order`."""
    rows = df.withColumn(AMOUNT, F.coalesce(amount.cast("long"), F.lit(0)))
    schema = StructType([*df.schema.fields, *(StructField(n, t) for n, t in ((RANGE, IntegerType()), (EDGE, BooleanType()), (VALUE, LongType())))])
    arrow = to_arrow_schema(StructType([StructField(f.name, f.dataType, True) for f in schema.fields]))
    keys, kept = list(keys), df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, key, carried = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = _key_starts(batch, keys, key)
            amounts = batch.column(AMOUNT).to_numpy().astype(np.int64)
            before = carried + np.concatenate([[0], amounts.cumsum()])
            began = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
            sums = before[:-1] - np.where(began >= 0, before[np.maximum(began, 0)], 0)
            columns = [batch.column(c) for c in kept] + [pa.array([number] * n, pa.int32()), pa.array([False] * n), pa.array(sums)]
            yield pa.RecordBatch.from_arrays([_as(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
            key, carried = _key_at(batch, keys, n - 1), int(sums[-1] + amounts[-1])
        if key is not None:
            yield _edge(schema, arrow, keys, number, key, carried)

    ordered = [F.col(c).asc() for c in (*keys, *order)]
    scanned = _staged_ranges(rows, ordered, schema, run, ranges)
    edges = scanned.filter(EDGE).select(RANGE, *keys, VALUE)
    upto = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, 0)
    found = _handed_on(edges.withColumn("handed", F.sum(VALUE).over(upto)), keys)
    # null keys are keys like others here
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (RANGE, *keys)]
    out = scanned.filter(~F.col(EDGE)).alias("s").join(F.broadcast(found).alias("f"), same, "left")
    return out.select(*[F.col(f"s.{c}") for c in kept], (F.col(f"s.{VALUE}") + F.coalesce("f.handed", F.lit(0))).alias(name))
