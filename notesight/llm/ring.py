"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns the arcs that end at its virtual nodes. A key belongs to the arc its hash lies in; keys beyond
the capacity of that arc's shard go on clockwise to the next virtual node whose shard has room. Only the number
of keys per arc (shards x virtual nodes) decides where blocks of keys go, so the walk around the ring is made
once over those counts, and every row finds its block by its rank within its arc.

With `slack` 0 the capacities are the exact even shares, so that counts differ by one at most; a larger slack
moves fewer keys when shards are added. Equal keys lie on one arc and stay together unless their shard fills up.

Null keys hash like any value. Repeated rows each take a place of their own. An empty table gives no rows.
Columns named shard or slot are replaced."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from notesight.operators.ordered import with_sum_before

OWN = ("shard", "slot")


def virtual_nodes(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions on the ring (sorted, signed 64-bit) and their shards. A shard's positions do not depend on
    the number of shards."""
    at = sorted(
        (int.from_bytes(hashlib.sha256(f"shard {s} node {v}".encode()).digest()[:8], "big", signed=True), s)
        for s in range(shards)
        for v in range(nodes)
    )
    return np.array([p for p, _ in at], np.int64), np.array([s for _, s in at])


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Even shares, the first `rows % shards` one larger; with slack, that much more for each."""
    even = [rows // shards + (s < rows % shards) for s in range(shards)]
    return even if slack == 0 else [int(np.ceil(rows * (1 + slack) / shards))] * shards


def walk(counts: np.ndarray, owners: np.ndarray, room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Blocks (arc, first rank, rank after the last, shard, slot of the first). Every shard first takes the
    keys of its own arcs, in ring order; what is left over goes on one node at a time."""
    filled = [0] * len(room)
    blocks: list[tuple[int, int, int, int, int]] = []
    waiting = [(arc, 0, int(n)) for arc, n in enumerate(counts) if n]
    steps = 0
    while waiting:
        left = []
        for arc, low, high in waiting:
            shard = int(owners[(arc + steps) % len(owners)])
            taken = min(high - low, room[shard] - filled[shard])
            if taken:
                blocks.append((arc, low, low + taken, shard, filled[shard]))
                filled[shard] += taken
            if low + taken < high:
                left.append((arc, low + taken, high))
        waiting, steps = left, steps + 1
    return blocks


def assign(df: DataFrame, key: Column, shards: int, nodes: int = 64, slack: float = 0.0, ties: Sequence[str] = ()) -> DataFrame:
    """Add `shard` and `slot` (its place there, gapless from 0). The rows are ranked along the ring by a scan over ranges, and
    written once; no rows of an arc meet in one task, and what goes to the driver and back has shards x nodes
    rows, and `shards` more, at most. Rows equal in key and `ties` are placed in any order."""
    spark = df.sparkSession
    kept = [c for c in df.columns if c not in OWN]
    positions, owners = virtual_nodes(shards, nodes)

    def arcs(batches):
        for batch in batches:
            keys = batch.column("hash").to_numpy(zero_copy_only=False)
            arc = np.searchsorted(positions, keys) % len(positions)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(arc.astype(np.int32))], [*batch.schema.names, "arc"])

    order = [f"tie_{i}" for i in range(len(ties))]
    rows = df.select(F.struct(*kept).alias("row"), F.xxhash64(key).alias("hash"), *[F.col(t).alias(o) for t, o in zip(ties, order)])
    placed = rows.mapInArrow(arcs, StructType([*rows.schema.fields, StructField("arc", IntegerType())]))
    ranked = with_sum_before(placed, ["arc"], ["hash", *order], F.lit(1), "rank")
    counts = np.zeros(len(owners), np.int64)
    for arc, n in ranked.groupBy("arc").agg(F.max("rank") + 1).collect():
        counts[arc] = n
    blocks = walk(counts, owners, capacities(int(counts.sum()), shards, slack))
    table = spark.createDataFrame(blocks, "arc int, low long, high long, shard int, base long")
    inside = (ranked["arc"] == table["arc"]) & (ranked["rank"] >= table["low"]) & (ranked["rank"] < table["high"])
    return ranked.join(F.broadcast(table), inside).select(
        *[F.col("row")[c].alias(c) for c in kept], "shard", (F.col("base") + ranked["rank"] - F.col("low")).alias("slot")
    )
