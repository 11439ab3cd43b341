"""The most frequent terms, exactly, without a shuffle of all distinct ones.

Each task keeps a summary of a bounded number of terms: counts that are too low by at most an error it knows (when the
summary overflows, all its counts are lowered by that of the first term beyond the bound). Summaries add up. A term that is in
none of them has at most the sum of all errors; so if that is below the k-th count found, all of the k most frequent terms
are among those whose count plus the errors reaches it. Only these are counted exactly. If the errors are too large to
tell, the bound is made four times as large and the texts are read again; at last it holds every distinct term and the
errors are nothing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from notesight.config import stage

#: Terms of a summary for each term wanted.
WIDTH = 8
LEAST_WIDTH = 4096
#: Candidates up to which they are sent to every task; more are joined.
MAX_BROADCAST = 500_000


class Summary:
    """Counts of at most `width` terms (twice that between cuts), each too low by at most `error`."""

    def __init__(self, width: int):
        self.width, self.error = width, 0
        self.counts: dict[str, int] = {}

    def add(self, terms: list[str], counts: list[int]) -> None:
        get = self.counts.get
        for term, n in zip(terms, counts):
            self.counts[term] = get(term, 0) + n
        if len(self.counts) > 2 * self.width:
            self.cut()

    def add_counted(self, terms: pa.Array, counts: np.ndarray) -> None:
        """Many distinct terms at once: those beyond the bound are cut before they become Python's."""
        if len(counts) > 2 * self.width:
            lowered = int(np.partition(counts, -self.width - 1)[-self.width - 1])
            self.error += lowered
            kept = np.flatnonzero(counts > lowered)
            terms, counts = terms.take(pa.array(kept)), counts[kept] - lowered
        self.add(terms.to_pylist(), counts.tolist())

    def cut(self) -> None:
        if len(self.counts) <= self.width:
            return
        lowered = sorted(self.counts.values(), reverse=True)[self.width]
        self.error += lowered
        self.counts = {term: n - lowered for term, n in self.counts.items() if n > lowered}


def summaries(rows: DataFrame, width: int) -> DataFrame:
    """(term, n, error): the terms of each task's summary, and a row of a null term with its error."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(width)
        for batch in batches:
            found = pc.value_counts(pc.drop_null(batch.column(0).flatten()))
            summary.add_counted(found.field("values"), found.field("counts").to_numpy())
        summary.cut()
        terms = [*summary.counts, None]
        counts = [*summary.counts.values(), 0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array(counts, pa.int64()), pa.array([0] * (len(terms) - 1) + [summary.error], pa.int64())],
            ["term", "n", "error"],
        )

    return rows.mapInArrow(run, "term string, n long, error long")


def candidates(rows: DataFrame, k: int, width: int) -> DataFrame | None:
    """(term): all that can be among the `k` most frequent, or None if the errors are too large to tell."""
    added = summaries(rows, width).groupBy("term").agg(F.sum("n").alias("low"), F.sum("error").alias("error"))
    merged = stage(added)  # at most as many rows as tasks times width
    known = merged.filter("term IS NOT NULL")
    error = merged.filter("term IS NULL").agg(F.sum("error")).first()[0] or 0
    found, last = known.orderBy(F.desc("low")).limit(k).agg(F.count(F.lit(1)), F.min("low")).first()
    reached = last if found == k else 0
    if error and error >= reached:
        return None
    wanted = known.filter(F.col("low") + error >= reached).select("term")
    return F.broadcast(wanted) if wanted.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST else wanted


def most_frequent(df: DataFrame, terms: Column, k: int, width: int | None = None) -> DataFrame:
    """(term, n): the `k` terms with the highest counts over all rows of an array column, ties by term. The texts are read
    once for the summaries and once for the counts; what is shuffled has a row for each task and term of a summary."""
    rows = df.select(terms.alias("terms"))
    width = width or max(LEAST_WIDTH, WIDTH * k)
    while (wanted := candidates(rows, k, width)) is None:
        width *= 4
    exploded = rows.select(F.explode("terms").alias("term"))
    counted = exploded.join(wanted, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.asc("term")).limit(k)
