"""Hospital stays and their notes: labels, filters, combining notes, joining both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from notesight.operators.ordered import with_next, with_sum_before

PLANNED = "ELECTIVE"
#: Bytes of text in one row of combined notes, about: a tenth of what a string can hold.
PART_BYTES = 256 << 20


def add_next_stay(stays: DataFrame, skip_elective: bool = False, ranges: int | None = None) -> DataFrame:
    """Add `next_stay`, the (admit_time, hadm_id, admit_type) of the same subject's next stay by admission time, then
    by hadm_id. With `skip_elective` it is the next stay that is not elective.

    The stays are scanned in order over ranges of subjects and times, so that a subject may have any share of
    the rows. A stay of an unknown subject has no next stay."""
    nobody = stays.filter(F.col("subject_id").isNull())
    known = with_next(
        stays.filter(F.col("subject_id").isNotNull()),
        ["subject_id"],
        ["admit_time", "hadm_id"],
        F.struct("admit_time", "hadm_id", "admit_type"),
        F.col("admit_type") != PLANNED if skip_elective else F.lit(True),
        "next_stay",
        ranges,
    )
    return known.unionByName(nobody.withColumn("next_stay", F.lit(None).cast(known.schema["next_stay"].dataType)))


def bucket_label(days: Column, splits: Sequence[float]) -> Column:
    """0, 1, .. by how many of the splits are at or below `days`; NULL days go to the last bucket."""
    passed = sum(((days >= F.lit(float(split))).cast("double") for split in sorted(splits)), F.lit(0.0))
    return F.coalesce(passed, F.lit(float(len(splits))))


def n_day_label(
    stays: DataFrame,
    splits: Sequence[float] = (30.0,),
    skip_elective: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add readmit_time, readmit_type, readmit_days (NULL unless the next stay is unplanned) and the label
    of the day bucket. Needs subject_id, hadm_id, admit_time, discharge_time, admit_type."""
    following = F.col("next_stay")
    unplanned = following["admit_type"] != PLANNED
    return (
        add_next_stay(stays, skip_elective, ranges)
        .withColumn("readmit_time", F.when(unplanned, following["admit_time"]))
        .withColumn("readmit_type", F.when(unplanned, following["admit_type"]))
        .drop("next_stay")
        .withColumn("readmit_days", F.datediff("readmit_time", "discharge_time"))
        .withColumn("label", bucket_label(F.col("readmit_days"), splits))
    )


def reverse_label(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.lit(1.0) - F.col("label"))


def keep_cohort(stays: DataFrame) -> DataFrame:
    """Drop newborn stays (and those of unknown type) and patients not alive at discharge."""
    alive = F.col("death_time").isNull() | (F.col("discharge_time") < F.col("death_time"))
    return stays.filter((F.lower("admit_type") != "newborn") & alive)


def labelled_cohort(stays: DataFrame, splits: Sequence[float] = (30.0,), **options) -> DataFrame:
    """Label first and filter second, so that a dropped stay still counts as a next stay. With one split
    the label is reversed: 1 means readmitted before that day."""
    labelled = n_day_label(stays, splits, **options)
    return keep_cohort(reverse_label(labelled) if len(splits) == 1 else labelled)


def cohort_profile(stays: DataFrame, labelled: DataFrame, notes: DataFrame, combined: DataFrame) -> DataFrame:
    """The counts of a run, one row; each table is read once."""
    counts = [
        stays.agg(F.count(F.lit(1)).alias("raw_stays")),
        labelled.agg(
            F.count(F.lit(1)).alias("kept_stays"),
            F.count("readmit_days").alias("unplanned"),
            F.count_if(F.col("label") == 1.0).alias("unplanned_under_30_days"),
        ),
        notes.agg(F.count(F.lit(1)).alias("notes")),
        combined.agg(F.count_if(F.col("part") == 1).alias("combined_notes")),
    ]
    out = counts[0]
    for one_row in counts[1:]:
        out = out.select("*", *[one_row.select(name).scalar().alias(name) for name in one_row.columns])
    return out


def discharge_notes(notes: DataFrame) -> DataFrame:
    """Discharge summaries with a text and an admission, without those marked as errors."""
    return notes.filter(
        (F.lower("category") == "discharge summary")
        & F.col("iserror").isNull()
        & F.col("text").isNotNull()
        & F.col("hadm_id").isNotNull()
    )


def _joined_texts(notes: DataFrame, keys: list[str], order: list[str], columns: Sequence[str]) -> DataFrame:
    grouped = notes.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, *columns))).alias("sorted_notes"))

    def joined(name: str) -> Column:
        return F.concat_ws(" ", F.transform("sorted_notes", lambda note: note[name])).alias(name)

    return grouped.select(*keys, *[joined(name) for name in columns], F.size("sorted_notes").alias("notes"))


def _combine(
    notes: DataFrame, keys: list[str], order: list[str], columns: Sequence[str], part_bytes: int, ranges: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The combined notes of admissions within `part_bytes`, those of larger ones, and the keys of these."""
    out = [*keys, "part", "is_whole", *columns, "notes"]
    size = sum((F.coalesce(F.octet_length(name), F.lit(0)) + 1 for name in columns), F.lit(0)).cast("bigint")
    sized = notes.withColumn("note_bytes", size)
    # all texts divided by part_bytes bounds their number: 400,000 keys for 100 TB
    large = sized.groupBy(*keys).agg(F.sum("note_bytes").alias("bytes")).filter(F.col("bytes") > part_bytes).select(*keys)
    few = _joined_texts(notes.join(F.broadcast(large), keys, "left_anti"), keys, order, columns)
    ordinary = few.withColumn("part", F.lit(1).cast("bigint")).withColumn("is_whole", F.lit(True)).select(*out)

    # the notes of large admissions are scanned in order over ranges of admissions and dates
    many = notes.join(F.broadcast(large), keys, "left_semi").select(*dict.fromkeys([*keys, *order, *columns]))
    cut = with_sum_before(many, keys, order, size, "bytes_before", ranges).withColumn(
        "part", (F.floor(F.col("bytes_before") / part_bytes) + 1).cast("bigint")
    )
    parts = _joined_texts(cut, [*keys, "part"], order, columns)
    whole = parts.groupBy(*keys).agg((F.count(F.lit(1)) == 1).alias("is_whole"))
    return ordinary, parts.join(whole, keys).select(*out), large


def combine_notes(
    notes: DataFrame,
    keys: Sequence[str] = ("subject_id", "hadm_id"),
    order: Sequence[str] = ("chart_date", "row_id"),
    columns: Sequence[str] = ("text",),
    part_bytes: int = PART_BYTES,
    ranges: int | None = None,
) -> DataFrame:
    """The texts of an admission's notes, in order, joined by a space, as parts numbered from 1: a note is in
    part 1 + (bytes of the notes before it) // `part_bytes`. So an admission is one row, with `is_whole`, unless
    its notes have more bytes than a string or a task can hold. The order must be unique."""
    ordinary, parts, _ = _combine(notes, list(keys), list(order), columns, part_bytes, ranges)
    return ordinary.unionByName(parts)


def latest_notes(
    notes: DataFrame,
    keys: Sequence[str] = ("subject_id", "hadm_id"),
    order: Sequence[str] = ("chart_date", "row_id"),
    columns: Sequence[str] = ("text",),
) -> DataFrame:
    """The last note of every admission."""
    latest = F.max_by(F.struct(*columns), F.struct(*order)).alias("latest")
    return notes.groupBy(*keys).agg(latest).select(*keys, "latest.*")


def join_notes(stays: DataFrame, combined: DataFrame, columns: Sequence[str] = ("text",)) -> DataFrame:
    """(subject_id, hadm_id, text, label, part, is_whole), for stays that have a note."""
    keys = ["hadm_id", "subject_id"]
    return (
        stays.select(*keys, "label")
        .join(combined.select(*keys, "part", "is_whole", *columns), keys, "left")
        .filter(F.col(columns[0]).isNotNull())
        .select("subject_id", "hadm_id", *columns, "label", "part", "is_whole")
    )


def readmission_dataset(
    stays: DataFrame,
    notes: DataFrame,
    splits: Sequence[float] = (30.0,),
    columns: Sequence[str] = ("text",),
    order: Sequence[str] = ("chart_date", "row_id"),
    part_bytes: int = PART_BYTES,
    **options,
) -> DataFrame:
    """Labelled stays joined to their combined discharge notes.

    The texts are shuffled once: the join uses the partitioning by admission they were combined in. The
    parts of large admissions meet their stays by a broadcast of the few stays concerned."""
    keys = ["subject_id", "hadm_id"]
    labelled = labelled_cohort(stays, splits, **options).select(*keys, "label")
    ordinary, parts, large = _combine(discharge_notes(notes), keys, list(order), columns, part_bytes)
    few = labelled.join(F.broadcast(large), keys, "left_semi")
    large_rows = parts.join(F.broadcast(few), keys).select(*keys, *columns, "label", "part", "is_whole")
    return join_notes(labelled, ordinary, columns).unionByName(large_rows)
