from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from notesight.jobs import roles
from notesight.operators import cohort

SF = "/root/testdata/sf0.001"
STAY = "subject_id int, hadm_id int, admit_time timestamp, discharge_time timestamp, death_time timestamp, admit_type string"


def label_of(spark, *following, **options):
    rows = [(1, 10, dt(2020, 1, 20), dt(2020, 1, 31), None, "EMERGENCY")]
    rows += [(1, 20 + i, day, day, None, kind) for i, (day, kind) in enumerate(following)]
    labelled = cohort.reverse_label(cohort.n_day_label(spark.createDataFrame(rows, STAY), **options))
    first = labelled.filter("hadm_id = 10").first()
    return first.readmit_days, first.label


@pytest.mark.parametrize("following, days, label", [
    ([(dt(2020, 2, 29), "EMERGENCY")], 29, 1.0),
    ([(dt(2020, 3, 1), "EMERGENCY")], 30, 0.0),
    ([(dt(2020, 3, 2), "URGENT")], 31, 0.0),
    ([(dt(2020, 2, 5), "ELECTIVE")], None, 0.0),
    ([(dt(2020, 2, 5), "elective")], 5, 1.0),
    ([(dt(2020, 2, 5), None)], None, 0.0),
    ([(dt(2020, 1, 30), "EMERGENCY")], -1, 1.0),
    ([], None, 0.0),
    ([(dt(2020, 2, 5), "ELECTIVE"), (dt(2020, 2, 10), "EMERGENCY")], None, 0.0),
    ([(dt(2020, 2, 5), "EMERGENCY"), (dt(2020, 2, 5), "ELECTIVE")], 5, 1.0),
])
def test_label(spark, following, days, label):
    assert label_of(spark, *following) == (days, label)
    # the same stays with the subject treated as too large for one task
    assert label_of(spark, *following, ranges=3) == (days, label)


@pytest.mark.parametrize("ranges", [1, 7])
def test_skip_elective(spark, ranges):
    following = [(dt(2020, 2, 5), "ELECTIVE"), (dt(2020, 2, 10), "EMERGENCY")]
    assert label_of(spark, *following, skip_elective=True, ranges=ranges) == (10, 1.0)


@pytest.mark.parametrize("skip", [False, True])
def test_hot_subjects_get_the_same_labels(spark, skip):
    # every order belongs to one of three subjects, one of them with a third of the rows
    stays = roles.stays(spark, SF).withColumn("subject_id", F.col("subject_id") % 3)
    plain = cohort.n_day_label(stays, skip_elective=skip)
    split = cohort.n_day_label(stays, skip_elective=skip, ranges=23)
    assert plain.count() == stays.count()
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_splits_make_classes(spark):
    days = spark.createDataFrame([(-1,), (29,), (30,), (89,), (90,), (None,)], "d int")
    labels = [row.label for row in days.select(cohort.bucket_label(F.col("d"), (90.0, 30.0)).alias("label")).collect()]
    assert labels == [0.0, 0.0, 1.0, 1.0, 2.0, 2.0]


def test_cohort_filters(spark):
    day = [dt(2020, 1, i) for i in range(1, 5)]
    rows = [
        (1, 1, day[0], day[2], None, "NEWBORN"), (1, 2, day[0], day[2], None, "newborn"),
        (1, 3, day[0], day[2], None, None), (1, 4, day[0], day[2], day[1], "URGENT"),
        (1, 5, day[0], day[2], day[2], "URGENT"), (1, 6, day[0], day[2], day[3], "URGENT"),
        (1, 7, day[0], day[2], None, "URGENT"),
    ]
    kept = cohort.keep_cohort(spark.createDataFrame(rows, STAY))
    assert sorted(row.hadm_id for row in kept.collect()) == [6, 7]


NOTE = "row_id int, subject_id int, hadm_id bigint, chart_date timestamp, category string, iserror int, text string"
NOTES = [
    (1, 1, 100, dt(2020, 1, 3), "Discharge summary", None, "three"),
    (2, 1, 100, dt(2020, 1, 1), "DISCHARGE SUMMARY", None, "one"),
    (3, 1, 100, dt(2020, 1, 2), "Discharge summary", None, "two"),
    (4, 1, 100, dt(2020, 1, 2), "Discharge summary", 1, "wrong"),
    (5, 1, 100, dt(2020, 1, 2), "Nursing", None, "nurse"),
    (6, 2, None, dt(2020, 1, 2), "Discharge summary", None, "no stay"),
    (7, 3, 300, dt(2020, 1, 2), "Discharge summary", None, None),
    (8, 4, 400, dt(2020, 1, 2), "Discharge summary", None, "only"),
]


def test_combine_and_latest(spark):
    notes = cohort.discharge_notes(spark.createDataFrame(NOTES, NOTE))
    combined = {row.hadm_id: row.text for row in cohort.combine_notes(notes).collect()}
    assert combined == {100: "one two three", 400: "only"}
    latest = {row.hadm_id: row.text for row in cohort.latest_notes(notes).collect()}
    assert latest == {100: "three", 400: "only"}


def test_large_admissions_come_in_parts(spark):
    notes = cohort.discharge_notes(spark.createDataFrame(NOTES, NOTE))
    parts = cohort.combine_notes(notes, part_bytes=4).orderBy("hadm_id", "part").collect()
    assert [(row.hadm_id, row.part, row.text, row.is_whole) for row in parts] == [
        (100, 1, "one", False), (100, 2, "two", False), (100, 3, "three", False), (400, 1, "only", True),
    ]


@pytest.mark.parametrize("part_bytes", [1, 7, 20, 10**6])
def test_parts_of_old_and_unnumbered_days(spark, part_bytes):
    """Days around 1970, unknown days, large ids and one note larger than a part: one text in order, however cut."""
    days = [dt(1970, 1, 1), dt(1969, 12, 31), None, dt(1970, 1, 1), dt(2020, 5, 5), dt(2020, 5, 5)]
    rows = [(10**14 + i, 10, 10, day, "discharge summary", None, f"w{i} " * (1 + i)) for i, day in enumerate(days)]
    combined = cohort.combine_notes(spark.createDataFrame(rows, NOTE.replace("row_id int", "row_id bigint")), part_bytes=part_bytes)
    found = combined.orderBy("part").collect()
    assert " ".join(row.text for row in found) == " ".join(rows[i][-1] for i in (2, 1, 0, 3, 4, 5))
    assert [row.part for row in found] == sorted({row.part for row in found}) and found[0].part == 1
    assert all(row.is_whole == (len(found) == 1) for row in found)


def test_dataset_with_large_admissions(spark):
    stays, notes = roles.stays(spark, SF), roles.conversation_notes(spark, SF)
    plain = {row.hadm_id: row for row in cohort.readmission_dataset(stays, notes).collect()}
    split = cohort.readmission_dataset(stays, notes, part_bytes=2000).orderBy("hadm_id", "part").collect()
    assert len(split) > len(plain) > 5 and any(row.part > 1 for row in split)
    texts, labels = {}, {}
    for row in split:
        texts.setdefault(row.hadm_id, []).append(row.text)
        labels.setdefault(row.hadm_id, set()).add(row.label)
    assert {key: " ".join(parts) for key, parts in texts.items()} == {key: row.text for key, row in plain.items()}
    assert labels == {key: {row.label} for key, row in plain.items()}


def test_plan_has_no_udf_and_prunes_columns(spark):
    plan = roles.stays(spark, SF).transform(cohort.labelled_cohort)._jdf.queryExecution().toString()
    assert "Python" not in plan and "l_comment" not in plan
