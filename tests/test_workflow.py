import csv
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from notesight.config import JobConfig
from notesight.plans import learners, workflow
from notesight.sources import clinical, tables

NOTES_HEADER = "ROW_ID,SUBJECT_ID,HADM_ID,CHARTDATE,CHARTTIME,STORETIME,CATEGORY,DESCRIPTION,CGID,ISERROR,TEXT".split(",")


def write_csv(path, header, rows):
    with open(path, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(header)
        writer.writerows(rows)


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    rng = random.Random(7)
    admissions, notes = [], []
    for subject in range(1, 121):
        day = datetime(2020, 1, 1)
        for stay in range(3):
            hadm = subject * 10 + stay
            out = day + timedelta(days=3)
            sick = rng.random() < 0.5
            admissions.append([hadm, subject, hadm, day, out, "", "EMERGENCY", *[""] * 10, 0, 1])
            words = ["fever", "weak", "relapse"] if sick else ["stable", "well", "home"]
            text = 'Seen, "ok"\r\n\r\nDischarge Condition: ' + " ".join(rng.choice(words) for _ in range(8)) + "\n\nend"
            notes.append([hadm, subject, f"{hadm}.0", out, "", "", "Discharge summary", "Report", "", "", text])
            day = out + timedelta(days=rng.randint(2, 10) if sick else rng.randint(60, 90))
    notes.append([9001, 1, "10.0", datetime(2020, 1, 1), "", "", "Nursing", "Report", "", "", "nursing"])
    notes.append([9002, 1, "", datetime(2020, 1, 1), "", "", "Discharge summary", "Report", "", "", "no stay"])
    header = "ROW_ID,SUBJECT_ID,HADM_ID,ADMITTIME,DISCHTIME,DEATHTIME,TYPE,A,B,C,D,E,F,G,H,I,J,K,L".split(",")
    write_csv(folder / "ADMISSIONS.csv", header, admissions)
    write_csv(folder / "NOTEEVENTS.csv", NOTES_HEADER, notes)
    write_csv(folder / "PATIENTS.csv", "A,B,C,D,E,F,G,H".split(","), [[1, 1, "F", "1950-01-01 00:00:00", "", "", "", "0"]])
    return str(folder)


def test_loaders(spark, inputs):
    patients, admissions, notes = clinical.load(spark, inputs)
    assert patients.first().gender == "F" and admissions.count() == 360
    assert notes.count() == 362 and dict(notes.dtypes)["hadm_id"] == "bigint"
    first = notes.filter("row_id = 10").first()
    assert first.hadm_id == 10 and first.text.startswith('Seen, "ok"  Discharge Condition: ')
    raw = clinical.load_notes(spark, inputs).filter("row_id = 10").first()
    assert "\n\nDischarge" in raw.text and "\n\nend" in raw.text


def test_samples_and_exports(spark, inputs, tmp_path):
    sample = clinical.generate_notes_sample(spark, inputs, 0.2)
    assert 40 < sample.count() < 110
    assert clinical.generate_notes_sample(spark, inputs, 0.2, by_hash=False).count() > 0
    clinical.export_notes_sample(sample, str(tmp_path))
    plain = spark.read.option("header", True).csv(str(tmp_path / "NOTEEVENTS_sampleforpandas.csv"))
    assert plain.count() == sample.count() and plain.filter("text like '%,%'").count() == 0
    notes = clinical.load_notes(spark, inputs)
    clinical.export_sections(notes, str(tmp_path / "sections"))
    clinical.export_plain_text(notes, str(tmp_path / "plain"))
    terms = spark.createDataFrame([("fever",)], "term string")
    clinical.export_terms(notes, terms, str(tmp_path / "terms"))
    for name in ("sections", "plain", "terms"):
        assert spark.read.option("header", True).csv(str(tmp_path / name)).count() == 362


def test_tables(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([(1, 'a "b", c\nd')], "x int, y string")
    for name in ("t.csv", "t.parquet"):
        path = tables.save_table(df, name, folder)
        assert tables.is_finished(spark, path)
        assert [tuple(map(str, row)) for row in tables.load_table(spark, name, folder, multi_line=True).collect()] == [("1", 'a "b", c\nd')]
        tables.save_table(df.limit(0), name, folder)
        assert tables.load_table(spark, name, folder, df.schema).count() == 0
    assert tables.load_table(spark, "missing.parquet", folder, df.schema).schema == df.schema
    with pytest.raises(FileNotFoundError):
        tables.load_table(spark, "missing.parquet", folder)
    (tmp_path / "words.txt").write_text("Big Word\r\nsmall\n\n")
    assert sorted(r.term for r in tables.load_word_list(spark, str(tmp_path / "words.txt")).collect()) == ["Big Word", "small"]
    assert {r.term for r in tables.load_word_list(spark, str(tmp_path / "words.txt"), lower=True).collect()} == {"big word", "small"}


def test_raw_notes(spark, tmp_path):
    (tmp_path / "raw.csv").write_bytes(b'ROW_ID,TEXT\n1,"a \\"q\\"\r\nb"\n')
    row = clinical.load_raw_notes(spark, str(tmp_path / "raw.csv")).first()
    assert (row.row_id, row.text) == ("1", 'a "q"\nb')


def test_converted_inputs_are_preferred(spark, inputs, tmp_path):
    import shutil

    for name in ("ADMISSIONS", "NOTEEVENTS", "PATIENTS"):
        shutil.copy(f"{inputs}/{name}.csv", tmp_path)
    clinical.convert_to_parquet(spark, str(tmp_path))
    assert "parquet" in clinical.load_notes(spark, str(tmp_path))._jdf.queryExecution().toString().lower()
    assert clinical.load_notes(spark, str(tmp_path)).count() == 362


@pytest.mark.parametrize("featurizer, learner", [("bag_of_words", "lr"), ("section_bow", "rf")])
def test_run_and_resume(spark, inputs, tmp_path, featurizer, learner):
    import shutil

    for name in ("ADMISSIONS", "NOTEEVENTS", "PATIENTS"):
        shutil.copy(f"{inputs}/{name}.csv", tmp_path)
    config = JobConfig(str(tmp_path), str(tmp_path / "models"), featurizer=featurizer, learner=learner, validation_ratio=0.1)
    assert workflow.next_stage(spark, config) == "clean"
    report = {(r.metric, r.label): r.value for r in workflow.run(spark, config).collect()}
    assert report[("auroc", 1.0)] > 0.75
    assert workflow.next_stage(spark, config) == "test"
    again = {(r.metric, r.label): r.value for r in workflow.run(spark, config).collect()}
    assert again == report
    other = JobConfig(str(tmp_path), str(tmp_path / "other"), featurizer=featurizer, learner="lr_bagged")
    assert workflow.next_stage(spark, other) == "train"
    bagged = learners.learner("lr_bagged", count=2)
    bagged.train(spark.read.parquet(str(tmp_path / "train.parquet")))
    bagged.save(workflow.model_path(other))
    assert workflow.next_stage(spark, other) == "test"
    assert workflow.run(spark, other).filter("metric = 'auroc'").count() == 2
    names = ("predictions_train.parquet", "predictions_validate.parquet", "predictions_test.parquet", "metrics_test.csv", "feature_importance.csv")
    assert all(tables.is_finished(spark, str(tmp_path / name)) for name in names)
    tables.save_vectors_csv(spark.read.parquet(str(tmp_path / "test.parquet")), "features", "test.csv", str(tmp_path), 5)
    assert "features_4" in spark.read.option("header", True).csv(str(tmp_path / "test.csv")).columns


def test_other_settings_are_not_resumed(spark, tmp_path):
    from dataclasses import replace

    config = JobConfig(str(tmp_path), str(tmp_path / "models"))
    one = spark.range(1)
    for name, names in ((workflow.COMBINED, workflow.COMBINED_SETTINGS), (workflow.TRAIN, workflow.TRAIN_SETTINGS)):
        with workflow._recorded(spark, config, str(tmp_path / name), names):
            tables.save_table(one, name, str(tmp_path))
    tables.save_table(one, workflow.TEST, str(tmp_path))
    assert workflow.next_stage(spark, config) == "train"
    assert workflow.next_stage(spark, replace(config, validation_ratio=0.1)) == "preprocess"
    assert workflow.next_stage(spark, replace(config, featurizer="tf_idf")) == "preprocess"
    assert workflow.next_stage(spark, replace(config, featurizer="section_bow")) == "clean"
    assert workflow.next_stage(spark, replace(config, splits=(30.0, 90.0))) == "clean"
    with pytest.raises(ZeroDivisionError):
        with workflow._recorded(spark, config, str(tmp_path / workflow.TRAIN), workflow.TRAIN_SETTINGS):
            1 / 0
    assert workflow.next_stage(spark, config) == "preprocess"


def test_command_line_jobs(spark, inputs, tmp_path):
    import shutil

    from notesight.__main__ import main

    for name in ("ADMISSIONS", "NOTEEVENTS", "PATIENTS"):
        shutil.copy(f"{inputs}/{name}.csv", tmp_path)
    (tmp_path / "raw.csv").write_text('ROW_ID,TEXT\n1,"seen well\n\nDischarge Condition: stable now\n\nend"\n')
    (tmp_path / "list.txt").write_text("Stable\nwell\n")
    main(["clean", str(tmp_path / "raw.csv"), str(tmp_path / "cleaned"), "--terms", str(tmp_path / "list.txt")])
    row = spark.read.option("header", True).csv(str(tmp_path / "cleaned")).first()
    assert (row.row_id, row.text, row.discharge_condition.strip()) == ("1", "stable well", "stable")
    (tmp_path / "words").mkdir()
    (tmp_path / "words" / "a.txt").write_text("fever weak relapse stable well home seen ok discharge condition end")
    (tmp_path / "lexicon.csv").write_text("term,polarity\nwell,1\nweak,-1\n")
    options = ["--dictionary", str(tmp_path / "words"), "--lexicon", str(tmp_path / "lexicon.csv"), "--csv"]
    main([str(tmp_path), str(tmp_path / "models"), "lr", "complex_bow", *options])
    assert spark.read.parquet(str(tmp_path / "feature_map.parquet")).filter("value = '(sentiment)'").count() == 1
    assert '"ok"' in spark.read.parquet(str(tmp_path / "combined.parquet")).first().text
    for name in ("combined.csv", "train.csv", "predictions_test.csv", "metrics_test.csv", "NOTEEVENTS.parquet"):
        assert tables.is_finished(spark, str(tmp_path / name))
    with pytest.raises(SystemExit):
        main([str(tmp_path), str(tmp_path / "models"), "lr", "complex_bow"])
