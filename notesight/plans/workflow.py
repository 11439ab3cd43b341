"""The run from input tables to metrics, in stages that hand over Parquet tables.

Every stage writes its tables before the next one reads them, so a lost executor or a failed run costs at
most one stage: `run` goes on from the latest finished one. The settings a table depends on are kept beside it;
a table made with others counts as not finished, one without any (made by hand) as it is."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from notesight.config import JobConfig
from notesight.functions.words import SECTION_HEADERS
from notesight.operators.cleaning import add_sections, clean
from notesight.operators.cohort import readmission_dataset
from notesight.operators.metrics import metrics_report
from notesight.operators.sampling import split_ratio
from notesight.plans.featurizers import featurizer
from notesight.plans.learners import KEYS, Learner, learner, name_importance
from notesight.sources import clinical
from notesight.sources.tables import is_finished, save_table, save_vectors_csv

COMBINED, TRAIN, TEST, VALIDATE = "combined.parquet", "train.parquet", "test.parquet", "validate.parquet"


#: The settings that decide what is in a table; the split for validation is checked by its own table.
COMBINED_SETTINGS = ("splits", "skip_elective", "cleaner")
TRAIN_SETTINGS = (*COMBINED_SETTINGS, "featurizer", "seed", "test_ratio")


def _settings(config: JobConfig, names: tuple[str, ...]) -> str:
    values = {name: getattr(config, name) for name in names}
    if names == COMBINED_SETTINGS:  # what the featurizer wants of the notes
        values["text"] = config.featurizer if config.featurizer in ("section_bow", "complex_bow") else "clean"
    return json.dumps(values, sort_keys=True)


@contextmanager
def _recorded(spark: SparkSession, config: JobConfig, path: str, names: tuple[str, ...]) -> Iterator[None]:
    """Keep the settings beside what is written meanwhile; if that breaks off, it counts as made with others."""

    def note(settings: str) -> None:
        spark.createDataFrame([(settings,)], "settings string").coalesce(1).write.mode("overwrite").text(f"{path}.settings")

    note("unfinished")
    yield
    note(_settings(config, names))


def _is_current(spark: SparkSession, config: JobConfig, path: str, names: tuple[str, ...]) -> bool:
    if not is_finished(spark, f"{path}.settings"):
        return True
    return spark.read.text(f"{path}.settings").first()["value"] == _settings(config, names)


def model_path(config: JobConfig) -> str:
    return os.path.join(config.model_dir, config.learner)


def _read(spark: SparkSession, config: JobConfig, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(config.data_dir, name))


def clean_data(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Clean the notes, label the stays and join both. CSV input becomes Parquet first, as the notes' CSV cannot be
    split among tasks. The sections are cut before line breaks go; `complex_bow` needs its sentences, so its
    notes keep their punctuation."""
    clinical.convert_to_parquet(spark, config.data_dir)
    _, admissions, notes = clinical.load(spark, config.data_dir, flatten=False)
    columns = ["text"]
    if config.featurizer == "section_bow":
        notes, columns = add_sections(notes), ["text", *SECTION_HEADERS]
    cleaned = config.cleaner and config.featurizer != "complex_bow"
    notes = clean(notes, columns, config.cleaner) if cleaned else clinical.flatten_notes(notes)
    combined = readmission_dataset(admissions, notes, config.splits, columns, skip_elective=config.skip_elective)
    with _recorded(spark, config, os.path.join(config.data_dir, COMBINED), COMBINED_SETTINGS):
        save_table(combined, COMBINED, config.data_dir)
    saved = _read(spark, config, COMBINED)
    if config.csv_copies:
        save_table(saved, "combined.csv", config.data_dir)
    return saved


def preprocess_data(spark: SparkSession, config: JobConfig, **options) -> None:
    """Split, fit the featurizer on the training rows, write vectors and the feature map."""
    rest, test = split_ratio(_read(spark, config, COMBINED), KEYS, config.test_ratio, config.seed)
    train, validate = rest, None
    if config.validation_ratio:
        train, validate = split_ratio(rest, KEYS, config.validation_ratio, config.seed + 1)
    fitted = featurizer(config.featurizer, **options).fit(train)
    with _recorded(spark, config, os.path.join(config.data_dir, TRAIN), TRAIN_SETTINGS):
        save_table(fitted.feature_map(spark), "feature_map.parquet", config.data_dir, single_file=True)
        if validate is not None:
            save_table(fitted.transform(validate), VALIDATE, config.data_dir)
        save_table(fitted.transform(train), TRAIN, config.data_dir)
        save_table(fitted.transform(test), TEST, config.data_dir)
    if config.csv_copies:
        for name in (TRAIN, TEST):
            save_vectors_csv(_read(spark, config, name), "features", name.replace(".parquet", ".csv"), config.data_dir, fitted.size)


def _report(predictions: DataFrame, name: str, config: JobConfig) -> DataFrame:
    spark = predictions.sparkSession
    save_table(predictions, f"predictions_{name}.parquet", config.data_dir)
    saved = _read(spark, config, f"predictions_{name}.parquet")
    if config.csv_copies:
        save_table(saved, f"predictions_{name}.csv", config.data_dir)
    save_table(metrics_report(saved), f"metrics_{name}.csv", config.data_dir, single_file=True)
    return metrics_report(saved)


def train_learner(spark: SparkSession, config: JobConfig) -> Learner:
    """Fit and save the model, its importance table, and the metrics on the rows it was fitted on (on all
    training rows for bagged learners)."""
    rows = _read(spark, config, TRAIN)
    fitted = learner(config.learner, seed=config.seed)
    importance = fitted.train(rows)
    named = name_importance(importance, _read(spark, config, "feature_map.parquet"))
    save_table(named, "feature_importance.csv", config.data_dir, single_file=True)
    _report(fitted.predict(rows if config.learner.endswith("_bagged") else fitted.draw(rows)), "train", config)
    if config.validation_ratio:
        _report(fitted.predict(_read(spark, config, VALIDATE)), "validate", config)
    with _recorded(spark, config, model_path(config), TRAIN_SETTINGS):
        fitted.save(model_path(config))
    return fitted


def test_learner(spark: SparkSession, config: JobConfig, fitted: Learner | None = None) -> DataFrame:
    """Score the test rows; returns the metrics."""
    fitted = fitted or learner(config.learner, seed=config.seed).load(model_path(config))
    return _report(fitted.predict(_read(spark, config, TEST)), "test", config)


test_learner.__test__ = False  # not a unit test


def _model_exists(spark: SparkSession, config: JobConfig) -> bool:
    path = model_path(config)
    last = "ensemble" if config.learner.endswith("_bagged") else "metadata"
    return is_finished(spark, os.path.join(path, last))


def next_stage(spark: SparkSession, config: JobConfig) -> str:
    def done(name: str) -> bool:
        return is_finished(spark, os.path.join(config.data_dir, name))

    combined, train = (os.path.join(config.data_dir, name) for name in (COMBINED, TRAIN))
    vectors = done(TRAIN) and done(TEST) and (done(VALIDATE) or not config.validation_ratio)
    if vectors and _is_current(spark, config, train, TRAIN_SETTINGS):
        model = _model_exists(spark, config) and _is_current(spark, config, model_path(config), TRAIN_SETTINGS)
        return "test" if model else "train"
    return "preprocess" if done(COMBINED) and _is_current(spark, config, combined, COMBINED_SETTINGS) else "clean"


def run(spark: SparkSession, config: JobConfig, **options) -> DataFrame:
    """Go on from the latest finished stage to the metrics of the test rows."""
    stage = next_stage(spark, config)
    if stage == "clean":
        clean_data(spark, config)
    if stage in ("clean", "preprocess"):
        preprocess_data(spark, config, **options)
    fitted = None if stage == "test" else train_learner(spark, config)
    return test_learner(spark, config, fitted)
