"""The three clinical input tables, and samples of the notes."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from notesight.functions import words
from notesight.functions.cleaning import drop_commas, flatten_lines, unix_lines
from notesight.operators.cleaning import add_sections, clean, prepare_notes
from notesight.operators.sampling import hash_sample, random_sample
from notesight.operators.terms import dictionary_words, match_terms
from notesight.sources.quoted_csv import read_quoted_csv
from notesight.sources.tables import is_finished, path_exists

# The column names and types of the input files.
PATIENT_SCHEMA = (
    "row_id int, subject_id int, gender string, dob timestamp, dod timestamp, dod_hosp timestamp, "
    "dod_ssn timestamp, expire_flag string"
)
ADMISSION_SCHEMA = (
    "row_id int, subject_id int, hadm_id int, admit_time timestamp, discharge_time timestamp, "
    "death_time timestamp, admit_type string, admit_loc string, discharge_loc string, insurance string, "
    "language string, religion string, marital_status string, ethnicity string, "
    "ed_register_time timestamp, ed_checkout_time timestamp, diagnosis string, hosp_exp_flag int, "
    "has_chartevents_data int"
)
NOTE_SCHEMA = (
    "row_id int, subject_id int, hadm_id double, chart_date timestamp, chart_time timestamp, "
    "store_time timestamp, category string, description string, cgid int, iserror int, text string"
)


def _read_csv(spark: SparkSession, data_dir: str, name: str, schema: str, escape: str | None = None) -> DataFrame:
    """The CSV file, or the Parquet folder `convert_to_parquet` has made of it. With `escape` its fields may have line
    breaks."""
    converted = os.path.join(data_dir, f"{name}.parquet")
    if is_finished(spark, converted):
        return spark.read.parquet(converted)
    path = os.path.join(data_dir, f"{name}.csv")
    if escape is not None:
        return read_quoted_csv(spark, path, schema, escape=escape)
    return spark.read.schema(schema).option("header", True).csv(path)


def load_patients(spark: SparkSession, data_dir: str) -> DataFrame:
    return _read_csv(spark, data_dir, "PATIENTS", PATIENT_SCHEMA)


def load_admissions(spark: SparkSession, data_dir: str) -> DataFrame:
    return _read_csv(spark, data_dir, "ADMISSIONS", ADMISSION_SCHEMA)


def load_notes(spark: SparkSession, data_dir: str, escape: str = '"') -> DataFrame:
    """Notes with a text. The admission id is written like a float, so it is read as a double (exact to
    2^53) and cast."""
    notes = _read_csv(spark, data_dir, "NOTEEVENTS", NOTE_SCHEMA, escape)
    return notes.filter(F.col("text").isNotNull()).withColumn("hadm_id", F.col("hadm_id").cast("bigint"))


def flatten_notes(notes: DataFrame) -> DataFrame:
    return notes.withColumn("text", flatten_lines(F.col("text")))


def load(spark: SparkSession, data_dir: str, flatten: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(patients, admissions, notes). Leave the line breaks in (`flatten=False`) to cut sections later."""
    notes = load_notes(spark, data_dir)
    return (
        load_patients(spark, data_dir),
        load_admissions(spark, data_dir),
        flatten_notes(notes) if flatten else notes,
    )


def convert_to_parquet(spark: SparkSession, data_dir: str) -> None:
    """The CSV files as Parquet, which later stages read by column; the notes' records are cut and parsed only once."""
    tables = {"PATIENTS": PATIENT_SCHEMA, "ADMISSIONS": ADMISSION_SCHEMA, "NOTEEVENTS": NOTE_SCHEMA}
    for name, schema in tables.items():
        # a conversion that broke off has no success marker, is not read, and is done again
        path = os.path.join(data_dir, f"{name}.parquet")
        if not is_finished(spark, path) and path_exists(spark, os.path.join(data_dir, f"{name}.csv")):
            escape = '"' if name == "NOTEEVENTS" else None
            _read_csv(spark, data_dir, name, schema, escape).write.mode("overwrite").parquet(path)


def load_raw_notes(spark: SparkSession, path: str) -> DataFrame:
    """Notes for the text cleaner: backslash escapes, lower-case column names, Unix line ends."""
    raw = read_quoted_csv(spark, path, escape="\\")
    named = raw.toDF(*[name.lower() for name in raw.columns])
    return named.withColumn("text", unix_lines(F.col("text")))


def generate_notes_sample(
    spark: SparkSession, data_dir: str, fraction: float = 0.05, seed: int = 12345, by_hash: bool = True
) -> DataFrame:
    """A sample of the discharge notes, by default one that a rerun reproduces."""
    notes = load_notes(spark, data_dir).filter(F.lower("category") == "discharge summary")
    return hash_sample(notes, ["row_id"], fraction, seed) if by_hash else random_sample(notes, fraction, seed)


def single_line(notes: DataFrame) -> DataFrame:
    """Notes that naive CSV readers can take: no line breaks and no commas in the text."""
    return notes.withColumn("text", drop_commas(flatten_lines(F.col("text"))))


def export_notes_sample(sample: DataFrame, data_dir: str) -> None:
    """Write the sample twice: as it is, and single-line without commas."""
    for name, table in (("NOTEEVENTS_sampleforhumans.csv", sample), ("NOTEEVENTS_sampleforpandas.csv", single_line(sample))):
        table.write.mode("overwrite").option("header", True).option("escape", '"').csv(os.path.join(data_dir, name))


def export_text(notes: DataFrame, path: str) -> None:
    notes.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_plain_text(notes: DataFrame, path: str) -> None:
    """Notes run through the second cleaner."""
    export_text(clean(notes, ["text"], "plain"), path)


def export_clean_notes(notes: DataFrame, path: str, cleaner: str = "notes", terms: DataFrame | None = None) -> None:
    """Raw notes with their sections, all cleaned; with a word list, the text is its words that the list knows."""
    ready = prepare_notes(notes, cleaner)
    if terms is not None:
        others = [name for name in ready.columns if name != "text"]
        ready = dictionary_words(ready, terms, others).withColumnRenamed("words", "text")
    export_text(ready, path)


def export_terms(notes: DataFrame, terms: DataFrame, path: str) -> None:
    """Notes reduced to the dictionary terms found in them."""
    others = [name for name in notes.columns if name != "text"]
    export_text(match_terms(notes, terms, keys=others).withColumnRenamed("terms", "text"), path)


def export_sections(notes: DataFrame, path: str, keys: tuple[str, ...] = ("row_id",)) -> None:
    """The five sections of every note, with the note's key."""
    export_text(add_sections(notes).select(*keys, *words.SECTION_HEADERS), path)
