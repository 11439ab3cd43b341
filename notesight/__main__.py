"""python -m notesight DATA_DIR MODEL_DIR [learner] [featurizer] [options]: run or resume, and print the test metrics.
python -m notesight sample DATA_DIR: write a sample of the discharge notes, for people and for naive CSV readers.
python -m notesight clean NOTES_CSV OUTPUT_DIR [options]: sections and clean texts of raw notes, as CSV."""

from __future__ import annotations

import sys
from argparse import ArgumentParser, Namespace, RawDescriptionHelpFormatter

from pyspark.sql import SparkSession, functions as F

from notesight.config import JobConfig
from notesight.functions.tokens import word_tokens
from notesight.operators.terms import token_counts
from notesight.plans.workflow import run
from notesight.sources import clinical
from notesight.sources.tables import load_word_list


def parsed(arguments: list[str]) -> Namespace:
    parser = ArgumentParser(prog="python -m notesight", description=__doc__, formatter_class=RawDescriptionHelpFormatter)
    parser.add_argument("places", nargs="+", help="as above")
    parser.add_argument("--csv", action="store_true", help="also write tables as CSV")
    parser.add_argument("--dictionary", help="complex_bow: a folder of text whose words are spelled right")
    parser.add_argument("--lexicon", help="complex_bow: a CSV file with the columns term, polarity")
    parser.add_argument("--negators", default="no,not,never,without", help="complex_bow: words that reverse the next one")
    parser.add_argument("--cleaner", default="notes", help="the cleaner, by name")
    parser.add_argument("--terms", help="clean: keep only the words of this list, one per line")
    return parser.parse_args(arguments)


def featurizer_options(spark: SparkSession, options: Namespace) -> dict:
    if not options.dictionary or not options.lexicon:
        raise SystemExit("complex_bow needs --dictionary and --lexicon")
    return {
        "dictionary": token_counts(spark.read.text(options.dictionary), word_tokens(F.col("value"))),
        "lexicon": spark.read.schema("term string, polarity int").option("header", True).csv(options.lexicon),
        "negators": tuple(options.negators.split(",")),
    }


def main(arguments: list[str]) -> None:
    options = parsed(arguments)
    job, *places = options.places
    spark = SparkSession.builder.appName("notesight").getOrCreate()
    if job == "sample" and len(places) == 1:
        clinical.export_notes_sample(clinical.generate_notes_sample(spark, places[0]), places[0])
    elif job == "clean" and len(places) == 2:
        listed = load_word_list(spark, options.terms, lower=True) if options.terms else None
        clinical.export_clean_notes(clinical.load_raw_notes(spark, places[0]), places[1], options.cleaner, listed)
    elif 2 <= len(options.places) <= 4 and job not in ("sample", "clean"):
        names = dict(zip(("learner", "featurizer"), places[1:]))
        config = JobConfig(job, places[0], cleaner=options.cleaner, csv_copies=options.csv, **names)
        extra = featurizer_options(spark, options) if config.featurizer == "complex_bow" else {}
        run(spark, config, **extra).orderBy("metric", "label").show(100, truncate=False)
    else:
        raise SystemExit(__doc__)


if __name__ == "__main__":
    main(sys.argv[1:])
