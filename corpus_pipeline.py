"""From documents to training sequences in five stages: quality rules, near-duplicates, benchmark
decontamination, personal data, packing.

Each stage takes all that the one before it kept and, but for the last, returns the columns it was given. Extra columns
of any name pass through. Empty tables stay empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from notesight.llm import decision_list, decontaminate, forest, packing, pii
from notesight.llm.common import staged
from notesight.llm.queries import table, tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base checks nor a learned rule reject. The rules are learned on labelled rows of the
    whole `documents` table, as labels are of those."""
    rules = decision_list.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return decision_list.judge(rows, rules, keep=["row"]).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with five-word shingles alike to 0.8 or more."""
    return forest.keep_one(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    scanned = decontaminate.scan(rows, table(spark, sf_dir, "benchmark"))
    return decontaminate.remove_documents(scanned).select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with marks in place of personal data; n_chars is that of the new text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their ids. The workers still hold memory of the stages before: they remember
    a quarter of the chunks that they do for packing alone."""
    return packing.pack(docs, tokenizer(), end_id=0, most_chunks=packing.MOST_CHUNKS // 4)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Rules are learned, near-duplicates found by hashing and texts tokenized, none of which SQL expresses.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
