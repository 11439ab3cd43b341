"""Queries on files: tables are written to the shared folder and read back by the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from notesight.config import new_path
from notesight.jobs import query
from notesight.jobs.roles import DICTIONARY, dictionary, documents, table
from notesight.operators import terms
from notesight.sources.quoted_csv import read_quoted_csv
from notesight.sources.tables import load_table, load_word_list, save_table

TURNS = "conv_id long, turn long, role string, text string"
#: Line breaks, quotes, separators and backslashes around each text, also at its ends.
TURNS_SQL = """SELECT conv_id, turn, '"' || role || '"' AS role,
  E'"a, b"\\\\\n\n' || replace(text, ' de ', E'",\n"') || E'\n\\\\"' AS text FROM conversations"""


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('"a, b"\\\n\n'), F.replace("text", F.lit(" de "), F.lit('",\n"')), F.lit('\n\\"'))
    role = F.concat(F.lit('"'), "role", F.lit('"'))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", role.alias("role"), text.alias("text"))


@query("csv_turns", TURNS_SQL)
def csv_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with line breaks, quotes doubled."""
    path = new_path(spark, "turns-csv")
    _turns(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return read_quoted_csv(spark, path, TURNS)


@query("csv_turns_backslash", TURNS_SQL)
def csv_turns_backslash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with line breaks, quotes and backslashes after a backslash; columns named by the header."""
    path = new_path(spark, "turns-csv")
    escaped = [F.concat(F.lit('"'), F.regexp_replace(c, r'([\\\\"])', r"\\$1"), F.lit('"')) for c in ("role", "text")]
    line = F.concat_ws(",", F.col("conv_id").cast("string"), F.col("turn").cast("string"), *escaped)
    header = spark.range(1).select(F.lit("conv_id,turn,role,text").alias("value"))
    # the header is the first line of a file of its own; the others have none
    header.write.text(path)
    _turns(spark, sf_dir).select(line.alias("value")).write.mode("append").text(path)
    names = read_quoted_csv(spark, path, escape="\\").columns
    rows = read_quoted_csv(spark, path, ", ".join(f"{n} string" for n in names), header=False, escape="\\")
    return rows.filter("conv_id <> 'conv_id'").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )


@query("table_round_trip", "SELECT doc_id, text, lang, n_chars FROM documents WHERE text <> ''")
def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table saved as CSV by name, replaced by itself as read back, and loaded again."""
    folder = new_path(spark, "tables")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars").filter("text <> ''")
    save_table(rows, "documents.csv", folder)
    schema = "doc_id long, text string, lang string, n_chars long"
    save_table(load_table(spark, "documents.csv", folder, schema, multi_line=True), "documents.csv", folder)
    return load_table(spark, "documents.csv", folder, schema, multi_line=True)


@query(
    "word_list_terms",
    rf"""WITH {DICTIONARY} SELECT doc_id,
  coalesce(string_agg(word, ' ' ORDER BY word) FILTER (WHERE term IS NOT NULL), '') AS words
FROM (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
LEFT JOIN dictionary ON term = word GROUP BY doc_id""",
)
def word_list_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the texts that a list knows which is read from files, one term a line."""
    path = new_path(spark, "word-list")
    dictionary(spark, sf_dir).select(F.upper("term")).write.text(path)
    return terms.dictionary_words(documents(spark, sf_dir), load_word_list(spark, path, lower=True), ["doc_id"])
