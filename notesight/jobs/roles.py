"""The driver's tables in the roles of the clinical ones, as DataFrames and as SQL common table
expressions with the same names and columns."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from notesight.config import spread
from notesight.functions.tokens import word_tokens
from notesight.operators.cohort import combine_notes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as hospital stays: as many days as they have lines; a finished one dies on the fourth day."""
    lines = (
        table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("int").alias("days"))
    )
    orders = table(spark, sf_dir, "orders")
    days = F.coalesce("days", F.lit(0))
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderdate").alias("admit_time"),
        (F.col("o_orderdate") + F.make_interval(days=days)).alias("discharge_time"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 4 DAYS")).alias("death_time"),
        F.when(F.col("o_orderpriority") == "5-LOW", "ELECTIVE")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Newborn")
        .otherwise(F.col("o_orderpriority"))
        .alias("admit_type"),
    )


STAYS = """lines AS (
  SELECT l_orderkey, CAST(count(*) AS INTEGER) AS days FROM lineitem GROUP BY l_orderkey
), stays AS (
  SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderdate AS admit_time,
    o_orderdate + to_days(coalesce(days, 0)) AS discharge_time,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 4 DAY END AS death_time,
    CASE o_orderpriority WHEN '5-LOW' THEN 'ELECTIVE' WHEN '4-NOT SPECIFIED' THEN 'Newborn'
      ELSE o_orderpriority END AS admit_type
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey
)"""


def event_stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as stays that end when they begin; a signup is planned."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("subject_id"),
        F.col("event_id").alias("hadm_id"),
        F.col("ts").alias("admit_time"),
        F.col("ts").alias("discharge_time"),
        F.when(F.col("event_type") == "signup", "ELECTIVE").otherwise(F.col("event_type")).alias("admit_type"),
    )


def conversation_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as notes of the order with the same number: a turn per day, the system's turns as
    nursing notes, very short ones as errors."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id")
    )
    notes = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"),
        F.col("conv_id").alias("hadm_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("turn").cast("int")).cast("timestamp").alias("chart_date"),
        F.when(F.col("role") == "system", "Nursing").otherwise("Discharge Summary").alias("category"),
        F.when(F.length("text") < 40, 1).alias("iserror"),
        "text",
    )
    return notes.join(orders, "hadm_id")


CONVERSATION_NOTES = """conversation_notes AS (
  SELECT conv_id * 1000 + turn AS row_id, conv_id AS hadm_id, o_custkey AS subject_id,
    DATE '2020-01-01' + CAST(turn AS INTEGER) AS chart_date,
    CASE WHEN role = 'system' THEN 'Nursing' ELSE 'Discharge Summary' END AS category,
    CASE WHEN length(text) < 40 THEN 1 END AS iserror, text
  FROM conversations JOIN orders ON o_orderkey = conv_id
)"""

KEPT_NOTES = CONVERSATION_NOTES + """, kept_notes AS (
  SELECT * FROM conversation_notes
  WHERE lower(category) = 'discharge summary' AND iserror IS NULL AND text IS NOT NULL
)"""


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as one combined note each, with the role of a turn as its section header."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("hadm_id"),
        "turn",
        F.timestamp_seconds(F.col("turn") * 86400).alias("chart_date"),
        F.concat(F.lit("\n\n"), "role", F.lit(": "), "text", F.lit("\n\n")).alias("text"),
    )
    return combine_notes(turns, keys=["hadm_id"], order=["chart_date", "turn"]).select("hadm_id", "text")


TRANSCRIPTS = r"""transcripts AS (
  SELECT conv_id AS hadm_id,
    string_agg(E'\n\n' || role || ': ' || text || E'\n\n', ' ' ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id
)"""

TRANSCRIPT_HEADERS = {"asked": r"user.*?:", "answered": r"assistant.*?:", "framed": r"system.*?:"}

HEADER_1 = "Admission Date: [**"
HEADER_2 = "**]  Discharge Date: [**21-"
HEADER_3 = "**] Date of Birth: [x]\nSex: F  Service: MEDICINE, seen at 10:45 am\n\n"
FOOTER = (
    "\n\nTake 20 mg by mouth q day, two tablet at bedtime daily; 3 ml q.d. Na 140 mmol/l, "
    "Hgb 9 g/dl.\r\nThe bone, sixteen or one mgs PO three times a day\n"
)


def clinical_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with the furniture of a discharge summary around them."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars"), "doc_id")
    return documents.select(
        "doc_id",
        F.concat(
            F.lit(HEADER_1), "source", F.lit(HEADER_2), F.col("n_chars").cast("string"), F.lit(HEADER_3), "text", F.lit(FOOTER)
        ).alias("text"),
    )


def literal(text: str) -> str:
    """A DuckDB string literal, with escapes for line breaks."""
    body = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r")
    return f"E'{body}'"


CLINICAL_NOTES = f"""clinical_notes AS (
  SELECT doc_id, {literal(HEADER_1)} || source || {literal(HEADER_2)} || CAST(n_chars AS VARCHAR) ||
    {literal(HEADER_3)} || text || {literal(FOOTER)} AS text
  FROM documents
)"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def document_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under the keys of a note; featurizing needs no label."""
    return documents(spark, sf_dir).select(F.col("doc_id").alias("subject_id"), F.col("doc_id").alias("hadm_id"), "text")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label: 1 for the toxic ones."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    return documents(spark, sf_dir).join(labels, "doc_id").select(
        F.col("doc_id").alias("subject_id"), F.col("doc_id").alias("hadm_id"), "text", "label"
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents scored by their length: a long one is predicted to be of good quality."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    odds = F.col("n_chars") / (F.col("n_chars") + 2000.0)
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "n_chars")
        .join(labels, "doc_id")
        .select(
            F.col("doc_id").alias("subject_id"),
            F.col("doc_id").alias("hadm_id"),
            "label",
            (F.col("n_chars") > 1000).cast("double").alias("prediction"),
            (F.lit(1.0) - odds).alias("probability_0"),
            odds.alias("probability_1"),
        )
    )


SCORED_DOCUMENTS = """scored_documents AS (
  SELECT doc_id AS subject_id, doc_id AS hadm_id, CAST(quality AS DOUBLE) AS label,
    CASE WHEN n_chars > 1000 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction,
    CAST(1 AS DOUBLE) - CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + CAST(2000 AS DOUBLE)) AS probability_0,
    CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + CAST(2000 AS DOUBLE)) AS probability_1
  FROM documents JOIN labels USING (doc_id)
)"""


def scored_by_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents in three classes (poor, good, toxic), scored by their length."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, 2.0).otherwise(F.col("quality").cast("double")).alias("label")
    )
    long = F.col("n_chars") / (F.col("n_chars") + 2000.0)
    prediction = F.when(F.col("n_chars") > 4000, 2.0).when(F.col("n_chars") > 1000, 1.0).otherwise(0.0)
    return (
        table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(labels, "doc_id")
        .select(
            F.col("doc_id").alias("subject_id"), F.col("doc_id").alias("hadm_id"), "label", prediction.alias("prediction"),
            ((1.0 - long) / 2.0).alias("probability_0"), F.lit(0.5).alias("probability_1"), (long / 2.0).alias("probability_2"),
        )
    )


SCORED_BY_THREE = """scored_documents AS (
  SELECT doc_id AS subject_id, doc_id AS hadm_id,
    CASE WHEN toxic = 1 THEN CAST(2 AS DOUBLE) ELSE CAST(quality AS DOUBLE) END AS label,
    CAST(CASE WHEN n_chars > 4000 THEN 2 WHEN n_chars > 1000 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
    (CAST(1 AS DOUBLE) - CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + CAST(2000 AS DOUBLE))) / 2 AS probability_0,
    CAST(0.5 AS DOUBLE) AS probability_1,
    CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + CAST(2000 AS DOUBLE)) / 2 AS probability_2
  FROM documents JOIN labels USING (doc_id)
)"""


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term, n): the words of the benchmark texts."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(word_tokens(F.col("text"))).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def words_sql(text: str) -> str:
    """Runs of letters, lower-cased, as a DuckDB list."""
    return f"list_filter(regexp_split_to_array(lower({text}), '[^a-z]+'), lambda w: w <> '')"


DICTIONARY = f"""dictionary AS (
  SELECT term, count(*) AS n FROM (SELECT unnest({words_sql('text')}) AS term FROM benchmark)
  GROUP BY term
)"""


# A small lexicon over words of the generated prose.
LEXICON = {
    "the": 1, "her": 1, "are": 1, "with": 1, "la": 1, "der": 1, "and": -1, "for": -1, "was": -1, "le": -1, "die": -1,
}
NEGATORS = ("that", "of", "de", "und")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON.items()), "term string, polarity int")


LEXICON_SQL = "lexicon(term, polarity) AS (VALUES " + ", ".join(f"('{w}', {p})" for w, p in LEXICON.items()) + ")"


def hash_fraction_sql(prefix: str, *parts: str, digits: int = 8) -> str:
    joined = f"concat_ws('|', '{prefix}', " + ", ".join(f"CAST({part} AS VARCHAR)" for part in parts) + ")"
    return f"(CAST(('0x' || substr(md5({joined}), 1, {digits})) AS BIGINT) / CAST({16**digits} AS DOUBLE))"
