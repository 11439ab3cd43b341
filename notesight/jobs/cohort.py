"""Queries on stays and their notes, samples and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from notesight.config import spread
from notesight.functions.cleaning import drop_commas, flatten_lines, unix_lines
from notesight.functions.vectors import split_array
from notesight.jobs import query
from notesight.jobs.roles import (
    FOOTER,
    KEPT_NOTES,
    SCORED_BY_THREE,
    SCORED_DOCUMENTS,
    STAYS,
    conversation_notes,
    event_stays,
    hash_fraction_sql,
    literal,
    scored_by_three,
    scored_documents,
    stays,
    table,
)
from notesight.operators import cohort, metrics, sampling

LABEL_COLUMNS = ["subject_id", "hadm_id", "readmit_day", "readmit_type", "readmit_days", "label"]


def _label_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("readmit_day", F.to_date("readmit_time").cast("string")).select(*LABEL_COLUMNS)


def _labelled_sql(source: str, label: str) -> str:
    """The labels of a stays table; `label` is an expression over readmit_days."""
    return f"""nexts AS (
  SELECT *, lead(admit_time) OVER w AS next_time, lead(admit_type) OVER w AS next_type
  FROM {source} WINDOW w AS (PARTITION BY subject_id ORDER BY admit_time, hadm_id)
), labelled AS (
  SELECT *, {label} AS label FROM (
    SELECT *, CASE WHEN next_type <> 'ELECTIVE' THEN next_time END AS readmit_time,
      CASE WHEN next_type <> 'ELECTIVE' THEN next_type END AS readmit_type,
      CASE WHEN next_type <> 'ELECTIVE'
        THEN CAST(date_diff('day', CAST(discharge_time AS DATE), CAST(next_time AS DATE)) AS INTEGER) END AS readmit_days
    FROM nexts)
)"""


BINARY = "CASE WHEN readmit_days < 30 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
THREE_WAY = (
    "CASE WHEN readmit_days < 30 THEN CAST(0 AS DOUBLE) WHEN readmit_days < 90 THEN CAST(1 AS DOUBLE) "
    "ELSE CAST(2 AS DOUBLE) END"
)
SELECT_LABELS = (
    "SELECT subject_id, hadm_id, CAST(CAST(readmit_time AS DATE) AS VARCHAR) AS readmit_day, readmit_type, "
    "readmit_days, label FROM labelled"
)
COHORT = "lower(admit_type) <> 'newborn' AND (death_time IS NULL OR discharge_time < death_time)"


@query("readmit_label", f"WITH {STAYS}, {_labelled_sql('stays', BINARY)} {SELECT_LABELS}")
def readmit_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_columns(cohort.reverse_label(cohort.n_day_label(stays(spark, sf_dir), (30.0,))))


@query("readmit_large_subjects", f"WITH {STAYS}, {_labelled_sql('stays', BINARY)} {SELECT_LABELS}")
def readmit_large_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same labels, scanned over so many ranges that subjects are cut."""
    return _label_columns(cohort.reverse_label(cohort.n_day_label(stays(spark, sf_dir), (30.0,), ranges=61)))


ONE_SUBJECT = """event_stays AS (
  SELECT 1 AS subject_id, event_id AS hadm_id, TIMESTAMP '2024-02-01 00:00:00' AS admit_time, TIMESTAMP '2024-01-31 00:00:00' AS discharge_time,
    CASE WHEN event_id % 7 < 3 THEN 'ELECTIVE' ELSE event_type END AS admit_type FROM events
)"""


@query("readmit_one_subject", f"WITH {ONE_SUBJECT}, {_labelled_sql('event_stays', BINARY)} {SELECT_LABELS}")
def readmit_one_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as stays of one subject on one day."""
    day = lambda text: F.lit(text).cast("timestamp")
    one = table(spark, sf_dir, "events").select(
        F.lit(1).alias("subject_id"), F.col("event_id").alias("hadm_id"), day("2024-02-01").alias("admit_time"),
        day("2024-01-31").alias("discharge_time"), F.when(F.col("event_id") % 7 < 3, "ELECTIVE").otherwise(F.col("event_type")).alias("admit_type"),
    )
    return _label_columns(cohort.reverse_label(cohort.n_day_label(one, (30.0,))))


@query("readmit_multiclass", f"WITH {STAYS}, {_labelled_sql('stays', THREE_WAY)} {SELECT_LABELS}")
def readmit_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_columns(cohort.n_day_label(stays(spark, sf_dir), (90.0, 30.0)))


EVENT_STAYS = """event_stays AS (
  SELECT user_id AS subject_id, event_id AS hadm_id, ts AS admit_time, ts AS discharge_time,
    CASE WHEN event_type = 'signup' THEN 'ELECTIVE' ELSE event_type END AS admit_type FROM events
)"""


@query("readmit_events", f"WITH {EVENT_STAYS}, {_labelled_sql('event_stays', BINARY)} {SELECT_LABELS}")
def readmit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_columns(cohort.reverse_label(cohort.n_day_label(event_stays(spark, sf_dir), (30.0,))))


@query(
    "readmit_skip_elective",
    f"""WITH {STAYS}, nexts AS (
  SELECT *, first_value(CASE WHEN admit_type <> 'ELECTIVE' THEN admit_time END IGNORE NULLS) OVER w AS readmit_time,
    first_value(CASE WHEN admit_type <> 'ELECTIVE' THEN admit_type END IGNORE NULLS) OVER w AS readmit_type
  FROM stays WINDOW w AS (PARTITION BY subject_id ORDER BY admit_time, hadm_id
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
), labelled AS (
  SELECT *, {BINARY} AS label FROM (
    SELECT *, CAST(date_diff('day', CAST(discharge_time AS DATE), CAST(readmit_time AS DATE)) AS INTEGER) AS readmit_days
    FROM nexts)
) {SELECT_LABELS}""",
)
def readmit_skip_elective(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = cohort.n_day_label(stays(spark, sf_dir), (30.0,), skip_elective=True)
    return _label_columns(cohort.reverse_label(labelled))


@query(
    "cohort_filters",
    f"""WITH {STAYS} SELECT subject_id, hadm_id, admit_type, CAST(CAST(discharge_time AS DATE) AS VARCHAR) AS discharge_day
FROM stays WHERE {COHORT}""",
)
def cohort_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cohort.keep_cohort(stays(spark, sf_dir))
    return kept.select(
        "subject_id", "hadm_id", "admit_type", F.to_date("discharge_time").cast("string").alias("discharge_day")
    )


@query(
    "cohort_profile",
    f"""WITH {STAYS}, {_labelled_sql('stays', BINARY)}, {KEPT_NOTES}
SELECT (SELECT count(*) FROM stays) AS raw_stays, count(*) AS kept_stays, count(readmit_days) AS unplanned,
  count(*) FILTER (WHERE label = 1) AS unplanned_under_30_days,
  (SELECT count(*) FROM conversation_notes) AS notes,
  (SELECT count(DISTINCT (subject_id, hadm_id)) FROM kept_notes) AS combined_notes
FROM labelled WHERE {COHORT}""",
)
def cohort_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, notes = stays(spark, sf_dir), conversation_notes(spark, sf_dir)
    combined = cohort.combine_notes(cohort.discharge_notes(notes))
    return cohort.cohort_profile(raw, cohort.labelled_cohort(raw), notes, combined)


COMBINED = """combined AS (
  SELECT subject_id, hadm_id, string_agg(text, ' ' ORDER BY chart_date, row_id) AS text, count(*) AS notes
  FROM kept_notes GROUP BY subject_id, hadm_id
)"""


@query("notes_combined", f"WITH {KEPT_NOTES}, {COMBINED} SELECT hadm_id, text, CAST(notes AS INTEGER) AS notes FROM combined")
def notes_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = conversation_notes(spark, sf_dir)
    combined = cohort.combine_notes(cohort.discharge_notes(notes))
    return combined.select("hadm_id", "text", "notes")


PART_BYTES = 2000


@query(
    "notes_in_parts",
    f"""WITH {KEPT_NOTES}, cut AS (
  SELECT hadm_id, subject_id, chart_date, row_id, text, 1 + coalesce(sum(octet_length(encode(text)) + 1) OVER (
    PARTITION BY subject_id, hadm_id ORDER BY chart_date, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {PART_BYTES} AS part
  FROM kept_notes
), joined AS (
  SELECT subject_id, hadm_id, CAST(part AS BIGINT) AS part, string_agg(text, ' ' ORDER BY chart_date, row_id) AS text,
    CAST(count(*) AS INTEGER) AS notes FROM cut GROUP BY ALL
) SELECT hadm_id, part, count(*) OVER (PARTITION BY subject_id, hadm_id) = 1 AS is_whole, text, notes FROM joined""",
)
def notes_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined notes in parts of about two thousand bytes."""
    notes = conversation_notes(spark, sf_dir)
    combined = cohort.combine_notes(cohort.discharge_notes(notes), part_bytes=PART_BYTES)
    return combined.select("hadm_id", "part", "is_whole", "text", "notes")


@query(
    "notes_one_admission",
    f"""WITH cut AS (
  SELECT turn, conv_id, text, 1 + coalesce(sum(octet_length(encode(text)) + 1) OVER (
    ORDER BY turn, conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {100 * PART_BYTES} AS part FROM conversations
) SELECT CAST(part AS BIGINT) AS part, string_agg(text, ' ' ORDER BY turn, conv_id) AS text, CAST(count(*) AS INTEGER) AS notes
FROM cut GROUP BY part""",
)
def notes_one_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as notes of one day of one admission, in parts."""
    turns = table(spark, sf_dir, "conversations").select(F.lit(1).alias("hadm_id"), "turn", "conv_id", "text")
    combined = cohort.combine_notes(turns, ["hadm_id"], ["turn", "conv_id"], part_bytes=100 * PART_BYTES)
    return combined.select("part", "text", "notes")


@query(
    "notes_latest",
    f"""WITH {KEPT_NOTES} SELECT hadm_id, text FROM (
  SELECT hadm_id, text, row_number() OVER (PARTITION BY subject_id, hadm_id ORDER BY chart_date DESC, row_id DESC) AS place
  FROM kept_notes) WHERE place = 1""",
)
def notes_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = cohort.discharge_notes(conversation_notes(spark, sf_dir))
    return cohort.latest_notes(notes).select("hadm_id", "text")


@query(
    "note_join",
    f"""WITH {STAYS}, {_labelled_sql('stays', BINARY)}, {KEPT_NOTES}, {COMBINED}
SELECT l.subject_id, l.hadm_id, text, label FROM labelled l JOIN combined c
  ON l.hadm_id = c.hadm_id AND l.subject_id = c.subject_id WHERE {COHORT}""",
)
def note_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = cohort.readmission_dataset(stays(spark, sf_dir), conversation_notes(spark, sf_dir))
    return joined.select("subject_id", "hadm_id", "text", "label")


NOTE_TEXT = f"text || {literal(FOOTER)}"


def _notes_with_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit(FOOTER)).alias("text"))


@query("notes_flatten", rf"SELECT doc_id, regexp_replace({NOTE_TEXT}, '[\r\n]', ' ', 'g') AS text FROM documents")
def notes_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notes_with_footer(spark, sf_dir).withColumn("text", flatten_lines(F.col("text")))


@query(
    "notes_export",
    rf"SELECT doc_id, replace(regexp_replace({NOTE_TEXT}, '[\r\n]', ' ', 'g'), ',', '') AS text FROM documents",
)
def notes_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notes_with_footer(spark, sf_dir).withColumn("text", drop_commas(flatten_lines(F.col("text"))))


@query("notes_crlf", rf"SELECT doc_id, replace({NOTE_TEXT}, E'\r\n', E'\n') AS text FROM documents")
def notes_crlf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notes_with_footer(spark, sf_dir).withColumn("text", unix_lines(F.col("text")))


@query(
    "notes_sample",
    f"SELECT doc_id, source FROM documents WHERE {hash_fraction_sql('sample12345', 'doc_id')} < CAST(0.05 AS DOUBLE)",
)
def notes_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_sample(table(spark, sf_dir, "documents").select("doc_id", "source"), ["doc_id"], 0.05)


@query(
    "split_ratio",
    f"""SELECT o_orderkey, CASE WHEN {hash_fraction_sql('split12345', 'o_orderkey')} < CAST(0.15 AS DOUBLE)
  THEN 'test' ELSE 'train' END AS part FROM orders""",
)
def split_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = sampling.split_ratio(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("folds", f"SELECT o_orderkey, CAST(floor({hash_fraction_sql('fold12345', 'o_orderkey')} * 5) AS INTEGER) AS fold FROM orders")
def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.assign_folds(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with a label: 1 for the returned ones."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
    )
    return spread(lines, "l_orderkey")


LABELS = """line_labels AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label FROM lineitem
), sizes AS (
  SELECT count(*) FILTER (WHERE label = 1) AS positive, count(*) FILTER (WHERE label <> 1) AS other FROM line_labels
)"""
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


@query("class_counts", f'WITH {LABELS} SELECT label, count(*) AS "rows" FROM line_labels GROUP BY label')
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.class_counts(_labels(spark, sf_dir))


@query(
    "balance_matched",
    f"""WITH {LABELS} SELECT line_labels.* FROM line_labels, sizes WHERE label = 1 OR
  {hash_fraction_sql('balance12345', *LINE_KEYS)} < CAST(positive AS DOUBLE) / CAST(other AS DOUBLE)""",
)
def balance_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.balance(_labels(spark, sf_dir), LINE_KEYS)


@query(
    "balance_exact",
    f"""WITH {LABELS}, ranked AS (
  SELECT *, row_number() OVER (ORDER BY CAST('0x' || substr(md5(concat_ws('|', 'balance12345', CAST(l_orderkey AS VARCHAR),
    CAST(l_linenumber AS VARCHAR))), 1, 15) AS BIGINT)) AS place FROM line_labels WHERE label <> 1
) SELECT * FROM line_labels WHERE label = 1
UNION ALL SELECT * EXCLUDE (place) FROM ranked WHERE place <= (SELECT count(*) FROM line_labels WHERE label = 1)""",
)
def balance_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many rows of the other class as there are positive ones, exactly."""
    return sampling.balance_exact(_labels(spark, sf_dir), ["l_orderkey", "l_linenumber"])


@query(
    "negatives_except",
    f"""WITH {LABELS} SELECT l_orderkey, label FROM line_labels
EXCEPT SELECT l_orderkey, label FROM line_labels WHERE label = 1""",
)
def negatives_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.negatives(_labels(spark, sf_dir).select("l_orderkey", "label"), distinct=True)


@query("negatives_filter", f"WITH {LABELS} SELECT * FROM line_labels WHERE label <> 1")
def negatives_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.negatives(_labels(spark, sf_dir))


@query(
    "bags",
    f"""WITH RECURSIVE {LABELS}, means AS (
  SELECT CAST(1 AS DOUBLE) AS label, 400 / CAST(positive AS DOUBLE) AS mean FROM sizes
  UNION ALL SELECT CAST(0 AS DOUBLE), 1000 / CAST(other AS DOUBLE) FROM sizes
), steps AS (
  SELECT label, mean, 0 AS k, exp(-mean) AS probability, exp(-mean) AS below FROM means
  UNION ALL SELECT label, mean, k + 1, probability * (mean / (k + 1)), below + probability * (mean / (k + 1)) FROM steps
  WHERE below < CAST(1 AS DOUBLE) - pow(2, -52) AND k < mean + 8.5 * sqrt(mean) + 20
), draws AS (
  SELECT line_labels.*, bag, row_number() OVER () AS draw, {hash_fraction_sql('bag12345', 'bag', *LINE_KEYS, digits=13)} AS fraction
  FROM line_labels, (SELECT unnest(range(1, 21)) AS bag)
)
SELECT l_orderkey, l_linenumber, l_partkey, d.label, CAST(bag AS INTEGER) AS bag, CAST(count(*) AS INTEGER) AS copies
FROM draws d JOIN steps s ON d.label = s.label AND fraction >= below
GROUP BY draw, l_orderkey, l_linenumber, l_partkey, d.label, bag""",
)
def bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.bags(_labels(spark, sf_dir), LINE_KEYS)


VOTES = f"""{SCORED_DOCUMENTS}, votes AS (
  SELECT * FROM scored_documents UNION ALL
  SELECT subject_id, hadm_id, label, CASE WHEN probability_1 > 0.6 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END,
    probability_0 * probability_0, probability_1 * probability_1 FROM scored_documents
)"""


@query(
    "ensemble_vote",
    f"""WITH {VOTES} SELECT subject_id, hadm_id, label, round(avg(prediction)) AS prediction,
  round(avg(probability_0), 9) AS probability_0, round(avg(probability_1), 9) AS probability_1
FROM votes GROUP BY subject_id, hadm_id, label""",
)
def ensemble_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = scored_documents(spark, sf_dir)
    second = first.withColumns(
        {
            "prediction": (F.col("probability_1") > 0.6).cast("double"),
            "probability_0": F.col("probability_0") * F.col("probability_0"),
            "probability_1": F.col("probability_1") * F.col("probability_1"),
        }
    )
    voted = metrics.ensemble_vote(first.unionByName(second))
    return voted.withColumns({name: F.round(name, 9) for name in ("probability_0", "probability_1")})


@query("confusion", f'WITH {SCORED_DOCUMENTS} SELECT label, prediction, count(*) AS "rows" FROM scored_documents GROUP BY ALL')
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(scored_documents(spark, sf_dir))


LABEL_FIGURES = """label_counts AS (
  SELECT c.label, count(*) FILTER (WHERE s.label = c.label) AS "rows",
    CAST(count(*) FILTER (WHERE s.label = c.label AND s.prediction = c.label) AS DOUBLE) AS hits,
    count(*) FILTER (WHERE s.prediction = c.label) AS predicted
  FROM scored_documents s, (SELECT DISTINCT unnest([label, prediction]) AS label FROM scored_documents) c GROUP BY c.label
), label_metrics AS (
  SELECT label, "rows", precision, recall,
    CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f_score
  FROM (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS precision, coalesce(hits / nullif("rows", 0), 0) AS recall
    FROM label_counts)
)"""
LABEL_METRICS = f"{SCORED_DOCUMENTS}, {LABEL_FIGURES}"
OVERALL = """overall AS (
  SELECT CAST(sum("rows") AS BIGINT) AS "rows", sum(recall * "rows") / sum("rows") AS accuracy,
    sum(precision * "rows") / sum("rows") AS precision, sum(recall * "rows") / sum("rows") AS recall,
    sum(f_score * "rows") / sum("rows") AS f_score FROM label_metrics
)"""


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 9) for name in names})


@query(
    "label_metrics",
    f"""WITH {LABEL_METRICS} SELECT label, "rows", round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(f_score, 9) AS f_score FROM label_metrics""",
)
def label_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.label_metrics(scored_documents(spark, sf_dir)), "precision", "recall", "f_score")


@query(
    "overall_metrics",
    f"""WITH {LABEL_METRICS}, {OVERALL} SELECT "rows", round(accuracy, 9) AS accuracy, round(precision, 9) AS precision,
  round(recall, 9) AS recall, round(f_score, 9) AS f_score FROM overall""",
)
def overall_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.overall_metrics(scored_documents(spark, sf_dir))
    return _rounded(report, "accuracy", "precision", "recall", "f_score")


def _auroc_sql(score: str, positive: int) -> str:
    """Wins of positives over negatives by mean rank."""
    return f"""(SELECT (sum(mean_rank) FILTER (WHERE label = {positive}) - p * (p + 1) / 2) / (p * n)
  FROM (SELECT label, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / CAST(2 AS DOUBLE) AS mean_rank
    FROM scored_documents),
  (SELECT CAST(count(*) FILTER (WHERE label = {positive}) AS DOUBLE) AS p,
    CAST(count(*) FILTER (WHERE label <> {positive}) AS DOUBLE) AS n FROM scored_documents) GROUP BY p, n)"""


@query("auroc", f"WITH {SCORED_DOCUMENTS} SELECT round({_auroc_sql('probability_1', 1)}, 9) AS auroc")
def auroc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.auroc(scored_documents(spark, sf_dir)), "auroc")


def _report_sql(source: str, classes: int) -> str:
    areas = "".join(f"\n  UNION ALL SELECT 'auroc', {i}, {_auroc_sql(f'probability_{i}', i)}" for i in range(classes))
    return f"""WITH {source}, {LABEL_FIGURES}, {OVERALL}
SELECT metric, label, round(value, 9) AS value FROM (
  SELECT 'confusion_predicted_' || CAST(CAST(prediction AS INTEGER) AS VARCHAR) AS metric, label, CAST(count(*) AS DOUBLE) AS value
  FROM scored_documents GROUP BY ALL
  UNION ALL SELECT unnest(['precision', 'recall', 'f_score']), label, unnest([precision, recall, f_score]) FROM label_metrics
  UNION ALL SELECT unnest(['accuracy', 'precision', 'recall', 'f_score']), NULL,
    unnest([accuracy, precision, recall, f_score]) FROM overall{areas}
)"""


@query("metrics_report", _report_sql(SCORED_DOCUMENTS, 2))
def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.metrics_report(scored_documents(spark, sf_dir)), "value")


@query("metrics_report_multiclass", _report_sql(SCORED_BY_THREE, 3))
def metrics_report_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.metrics_report(scored_by_three(spark, sf_dir)), "value")


@query(
    "ensemble_vote_multiclass",
    f"""WITH {SCORED_BY_THREE}, votes AS (
  SELECT * FROM scored_documents UNION ALL
  SELECT subject_id, hadm_id, label, CASE WHEN prediction = 2 THEN CAST(2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END,
    probability_2, probability_1, probability_0 FROM scored_documents
) SELECT subject_id, hadm_id, label, round(avg(prediction)) AS prediction, round(avg(probability_0), 9) AS probability_0,
  round(avg(probability_1), 9) AS probability_1, round(avg(probability_2), 9) AS probability_2
FROM votes GROUP BY subject_id, hadm_id, label""",
)
def ensemble_vote_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = scored_by_three(spark, sf_dir)
    second = first.withColumns({
        "prediction": F.when(F.col("prediction") == 2, 2.0).otherwise(0.0),
        "probability_0": F.col("probability_2"), "probability_2": F.col("probability_0"),
    })
    return _rounded(metrics.ensemble_vote(first.unionByName(second)), *[f"probability_{i}" for i in range(3)])


EMBEDDING_SLOTS = 64


@query(
    "vector_columns",
    "SELECT vec_id, label, " + ", ".join(
        f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS embedding_{i}" for i in range(EMBEDDING_SLOTS)
    ) + " FROM embeddings",
)
def vector_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    wide = split_array(vectors, "embedding", EMBEDDING_SLOTS)
    return wide.withColumns({f"embedding_{i}": F.round(f"embedding_{i}", 6) for i in range(EMBEDDING_SLOTS)})
