"""Queries that count words: tokens, n-grams, vocabularies, TF-IDF and feature vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from notesight.functions.tokens import ngrams, remove_stop_words, word_tokens
from notesight.functions.words import REMOVER_STOP_WORDS
from notesight.config import spread, stage
from notesight.jobs import query
from notesight.jobs.roles import (
    NEGATORS, TRANSCRIPT_HEADERS, TRANSCRIPTS, dictionary, documents, document_notes, hash_fraction_sql, lexicon, transcripts,
    words_sql,
)
from notesight.jobs.text import _section_sql, corrections_sql, porter_sql, scores_sql
from notesight.operators import features, frequent
from notesight.operators.cleaning import add_sections
from notesight.operators.sampling import split_ratio
from notesight.plans.featurizers import Block, Featurizer, featurizer

STOPS = "(" + ", ".join("'" + word.replace("'", "''") + "'" for word in REMOVER_STOP_WORDS) + ")"
TOKENS = f"""tokens AS (
  SELECT doc_id, list_filter({words_sql('text')}, lambda w: w NOT IN {STOPS}) AS ws FROM documents
)"""
SIZE, GRAM_SIZE = 3000, 1000


def _tokens(text: str = "text"):
    return remove_stop_words(word_tokens(F.col(text)))


@query("tokens", f"WITH {TOKENS} SELECT doc_id, array_to_string(ws, ' ') AS tokens, CAST(len(ws) AS INTEGER) AS n FROM tokens")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = documents(spark, sf_dir).select("doc_id", _tokens().alias("tokens"))
    return kept.select("doc_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n"))


BIGRAMS = """bigrams AS (
  SELECT doc_id, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) AS ws FROM tokens
)"""


@query("bigrams", f"WITH {TOKENS}, {BIGRAMS} SELECT doc_id, array_to_string(ws, '|') AS bigrams FROM bigrams")
def bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = ngrams(_tokens(), 2)
    return documents(spark, sf_dir).select("doc_id", F.array_join(grams, "|").alias("bigrams"))


def _vocabulary_sql(name: str, counts: str, size: int) -> str:
    return f"""{name} AS (
  SELECT row_number() OVER (ORDER BY n DESC, term) - 1 AS feature, term AS value, n FROM {counts} ORDER BY n DESC, term LIMIT {size}
)"""


def _counts_sql(name: str, source: str) -> str:
    return f"{name} AS (SELECT term, count(*) AS n FROM (SELECT unnest(ws) AS term FROM {source}) GROUP BY term)"


@query("vocabulary", f"WITH {TOKENS}, {_counts_sql('counts', 'tokens')}, {_vocabulary_sql('vocabulary', 'counts', SIZE)} SELECT * FROM vocabulary")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = features.corpus_counts(documents(spark, sf_dir), "text", stem=False)
    return features.vocabulary(counts, SIZE)


STEMMED_COUNTS = f"""words AS (
  SELECT term, count(*) AS n FROM (SELECT unnest({words_sql('text')}) AS term FROM documents) GROUP BY term
), {porter_sql('words')}, stemmed AS (
  SELECT stem AS term, CAST(sum(n) AS BIGINT) AS n FROM words JOIN stems USING (term) WHERE stem NOT IN {STOPS} GROUP BY stem
)"""


@query("stem_vocabulary", f"WITH {STEMMED_COUNTS}, {_vocabulary_sql('vocabulary', 'stemmed', SIZE)} SELECT * FROM vocabulary")
def stem_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.vocabulary(features.corpus_counts(documents(spark, sf_dir), "text"), SIZE)


TERM_COUNTS = "document_counts AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS term FROM tokens) GROUP BY ALL)"


@query(
    "bigram_top",
    f"WITH {TOKENS}, {BIGRAMS}, {_counts_sql('counts', 'bigrams')} SELECT term, n FROM counts ORDER BY n DESC, term LIMIT {GRAM_SIZE}",
)
def bigram_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent bigrams, without a shuffle of all of them."""
    return frequent.most_frequent(documents(spark, sf_dir), ngrams(_tokens(), 2), GRAM_SIZE)


@query(
    "term_counts",
    f"""WITH {TOKENS}, {_counts_sql('counts', 'tokens')}, {_vocabulary_sql('vocabulary', 'counts', SIZE)}, {TERM_COUNTS}
SELECT doc_id, feature, d.n FROM document_counts d JOIN vocabulary v ON v.value = d.term""",
)
def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_counts(documents(spark, sf_dir))


def _feature_counts(rows: DataFrame) -> DataFrame:
    return features.vocabulary_counts(rows, ["doc_id"], _tokens(), SIZE)


@query(
    "tfidf",
    f"""WITH {TOKENS}, {_counts_sql('counts', 'tokens')}, {_vocabulary_sql('vocabulary', 'counts', SIZE)}, {TERM_COUNTS}, found AS (
  SELECT doc_id, feature, d.n FROM document_counts d JOIN vocabulary v ON v.value = d.term
), weights AS (
  SELECT feature, ln(((SELECT count(*) FROM documents) + CAST(1 AS DOUBLE)) / (count(*) + CAST(1 AS DOUBLE))) AS idf FROM found GROUP BY feature
) SELECT doc_id, feature, n, round(n * idf, 6) AS value FROM found JOIN weights USING (feature)""",
)
def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    weighted = features.tfidf(_feature_counts(rows), rows, SIZE)
    return weighted.select("doc_id", "feature", "n", F.round("value", 6).alias("value"))


@query(
    "ngram_counts",
    f"""WITH {TOKENS}, {BIGRAMS}, {_counts_sql('counts', 'bigrams')}, {_vocabulary_sql('vocabulary', 'counts', GRAM_SIZE)}
SELECT doc_id, feature, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS term FROM bigrams) d
JOIN vocabulary v ON v.value = d.term GROUP BY doc_id, feature""",
)
def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    return features.vocabulary_counts(rows, ["doc_id"], ngrams(_tokens(), 2), GRAM_SIZE, summarized=True)


@query(
    "section_counts",
    f"WITH {TRANSCRIPTS}, cut AS (SELECT hadm_id, "
    + ", ".join(f"{_section_sql(header)} AS {name}" for name, header in TRANSCRIPT_HEADERS.items())
    + f""" FROM transcripts), long AS (
  SELECT hadm_id, unnest({list(TRANSCRIPT_HEADERS)}) AS section, unnest([{', '.join(TRANSCRIPT_HEADERS)}]) AS text FROM cut
), tokens AS (
  SELECT hadm_id, section, unnest(list_filter({words_sql('text')}, lambda w: w NOT IN {STOPS})) AS term FROM long WHERE text IS NOT NULL
) SELECT hadm_id, section, term, count(*) AS n FROM tokens GROUP BY ALL""",
)
def section_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = add_sections(transcripts(spark, sf_dir), headers=TRANSCRIPT_HEADERS)
    long = cut.select("hadm_id", F.explode(F.array(*[
        F.struct(F.lit(name).alias("section"), F.col(name).alias("text")) for name in TRANSCRIPT_HEADERS
    ])).alias("cut")).select("hadm_id", "cut.*")
    return features.term_counts(long, ["hadm_id", "section"], _tokens())


# --- feature vectors, shown as a slot count and a sum per row


def _long(vectors: DataFrame, places: int = 6) -> DataFrame:
    """(doc_id, feature, value): the non-zero slots of a vector column."""
    slots = vectors.select("subject_id", F.posexplode(vector_to_array("features")).alias("feature", "value"))
    return slots.filter("value != 0").select(
        F.col("subject_id").alias("doc_id"), F.col("feature").cast("bigint").alias("feature"), F.round("value", places).alias("value")
    )


DOCUMENT_WORDS = f"""placed AS (SELECT doc_id, unnest({words_sql('text')}) AS term FROM documents
), words AS (SELECT DISTINCT term FROM placed), {porter_sql('words')}, kept AS (
  SELECT doc_id, stem AS term, count(*) AS n FROM placed JOIN stems USING (term) WHERE stem NOT IN {STOPS} GROUP BY ALL
), totals AS (SELECT term, CAST(sum(n) AS BIGINT) AS n FROM kept GROUP BY term)"""


@query(
    "bow_vectors",
    f"""WITH {DOCUMENT_WORDS}, {_vocabulary_sql('vocabulary', 'totals', SIZE)}
SELECT doc_id, feature, CAST(k.n AS DOUBLE) AS value FROM kept k JOIN vocabulary v ON v.value = k.term""",
)
def bow_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_notes(spark, sf_dir)
    return _long(featurizer("bag_of_words").fit(rows).transform(rows))


IS_TEST = f"{hash_fraction_sql('split12345', 'doc_id', 'doc_id')} < CAST(0.15 AS DOUBLE)"


@query(
    "bow_vectors_held_out",
    f"""WITH {DOCUMENT_WORDS.replace('SELECT term, CAST(sum(n) AS BIGINT) AS n FROM kept', f'SELECT term, CAST(sum(n) AS BIGINT) AS n FROM kept WHERE NOT ({IS_TEST})')},
  {_vocabulary_sql('vocabulary', 'totals', SIZE)}
SELECT doc_id, feature, CAST(k.n AS DOUBLE) AS value FROM kept k JOIN vocabulary v ON v.value = k.term WHERE {IS_TEST}""",
)
def bow_vectors_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the training documents, applied to the others."""
    train, test = split_ratio(document_notes(spark, sf_dir), ["subject_id", "hadm_id"])
    return _long(featurizer("bag_of_words").fit(train).transform(test))


@query(
    "tfidf_vectors",
    f"""WITH kept AS (SELECT doc_id, term, count(*) AS n FROM (
    SELECT doc_id, unnest({words_sql('text')}) AS term FROM documents) WHERE term NOT IN {STOPS} GROUP BY ALL
), totals AS (SELECT term, CAST(sum(n) AS BIGINT) AS n FROM kept GROUP BY term), {_vocabulary_sql('vocabulary', 'totals', SIZE)}, found AS (
  SELECT doc_id, feature, k.n FROM kept k JOIN vocabulary v ON v.value = k.term
), weights AS (
  SELECT feature, ln(((SELECT count(*) FROM documents) + CAST(1 AS DOUBLE)) / (count(*) + CAST(1 AS DOUBLE))) AS idf
  FROM found GROUP BY feature
) SELECT doc_id, feature, round(n * idf, 6) AS value FROM found JOIN weights USING (feature) WHERE n * idf <> 0""",
)
def tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_notes(spark, sf_dir)
    return _long(featurizer("tf_idf").fit(rows).transform(rows))


@query(
    "ngram_vectors",
    f"""WITH training AS (SELECT doc_id, {words_sql('text')} AS ws FROM documents
), placed AS (SELECT doc_id, ws[place] AS term, place FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS place FROM training)
), words AS (SELECT DISTINCT term FROM placed), {porter_sql('words')}, kept AS (
  SELECT doc_id, stem, lead(stem) OVER (PARTITION BY doc_id ORDER BY place) AS following
  FROM placed JOIN stems USING (term) WHERE stem NOT IN {STOPS}
), ones AS (SELECT stem AS term, count(*) AS n FROM kept GROUP BY ALL
), twos AS (SELECT stem || ' ' || following AS term, count(*) AS n FROM kept WHERE following IS NOT NULL GROUP BY ALL
), {_vocabulary_sql('first', 'ones', SIZE)}, {_vocabulary_sql('second', 'twos', GRAM_SIZE)}
SELECT doc_id, feature, CAST(count(*) AS DOUBLE) AS value FROM (
  SELECT doc_id, feature FROM kept JOIN first ON stem = value
  UNION ALL SELECT doc_id, feature + (SELECT count(*) FROM first) FROM kept JOIN second ON stem || ' ' || following = value)
GROUP BY ALL""",
)
def ngram_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_notes(spark, sf_dir)
    return _long(featurizer("ngrams").fit(rows).transform(rows))


SECTION_COLUMNS = ["text", *TRANSCRIPT_HEADERS]


@query(
    "section_vectors",
    f"WITH {TRANSCRIPTS}, cut AS (SELECT hadm_id, text, "
    + ", ".join(f"{_section_sql(header)} AS {name}" for name, header in TRANSCRIPT_HEADERS.items())
    + f""" FROM transcripts), long AS (
  SELECT hadm_id, unnest(range(0, {len(SECTION_COLUMNS)})) AS section, unnest([{', '.join(SECTION_COLUMNS)}]) AS text FROM cut
), listed AS (SELECT hadm_id, section, {words_sql('text')} AS ws FROM long WHERE text IS NOT NULL
), placed AS (SELECT hadm_id, section, ws[place] AS term, place FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS place FROM listed)
), words AS (SELECT DISTINCT term FROM placed), {porter_sql('words')}, kept AS (
  SELECT hadm_id, section, stem, lead(stem) OVER (PARTITION BY hadm_id, section ORDER BY place) AS following
  FROM placed JOIN stems USING (term) WHERE stem NOT IN {STOPS}
), grams AS (
  SELECT hadm_id, 2 * section AS block, stem AS gram FROM kept
  UNION ALL SELECT hadm_id, 2 * section + 1, stem || ' ' || following FROM kept WHERE following IS NOT NULL
), ranked AS (
  SELECT block, gram, row_number() OVER (PARTITION BY block ORDER BY n DESC, gram) AS place
  FROM (SELECT block, gram, count(*) AS n FROM grams GROUP BY ALL)
), known AS (SELECT * FROM ranked WHERE place <= CASE WHEN block % 2 = 0 THEN 2000 ELSE 1000 END
), numbered AS (SELECT block, gram, row_number() OVER (ORDER BY block, place) - 1 AS feature FROM known)
SELECT hadm_id AS doc_id, feature, CAST(count(*) AS DOUBLE) AS value FROM grams JOIN numbered USING (block, gram) GROUP BY ALL""",
)
def section_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = add_sections(transcripts(spark, sf_dir), headers=TRANSCRIPT_HEADERS)
    # as in a run, the combined notes are written before the featurizer reads them
    rows = spread(stage(cut.withColumn("subject_id", F.col("hadm_id"))), "hadm_id")
    blocks = [Block(name, n, size) for name in SECTION_COLUMNS for n, size in ((1, 2000), (2, 1000))]
    return _long(Featurizer("section_bow", tuple(blocks)).fit(rows).transform(rows))


@query("word2vec")
def word2vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_notes(spark, sf_dir)
    return _long(featurizer("word2vec").fit(rows).transform(rows), 4)


@query(
    "complex_vectors",
    f"""WITH {corrections_sql('documents')}, kept AS (
  SELECT doc_id, corrected AS term, count(*) AS n FROM (SELECT doc_id, unnest({words_sql('text')}) AS term FROM documents)
  JOIN corrections USING (term) WHERE corrected NOT IN {STOPS} GROUP BY ALL
), totals AS (SELECT term, CAST(sum(n) AS BIGINT) AS n FROM kept GROUP BY term
), {_vocabulary_sql('vocabulary', 'totals', 1000)}, {scores_sql('documents')}
SELECT doc_id, feature, CAST(k.n AS DOUBLE) AS value FROM kept k JOIN vocabulary v ON v.value = k.term
UNION ALL SELECT doc_id, (SELECT count(*) FROM vocabulary), sum(score) FROM scores GROUP BY doc_id HAVING sum(score) <> 0""",
)
def complex_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_notes(spark, sf_dir)
    plan = featurizer(
        "complex_bow", dictionary=dictionary(spark, sf_dir), lexicon=lexicon(spark), negators=NEGATORS
    )
    return _long(plan.fit(rows).transform(rows))


@query(
    "feature_map",
    f"WITH {DOCUMENT_WORDS}, {_vocabulary_sql('vocabulary', 'totals', SIZE)} SELECT feature, value FROM vocabulary",
)
def feature_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featurizer("bag_of_words").fit(document_notes(spark, sf_dir)).feature_map(spark)
