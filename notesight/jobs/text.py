"""Queries that clean, cut and match text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from notesight.functions import cleaning, words
from notesight.functions.stemmer import (
    DOUBLE_CONSONANT, HAS_VOWEL, MEASURE_1, MEASURE_1_UP, MEASURE_2_UP, SHORT_SYLLABLE, STEP_2, STEP_3,
    STEP_4, stem_text,
)
from notesight.functions.tokens import word_tokens
from notesight.jobs import query
from notesight.jobs.roles import (
    CLINICAL_NOTES, LEXICON_SQL, NEGATORS, TRANSCRIPT_HEADERS, TRANSCRIPTS, clinical_notes, DICTIONARY, dictionary,
    documents, lexicon, transcripts, words_sql,
)
from notesight.operators import abbreviations, cleaning as cleaning_jobs, terms

# --- the cleaning rules in SQL, over an expression


def _list(values: Sequence[str]) -> str:
    return "[" + ", ".join("'" + value.replace("'", "''") + "'" for value in values) + "]"


def _keep(text: str, condition: str) -> str:
    split = rf"regexp_split_to_array({text}, '[\s\x0b\x1c-\x1f\x85\p{{Z}}]+')"
    return f"array_to_string(list_filter({split}, lambda w: w <> '' AND {condition}), ' ')"


def _blank(text: str, pattern: str) -> str:
    return f"regexp_replace({text}, '{pattern}', ' ', 'g')"


def _any(parts: Sequence[str]) -> str:
    return "(?:" + "|".join(parts) + ")"


def _bounded(parts: Sequence[str]) -> str:
    return r"\b" + _any(parts) + r"\b"


SQL_STEPS = {
    "drop_stop_words": lambda t: _keep(t, f"NOT list_contains({_list(words.STOP_WORDS)}, w)"),
    "drop_brackets": lambda t: _blank(t, r"\[.*?\]"),
    "letters_only": lambda t: _blank(t, "[^a-zA-Z]+"),
    "squeeze_spaces": lambda t: f"trim({_blank(t, r'[[:space:]]+')})",
    "lower": lambda t: f"lower({t})",
    "drop_short_words": lambda t: _keep(t, "length(w) > 1"),
    "drop_custom_words": lambda t: _keep(t, f"NOT list_contains({_list(words.CUSTOM_WORDS)}, w)"),
    "drop_frequencies": lambda t: _blank(t, _any((*words.FREQUENCY_PHRASES, _bounded(words.FREQUENCY_WORDS)))),
    "drop_doses": lambda t: _blank(t, _bounded((*words.DOSE_UNITS, "po"))),
    "drop_numbers": lambda t: _blank(t, _bounded(words.NUMBER_WORDS)),
    "drop_form_words": lambda t: _blank(t, _any(words.FORM_WORDS)),
    "drop_date_headings": lambda t: _blank(t, _any(words.DATE_HEADINGS)),
    "drop_clock_times": lambda t: _blank(t, _any(words.CLOCK_TIMES)),
    "drop_marks": lambda t: _blank(t, r"\[\*\*[^*]+\*\*\]"),
    "drop_lab_units": lambda t: _blank(t, _any(words.LAB_UNITS)),
    "drop_frequencies_anywhere": lambda t: _blank(t, _any((*words.FREQUENCY_PHRASES, "daily"))),
    "drop_doses_anywhere": lambda t: _blank(t, _any(words.DOSE_UNITS)),
    "drop_numbers_anywhere": lambda t: _blank(t, _any(words.NUMBER_WORDS)),
    "lower_letters_only": lambda t: _blank(t, "[^a-z]"),
    "squeeze_blanks": lambda t: _blank(t, " +"),
}
NOTE_STEP_NAMES = (
    "drop_stop_words drop_brackets letters_only squeeze_spaces lower drop_short_words drop_custom_words "
    "drop_frequencies drop_doses drop_numbers squeeze_spaces"
).split()
PLAIN_STEP_NAMES = (
    "lower drop_form_words drop_date_headings drop_clock_times drop_marks drop_lab_units "
    "drop_frequencies_anywhere drop_doses_anywhere drop_numbers_anywhere lower_letters_only squeeze_blanks"
).split()


def _clean_query(name: str, steps: Sequence[str]) -> None:
    """A query that runs some cleaning steps over the clinical notes."""
    text = "text"
    for step in steps:
        text = SQL_STEPS[step](text)
    chain = [F.lower if step == "lower" else getattr(cleaning, step) for step in steps]

    @query(name, f"WITH {CLINICAL_NOTES} SELECT doc_id, {text} AS text FROM clinical_notes")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return cleaning_jobs.clean(clinical_notes(spark, sf_dir), ["text"], chain)


_clean_query("clean_stopwords", ["drop_stop_words"])
_clean_query("clean_brackets", ["drop_brackets"])
_clean_query("clean_letters", ["letters_only", "squeeze_spaces", "lower"])
_clean_query("clean_short_words", ["letters_only", "lower", "drop_short_words", "drop_custom_words"])
_clean_query("clean_medication", ["letters_only", "lower", "drop_frequencies"])
_clean_query("clean_units", ["letters_only", "lower", "drop_doses"])
_clean_query("clean_numbers", ["letters_only", "lower", "drop_numbers"])
_clean_query("clean_form_words", ["lower", "drop_form_words"])
_clean_query("clean_dates", ["lower", "drop_date_headings", "drop_clock_times"])
_clean_query("clean_deid", ["drop_marks"])
_clean_query("clean_lab_units", ["lower", "drop_lab_units", "drop_frequencies_anywhere", "drop_doses_anywhere"])
_clean_query("clean_notes", NOTE_STEP_NAMES)
_clean_query("clean_notes_alt", PLAIN_STEP_NAMES)


def _section_sql(header: str) -> str:
    match = rf"regexp_extract(lower(text), '\n\n(?:{header}).*?\n\n', 0, 's')"
    start = f"strpos({match}, ':') + 2"
    return f"CASE WHEN {match} <> '' THEN substr({match}, {start}, greatest(length({match}) - ({start}) - 1, 0)) END"


@query(
    "sections",
    f"WITH {TRANSCRIPTS} SELECT hadm_id, "
    + ", ".join(f"{_section_sql(header)} AS {name}" for name, header in TRANSCRIPT_HEADERS.items())
    + " FROM transcripts",
)
def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cleaning_jobs.add_sections(transcripts(spark, sf_dir), headers=TRANSCRIPT_HEADERS)
    return cut.select("hadm_id", *TRANSCRIPT_HEADERS)


DISCHARGE_NOTES = r"""discharge AS (
  SELECT hadm_id, text || E'\n\nCondition at Discharge: ' || hadm_id || E' stable\n\nDischarge Diagnoses:\n' ||
    substr(text, 3) || E'\n\nDischarge Status:\n\nDischarge Medications: ' || hadm_id AS text FROM transcripts
)"""


@query(
    "discharge_sections",
    f"WITH {TRANSCRIPTS}, {DISCHARGE_NOTES} SELECT hadm_id, "
    + ", ".join(f"{_section_sql(header)} AS {name}" for name, header in words.SECTION_HEADERS.items())
    + " FROM discharge",
)
def discharge_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("hadm_id").cast("string")
    text = F.concat(
        "text", F.lit("\n\nCondition at Discharge: "), number, F.lit(" stable\n\nDischarge Diagnoses:\n"),
        F.substr("text", F.lit(3)), F.lit("\n\nDischarge Status:\n\nDischarge Medications: "), number,
    )
    notes = transcripts(spark, sf_dir).withColumn("text", text)
    return cleaning_jobs.add_sections(notes).select("hadm_id", *words.SECTION_HEADERS)


@query(
    "term_match",
    # the terms are runs of letters, so an occurrence lies within one run of letters, and distinct runs are looked at once
    f"""WITH {DICTIONARY}, numbered AS (
  SELECT doc_id, runs[place] AS run, place FROM (SELECT doc_id, runs, unnest(range(1, len(runs) + 1)) AS place FROM (
    SELECT doc_id, regexp_extract_all(text, '[a-z]+') AS runs FROM documents))
), starts AS (
  SELECT run, unnest(range(1, length(run) + 1)) AS start FROM (SELECT DISTINCT run FROM numbered)
), pieces AS (
  SELECT run, start + size - 1 AS finish, size, substr(run, start, size) AS term
  FROM starts CROSS JOIN (SELECT DISTINCT length(term) AS size FROM dictionary) WHERE start + size - 1 <= length(run)
), inside AS (SELECT run, finish, size, term FROM pieces JOIN dictionary USING (term))
SELECT doc_id, coalesce(terms, '') AS terms FROM documents LEFT JOIN (
  SELECT doc_id, string_agg(term, ' ' ORDER BY place, finish, size DESC) AS terms FROM numbered JOIN inside USING (run)
  GROUP BY doc_id) USING (doc_id)""",
)
def term_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.match_terms(documents(spark, sf_dir), dictionary(spark, sf_dir), ["doc_id"])


@query(
    "term_match_words",
    f"""WITH {DICTIONARY}, numbered AS (
  SELECT doc_id, runs, unnest(range(1, len(runs) + 1)) AS place FROM (
    SELECT doc_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+') AS runs FROM documents)
)
SELECT doc_id, coalesce(terms, '') AS terms FROM documents LEFT JOIN (
  SELECT doc_id, string_agg(term, ' ' ORDER BY place) AS terms FROM numbered JOIN dictionary ON term = runs[place]
  GROUP BY doc_id) USING (doc_id)""",
)
def term_match_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.match_terms(documents(spark, sf_dir), dictionary(spark, sf_dir), ["doc_id"], whole_words=True)


@query(
    "term_match_long_list",
    f"""WITH numbered AS (
  SELECT doc_id, runs, unnest(range(1, len(runs) + 1)) AS place FROM (
    SELECT doc_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+') AS runs FROM documents)
), listed AS (SELECT DISTINCT runs[place] AS term FROM numbered WHERE length(runs[place]) % 4 = 0)
SELECT doc_id, coalesce(terms, '') AS terms FROM documents LEFT JOIN (
  SELECT doc_id, string_agg(term, ' ' ORDER BY place) AS terms FROM numbered JOIN listed ON term = runs[place]
  GROUP BY doc_id) USING (doc_id)""",
)
def term_match_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the texts with four, eight, .. letters as a list, which is joined whatever its size."""
    rows = documents(spark, sf_dir)
    runs = rows.select(F.explode(F.regexp_extract_all("text", F.lit(r"([\p{L}\p{N}]+)"))).alias("term"))
    listed = runs.filter(F.length("term") % 4 == 0).distinct()
    return terms.match_terms(rows, listed, ["doc_id"], whole_words=True, max_pattern=0)


@query(
    "dictionary_words",
    rf"""WITH {DICTIONARY} SELECT doc_id,
  coalesce(string_agg(word, ' ' ORDER BY word) FILTER (WHERE term IS NOT NULL), '') AS words
FROM (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
LEFT JOIN dictionary ON term = word GROUP BY doc_id""",
)
def dictionary_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.dictionary_words(documents(spark, sf_dir), dictionary(spark, sf_dir), ["doc_id"])


def sentences_sql(source: str) -> str:
    return rf"""sentences AS (
  SELECT doc_id, CAST(place - 1 AS INTEGER) AS sentence_no, pieces[place] AS sentence FROM (
    SELECT doc_id, pieces, unnest(range(1, len(pieces) + 1)) AS place FROM (
      SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', E'\\1\x01', 'g'), E'\x01'), lambda piece: piece <> '') AS pieces
      FROM {source}))
)"""


def scores_sql(source: str) -> str:
    """scores(doc_id, sentence_no, score) of the texts of a table."""
    return f"""{sentences_sql(source)}, {LEXICON_SQL}, sentence_words AS (
  SELECT doc_id, sentence_no, {words_sql('sentence')} AS ws FROM sentences
), sentence_places AS (
  SELECT doc_id, sentence_no, ws, unnest(range(1, len(ws) + 1)) AS place FROM sentence_words
), polarities AS (
  SELECT doc_id, sentence_no, sum(polarity * CASE WHEN place > 1 AND ws[place - 1] IN ({', '.join(f"'{n}'" for n in NEGATORS)})
    THEN -1 ELSE 1 END) AS score
  FROM sentence_places JOIN lexicon ON term = ws[place] GROUP BY doc_id, sentence_no
), scores AS (
  SELECT doc_id, sentence_no, CAST(coalesce(score, 0) AS DOUBLE) AS score
  FROM sentence_words LEFT JOIN polarities USING (doc_id, sentence_no)
)"""


@query("sentences", f"WITH {sentences_sql('documents')} SELECT * FROM sentences")
def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.sentence_rows(documents(spark, sf_dir), ["doc_id"])


ABBREVIATIONS = f"""{CLINICAL_NOTES}, found AS (
  SELECT unnest(regexp_extract_all(lower(text), '[a-z]+(?:\\.[a-z]+)*\\.?')) AS found FROM clinical_notes
), word_counts AS (
  SELECT rtrim(found, '.') AS word, count(*) AS n, count(*) FILTER (WHERE found LIKE '%.') AS dotted FROM found GROUP BY ALL
), shares AS (SELECT sum(dotted) / sum(n) AS share FROM word_counts), rated AS (
  SELECT word, n, dotted, length(replace(word, '.', '')) AS letters, length(word) - length(replace(word, '.', '')) AS periods,
    2 * (dotted * ln(0.99::DOUBLE) + (n - dotted) * ln(1 - 0.99::DOUBLE) - dotted * ln(share) - (n - dotted) * ln(1 - share)) AS ratio
  FROM word_counts, shares WHERE dotted > 0
), abbreviations AS (
  SELECT word, n, dotted, ratio * (periods + 1) * exp(-letters::DOUBLE) * pow(letters::DOUBLE, -(n - dotted)::DOUBLE) AS score FROM rated
  WHERE ratio * (periods + 1) * exp(-letters::DOUBLE) * pow(letters::DOUBLE, -(n - dotted)::DOUBLE) >= 0.3
)"""


@query("abbreviations", f"WITH {ABBREVIATIONS} SELECT word, n, dotted, round(score, 4) AS score FROM abbreviations")
def abbreviation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the notes that are abbreviations by their periods."""
    return abbreviations.abbreviations(clinical_notes(spark, sf_dir)).withColumn("score", F.round("score", 4))


@query(
    "sentences_known",
    rf"""WITH {ABBREVIATIONS}, {sentences_sql('clinical_notes')}, ends AS (
  SELECT *, regexp_extract(lower(sentence), '([a-z]+(?:\.[a-z]+)*)\.\z', 1) IN (SELECT word FROM abbreviations) AS goes_on FROM sentences
), numbered AS (
  SELECT *, coalesce(sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (
    PARTITION BY doc_id ORDER BY sentence_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS number FROM ends
) SELECT doc_id, CAST(number AS INTEGER) AS sentence_no, string_agg(sentence, ' ' ORDER BY n.sentence_no) AS sentence
FROM numbered n GROUP BY doc_id, number""",
)
def sentences_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences that do not end after an abbreviation."""
    return abbreviations.sentence_rows(clinical_notes(spark, sf_dir), ["doc_id"])


@query("sentence_sentiment", f"WITH {scores_sql('documents')} SELECT * FROM scores")
def sentence_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.sentence_sentiment(documents(spark, sf_dir), lexicon(spark), NEGATORS, ["doc_id"])


def _deletions_sql(name: str, source: str) -> str:
    """{name}(term, part): the words of a table with none, one or two letters left out."""
    less = lambda table: f"""SELECT DISTINCT term, substr(part, 1, i - 1) || substr(part, i + 1) AS part
    FROM (SELECT term, part, unnest(range(1, length(part) + 1)) AS i FROM {table})"""  # noqa: E731
    return f"""{name}_0 AS MATERIALIZED (SELECT term, term AS part FROM {source}), {name}_1 AS MATERIALIZED ({less(f'{name}_0')}),
  {name}_2 AS MATERIALIZED ({less(f'{name}_1')}),
  {name} AS MATERIALIZED (SELECT * FROM {name}_0 UNION SELECT * FROM {name}_1 UNION SELECT * FROM {name}_2)"""


def corrections_sql(source: str) -> str:
    """corrections(term, corrected, distance) of the words of a table's texts: words at most two changes apart are equal
    with at most two letters left out of each."""
    return f"""{DICTIONARY}, tokens AS MATERIALIZED (
  SELECT DISTINCT unnest({words_sql('text')}) AS term FROM {source}
), unknown AS MATERIALIZED (
  SELECT term FROM tokens ANTI JOIN dictionary USING (term) WHERE length(term) <= (SELECT max(length(term)) + 2 FROM dictionary)
), {_deletions_sql('token_parts', 'unknown')}, {_deletions_sql('known_parts', 'dictionary')}, pairs AS MATERIALIZED (
  SELECT DISTINCT t.term, k.term AS candidate FROM token_parts t JOIN known_parts k USING (part)
), near AS MATERIALIZED (
  SELECT p.term, candidate, d.n, levenshtein(p.term, candidate) AS distance FROM pairs p JOIN dictionary d ON d.term = candidate
), best AS (
  SELECT term, candidate AS corrected, CAST(distance AS INTEGER) AS distance FROM (
    SELECT *, row_number() OVER (PARTITION BY term ORDER BY distance, n DESC, candidate) AS place
    FROM near WHERE distance <= 2) WHERE place = 1
  UNION ALL SELECT term, term, 0 FROM dictionary
), corrections AS (
  SELECT term, coalesce(corrected, term) AS corrected, distance FROM tokens LEFT JOIN best USING (term)
)"""


@query("spell_correct", f"WITH {corrections_sql('documents')} SELECT * FROM corrections")
def spell_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = terms.token_counts(documents(spark, sf_dir), word_tokens(F.col("text")))
    return terms.correct_spelling(counts, dictionary(spark, sf_dir))


# --- Porter's algorithm in SQL: a chain of common table expressions over distinct words


def porter_sql(source: str) -> str:
    """CTEs that end in stems(term, stem) for source(term)."""
    has = lambda text, pattern: f"regexp_matches({text}, '{pattern}')"
    cut = lambda text, count: f"substr({text}, 1, length({text}) - {count})"

    def suffix_step(name: str, before: str, endings: dict[str, str], measure: str, extra: str = "TRUE") -> str:
        pattern = "(" + "|".join(endings) + ")$"
        cases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in endings.items())
        return f"""{name}_found AS MATERIALIZED (SELECT term, w, suffix, substr(w, 1, length(w) - length(suffix)) AS root
    FROM (SELECT term, w, regexp_extract(w, '{pattern}', 1) AS suffix FROM {before})),
  {name} AS MATERIALIZED (SELECT term, CASE WHEN suffix <> '' AND {has('root', measure)} AND {extra}
    THEN root || CASE suffix {cases} END ELSE w END AS w FROM {name}_found)"""

    return f"""p0 AS MATERIALIZED (SELECT term, regexp_replace(term, '^y', 'Y') AS w FROM {source}),
  p1 AS MATERIALIZED (SELECT term, CASE WHEN w LIKE '%sses' OR w LIKE '%ies' THEN {cut('w', 2)} WHEN w LIKE '%ss' THEN w
    WHEN w LIKE '%s' THEN {cut('w', 1)} ELSE w END AS w FROM p0),
  p2 AS MATERIALIZED (SELECT term, w, CASE WHEN w LIKE '%eed' THEN NULL
    WHEN w LIKE '%ed' AND {has(cut('w', 2), HAS_VOWEL)} THEN {cut('w', 2)}
    WHEN w LIKE '%ing' AND {has(cut('w', 3), HAS_VOWEL)} THEN {cut('w', 3)} END AS root FROM p1),
  p3 AS MATERIALIZED (SELECT term, CASE WHEN w LIKE '%eed' THEN CASE WHEN {has(cut('w', 3), MEASURE_1_UP)} THEN {cut('w', 1)} ELSE w END
    WHEN root IS NULL THEN w
    WHEN {has('root', '(at|bl|iz)$')} OR {has('root', SHORT_SYLLABLE)} THEN root || 'e'
    WHEN {has('root', DOUBLE_CONSONANT)} THEN {cut('root', 1)} ELSE root END AS w FROM p2),
  p4 AS MATERIALIZED (SELECT term, CASE WHEN w LIKE '%y' AND {has(cut('w', 1), HAS_VOWEL)} THEN {cut('w', 1)} || 'i' ELSE w END AS w FROM p3),
  {suffix_step('p5', 'p4', STEP_2, MEASURE_1_UP)},
  {suffix_step('p6', 'p5', STEP_3, MEASURE_1_UP)},
  {suffix_step('p7', 'p6', {ending: '' for ending in STEP_4}, MEASURE_2_UP, "(suffix <> 'ion' OR root LIKE '%s' OR root LIKE '%t')")},
  p8 AS MATERIALIZED (SELECT term, CASE WHEN w LIKE '%e' AND ({has(cut('w', 1), MEASURE_2_UP)} OR
      ({has(cut('w', 1), MEASURE_1)} AND NOT {has(cut('w', 1), SHORT_SYLLABLE)})) THEN {cut('w', 1)} ELSE w END AS w FROM p7),
  p9 AS MATERIALIZED (SELECT term, CASE WHEN w LIKE '%ll' AND {has('w', MEASURE_2_UP)} THEN {cut('w', 1)} ELSE w END AS w FROM p8),
  stems AS MATERIALIZED (SELECT term, CASE WHEN length(term) > 2 THEN lower(w) ELSE term END AS stem FROM p9)"""


@query(
    "stems",
    f"""WITH words AS MATERIALIZED (
  SELECT term, count(*) AS n FROM (SELECT unnest({words_sql('text')}) AS term FROM documents) GROUP BY term
), {porter_sql('words')} SELECT term, n, stem FROM words JOIN stems USING (term)""",
)
def stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = terms.token_counts(documents(spark, sf_dir), word_tokens(F.col("text")))
    return counts.withColumn("stem", stem_text(F.col("term")))


@query(
    "stemmed_text",
    rf"""WITH places AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS place FROM (
    SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^a-z]+', ' ', 'g'), '\s+'), lambda w: w <> '') AS ws
    FROM documents)
), words AS (SELECT DISTINCT ws[place] AS term FROM places), {porter_sql('words')}, joined AS (
  SELECT doc_id, string_agg(stem, ' ' ORDER BY place) AS text FROM places JOIN stems ON term = ws[place] GROUP BY doc_id
) SELECT doc_id, coalesce(j.text, '') AS text FROM documents LEFT JOIN joined j USING (doc_id)""",
)
def stemmed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = cleaning_jobs.clean(documents(spark, sf_dir), ["text"], [F.lower, cleaning.letters_only])
    return cleaning_jobs.stem_columns(lowered, ["text"])
