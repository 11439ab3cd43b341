import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from notesight.functions import cleaning, tokens, words
from notesight.functions.cleaning import apply_steps
from notesight.functions.sections import extract_section
from notesight.functions.stemmer import porter, stem_text, stem_tokens
from notesight.operators.cleaning import add_sections, clean, prepare_notes, stem_columns


def value(spark, text, step):
    return spark.createDataFrame([(text,)], "t string").select(step(F.col("t")).alias("v")).first().v


@pytest.mark.parametrize("step, text, expected", [
    (cleaning.drop_stop_words, "The patient and the nurse", "The patient nurse"),
    (cleaning.drop_stop_words, " a big\n\nhouse ", "big house"),
    (cleaning.drop_brackets, "seen [**2101-1-1**] today", "seen   today"),
    (cleaning.drop_brackets, "a [b\nc] d", "a [b\nc] d"),
    (cleaning.drop_short_words, "a bc d ef", "bc ef"),
    (cleaning.drop_custom_words, "admission date stable", "stable"),
    (cleaning.drop_frequencies, "x meqs q day daily midday tablet", "x  s  ay   midday  "),
    (cleaning.drop_doses, "take mg mgs smg", "take     smg"),
    (cleaning.drop_doses, "émg mg", "émg  "),
    (cleaning.drop_numbers, "one bone sixteen", "  bone  "),
    (cleaning.drop_marks, "[**Name**] x [y]", "  x [y]"),
    (cleaning.drop_form_words, "sex:  f, in service", " , in  "),
    (cleaning.drop_date_headings, "admission date: today", " : today"),
    (cleaning.drop_clock_times, "at 10:45 am or 7pm", "at   or  "),
    (cleaning.drop_lab_units, "9 g/dl 4 mmol/l", "9   4  "),
    (cleaning.flatten_lines, "a\r\nb", "a  b"),
    (cleaning.unix_lines, "a\r\nb\r", "a\nb\r"),
])
def test_step(spark, step, text, expected):
    assert value(spark, text, step) == expected


def test_letters(spark):
    steps = (cleaning.letters_only, cleaning.squeeze_spaces, F.lower)
    assert value(spark, "BP 120/80, OK", lambda t: apply_steps(t, steps)) == "bp ok"


def test_unbounded_numbers(spark):
    steps = (cleaning.drop_numbers_anywhere, cleaning.lower_letters_only, cleaning.squeeze_blanks)
    assert value(spark, "bone sixteen", lambda t: apply_steps(t, steps)) == "b teen"


def test_clean_fills_null(spark):
    df = spark.createDataFrame([("The One mg DAY of pain", None)], "a string, b string")
    assert tuple(clean(df, ["a", "b"]).first()) == ("the pain", "")


def test_stop_words():
    assert len(words.STOP_WORDS) == 179 and len(set(words.CUSTOM_WORDS)) == 14


def test_remover_stop_words(spark):
    assert words.REMOVER_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


CONDITION = words.SECTION_HEADERS["discharge_condition"]


@pytest.mark.parametrize("text, expected", [
    ("x\n\nDischarge Condition: Good\nstable\n\nnext", "good\nstable"),
    ("x\n\nDischarge Condition:\n\nnext", ""),
    ("x\n\nDischarge Condition: \n\nnext", ""),
    ("no header", None),
    ("x\n\nDischarge Condition: good", None),
    ("\n\nCondition at discharge: fair\n\n", "fair"),
    ("\n\nDischarge Condition: a\n\n\n\nDischarge Condition: b\n\n", "a"),
    (None, None),
])
def test_section(spark, text, expected):
    assert value(spark, text, lambda t: extract_section(t, CONDITION)) == expected


def test_all_sections(spark):
    text = "\n\nDischarge Diagnoses: X\n\n\n\nDischarge Status: Home\n\n\n\nDischarge Medications: a b\n\n\n\nDischarge Instructions: rest\n\n"
    row = add_sections(spark.createDataFrame([(text,)], "text string")).first()
    assert tuple(row)[1:] == (None, "home", "x", "a b", "rest")
    prepared = prepare_notes(spark.createDataFrame([(text,)], "text string")).first()
    assert prepared.discharge_medication == "" and prepared.discharge_condition == ""


# examples given with the algorithm
PORTER = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster
bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling
fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit
rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic differentli
differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl
triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness
good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust
defensible defens irritant irrit replacement replac adjustment adjust dependent depend adoption adopt homologou
homolog communism commun activate activ angulariti angular homologous homolog effective effect bowdlerize
bowdler probate probat rate rate cease ceas controll control roll roll is is as as this thi was wa always alwai
toxicology toxicologi yes ye""".split()


@pytest.mark.parametrize("word, expected", list(zip(PORTER[::2], PORTER[1::2])))
def test_porter(word, expected):
    assert porter()(word) == expected


def test_stem_columns(spark):
    df = spark.createDataFrame([("relational  cats",), (None,), ("",)], "text string")
    assert [row.text for row in stem_columns(df, ["text"]).collect()] == ["relat cat", None, ""]
    arrays = df.select(stem_tokens(F.split(F.coalesce("text", F.lit("")), " +")).alias("t"))
    assert [row.t for row in arrays.collect()] == [["relat", "cat"], [], []]
    assert df.select(stem_text(F.col("text")).alias("t")).schema["t"].dataType.simpleString() == "string"


@pytest.mark.parametrize("items, n, expected", [
    (["a"], 2, []), ([], 2, []), (["a", "b", "c"], 2, ["a b", "b c"]), (["a", "b"], 1, ["a", "b"]),
    (["a", "b", "c"], 3, ["a b c"]),
])
def test_ngrams(spark, items, n, expected):
    df = spark.createDataFrame([(items,)], "t array<string>")
    assert df.select(tokens.ngrams(F.col("t"), n).alias("g")).first().g == expected


def test_tokens_and_sentences(spark):
    assert value(spark, "It's 2 Big-dogs.", tokens.word_tokens) == ["it", "s", "big", "dogs"]
    assert value(spark, None, tokens.word_tokens) == []
    assert value(spark, "One. Two!  Three? four.five. ", tokens.sentences) == ["One.", "Two!", "Three?", "four.five."]


def test_stemmer_takes_texts_by_slices_of_bounded_size(spark):
    import pyarrow as pa

    from notesight.functions import stemmer

    texts = pa.array(["aa", None, "", "b" * 10, "c", "é"])
    assert [each.to_pylist() for each in stemmer.slices(texts, 4)] == [["aa", None, ""], ["b" * 10], ["c", "é"]]
    assert [each.to_pylist() for each in stemmer.slices(texts.slice(2), 1)] == [[""], ["b" * 10], ["c"], ["é"]]
    assert [len(each) for each in stemmer.slices(texts.slice(0, 0), 1)] == [0]
    # more distinct words than are remembered, over several slices
    words = spark.range(0, 250_000, 1, 2).select(F.concat(F.lit("x"), F.translate(F.col("id").cast("string"), "0123456789", "abcdfghjkl"), F.lit(" cats")).alias("text"))
    got = words.select("text", stem_text(F.col("text")).alias("stems")).filter("stems IS NULL OR NOT endswith(stems, ' cat')")
    assert got.count() == 0 and stemmer.MEMORY <= 100_000
