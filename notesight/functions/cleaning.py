"""The cleaning rules for note text, each a function from column to column.

Every rule uses its input once, so a chain of them stays one projection without repeated work."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

from notesight.functions import words

Step = Callable[[Column], Column]

# White space as Python's str.split() sees it; Java's \s alone stops at ASCII.
SPACES = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def either(parts: Iterable[str], starts: str = "") -> str:
    """Any of the parts. A look at the first character, one of `starts`, spares the regular expression
    engine a try of every part at every place; by default the first letters of the parts."""
    parts = list(parts)
    starts = starts or "".join(sorted({part[0] for part in parts}))
    return f"(?=[{starts}])(?:" + "|".join(parts) + ")"


def whole_word(parts: Iterable[str]) -> str:
    return r"(?U)\b" + either(parts) + r"\b"


def blank(pattern: str) -> Step:
    """A step that puts one space in place of every match."""
    return lambda text: F.regexp_replace(text, pattern, " ")


def keep_words(keep: Callable[[Column], Column]) -> Step:
    """A step that splits on white space, keeps some words and joins them by one space."""

    def step(text: Column) -> Column:
        kept = F.filter(F.split(text, SPACES), lambda word: (word != "") & keep(word))
        return F.array_join(kept, " ")

    return step


# --- first cleaner
drop_stop_words = keep_words(lambda word: ~word.isin(words.STOP_WORDS))
drop_brackets = blank(r"\[[^\]\n]*\]")
letters_only = blank(r"[^a-zA-Z]+")
drop_short_words = keep_words(lambda word: F.length(word) > 1)
drop_custom_words = keep_words(lambda word: ~word.isin(words.CUSTOM_WORDS))
drop_frequencies = blank(
    either((*words.FREQUENCY_PHRASES, whole_word(words.FREQUENCY_WORDS)), starts="abmopqtds")
)
drop_doses = blank(whole_word((*words.DOSE_UNITS, "po")))
drop_numbers = blank(whole_word(words.NUMBER_WORDS))


def squeeze_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


# --- second cleaner: no word bounds, lower-cased text
drop_form_words = blank(either(words.FORM_WORDS))
drop_date_headings = blank(either(words.DATE_HEADINGS))
drop_clock_times = blank(either(words.CLOCK_TIMES, starts="0-9"))
drop_marks = blank(r"\[\*\*[^*]+\*\*\]")
drop_lab_units = blank(either(words.LAB_UNITS))
drop_frequencies_anywhere = blank(either((*words.FREQUENCY_PHRASES, "daily")))
drop_doses_anywhere = blank(either(words.DOSE_UNITS))
drop_numbers_anywhere = blank(either(words.NUMBER_WORDS))
lower_letters_only = blank(r"[^a-z]")
squeeze_blanks = blank(r" +")

# --- export
flatten_lines = blank(r"[\r\n]")


def drop_commas(text: Column) -> Column:
    return F.regexp_replace(text, ",", "")


def unix_lines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n", "\n")


NOTE_STEPS: tuple[Step, ...] = (
    drop_stop_words,
    drop_brackets,
    letters_only,
    squeeze_spaces,
    F.lower,
    drop_short_words,
    drop_custom_words,
    drop_frequencies,
    drop_doses,
    drop_numbers,
    squeeze_spaces,
)

PLAIN_STEPS: tuple[Step, ...] = (
    F.lower,
    drop_form_words,
    drop_date_headings,
    drop_clock_times,
    drop_marks,
    drop_lab_units,
    drop_frequencies_anywhere,
    drop_doses_anywhere,
    drop_numbers_anywhere,
    lower_letters_only,
    squeeze_blanks,
)

CLEANERS = {"notes": NOTE_STEPS, "plain": PLAIN_STEPS}


def apply_steps(text: Column, steps: Iterable[Step]) -> Column:
    for step in steps:
        text = step(text)
    return text
