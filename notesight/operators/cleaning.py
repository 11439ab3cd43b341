"""Cleaning and cutting notes, several columns in one projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from notesight.functions import words
from notesight.functions.cleaning import CLEANERS, Step, apply_steps
from notesight.functions.sections import extract_section
from notesight.functions.stemmer import stem_text


def clean(df: DataFrame, columns: Sequence[str], steps: str | Iterable[Step] = "notes") -> DataFrame:
    """Run a cleaner (by name, or as a list of steps) over the columns; NULL becomes an empty text."""
    chain = CLEANERS[steps] if isinstance(steps, str) else tuple(steps)
    cleaned = {name: F.coalesce(apply_steps(F.col(name), chain), F.lit("")) for name in columns}
    return df.withColumns(cleaned)


def add_sections(
    df: DataFrame, text: str = "text", headers: Mapping[str, str] = words.SECTION_HEADERS
) -> DataFrame:
    """One column per section of the text, NULL where the note has no such section. Must run before
    line breaks are flattened."""
    return df.withColumns({name: extract_section(F.col(text), header) for name, header in headers.items()})


def stem_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: stem_text(F.col(name)) for name in columns})


def prepare_notes(notes: DataFrame, steps: str | Iterable[Step] = "notes") -> DataFrame:
    """Cut the sections out of raw notes, then clean the text and the sections."""
    return clean(add_sections(notes), ["text", *words.SECTION_HEADERS], steps)
