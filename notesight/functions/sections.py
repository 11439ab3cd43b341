"""Sections of a note: a header that starts a paragraph, up to the next blank line."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def extract_section(text: Column, header: str) -> Column:
    """The first section under `header` (a pattern that ends in a colon), in lower case: what follows the
    colon and one more character, up to the blank line. NULL if there is no such section."""
    found = F.regexp_extract(F.lower(text), f"(?s)\n\n(?:{header}).*?\n\n", 0)

    def body(match: Column) -> Column:
        start = F.instr(match, ":") + 2
        size = F.greatest(F.length(match) - start - 1, F.lit(0))
        return F.when(match != "", F.substring(match, start, size))

    # the one-element array makes the match a variable, so the pattern runs once per text
    return F.transform(F.array(found), body).getItem(0)
