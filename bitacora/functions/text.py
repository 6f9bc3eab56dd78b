"""Text expressions: whitespace, mojibake, normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bitacora.fixed_values import (
    DATE_PATTERN,
    MOJIBAKE_PAIR,
    SPANISH_STOP_WORDS,
    TIME_PATTERN,
    UNKNOWN_MARK,
)
from bitacora.functions.dialect import (
    NOT_AFTER_WORD,
    NOT_BEFORE_WORD,
    SPACE,
    SPACE_CHARS,
    WORD_SET,
)

# The look ahead is the cheapest test, so it comes first.
_DATE = r"(?U)(?=\d)" + NOT_AFTER_WORD + DATE_PATTERN.format(n=r"\d") + NOT_BEFORE_WORD
_TIME = r"(?U)(?=\d)" + NOT_AFTER_WORD + TIME_PATTERN.format(n=r"\d") + NOT_BEFORE_WORD


def collapse_spaces(text: Column) -> Column:
    """Each run of whitespace becomes one space; none is left at the ends."""
    return F.trim(F.regexp_replace(text, f"(?U){SPACE}+", " "))


def strip(text: Column) -> Column:
    """``text`` without whitespace (any Unicode whitespace) at the ends."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def repair_mojibake(text: Column) -> Column:
    """Undo UTF-8 that was read as Latin-1, for the whole text or not at all.

    Only a text with a typical pair is tried.  It stays as it is when it holds
    a character outside Latin-1 or when its bytes are not valid UTF-8.
    """
    suspicious = text.rlike(MOJIBAKE_PAIR) & text.rlike(r"\A[\x00-\xFF]*\z")
    as_bytes = F.encode(text, "ISO-8859-1").cast("string")
    return F.when(suspicious, F.coalesce(F.try_validate_utf8(as_bytes), text)).otherwise(text)


def drop_dates_and_times(text: Column) -> Column:
    """Dates (day/month/year in digits), then clock times, become a space."""
    return F.regexp_replace(F.regexp_replace(text, _DATE, " "), _TIME, " ")


def normalize_text(
    text: Column, keep_unk: bool = False, remove_stop_words: bool = False
) -> Column:
    """Lower-case words and numbers separated by single spaces; null becomes ''.

    ``text`` should be a plain column: the mojibake step reads it several times.
    """
    s = repair_mojibake(text)
    s = F.replace(s, F.lit("\ufffd"), F.lit(UNKNOWN_MARK if keep_unk else " "))
    s = drop_dates_and_times(F.lower(s))
    # Whatever is neither word nor space turns into a space and runs of spaces
    # shrink to one: that is one replacement of every run of non-word characters.
    s = F.trim(F.regexp_replace(s, f"[^{WORD_SET}]+", " "))
    if remove_stop_words:
        s = F.array_join(without_stop_words(F.split(s, " ")), " ")
    return F.coalesce(s, F.lit(""))


def without_stop_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(SPANISH_STOP_WORDS))
