"""Folio keys and folio lists: parse, format, de-duplicate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bitacora.functions.text import strip


# A bracketed list in which every double quote opens or closes an item.
_QUOTED_LIST = r"""\A\[\s*+(?:(?:"[^"]*"|[^",\[\]]*+)\s*+,\s*+)*+(?:"[^"]*"|[^",\[\]]*+)\s*+\]\z"""


def folio_key(value: Column) -> Column:
    """Trimmed text; null when it is blank or spells ``nan``."""
    key = strip(value.cast("string"))
    return F.when(~F.lower(key).isin("", "nan"), key)


def parse_list(text: Column) -> Column:
    """Folio list from its text form; never null.

    Accepts a bracketed list of quoted or bare items and plain comma-separated
    items.  Blank items are dropped.  Double quotes are only list syntax where they
    stand in pairs around the items of a bracketed list; elsewhere they belong to
    the item.
    """
    whole = strip(text)
    bracketed = whole.startswith("[") & whole.endswith("]")
    items = F.translate(whole, "[]'", "")
    paired = bracketed & whole.rlike(_QUOTED_LIST)
    items = F.when(paired, F.translate(items, '"', "")).otherwise(items)
    parts = F.transform(F.split(items, ","), strip)
    parsed = F.filter(parts, lambda item: item != "")
    blank = whole.isNull() | whole.isin("", "nan", "[]")
    return F.when(blank, F.array().cast("array<string>")).otherwise(parsed)


def as_list(value: Column, data_type: str) -> Column:
    """A folio list as an array, whatever form the column has.

    ``data_type`` is the column's Spark type; arrays pass through.
    """
    if data_type.startswith("array"):
        return F.coalesce(value.cast("array<string>"), F.array().cast("array<string>"))
    return parse_list(value.cast("string"))


def format_list(items: Column) -> Column:
    """Text form of a folio list: ``['a', 'b']``, or ``[]`` when it is empty."""
    joined = F.array_join(items, "', '")
    return F.when(F.size(items) == 0, "[]").otherwise(F.concat(F.lit("['"), joined, F.lit("']")))


def prioritized_distinct(*lists: Column) -> list[Column]:
    """Each item stays only in the first list that has it, and once there."""
    kept: list[Column] = []
    for items in lists:
        kept.append(F.array_except(items, F.concat(*kept)) if kept else F.array_distinct(items))
    return kept
