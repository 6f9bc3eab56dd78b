"""Extraction of related folios from incident notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.fixed_values import (
    CANCELLED_PATTERN,
    EXTRACTION_COLUMNS,
    FOLIO_DIGITS,
    LINKED_PATTERN,
    PHRASES,
    REFERENCE_PATTERN,
    SPLIT_PATTERN,
)
from bitacora.functions.dialect import SPACE, WORD_SET
from bitacora.functions.lists import prioritized_distinct
from bitacora.functions.phrases import flatten_dictionary, replace_phrases
from bitacora.functions.text import collapse_spaces

_FOLIO = rf"\d{{{FOLIO_DIGITS}}}"
_HAS_FOLIO = f"(?U){_FOLIO}"


class Relation:
    """One kind of reference between folios, found and removed by one pattern.

    The pattern first tries the strict form, in which every number has ten
    digits, and falls back to the general form with numbers of any length.
    Group 1 is the core of a strict match and group 2 a whole general match.
    Replacing by group 2 therefore removes the valid references and keeps the
    invalid ones, which are still skipped over as a whole.
    """

    def __init__(self, name: str, keyword: str, starts: str, parts: tuple[str, str, str]):
        self.name = name
        self.keyword = f"(?iU){keyword}"
        # Looking back for a digit changes no match; it stops a long number
        # from being tried again from each of its digits.  Neither does looking
        # for a possible first character; it is quicker than trying both forms.
        lead, core, tail = parts
        strict = self._fill(core, rf"(?<!\d){_FOLIO}(?!\d)")
        general = self._fill(core, r"(?<!\d)\d+")
        lead, tail = self._fill(lead), self._fill(tail)
        self.pattern = (
            f"(?iUd)(?=[{starts}])(?:(?:{lead}({strict}){tail})|({lead}{general}{tail}))"
        )

    @staticmethod
    def _fill(part: str, number: str = "") -> str:
        return part.format(n=number, s=SPACE, w=WORD_SET)

    def cores(self, text: Column) -> Column:
        """Cores of the valid references, one per line; '' if there are none."""
        found = F.array_join(F.regexp_extract_all(text, F.lit(self.pattern), F.lit(1)), "\n")
        return F.coalesce(F.when(text.rlike(self.keyword), found), F.lit(""))

    def removed(self, text: Column) -> Column:
        return F.regexp_replace(text, self.pattern, "$2")


SPLIT = Relation("split", "se dividio", r"ef\d", SPLIT_PATTERN)
LINKED = Relation("linked", "ligado", r"ef\d", LINKED_PATTERN)
CANCELLED = Relation("cancelled", "cancelado", r"ef\d", CANCELLED_PATTERN)
REFERENCE = Relation("reference", "referencia", "er", REFERENCE_PATTERN)

# Each relation is searched in the text that the ones before it left.
RELATIONS = (SPLIT, LINKED, CANCELLED, REFERENCE)


def folios_in(cores: Column) -> Column:
    """Every folio in the cores, in text order."""
    return F.regexp_extract_all(cores, F.lit(_HAS_FOLIO), F.lit(0))


def folio_pairs(cores: Column, which: int) -> Column:
    """First (1) or second (2) folio of every core that relates two."""
    return F.regexp_extract_all(cores, F.lit(rf"(?U)({_FOLIO})\D+({_FOLIO})"), F.lit(which))


def extract_relations(
    df: DataFrame, text: str, relations: tuple[Relation, ...] = RELATIONS
) -> DataFrame:
    """Adds ``_<relation>`` (cores) per relation and ``_rest`` (text without them).

    A note without a ten-digit number is null throughout the steps, which skips
    the patterns.  Every step names the text before it just once: a condition on
    a result may be moved below the steps, and then repeats them once, not once
    for each way to reach them.
    """
    note = F.col(f"`{text}`")
    df = df.withColumn(
        "_note", F.when(note.isNull() | note.isin("", "nan"), "").otherwise(note)
    ).withColumn("_rest", F.when(F.col("_note").rlike(_HAS_FOLIO), F.col("_note")))
    for relation in relations:
        rest = F.col("_rest")
        df = df.withColumns(
            {f"_{relation.name}": relation.cores(rest), "_rest": relation.removed(rest)}
        )
    return df.withColumn("_rest", F.coalesce("_rest", "_note")).drop("_note")


def extract_notes(
    df: DataFrame, notes: str = "Notas", phrases: dict[str, list[str]] | DataFrame | None = PHRASES
) -> DataFrame:
    """Adds the six extraction columns for the note column ``notes``.

    ``dividido_de``, ``dividido_a``, ``cancelado``, ``referencia_folio`` and
    ``folios_ligados`` are arrays of ten-digit folios, never null.  Apart from
    ``cancelado`` no folio occurs twice in or across them; linked folios win
    over references, those over split targets, those over split origins.
    ``nota_limpia`` is the text left after removing the references and replacing
    the dictionary phrases.  ``phrases`` of None skips the replacement; a large dictionary
    is better a table (phrase, new), as ``load_phrase_table`` gives it.
    """
    clash = sorted(set(EXTRACTION_COLUMNS) & set(df.columns))
    if clash:
        raise ValueError(f"input already has result columns: {clash}")
    given = df.columns
    df = extract_relations(df, notes)
    table = phrases if isinstance(phrases, DataFrame) else flatten_dictionary(phrases or {})
    df = replace_phrases(df, "_rest", table, "_rest")
    df = df.withColumns(
        {
            "_linked": folios_in(F.col("_linked")),
            "cancelado": folios_in(F.col("_cancelled")),
            "_reference": folios_in(F.col("_reference")),
            "_to": folio_pairs(F.col("_split"), 2),
            "_from": folio_pairs(F.col("_split"), 1),
        }
    )
    linked, reference, split_to, split_from = prioritized_distinct(
        F.col("_linked"), F.col("_reference"), F.col("_to"), F.col("_from")
    )
    return df.select(
        *[F.col(f"`{c}`") for c in given],
        split_from.alias("dividido_de"),
        split_to.alias("dividido_a"),
        "cancelado",
        reference.alias("referencia_folio"),
        linked.alias("folios_ligados"),
        collapse_spaces(F.col("_rest")).alias("nota_limpia"),
    )
