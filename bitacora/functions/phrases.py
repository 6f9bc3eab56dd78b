"""Replacement of dictionary phrases in a text column."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.functions.dialect import edges, literal
from bitacora.functions.phrase_table import replace_from_table

# A private-use character: word edges see it as a non-word character, and a
# text that already holds it takes the slower branch below.
_MARK = "\ue000"


def flatten_dictionary(categories: dict[str, list[str]]) -> dict[str, str]:
    """Lower-case phrase -> replacement; a blank category replaces by a space.

    An empty phrase is dropped: it would match at every word edge.
    """
    return {
        phrase.lower(): category if category.strip() else " "
        for category, phrases in categories.items()
        for phrase in phrases
        if phrase
    }


# Groups inside one another in a pattern; phrases that branch deeper are listed.
_DEEPEST = 50


def _shared_starts(phrases: list[str], depth: int = 0) -> str:
    """Alternation in which phrases with the same start share it.

    Of two phrases only one of which continues the other, the longer is tried
    first; phrases that part at some character cannot both match.
    """
    start = os.path.commonprefix(phrases)
    rests = [p[len(start) :] for p in phrases]
    if not any(rests):
        return literal(start)
    if depth == _DEEPEST:
        listed = sorted(set(rests), key=len, reverse=True)
        return literal(start) + f"(?:{'|'.join(map(literal, listed))})"
    branches: dict[str, list[str]] = {}
    for rest in rests:
        if rest:
            branches.setdefault(rest[0], []).append(rest)
    body = "|".join(_shared_starts(of, depth + 1) for of in branches.values())
    return literal(start) + f"(?:{body})" + ("?" if "" in rests else "")


def dictionary_pattern(replacements: dict[str, str]) -> str:
    """One alternation over all phrases: whole words, longest first, any case.

    Group 1 is the phrase.
    """
    by_length = sorted(replacements, key=len, reverse=True)
    found = {edges(p) for p in by_length}
    if len(found) > 1:
        body = "|".join(edges(p)[0] + literal(p) + edges(p)[1] for p in by_length)
        return f"(?iU)({body})"
    ((before, after),) = found
    if all(ch.upper().lower() == ch for p in by_length for ch in p):
        # Looking at the next character is cheaper than looking back at the
        # edge, so it comes first.
        starts = "".join(sorted({literal(p[0]) for p in by_length}))
        return f"(?iU)(?=[{starts}]){before}({_shared_starts(by_length)}){after}"
    # Some character has a second lower-case form: starts could overlap.
    return f"(?iU){before}({'|'.join(literal(p) for p in by_length)}){after}"


# A dictionary of more phrases is a table that is joined, not a pattern in the plan.
MOST_IN_PATTERN = 1000


def replace_phrases(
    df: DataFrame, text: str, replacements: dict[str, str] | DataFrame, result: str
) -> DataFrame:
    """Replaces every dictionary phrase in one pass from left to right.

    Matches are marked by one pattern, the text is cut at the marks, and each
    match is looked up.  Large dictionaries, and those that are tables (phrase, new)
    already, are looked up by a join; a stream can't join what is computed from it, so
    there a dictionary always is a pattern.
    """
    if isinstance(replacements, DataFrame):
        return replace_from_table(df, text, replacements, result)
    if len(replacements) > MOST_IN_PATTERN and not df.isStreaming:
        table = df.sparkSession.createDataFrame(list(replacements.items()), "phrase string, new string")
        return replace_from_table(df, text, table, result)
    column = F.col(text)
    if not replacements:
        return df.withColumn(result, column)
    pattern = dictionary_pattern(replacements)
    table = F.create_map(*[F.lit(x) for pair in replacements.items() for x in pair])

    def meaning(match: Column) -> Column:
        return F.coalesce(F.try_element_at(table, F.lower(match)), match)

    # Odd pieces of the marked text are the matches.
    marked = F.col("_marked")
    pieces = F.transform(
        F.split(marked, _MARK, -1),
        lambda piece, i: F.when(i % 2 == 1, meaning(piece)).otherwise(piece),
    )
    # Same result without marks, for texts that contain the mark itself.
    gaps = F.split(column, pattern, -1)
    matches = F.regexp_extract_all(column, F.lit(pattern), F.lit(1))
    joined = F.zip_with(
        gaps, matches, lambda gap, match: F.concat(gap, F.coalesce(meaning(match), F.lit("")))
    )
    return (
        df.withColumn("_marked", F.regexp_replace(column, pattern, f"{_MARK}$1{_MARK}"))
        .withColumn(
            result,
            F.when(~marked.contains(_MARK), marked)
            .when(column.contains(_MARK), F.array_join(joined, ""))
            .otherwise(F.array_join(pieces, "")),
        )
        .drop("_marked")
    )
