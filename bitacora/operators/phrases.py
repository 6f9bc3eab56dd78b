"""Removal of phrases from a text column, or their replacement by tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.functions.dialect import replacement, whole_phrase
from bitacora.functions.phrase_table import replace_each_from_table
from bitacora.functions.text import collapse_spaces


# More phrases are a table that texts look up by their words.
MOST_IN_FOLD = 200


def _replace_each(df: DataFrame, text: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """Replaces each phrase in turn, longest first, in what the last one left.

    The phrases are one array that a fold goes through, so the plan is the same for
    any number.  A phrase is only searched by its pattern in rows that contain it.
    """
    if not pairs:
        return df.withColumn(text, collapse_spaces(F.col(f"`{text}`")))
    if len(pairs) > MOST_IN_FOLD and not df.isStreaming:
        rows = [(phrase, new, at) for at, (phrase, new) in enumerate(pairs)]
        return _from_table(df, text, df.sparkSession.createDataFrame(rows, "phrase string, new string, at bigint"))
    longest_first = sorted(pairs, key=lambda pair: len(pair[0]), reverse=True)
    steps = F.array(
        *[
            F.struct(
                F.lit(phrase).alias("phrase"),
                F.lit(whole_phrase(phrase)).alias("pattern"),
                F.lit(replacement(new)).alias("new"),
            )
            for phrase, new in longest_first
        ]
    )

    def step(done: Column, at: Column) -> Column:
        changed = F.regexp_replace(done, at["pattern"], at["new"])
        return F.when(done.contains(at["phrase"]), changed).otherwise(done)

    return df.withColumn(text, collapse_spaces(F.aggregate(steps, F.col(f"`{text}`"), step)))


def _from_table(df: DataFrame, text: str, phrases: DataFrame) -> DataFrame:
    done = replace_each_from_table(df, text, phrases)
    return done.withColumn(text, collapse_spaces(F.col(f"`{text}`")))


def _ordered(phrases: DataFrame) -> DataFrame:
    """Phrases of a table without an order of their own come by their text."""
    return phrases if "at" in phrases.columns else phrases.withColumn("at", F.col("phrase"))


def remove_phrases(df: DataFrame, text: str, phrases: list[str] | DataFrame) -> DataFrame:
    """Replaces whole-word, case-sensitive occurrences of the phrases by a space.

    A table has them in a column ``phrase``, each once.
    """
    if isinstance(phrases, DataFrame):
        return _from_table(df, text, _ordered(phrases).withColumn("new", F.lit(" ")))
    return _replace_each(df, text, [(phrase, " ") for phrase in phrases])


def collapse_phrases(df: DataFrame, text: str, mapping: dict[str, str] | DataFrame) -> DataFrame:
    """Replaces whole-word, case-sensitive occurrences of each phrase by its token.

    A table has columns ``phrase`` and ``token``; among phrases of one length the order is
    that of a column ``at``, or of the phrases.
    """
    if isinstance(mapping, DataFrame):
        new = F.concat(F.lit(" "), "token", F.lit(" "))
        return _from_table(df, text, _ordered(mapping).withColumn("new", new))
    return _replace_each(df, text, [(phrase, f" {new} ") for phrase, new in mapping.items()])
