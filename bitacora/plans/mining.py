"""Phrase mining: frequent n-grams, their tokens, and shorter texts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bitacora.operators.ngrams import substitution_map, top_ngrams
from bitacora.operators.phrases import collapse_phrases, remove_phrases
from bitacora.storage import Workspace


def _written(df: DataFrame) -> DataFrame:
    """The texts, computed once: they are mined first and rewritten after."""
    return Workspace(df.sparkSession).stage(df)[0]


def mine_map(
    df: DataFrame, text: str = "text", prefix: str = "TOKEN", **options
) -> dict[str, str]:
    """Phrase -> token for the most frequent n-grams; ``top_k`` entries at most."""
    tokens = substitution_map(top_ngrams(df, text, **options), prefix).orderBy("rank")
    return {row["phrase"]: row["token"] for row in tokens.collect()}


def tokenize_frequent(
    df: DataFrame, text: str = "text", prefix: str = "TOKEN", **options
) -> DataFrame:
    """Texts with their own most frequent n-grams replaced by tokens."""
    df = _written(df)
    return collapse_phrases(df, text, mine_map(df, text, prefix, **options))


def drop_frequent(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """Texts without their own most frequent n-grams."""
    df = _written(df)
    return remove_phrases(df, text, list(mine_map(df, text, **options)))
