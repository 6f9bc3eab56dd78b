"""Frequent word n-grams of a text column, and their tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.functions.dialect import WORD
from bitacora.functions.text import without_stop_words
from bitacora.operators.numbering import number_rows
from bitacora.storage import Workspace


def tokens(text: Column, use_stop_words: bool = True) -> Column:
    """Lower-case runs of two or more word characters, without stop words."""
    words = F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(f"{WORD}{{2,}}"), F.lit(0)
    )
    return without_stop_words(words) if use_stop_words else words


def ngrams(words: Column, shortest: int, longest: int) -> Column:
    """All n-grams, ``shortest`` <= n <= ``longest``, of words joined by spaces.

    A pattern matches one word after the other and captures it together with
    the words ahead, so n-grams overlap.
    """
    word = "[^ ]+"
    return F.concat(
        *[
            F.regexp_extract_all(
                words, F.lit(f"(?=({' '.join([word] * n)})){word} ?"), F.lit(1)
            )
            for n in range(shortest, longest + 1)
        ]
    )


def _word_rows(df: DataFrame, text: str, use_stop_words: bool) -> DataFrame:
    return df.select(F.array_join(tokens(F.col(f"`{text}`"), use_stop_words), " ").alias("_words"))


def _counted(words: DataFrame, grams: Column, among: DataFrame | None = None) -> DataFrame:
    """(phrase, freq, docs) of the n-grams of each row, of those whose both ends are ``among`` if given."""
    before = F.concat(F.array(F.lit(None).cast("string")), F.col("_grams"))
    rows = (
        words.select(F.sort_array(grams).alias("_grams"))
        .select(F.inline(F.arrays_zip(F.col("_grams").alias("phrase"), before.alias("before"))))
        # One entry too many per text, from the shift.
        .where(F.col("phrase").isNotNull())
    )
    if among is not None:
        for pattern in (" [^ ]+$", "^[^ ]+ "):
            end = among.select(F.col("phrase").alias("_end"))
            rows = rows.join(end, F.regexp_replace("phrase", pattern, "") == F.col("_end"), "left_semi")
    return rows.groupBy("phrase").agg(
        F.count(F.lit(1)).alias("freq"),
        F.count_if(~F.col("phrase").eqNullSafe(F.col("before"))).alias("docs"),
    )


def ngram_counts(
    df: DataFrame,
    text: str = "text",
    ngram_range: tuple[int, int] = (2, 4),
    use_stop_words: bool = True,
) -> DataFrame:
    """(phrase, freq, docs): occurrences and number of texts for every n-gram.

    The n-grams of a text are sorted inside its row and each is paired with the
    one before it, which tells the first of each kind apart; the number of texts
    is then a plain sum.  Both counts need one shuffle, after partial sums, and
    no text identifier.
    """
    return _counted(_word_rows(df, text, use_stop_words), ngrams(F.col("_words"), *ngram_range))


# So many n-grams are put together to longer ones by the driver, and so many of these
# are looked for inside the rows; more are joined.
MOST_LISTED, MOST_LOOKED_FOR = 200, 2000


def _longer(words: DataFrame, n: int, ends: DataFrame) -> DataFrame | None:
    """Counts of the n-grams whose first and last n - 1 words are both a phrase of ``ends``."""
    grams = ngrams(F.col("_words"), n, n)
    listed = [r["phrase"] for r in ends.select("phrase").limit(MOST_LISTED + 1).collect()]
    if len(listed) > MOST_LISTED:
        return _counted(words, grams, ends)
    last = {}
    for phrase in listed:
        start, _, word = phrase.rpartition(" ")
        last.setdefault(start, []).append(word)
    found = [f"{p} {word}" for p in listed for word in last.get(p.partition(" ")[2], [])]
    if not found:
        return None
    if len(found) > MOST_LOOKED_FOR:
        return _counted(words, grams, ends)
    return _counted(words, F.filter(grams, lambda g: g.isin(found)))


def top_ngrams(
    df: DataFrame,
    text: str = "text",
    ngram_range: tuple[int, int] = (2, 4),
    min_df: int | float = 10,
    top_k: int = 30,
    use_stop_words: bool = True,
) -> DataFrame:
    """The ``top_k`` most frequent n-grams as (phrase, freq), most frequent first.

    Only n-grams of at least ``min_df`` texts count (a share of the texts if it
    is a float).  Ties are in code-point order of the phrase.

    An n-gram is no more frequent, and in no more texts, than the shorter ones in it.  So
    all of the shortest are counted, and of longer ones only those that begin and end with
    one that is as frequent as the last of the ``top_k`` so far.
    """
    ws = Workspace(df.sparkSession)
    words, seen = ws.stage(_word_rows(df, text, use_stop_words), texts=F.count(F.lit(1)))
    least = min_df * (seen["texts"] or 0) if isinstance(min_df, float) else min_df
    shortest, longest = ngram_range
    order = (F.col("freq").desc(), "phrase")
    top = ends = None
    for n in range(shortest, longest + 1):
        if n == shortest:
            counts = _counted(words, ngrams(F.col("_words"), n, n))
        else:
            counts = _longer(words, n, ends)
        if counts is None:
            break
        counts, _ = ws.stage(counts.where(F.col("docs") >= F.lit(least)).select("phrase", "freq"))
        top = counts if top is None else top.unionByName(counts)
        top = top.orderBy(*order).limit(top_k)
        last = top.agg(F.count(F.lit(1)).alias("n"), F.min("freq").alias("freq")).first()
        ends = counts.where(F.col("freq") >= last["freq"]) if last["n"] and last["n"] == top_k else counts
    if top is None:
        return df.sparkSession.createDataFrame([], "phrase string, freq bigint")
    return top.orderBy(*order).limit(top_k)


def substitution_map(
    top: DataFrame, prefix: str = "TOKEN", order: str | None = None
) -> DataFrame:
    """(phrase, token, rank) for the rows of ``top_ngrams``: <<PREFIX_1>> and on.

    Ranks follow the column ``order``, which is distinct per row, or else the
    frequency.  A phrase given twice keeps its last token.  Rows are numbered by
    ranges: ``top`` may be any frame.
    """
    place = F.col(f"`{order}`") if order else F.struct(-F.col("freq"), "phrase")
    ranked = number_rows(
        top.select("phrase", place.alias("_place")), "_place", "rank", Workspace(top.sparkSession)
    )
    last = ranked.groupBy("phrase").agg(F.max("rank").cast("bigint").alias("rank"))
    return last.select(
        "phrase", F.format_string(f"<<{prefix.replace('%', '%%')}_%d>>", "rank").alias("token"), "rank"
    )
