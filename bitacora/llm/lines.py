"""Line deduplication by overlapping windows of three consecutive lines.

A window is three consecutive lines that hold a word; lines without one are passed
over and always kept.  Of equal windows the first stays, in the order of
(doc_id, place in the text); every line covered by a later
one goes, once however many windows cover it.

Null ids come after all others.  A null text has no lines.  A document with fewer
than three such lines has no window and stays whole.  Rows that agree in doc_id and
text are one document given several times: each gets the same result.  An empty table
gives no row; columns of any name pass in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.llm.text import at, given, has_word, packed
from bitacora.storage import Workspace

SIZE = 3


def _lines(text: Column) -> Column:
    """Place and hash of every line that holds a word."""

    def hashed(line: Column, i: Column) -> Column:
        return F.when(has_word(line), F.struct(i.alias("i"), F.xxhash64(line).alias("h")))

    return F.filter(F.transform(F.split(text, "\n"), hashed), lambda x: x.isNotNull())


def line_windows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per window: its hash, its document and the places of its lines."""
    df = docs.select(
        "doc_id",
        F.xxhash64(given(F.col("text"))).alias("digest"),
        _lines(given(F.col("text"))).alias("ls"),
    ).where(F.size("ls") >= size)
    ls = F.col("ls")
    runs = F.transform(
        F.slice(ls, F.lit(1), F.size(ls) - (size - 1)),
        lambda x, i: F.struct(
            F.xxhash64(x["h"], *[at(ls, i + k)["h"] for k in range(1, size)]).alias("h"),
            F.array(x["i"], *[at(ls, i + k)["i"] for k in range(1, size)]).alias("places"),
        ),
    )
    return df.select("doc_id", "digest", F.explode(runs).alias("w")).select(
        F.col("w.h").alias("h"), "doc_id", "digest", F.col("w.places").alias("places")
    )


def dedup_lines(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``row`` with the document, ``n_lines``, ``n_removed`` and the ``kept`` text."""
    spark = docs.sparkSession
    windows, _ = Workspace(spark).stage(line_windows(docs, size))
    # Nulls last: the first field says whether the id is missing.
    place = F.struct(
        F.col("doc_id").isNull().alias("none"),
        F.col("doc_id"),
        F.col("digest"),
        F.col("places")[0].alias("at"),
    )
    firsts = (
        windows.groupBy("h")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("h", "first")
    )
    later = (
        windows.join(firsts, "h")
        .where(~F.col("first").eqNullSafe(place))
        .select("doc_id", "digest", F.explode("places").alias("at"))
        .groupBy("doc_id", "digest")
        .agg(F.collect_set("at").alias("gone"))
        .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "gone")
    )
    text = given(F.col("text"))
    df = packed(docs, text=text, id=F.col("doc_id"), digest=F.xxhash64(text))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    df = df.join(later, same, "left")
    df = df.withColumn("lines", F.split("text", "\n"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(places, F.col("gone")), lambda i: at(F.col("lines"), i))
    return df.select(
        "row",
        F.when(F.col("text") == "", 0).otherwise(F.size("lines")).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept"),
    )
