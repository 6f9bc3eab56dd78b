"""Mixing sources to target weights.

Every document gets a hash-random key; within its source documents are sorted by
it, in hash ranges; distributed prefix sums of their sizes tell where the source's
budget ends, and the document there is cut.  Where a budget exceeds its source the
source is repeated in whole epochs before the cut.

Sizes are numbers of words, none for a null text.  Sources in the order of their
code points, null last, weigh 5, 2, 1, 5, ...; together they get ``share`` times all
words.  No source gets more than ``most`` times its own words; what is above goes to
the others by weight, until none is above.  A source without words gets nothing.
Keys are of id and text, so rows without an id, or of one id, are ordered by their text, and
only rows equal in both have one key; they are taken in either order, so the result is the
same.  An empty table has no source and gives no row.  ``mix`` returns columns of its own,
``mixed_documents`` those of the documents, whatever their names.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitacora.llm.text import packed, row_digest, unpacked, words
from bitacora.operators.numbering import number_rows
from bitacora.storage import Workspace

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
# Rows per hash range, about.
RANGE_ROWS = 16_384

_KEY_BITS = 60


def mix_key(doc_id: Column, text: Column) -> Column:
    """The same for rows that agree in id and text only: many texts of one id are dealt alike."""
    return row_digest(doc_id, text)


def budgets(sizes: DataFrame, ws: Workspace, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """Source (``given`` and ``source``), rows, ``source_size`` and ``target``."""
    totals, seen = ws.stage(
        sizes.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
        ),
        total=F.sum("source_size"),
    )
    # A struct sorts null sources last and gives every source a place.
    ranked = number_rows(
        totals.withColumn("place", F.struct(F.col("source").isNull(), F.col("source"))),
        "place", "number", ws,
    )
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked, _ = ws.stage(
        ranked.drop("place").withColumn(
            "weight", F.get(cycle, F.pmod(F.col("number") - 1, F.lit(len(weights))).cast("int"))
        )
    )
    most_words = (most * F.col("source_size")).cast("double")
    wanted = share * (seen["total"] or 0)
    # Words a unit of weight gets.  It rises as sources reach their limit and
    # leave the rest to the others; each round is one row of sums.
    capped, unit = -1, 0.0
    for _ in itertools.count():
        full = most_words < F.col("weight") * F.lit(unit)
        row = ranked.agg(
            F.count_if(full).alias("n"),
            F.coalesce(F.sum(F.when(full, most_words)), F.lit(0.0)).alias("words"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if row.n == capped or not row.weight:
            break
        capped, unit = row.n, (wanted - row.words) / row.weight
    target = F.least(most_words, F.col("weight") * F.lit(unit))
    return ranked.select("source", "source_rows", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """doc_id, source, key, size, source_size, target and ``taken`` words per document."""
    ws = Workspace(docs.sparkSession)
    sizes, _ = ws.stage(
        docs.select(
            "doc_id",
            "source",
            F.size(words(F.col("text"))).cast("bigint").alias("size"),
            mix_key(F.col("doc_id"), F.col("text")).alias("key"),
        )
    )
    plan = budgets(sizes, ws, weights, share, most).withColumnRenamed("source", "_source")
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    # Keys are random, so their leading bits cut a source into even ranges.
    bits = F.least(
        F.lit(_KEY_BITS),
        F.greatest(F.lit(0), F.ceil(F.log2(F.col("source_rows") / RANGE_ROWS))),
    ).cast("int")
    leading = F.conv(F.substring("key", 1, _KEY_BITS // 4), 16, 10).cast("bigint")
    joined = joined.withColumn(
        "range", F.call_function("shiftright", leading, F.lit(_KEY_BITS) - bits)
    )
    sums = joined.groupBy("source", "range").agg(F.sum("size").alias("words"))
    ranges = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("_source"),
        F.col("range").alias("_range"),
        F.coalesce(F.sum("words").over(ranges), F.lit(0)).alias("offset"),
    )
    inside = (
        Window.partitionBy("source", "range")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = joined.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range"))
    placed = placed.join(offsets, same, "left").withColumn("before", F.col("before") + F.col("offset"))
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)))
    ).otherwise(0)
    rest = F.floor("target") - epochs * F.col("source_size") - F.col("before")
    last = F.least(F.col("size"), F.greatest(F.lit(0), rest))
    return placed.select(
        "doc_id",
        "source",
        "key",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + last).cast("bigint").alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """The documents of the mix with the columns of ``docs``: one row per epoch.

    Where the cut falls inside a document its last copy holds the words before the
    cut, joined by blanks; ``n_chars``, if there is one, follows.
    """
    taken = (
        mix(docs, weights, share, most)
        .where("taken > 0")
        .groupBy("key", "size", F.col("source").alias("_source"))
        # Repeated rows: as many words from each as from the fullest.
        .agg(F.max("taken").alias("taken"))
        .select(F.col("key").alias("_key"), F.col("size").alias("_size"), "_source", "taken")
    )
    columns = docs.columns
    df = packed(
        docs,
        key=mix_key(F.col("doc_id"), F.col("text")),
        source=F.col("source"),
        size=F.size(words(F.col("text"))).cast("bigint"),
    )
    same = (
        (F.col("key") == F.col("_key"))
        & (F.col("size") == F.col("_size"))
        & F.col("source").eqNullSafe(F.col("_source"))
    )
    df = df.join(taken, same).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("taken") - 1) / F.col("size"))))
    )
    part = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size"))
    cut = part < F.col("size")
    text = F.when(
        cut, F.array_join(F.slice(words(F.col("row.text")), F.lit(1), part.cast("int")), " ")
    ).otherwise(F.col("row.text"))
    values = {"text": text}
    if "n_chars" in columns:
        length = F.length(text).cast(docs.schema["n_chars"].dataType)
        values["n_chars"] = F.when(cut, length).otherwise(F.col("row.n_chars"))
    return df.select(*[values.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])
