"""Records of CSV files that span lines, read by as many tasks as a file has blocks.

A line can't tell alone whether it begins inside a quoted cell, but it can tell for both
cases how it ends.  That makes it a function of one bit; functions compose, so every block
of a file has one too, and a small table of blocks gives each the state it begins in:

1. every line gets its two outcomes;
2. per block they are composed, per file the blocks are;
3. with the state of its block every line knows whether it begins a record, and lines are
   glued to records;
4. what is open at the end of a block meets the beginning of the next.

Quotes are told apart as the reports' own reader does: one at the start of a cell opens it,
two inside are one quote, after one that closes text goes on as it is, and elsewhere a
quote is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Encodings in which the bytes of quotes, commas and line ends mean nothing else.
_LATIN1 = {"iso-8859-1", "latin-1", "latin1"}
SPLITTABLE = {"utf-8", "utf8", "us-ascii", "ascii"} | _LATIN1

# States of the reading of a line: at the start of a cell, in one without quotes, in a quoted
# one, at a quote in that, in text after the quoted part.
_FRESH, _BARE, _QUOTED, _CLOSING, _TAIL = range(5)


def _after_text(state: Column, text: Column) -> Column:
    """State after a text without quotes."""
    outside = F.when(text.endswith(","), _FRESH)
    return (
        F.when((text == "") | (state == _QUOTED), state)
        .when(state.isin(_CLOSING, _TAIL) & ~text.contains(","), _TAIL)
        .otherwise(F.coalesce(outside, F.lit(_BARE)))
    )


def _after_quote(state: Column) -> Column:
    return (
        F.when(state.isin(_FRESH, _CLOSING), _QUOTED)
        .when(state == _QUOTED, _CLOSING)
        .otherwise(state)
    )


def _ends_inside(pieces: Column, state: int) -> Column:
    """Whether a line, cut at its quotes, that begins in a state ends inside a quoted cell."""
    numbered = F.transform(pieces, lambda p, i: F.struct(p.alias("text"), i.alias("i")))

    def step(now: Column, piece: Column) -> Column:
        return _after_text(F.when(piece["i"] > 0, _after_quote(now)).otherwise(now), piece["text"])

    return F.aggregate(numbered, F.lit(state), step) == _QUOTED


def goes_on(text: Column) -> Column:
    """Whether text may follow a closing quote in its cell."""
    return text.contains('"') & (
        text.rlike(r'[^,"\n]"[^,"\n\r]') | text.rlike(r'(?:^|,)""[^,"\n\r]')
    )


def plain_cells(record: Column) -> Column:
    """A record in which text after a closing quote stands inside the quotes.

    ``"ab"c"d`` means ``abc"d``, which is written ``"abc""d"``.
    """
    pieces = F.transform(F.split(record, '"', -1), lambda p, i: F.struct(p.alias("text"), i.alias("i")))
    start = F.struct(F.lit(_FRESH).alias("state"), F.lit("").alias("out"))

    def step(now: Column, piece: Column) -> Column:
        text, before = piece["text"], now["state"]
        state = F.when(piece["i"] > 0, _after_quote(before)).otherwise(before)
        # A closing quote is held back until it is known what follows.
        quote = (
            F.when(piece["i"] == 0, "")
            .when((before == _QUOTED), "")
            .when(before.isin(_CLOSING, _TAIL), '""')
            .otherwise('"')
        )
        at = F.locate(",", text)
        closed = F.when(
            at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.lit('"'), F.substring(text, at, F.length(text)))
        ).otherwise(text)
        held = state.isin(_CLOSING, _TAIL) & (text != "")
        said = F.when(held, closed).otherwise(text)
        return F.struct(
            _after_text(state, text).alias("state"), F.concat(now["out"], quote, said).alias("out")
        )

    done = F.aggregate(pieces, start, step)
    closed = F.when(done["state"].isin(_CLOSING, _TAIL), F.concat(done["out"], F.lit('"'))).otherwise(done["out"])
    return F.when(goes_on(record), closed).otherwise(record)


def _lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """file, block, row, the text of the line, and how it ends from outside and inside."""
    raw = F.col("value")
    if encoding.lower() in _LATIN1:
        raw = F.decode(raw.cast("binary"), "ISO-8859-1")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        raw.alias("line"),
    )
    pieces = F.split("line", '"', -1)
    quoted = F.col("line").contains('"')
    return lines.select(
        "*",
        F.when(quoted, _ends_inside(pieces, _FRESH)).otherwise(False).alias("from_out"),
        F.when(quoted, _ends_inside(pieces, _QUOTED)).otherwise(True).alias("from_in"),
    )


def _running(lines: DataFrame, *keep: str) -> DataFrame:
    """Every line with the composition of its block up to it: how it ends from either state.

    A line that ends alike from both states forgets what was before; of the others each
    either keeps the state or turns it over.
    """
    order = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    forgets = F.col("from_out") == F.col("from_in")
    lines = lines.withColumn("turns", F.sum((F.col("from_out") & ~F.col("from_in")).cast("bigint")).over(order))
    known = F.when(forgets, F.struct(F.col("from_out").alias("state"), F.col("turns").alias("turns")))
    lines = lines.withColumn("known", F.last(known, ignorenulls=True).over(order))
    since = (F.col("turns") - F.coalesce("known.turns", F.lit(0))) % 2 == 1

    def end(start: bool) -> Column:
        return F.coalesce("known.state", F.lit(start)) != since

    return lines.select("file", "block", "row", *keep, end(False).alias("end_out"), end(True).alias("end_in"))


def _block_starts(lines: DataFrame) -> DataFrame:
    """file, block, and whether the block begins inside a quoted cell; one row per block."""
    # Lines that keep the state say nothing about the block, except that it is there.
    telling = lines.where(F.col("from_out") | ~F.col("from_in"))
    every = lines.select("file", "block").distinct()
    last = (
        _running(telling.select("file", "block", "row", "from_out", "from_in"))
        .groupBy("file", "block")
        .agg(F.max_by(F.struct("end_out", "end_in"), "row").alias("end"))
    )
    blocks = every.join(last, ["file", "block"], "left").select(
        "file", "block", F.coalesce("end.end_out", F.lit(False)).alias("from_out"),
        F.coalesce("end.end_in", F.lit(True)).alias("from_in"),
    )
    # Blocks are to a file as lines are to a block.
    as_lines = blocks.select("file", F.lit(0).alias("block"), F.col("block").alias("row"), "from_out", "from_in")
    before = Window.partitionBy("file").orderBy("row")
    return _running(as_lines).select(
        "file",
        F.col("row").alias("block"),
        F.coalesce(F.lag("end_out").over(before), F.lit(False)).alias("starts_inside"),
    )


def scan_tasks(spark: SparkSession, path: str | list[str]) -> int:
    """How many tasks read the files."""
    return spark.read.text(path).select("value").rdd.getNumPartitions()


def read_records(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """Every record that isn't blank: its file, block and row, which are its order, ``record``,
    its text, and ``is_header``, which is true for the first of a file.
    """
    lines = _lines(spark, path, encoding)
    of_block = Window.partitionBy("file", "block").orderBy("row")
    so_far = of_block.rowsBetween(Window.unboundedPreceding, 0)
    # Blocks are those of the same scan; a line without one stops the job.
    lost = F.raise_error(F.lit("a block of the file has changed")).cast("boolean")
    told = _running(lines, "line").join(_block_starts(lines), ["file", "block"], "left")
    told = told.withColumn("starts_inside", F.coalesce("starts_inside", lost))
    inside = F.when(F.col("starts_inside"), F.col("end_in")).otherwise(F.col("end_out"))
    told = told.withColumn("inside", inside)
    told = told.withColumn("begins", ~F.coalesce(F.lag("inside").over(of_block), F.col("starts_inside")))
    filled = F.col("begins") & F.col("line").rlike(r"[^\s\ufeff]")
    told = told.withColumns(
        {
            "rec": F.last(F.when(F.col("begins"), F.col("row")), ignorenulls=True).over(so_far),
            "nth": F.sum(filled.cast("int")).over(so_far),
        }
    )
    pieces = told.groupBy("file", "block", "rec").agg(
        F.array_sort(F.collect_list(F.struct("row", "line"))).alias("lines"),
        F.max_by("inside", "row").alias("open"),
        F.min("nth").alias("nth"),
    )
    pieces = pieces.select(
        "file", "block", "rec", "open",
        F.array_join(F.col("lines.line"), "\n").alias("text"),
        (F.col("rec").isNotNull() & (F.col("block") == 0) & (F.col("nth") == 1)).alias("is_header"),
    )
    whole = pieces.where(F.col("rec").isNotNull() & ~F.col("open")).select(
        "file", "block", F.col("rec").alias("row"), F.col("text").alias("record"), "is_header"
    )
    # At most two a block: what began in an earlier one, and what goes on in the next.
    in_order = Window.partitionBy("file").orderBy("block", F.col("rec").asc_nulls_first())
    owner = F.last(F.when(F.col("rec").isNotNull(), F.struct("block", "rec")), ignorenulls=True).over(
        in_order.rowsBetween(Window.unboundedPreceding, 0)
    )
    part = F.struct("block", F.col("rec").isNotNull().alias("own"), "text")
    glued = (
        pieces.where(F.col("rec").isNull() | F.col("open"))
        .withColumn("owner", owner)
        .groupBy("file", F.col("owner.block").alias("owner_block"), F.col("owner.rec").alias("row"))
        .agg(F.array_sort(F.collect_list(part)).alias("parts"), F.max("is_header").alias("is_header"))
        .select(
            "file", F.col("owner_block").alias("block"), "row",
            F.array_join(F.col("parts.text"), "\n").alias("record"), "is_header",
        )
    )
    # A carriage return before a line end belongs to it; the mark of the encoding to nothing.
    text = F.regexp_replace("record", "\r(?=\n|\\z)", "")
    text = F.when(F.col("is_header"), F.regexp_replace(text, "\\A\ufeff", "")).otherwise(text)
    return (
        whole.unionByName(glued)
        .withColumn("record", text)
        .where(F.col("record").rlike(r"\S"))
        .select("file", "block", "row", "record", "is_header")
    )
