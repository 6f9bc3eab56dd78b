"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a hash of the document.  It starts
with one bucket of no bits; only buckets above the byte limit split, on the next
bit, until every shard fits.  A shard is named by its bits.

Bytes are those of the text in UTF-8, none for a null text.  Rows that agree in
doc_id and text share all bits and stay in one shard, as does a single text above
the limit: such a shard splits as long as that parts it from others, and at the
last bit it may stay above the limit.  An empty table has no shard.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.llm.text import given, packed, row_digest, unpacked
from bitacora.storage import Workspace

# Bits of a hash, and how many of them a round of splitting looks at.
BITS, STEP = 60, 6
LIMIT = 16 << 20


def hash_bits(doc_id: Column, text: Column) -> Column:
    """60 bits of a digest of id and text, so texts under one id are told apart."""
    return F.conv(F.substring(row_digest(doc_id, text), 1, BITS // 4), 16, 10).cast("bigint")


def _prefix(bits: Column, depth: Column | int) -> Column:
    if isinstance(depth, int):
        return F.shiftright(bits, BITS - depth)
    return F.call_function("shiftright", bits, (F.lit(BITS) - depth).cast("int"))


def directory(docs: DataFrame, limit: int = LIMIT) -> list[tuple[int, DataFrame]]:
    """Per level of bits: entry (leading bits), its shard's depth and bytes.

    Each round adds up bytes by STEP more bits, only for what is still above the
    limit, and reads the sums at every depth between from these: one bucket may
    hold all rows, as they are summed before anything is moved.
    """
    ws = Workspace(docs.sparkSession)
    slim, _ = ws.stage(
        docs.select(
            hash_bits(F.col("doc_id"), F.col("text")).alias("bits"),
            F.octet_length(given(F.col("text"))).cast("bigint").alias("bytes"),
        )
        .groupBy("bits")
        .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    )
    levels: list[tuple[int, DataFrame]] = []
    open_rows = slim
    for low in range(0, BITS, STEP):
        high = low + STEP
        sums = open_rows.groupBy(_prefix(F.col("bits"), high).alias("entry")).agg(
            F.sum("bytes").alias("bytes"), F.max("bits").alias("most"), F.min("bits").alias("least")
        )
        depths = F.sequence(F.lit(low), F.lit(high))
        each = sums.select(
            "entry", "most", "least", "bytes", F.explode(depths).alias("depth")
        ).withColumn("prefix", F.call_function("shiftright", F.col("entry"), (F.lit(high) - F.col("depth")).cast("int")))
        # A bucket that holds one hash value only can't be split any more.
        fits = each.groupBy("depth", "prefix").agg(
            F.sum("bytes").alias("shard_bytes"),
            (F.min("least") == F.max("most")).alias("single"),
        ).where((F.col("shard_bytes") <= limit) | F.col("single") | (F.col("depth") == BITS))
        chosen = (
            each.join(fits, ["depth", "prefix"])
            .groupBy("entry")
            .agg(F.min(F.struct("depth", "shard_bytes")).alias("s"))
        )
        level = sums.select("entry").join(chosen, "entry", "left").select(
            "entry", F.col("s.depth").alias("depth"), F.col("s.shard_bytes").alias("shard_bytes")
        )
        level, seen = ws.stage(level, open=F.count_if(F.col("depth").isNull()))
        levels.append((high, level.where(F.col("depth").isNotNull())))
        if not seen["open"]:
            break
        still = level.where(F.col("depth").isNull()).select(F.col("entry").alias("_entry"))
        open_rows = open_rows.join(still, _prefix(F.col("bits"), high) == F.col("_entry"), "left_semi")
    return levels


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``row`` with the document, its ``bytes``, ``shard`` (bits), ``depth``, ``shard_bytes``."""
    df = packed(
        docs,
        bits=hash_bits(F.col("doc_id"), F.col("text")),
        bytes=F.octet_length(given(F.col("text"))).cast("bigint"),
    )
    found = []
    for high, level in directory(docs, limit):
        name = f"level_{high}"
        entry = level.select(
            F.col("entry").alias(f"entry_{high}"), F.struct("depth", "shard_bytes").alias(name)
        )
        df = df.join(entry, _prefix(F.col("bits"), high) == F.col(f"entry_{high}"), "left")
        found.append(F.col(name))
    df = df.withColumn("s", reduce(lambda a, b: F.coalesce(a, b), found))
    # Leading zeros count: the bits are those below a one put in front of all.
    bits = F.substring(F.bin(F.col("bits").bitwiseOR(F.lit(1 << BITS))), 2, BITS)
    return df.select(
        "row",
        "bytes",
        F.substring(bits, F.lit(1), F.col("s.depth")).alias("shard"),
        F.col("s.depth").cast("bigint").alias("depth"),
        F.col("s.shard_bytes").alias("shard_bytes"),
    )


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Writes each shard of ``docs`` as a folder ``shard=<bits>`` of Parquet files.

    Rows are sorted by shard before writing, so that a task holds few files open.
    """
    placed = unpacked(assign(docs, limit), docs.columns, F.concat(F.lit("b"), F.col("shard")).alias("shard"))
    placed.repartitionByRange("shard", "doc_id").write.partitionBy("shard").parquet(path)
