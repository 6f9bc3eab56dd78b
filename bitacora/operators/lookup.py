"""Left join of a fact table to a unique lookup table that survives hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with at least this many rows is hot.
HOT_ROWS = 1_000_000
# No more than this many keys are ever hot, about 40 bytes each: beyond as many
# million rows the limit rises with the table.
MAX_HOT_KEYS = 1_000_000

_SALTS = 4096


def hot_limit(rows: int, hot_rows: int = HOT_ROWS) -> int:
    """Rows from which a key of a table with ``rows`` rows counts as hot.

    At most ``rows / limit`` keys reach the limit, hence at most MAX_HOT_KEYS.
    """
    return max(hot_rows, rows // MAX_HOT_KEYS + 1)


def keyed_lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: Column,
    hot: DataFrame | None = None,
    null_keys: bool = False,
) -> DataFrame:
    """``facts`` with the other columns of ``table``, which is unique on ``key``.

    ``hot`` holds the rows of ``table`` whose key is frequent in ``facts``, no
    more than MAX_HOT_KEYS.  They are broadcast; their fact rows, and those with
    a null key, are spread over the shuffle by ``spread_by`` (distinct per row)
    under salts that match nothing.  Every row passes exactly once.
    """
    if hot is None and not null_keys:
        return facts.join(table, key, "left")
    given = facts.columns
    found = [c for c in table.columns if c != key]
    k = F.col(f"`{key}`")
    spread = k.isNull()
    if hot is not None:
        rows = hot.select(F.col(f"`{key}`"), F.struct(*found).alias("_hot"))
        facts = facts.join(F.broadcast(rows), key, "left")
        spread = spread | F.col("_hot").isNotNull()
    salt = F.when(spread, 1 + F.pmod(F.xxhash64(spread_by), F.lit(_SALTS))).otherwise(0)
    facts = facts.withColumn("_salt", salt)
    # As a constant the salt of the table would leave the join key again, and
    # the rows would not be spread; what a generator yields stays in it.
    cold = table.withColumn("_salt", F.explode(F.array(F.lit(0).cast("bigint"))))
    joined = facts.join(cold, [key, "_salt"], "left")
    if hot is None:
        return joined.select(*[F.col(f"`{c}`") for c in given], *found)
    return joined.select(
        *[F.col(f"`{c}`") for c in given],
        *[F.coalesce(F.col(f"_hot.{c}"), F.col(c)).alias(c) for c in found],
    )


def frequent_keys(facts: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys with at least ``limit`` rows, counted before any row is moved."""
    return (
        facts.where(F.col(f"`{key}`").isNotNull())
        .groupBy(F.col(f"`{key}`"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= limit)
        .select(F.col(f"`{key}`"))
    )
