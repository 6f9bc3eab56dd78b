"""Precinct of an incident by its municipality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitacora.operators.lookup import HOT_ROWS, frequent_keys, hot_limit, keyed_lookup
from bitacora.sources.dictionaries import Precincts, default_precincts


def assign_precinct(
    df: DataFrame,
    precincts: Precincts | None | str = "default",
    municipality: str = "Municipio",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sets ``comisaria`` from the municipality, ignoring case but not spaces.

    Unknown and missing municipalities get null, and so does every row when
    there is no dictionary (``precincts`` of None) or no municipality column.
    """
    if precincts == "default":
        precincts = default_precincts(df.sparkSession)
    if precincts is None or municipality not in df.columns:
        return df.withColumn("comisaria", F.lit(None).cast("string"))
    names = precincts.frame.select(F.col("municipio").alias("_name"), "comisaria")
    rows = df.drop("comisaria").withColumn("_name", F.upper(F.col(f"`{municipality}`")))
    if precincts.is_small:
        return rows.join(F.broadcast(names), "_name", "left").drop("_name")
    if df.isStreaming:
        # No counts of a stream: a plain join.
        return rows.join(names, "_name", "left").drop("_name")
    # Too large to ship: only the entries of frequent municipalities are.
    hot, count = None, rows.count()
    limit = hot_limit(count, hot_rows)
    if count >= limit:
        frequent = frequent_keys(rows, "_name", limit)
        hot = names.join(F.broadcast(frequent), "_name", "left_semi")
    return keyed_lookup(
        rows,
        names,
        "_name",
        spread_by=F.monotonically_increasing_id(),
        hot=hot,
        null_keys=True,
    ).drop("_name")
