"""Separation of cancelled incidents that are related to no other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.fixed_values import GROUP_COLUMNS
from bitacora.functions.lists import as_list, folio_key
from bitacora.operators.lookup import HOT_ROWS, frequent_keys, hot_limit, keyed_lookup


def attach_groups(
    df: DataFrame,
    groups: DataFrame,
    rows: int | None = None,
    row_id: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds ``Folio_Key``, ``Grupo_ID`` and ``Tamano_Grupo`` to every row.

    Rows without a folio or without a group keep null group columns.  ``rows``
    is the row count where it is known, else they are counted; a table too small
    for a hot folio skips looking for one.  ``row_id`` is a column that tells the rows apart.
    """
    keyed = df.withColumn("Folio_Key", folio_key(F.col("Folio")))
    table = groups.select(
        folio_key(F.col("Folio")).alias("Folio_Key"), "Grupo_ID", "Tamano_Grupo"
    )
    hot = None
    rows = df.count() if rows is None else rows
    limit = hot_limit(rows, hot_rows)
    if rows >= limit:
        hot = table.join(
            F.broadcast(frequent_keys(keyed, "Folio_Key", limit)), "Folio_Key", "left_semi"
        )
    spread = F.col(f"`{row_id}`") if row_id else F.monotonically_increasing_id()
    return keyed_lookup(keyed, table, "Folio_Key", spread_by=spread, hot=hot, null_keys=True)


def is_cancelled(df: DataFrame) -> Column:
    return F.size(as_list(F.col("cancelados"), dict(df.dtypes)["cancelados"])) > 0


def is_isolated() -> Column:
    size = F.col("Tamano_Grupo")
    return size.isNull() | (size == 1)


def separate_cancelled(df: DataFrame, groups: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(cancelled and isolated rows, all other rows), group columns included.

    Every input row is in exactly one of the two.  ``options`` are those of
    ``attach_groups``.
    """
    grouped = attach_groups(df, groups, **options)
    apart = is_cancelled(grouped) & is_isolated()
    return grouped.where(apart), grouped.where(~apart)


def without_group_columns(df: DataFrame) -> DataFrame:
    return df.drop(*GROUP_COLUMNS)
