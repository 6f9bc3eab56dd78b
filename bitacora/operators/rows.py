"""Row filters and projections of the incident report."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.fixed_values import EXCLUDED_TYPES, REPORT_COLUMNS, REQUIRED_COLUMNS

log = logging.getLogger(__name__)


def check_columns(df: DataFrame) -> DataFrame:
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"required columns not found in the report: {missing}")
    return df


def is_excluded(kind: Column) -> Column:
    """Excluded incident type; a missing type is not excluded."""
    return F.coalesce(kind.isin(EXCLUDED_TYPES), F.lit(False))


def drop_excluded_types(df: DataFrame, kind: str = "Tipo de Incidente") -> DataFrame:
    return df.where(~is_excluded(F.col(f"`{kind}`")))


def project_report(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Report columns under their output names and in their order.

    Absent columns are left out with a warning.  ``keep`` names columns to carry
    along behind them.
    """
    absent = [c for c in REPORT_COLUMNS if c not in df.columns]
    if absent:
        log.warning("columns not in the table, left out: %s", absent)
    return df.select(
        *[F.col(f"`{a}`").alias(b) for a, b in REPORT_COLUMNS.items() if a in df.columns],
        *[c for c in keep if c in df.columns],
    )


def spread_rows(df: DataFrame) -> DataFrame:
    """The scan ``df`` over all cores, where it has fewer partitions than cores.

    The text work on a row costs far more than moving it, but a file that cannot
    be split gives one partition.  A scan of many files stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
