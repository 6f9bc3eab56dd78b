"""Report processing: from raw incident rows to the processed report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitacora.fixed_values import PHRASES
from bitacora.functions.text import normalize_text
from bitacora.operators.notes import extract_notes
from bitacora.operators.precincts import assign_precinct
from bitacora.operators.rows import check_columns, drop_excluded_types, project_report
from bitacora.sources.dictionaries import Precincts
from bitacora.sources.reports import ORDER, read_report
from bitacora.sources.sinks import write_csv


def process_rows(
    df: DataFrame,
    precincts: Precincts | None | str = "default",
    phrases: dict[str, list[str]] | DataFrame | None = PHRASES,
    keep: tuple[str, ...] = (ORDER,),
) -> DataFrame:
    """Filter, extract, normalise, look up, project: one stage without a shuffle.

    Works on batch and streaming frames alike.  ``keep`` names columns to carry
    along behind the report columns.
    """
    rows = drop_excluded_types(check_columns(df))
    rows = rows.withColumn("Notas", F.coalesce("Notas", F.lit("")))
    rows = extract_notes(rows, "Notas", phrases)
    rows = rows.withColumn("nota_limpia", normalize_text(F.col("nota_limpia")))
    return project_report(assign_precinct(rows, precincts), keep)


def process_report(
    spark: SparkSession,
    input_path: str | list[str],
    output_path: str | None = None,
    precincts: Precincts | None | str = "default",
    phrases: dict[str, list[str]] | DataFrame | None = PHRASES,
    **read_options,
) -> DataFrame:
    """Processed report of a CSV report, also written as CSV if asked for."""
    report = process_rows(read_report(spark, input_path, **read_options), precincts, phrases)
    if output_path:
        write_csv(report.drop(ORDER), output_path)
    return report.drop(ORDER)
