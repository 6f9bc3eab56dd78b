"""The report stage over files that keep arriving in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bitacora.fixed_values import PHRASES
from bitacora.plans.report import process_rows
from bitacora.sources.dictionaries import Precincts
from bitacora.sources.reports import (
    BROKEN,
    CSV_OPTIONS,
    ORDER,
    checked_width,
    literal_path,
    missing_to_null,
    read_report,
    report_schema,
)
from bitacora.sources.sinks import lists_as_text


def read_report_stream(
    spark: SparkSession,
    folder: str,
    columns: list[str],
    encoding: str = "UTF-8",
    multiline: bool = False,
    files_per_batch: int = 1000,
) -> DataFrame:
    """New CSV reports in ``folder`` as a stream of strings.

    Columns, encoding and the need for multi-line records are the same for all files and
    given.  A file with another header, or a record longer than it, stops the stream.
    """
    raw = (
        spark.readStream.schema(report_schema(columns))
        .options(**CSV_OPTIONS, header=True, enforceSchema=False, columnNameOfCorruptRecord=BROKEN)
        .options(encoding=encoding, multiLine=multiline)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return missing_to_null(checked_width(raw, columns), columns)


def stream_report(
    raw: DataFrame,
    output_path: str,
    checkpoint_path: str,
    precincts: Precincts | None | str = "default",
    phrases: dict[str, list[str]] | DataFrame | None = PHRASES,
    once: bool = False,
) -> StreamingQuery:
    """Starts the processed report of a stream as CSV files, each row exactly once.

    ``checkpoint_path`` keeps what was read; a restarted job goes on from there.  With
    ``once`` the job ends when all files there are have been processed.
    """
    report = lists_as_text(process_rows(raw, precincts, phrases, keep=()))
    writer = (
        report.writeStream.format("csv")
        .options(header=True, quote='"', escape='"', emptyValue="")
        .option("checkpointLocation", checkpoint_path)
    )
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start(output_path)


def stream_files(
    spark: SparkSession,
    folder: str,
    output_path: str,
    checkpoint_path: str,
    precincts: Precincts | None | str = "default",
    phrases: dict[str, list[str]] | DataFrame | None = PHRASES,
    files_per_batch: int = 1000,
    once: bool = False,
    **read_options,
) -> StreamingQuery:
    """Starts the processed report of files that arrive, each read as the batch job reads it.

    The stream is of files, not of lines: encoding, multi-line records and the header are
    found out for each as ``read_report`` does, with its ``read_options``.  The rows of
    a batch of files are one folder ``lote=<number>`` under ``output_path``, written anew if
    the batch is tried again, so every row is there once.  No more than ``files_per_batch``
    names pass through the driver at a time.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )

    def work(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        paths = [literal_path(session, row["path"]) for row in batch.orderBy("path").collect()]
        if not paths:
            return
        report = process_rows(read_report(session, paths, **read_options), precincts, phrases)
        lists_as_text(report.drop(ORDER)).write.mode("overwrite").options(
            header=True, quote='"', escape='"', emptyValue=""
        ).csv(f"{output_path.rstrip('/')}/lote={number}")

    writer = names.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if once else writer).start()
