"""The whole job: report, relation graph, separation, files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bitacora.fixed_values import PHRASES
from bitacora.operators.graph import component_table, graph_edges
from bitacora.operators.lookup import HOT_ROWS
from bitacora.operators.rows import check_columns, is_excluded
from bitacora.operators.separation import (
    attach_groups,
    is_cancelled,
    is_isolated,
    without_group_columns,
)
from bitacora.plans.report import process_rows
from bitacora.plans.resume import KeptStages
from bitacora.sources.dictionaries import Precincts
from bitacora.sources.reports import ORDER, read_report
from bitacora.sources.sinks import write_csv
from bitacora.storage import Workspace

APART = "_apart"


@dataclass
class Result:
    """Frames of a pipeline run and the row counts of its stages."""

    rows: DataFrame  # every report row, its group and the flag ``_apart``
    groups: DataFrame
    counts: dict[str, int] = field(default_factory=dict)
    ws: Workspace | None = None

    def close(self) -> None:
        """Deletes the tables behind the frames, which stop working."""
        if self.ws:
            self.ws.remove()

    @property
    def clean(self) -> DataFrame:
        return self.rows.where(~F.col(APART)).drop(APART)

    @property
    def cancelled(self) -> DataFrame:
        return self.rows.where(APART).drop(APART)


def analyze(
    df: DataFrame,
    order: str | None = ORDER,
    precincts: Precincts | None | str = "default",
    phrases: dict[str, list[str]] | DataFrame | None = PHRASES,
    ws: Workspace | None = None,
    hot_rows: int = HOT_ROWS,
    keep_groups: bool = True,
    kept: KeptStages | None = None,
) -> Result:
    """Report, graph and separation of raw incident rows.

    The processed report is written to the workspace once: the graph reads four
    narrow columns of it and the join back reads the rest, and the row order is
    fixed by then.  Without ``order``, or where a plain frame has none, groups are
    numbered by folio.  ``keep_groups=False`` spares writing the groups, for callers
    that read them with the rows only.  ``kept`` holds a report that was finished before,
    or gets it.
    """
    ws = ws or Workspace(df.sparkSession)
    order = None if order == ORDER and ORDER not in df.columns else order
    kind = F.col("`Tipo de Incidente`")
    counted = check_columns(df).withColumn("_excluded", is_excluded(kind))
    report, seen = kept and kept.find("report") or _stage_report(counted, order, precincts, phrases, kept or ws)
    groups = component_table(report, order, ws, hot_rows, edges=graph_edges(report))
    if keep_groups:
        groups, _ = ws.stage(groups)
    grouped = attach_groups(report, groups, seen["kept"], order, hot_rows)
    rows = grouped.withColumn(APART, is_cancelled(grouped) & is_isolated())
    return Result(rows, groups, seen, ws)


def _stage_report(counted, order, precincts, phrases, ws):
    read = Observation()
    counted = counted.observe(
        read,
        F.count(F.lit(1)).alias("read"),
        F.count_if("_excluded").alias("discarded"),
    )
    keep = (order,) if order else ()
    rows, count = process_rows(counted, precincts, phrases, keep), F.count(F.lit(1))
    if isinstance(ws, KeptStages):
        report, kept = ws.stage("report", rows, kept=count)
        ws.finish("report", report, {**read.get, **kept})
    else:
        report, kept = ws.stage(rows, kept=count)
    return report, {**read.get, **kept}


def separate_to_files(
    df: DataFrame,
    groups: DataFrame,
    cancelled_path: str | None = None,
    clean_path: str | None = None,
    relations_path: str | None = None,
    ws: Workspace | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``separate_cancelled`` that also writes the parts, each if it has a path.

    The files leave out the group columns; the frames keep them.  The joined
    rows are written to the workspace once and read for every part.
    """
    ws = ws or Workspace(df.sparkSession)
    grouped = attach_groups(df, groups)
    rows, _ = ws.stage(grouped.withColumn(APART, is_cancelled(grouped) & is_isolated()))
    done = Result(rows, groups)
    for part, path in ((done.cancelled, cancelled_path), (done.clean, clean_path)):
        if path:
            write_csv(without_group_columns(part), path, bom=True)
    if relations_path:
        write_csv(groups, relations_path, bom=True)
    return done.cancelled, done.clean


def run(
    spark: SparkSession,
    input_path: str | list[str],
    output_path: str,
    cancelled_path: str | None = None,
    clean_path: str | None = None,
    relations_path: str | None = None,
    precincts: Precincts | None | str = "default",
    phrases: dict[str, list[str]] | DataFrame | None = PHRASES,
    keep_order: bool = False,
    single_file: bool = False,
    resume_path: str | None = None,
    **read_options,
) -> dict[str, int]:
    """CSV report in, clean CSV report out; returns the row counts of the stages.

    ``output_path`` gets the clean rows with their group columns.  The optional
    files get the cancelled rows and the clean rows without them, and the
    component table.  All files start with a byte-order mark.  ``keep_order``
    writes the rows in input order, for one more shuffle.

    ``resume_path`` is a folder that outlives the job.  There the processed report, which
    takes most of the time, is kept until all files are written: the same job over the same
    files, started again, goes on from it.
    """
    ws = Workspace(spark)
    kept = None
    if resume_path:
        told = precincts if isinstance(precincts, str) or precincts is None else precincts.frame
        options = {"precincts": told, "phrases": phrases, **read_options}
        kept = KeptStages(spark, resume_path, input_path, options)
    try:
        raw = read_report(spark, input_path, **read_options)
        result = analyze(
            raw, ORDER, precincts, phrases, ws, keep_groups=bool(relations_path), kept=kept
        )
        flag = F.col(APART)
        measures = {"cancelled_isolated": F.count_if(flag), "clean": F.count_if(~flag)}
        seen = Observation()
        if keep_order or single_file or cancelled_path or clean_path:
            # Shuffled again or written more than once: join, and count, only once.
            rows, counts = ws.stage(result.rows, **measures)
        else:
            counts = None
            rows = result.rows.observe(seen, *[m.alias(n) for n, m in measures.items()])
        done = Result(rows, result.groups)
        order = ORDER if keep_order else None

        def write(df: DataFrame, path: str | None) -> None:
            if path:
                df = df if keep_order else df.drop(ORDER)
                write_csv(df, path, bom=True, order=order, single_file=single_file)

        write(done.clean, output_path)
        write(without_group_columns(done.cancelled), cancelled_path)
        write(without_group_columns(done.clean), clean_path)
        if relations_path:
            write_csv(done.groups, relations_path, bom=True, single_file=single_file)
        counts = {**result.counts, **(counts or seen.get)}
        if kept:
            kept.remove()
        return counts
    finally:
        ws.remove()
