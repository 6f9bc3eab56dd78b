"""CSV output of reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitacora.functions.lists import format_list

_BOM = "\ufeff"


def lists_as_text(df: DataFrame) -> DataFrame:
    """Array columns in their text form, which CSV can hold."""
    arrays = [name for name, kind in df.dtypes if kind.startswith("array")]
    return df.withColumns({name: format_list(F.col(f"`{name}`")) for name in arrays})


def write_csv(
    df: DataFrame,
    path: str,
    bom: bool = False,
    order: str | None = None,
    single_file: bool = False,
) -> None:
    """Writes a folder of CSV files with header, in UTF-8, replacing what is there.

    ``bom`` starts every file with a byte-order mark.  ``order`` sorts the rows
    over all files by that column and leaves the column out.  ``single_file``
    brings everything into one file through one task, for small results only.
    """
    if order:
        df = df.orderBy(order)
    if single_file:
        df = df.coalesce(1) if order else df.repartition(1)
    columns = [c for c in df.columns if c != order]
    df = lists_as_text(df.select(*[F.col(f"`{c}`") for c in columns]))
    if bom:
        df = df.withColumnRenamed(columns[0], _BOM + columns[0])
    df.write.mode("overwrite").options(
        header=True,
        encoding="UTF-8",
        quote='"',
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
