"""CSV incident reports as DataFrames of strings."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bitacora.fixed_values import MISSING_TOKENS
from bitacora.operators.rows import spread_rows
from bitacora.sources.records import SPLITTABLE, goes_on, plain_cells, read_records, scan_tasks

# Order of the rows in the input: file, block of the file, row in the block.
ORDER = "_orden"
BROKEN = "_corrupt_record"
# The width of a record shows only when all of its cells are parsed.
CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnPruning": False}


def _escaped(path: str) -> str:
    """A path that matches only itself where patterns are allowed."""
    return "".join("\\" + ch if ch in "{}[]*?\\" else ch for ch in path)


def literal_path(spark: SparkSession, path: str | list[str]) -> str | list[str]:
    """``path``, escaped where a file or folder of just that name exists."""
    if not isinstance(path, str):
        return [literal_path(spark, p) for p in path]
    if _escaped(path) == path:
        return path
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return _escaped(path) if system.exists(place) else path


def _named_file(uri: str) -> str:
    """The path of a file from the address that a scan gives for it."""
    return _escaped(unquote(uri))


def file_traits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, latin1, multiline, goes_on) for every input file, from one pass over its lines.

    A file with any line that is not UTF-8 is read as Latin-1.  A quoted field
    can only span lines if some line holds an odd number of quotes.  In a file that
    goes on, text may follow a closing quote in its cell.  All others are left to the
    plain reader.
    """
    line = F.col("value")
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            (~F.is_valid_utf8(line)).alias("latin1"),
            (quotes % 2 == 1).alias("multiline"),
            goes_on(F.when(F.is_valid_utf8(line), line).otherwise("")).alias("goes_on"),
        )
        .groupBy("file")
        .agg(*[F.max(c).alias(c) for c in ("latin1", "multiline", "goes_on")])
    )


def _first_record(
    spark: SparkSession, path: str | list[str], options: dict, width: int = 64
) -> list[str | None] | None:
    """The cells of the first record.

    It is read under a schema of some width, as finding one out would take file names
    for patterns; a record of another width comes with its text, which tells it.
    """
    cells = [f"c{i}" for i in range(width)]
    schema = StructType([StructField(c, StringType()) for c in [*cells, BROKEN]])
    reader = spark.read.schema(schema).options(
        header=False, columnNameOfCorruptRecord=BROKEN, **options
    )
    fields = _field_count(F.col(BROKEN)).alias("fields")
    row = reader.csv(path).select(*cells, BROKEN, fields).first()
    if row is None:
        return None
    count = width if row[BROKEN] is None else row["fields"]
    return list(row)[:count] if count <= width else _first_record(spark, path, options, count)


def _column_names(
    spark: SparkSession, path: str | list[str], options: dict
) -> tuple[list[str], list[str | None]]:
    """Names from the header record, and its cells as they are.

    Repeated names get .1, .2 and so on, empty ones a name by their position.
    """
    first = _first_record(spark, path, options)
    if first is None:
        raise ValueError(f"no header in {path}")
    names: list[str] = []
    for at, name in enumerate(first):
        name = f"Unnamed: {at}" if name is None else name
        unique, again = name, 0
        while unique in names:
            again += 1
            unique = f"{name}.{again}"
        names.append(unique)
    folded: dict[str, str] = {}
    for name in names:
        other = folded.setdefault(name.lower(), name)
        if other != name:
            raise ValueError(f"columns differ only in case: {other!r}, {name!r}")
    return names, first


def _check_headers(
    spark: SparkSession, path: str | list[str], width: int, options: dict
) -> None:
    """Raises unless all files have the same first record."""
    cells = [f"c{i}" for i in range(width + 1)]
    schema = StructType([StructField(c, StringType()) for c in cells])
    records = spark.read.schema(schema).options(header=False, **options).csv(path)
    at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    firsts = (
        records.select(
            F.col("_metadata.file_path").alias("file"), at.alias("at"), F.struct(*cells).alias("cells")
        )
        .groupBy("file")
        .agg(F.min_by("cells", "at").alias("cells"))
        .select("cells")
        .distinct()
        .take(2)
    )
    if len(firsts) > 1:
        raise ValueError(f"headers differ between files: {firsts[0].cells} and {firsts[1].cells}")


def _field_count(record: Column) -> Column:
    """Number of fields in the text of one CSV record."""
    bare = F.regexp_replace(record, r'"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _order(file: Column | str, block: Column | str, row: Column | str) -> Column:
    columns = (F.col(c) if isinstance(c, str) else c for c in (file, block, row))
    return F.struct(*[c.alias(n) for c, n in zip(columns, ("file", "block", "row"))])


def checked_width(df: DataFrame, names: list[str], long_rows: str = "fail") -> DataFrame:
    """Rows of the width of the header, from rows that come with the text of odd records.

    Lines of blanks go, short rows stay padded with nulls, long ones are an error.
    """
    # (A scan may not ask for the record alone, so the first cell is looked at too.)
    record, first = F.col(BROKEN), F.col(f"`{names[0]}`")
    filled = record.isNull() | first.rlike(r"\S") | record.rlike(r"\S")
    df = df.where(F.coalesce(filled, F.lit(False)))
    if long_rows == "fail":
        too_long = F.coalesce(_field_count(record) > len(names), F.lit(False))
        message = F.concat(F.lit(f"more than {len(names)} fields in record: "), record)
        df = df.where(F.assert_true(~too_long, message).isNull())
    return df.drop(BROKEN)


def report_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in [*names, BROKEN]])


def _read_alike(
    spark: SparkSession, path: str | list[str], names: list[str], options: dict, long_rows: str
) -> DataFrame:
    df = (
        spark.read.schema(report_schema(names))
        .options(header=True, columnNameOfCorruptRecord=BROKEN, **options)
        .csv(path)
    )
    at = _order("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return checked_width(df.withColumn(ORDER, at), names, long_rows)


def _read_split(
    spark: SparkSession, path: str | list[str], names: list[str], header: list[str | None],
    encoding: str, long_rows: str,
) -> DataFrame:
    """The same rows of files whose records span lines, by as many tasks as they have blocks."""
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    records = read_records(spark, path, encoding).withColumn("record", plain_cells(F.col("record")))
    width = len(header)
    wide = ", ".join(f"c{i} string" for i in range(width + 1))
    cells = F.from_csv("record", F.lit(wide), {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    want = F.array(*[F.lit(c).cast("string") for c in [*header, None]])
    found = F.array(*[cells.getField(f"c{i}") for i in range(width + 1)])
    other = F.concat(F.lit(f"the header is not {header} but: "), F.col("record"))
    # A header that is another stops the job, one that is right is no row.
    bad = F.when(~found.eqNullSafe(want), F.raise_error(other).cast("boolean"))
    rows = records.where(F.when(F.col("is_header"), F.coalesce(bad, F.lit(False))).otherwise(True))
    fields = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in report_schema(names))
    row = F.from_csv("record", F.lit(fields), options).alias("_row")
    df = rows.select(row, _order("file", "block", "row").alias(ORDER)).select("_row.*", ORDER)
    return checked_width(df, names, long_rows)


def missing_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cells that spell a missing value become null."""
    return df.withColumns(
        {
            c: F.when(~F.col(f"`{c}`").isin(MISSING_TOKENS), F.col(f"`{c}`"))
            for c in columns
        }
    )


def read_report(
    spark: SparkSession,
    path: str | list[str],
    encoding: str | None = None,
    multiline: bool | None = None,
    long_rows: str = "fail",
) -> DataFrame:
    """Reads CSV reports with a header; every column is a string.

    ``path`` is a file, a folder or a list; all files share one header.  UTF-8
    or Latin-1 and the need for multi-line records are found out per file,
    unless both ``encoding`` and ``multiline`` say so for all.  Records longer
    than the header stop the job, or lose the surplus with ``long_rows="keep"``.
    The column ``_orden`` holds the order of the rows.

    Files whose records span lines are read by block all the same, unless their
    encoding has quotes or line ends of several bytes.
    """
    if long_rows not in ("fail", "keep"):
        raise ValueError("long_rows is 'fail' or 'keep'")
    path = literal_path(spark, path)
    if encoding is not None and multiline is not None:
        kinds = {(encoding, multiline): path}
    else:
        # One small row per file; the driver lists the files anyway.
        kinds = {}
        for row in file_traits(spark, path).collect():
            found = "ISO-8859-1" if row["latin1"] else "UTF-8"
            kind = (
                found if encoding is None else encoding,
                row["multiline"] or row["goes_on"] if multiline is None else multiline,
            )
            kinds.setdefault(kind, []).append(_named_file(row["file"]))
        if len(kinds) == 1:
            kinds = {kind: path for kind in kinds}
    if not kinds:
        raise ValueError(f"no header in {path}")
    names = None
    parts = []
    cores = spark.sparkContext.defaultParallelism
    for (charset, spans_lines), files in sorted(kinds.items(), key=lambda kind: kind[0]):
        options = {**CSV_OPTIONS, "encoding": charset, "multiLine": spans_lines}
        found, header = _column_names(spark, files, options)
        if names is None:
            names = found
        elif found != names:
            raise ValueError(f"headers differ between files: {names} and {found}")
        if spans_lines and charset.lower() in SPLITTABLE:
            part = _read_split(spark, files, names, header, charset, long_rows)
            # A small file has fewer blocks than there are cores for its rows.
            parts.append(part.repartition(cores) if scan_tasks(spark, files) < cores else part)
            continue
        # Every file is checked to have this header: by the scan, which compares
        # names, or here where the names had to be made up.
        options["enforceSchema"] = names != list(header)
        if options["enforceSchema"]:
            _check_headers(spark, files, len(names), options)
        part = _read_alike(spark, files, names, options, long_rows)
        parts.append(spread_rows(part) if spans_lines else part)
    return missing_to_null(reduce(DataFrame.unionByName, parts), names)
