"""CSV files whose records span lines, read in blocks, against pandas and the plain reader."""

import random

import pandas as pd
import pytest

from bitacora.sources.records import read_records, scan_tasks
from bitacora.sources.reports import ORDER, read_report

HEADER = "Folio,Tipo de Incidente,Notas,Municipio\n"


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def cell(rng):
    kind = rng.randrange(9)
    if kind == 0:
        return '"' + "".join(rng.choice(["a", "\n", ",", '""', " ", "é", "b c"]) for _ in range(rng.randrange(30))) + '"'
    if kind == 1:
        return f'"x{rng.randrange(9)}"tail {rng.randrange(9)}'
    if kind == 2:
        return f'mid"quote{rng.randrange(9)}"'
    if kind == 3:
        return '"ab"c"d'
    if kind == 4:
        return '""after'
    return "".join(rng.choice("abc xyz") for _ in range(rng.randrange(1, 12))).strip() or "z"


def table(rng, n, plain=False):
    rows = []
    for i in range(n):
        cells = [cell(rng) for _ in range(3)]
        if plain:
            cells = [c if c.count('"') % 2 == 0 and not c.startswith('"x') and c[0] in '"abcxyz' and "tail" not in c
                     and c != '""after' and not c.startswith("mid") else "p" for c in cells]
            cells = ["p" if c.startswith('"ab"') else c for c in cells]
        rows.append(f"{i},{','.join(cells)}\n" + ("\n" if rng.random() < 0.05 else ""))
    return HEADER + "".join(rows)


def wanted(path, encoding="utf-8"):
    frame = pd.read_csv(path, dtype=str, keep_default_na=False, encoding=encoding)
    return [tuple(None if v in ("", "nan", "NA") else v for v in r) for r in frame.itertuples(index=False)]


def got(df):
    return [tuple(r)[:-1] for r in df.orderBy(ORDER).collect()]


@pytest.mark.parametrize("seed", range(4))
def test_against_another_reader(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    path = tmp_path / "a.csv"
    path.write_text(table(rng, 150), newline="")
    df = read_report(spark, str(path))
    assert scan_tasks(spark, str(path)) > 8
    assert got(df) == wanted(path)
    # One block or many, the rows are the same.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    assert got(read_report(spark, str(path))) == wanted(path)


def test_same_rows_as_the_plain_reader(spark, tmp_path, small_blocks):
    rng = random.Random(9)
    path = tmp_path / "a.csv"
    path.write_text(table(rng, 200, plain=True), newline="")
    raw = (
        spark.read.options(header=True, multiLine=True, quote='"', escape='"', nullValue="").csv(str(path)).collect()
    )
    assert got(read_report(spark, str(path))) == [tuple(r) for r in raw]


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_several_files(spark, tmp_path, small_blocks, encoding, end):
    folder = tmp_path / "in"
    folder.mkdir()
    rng = random.Random(3)
    want = []
    for name in ("b", "a", "c"):
        path = folder / f"{name} 1 [x].csv"
        text = table(rng, 40).replace("\r", "")
        bom = "﻿" if encoding == "utf-8" and name == "a" else ""
        path.write_bytes((bom + text.replace("\n", end) + f'99,"one{end}two",ñ,z').encode(encoding))
        want += [
            tuple(v and v.replace("\r\n", "\n") for v in r) for r in wanted(path, "utf-8-sig" if bom else encoding)
        ]
    df = read_report(spark, str(folder))
    assert sorted(got(df), key=repr) == sorted(want, key=repr)
    assert df.columns[:1] == ["Folio"]


def test_records_longer_than_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f'line {i} ""quoted"", and more' for i in range(400))
    text = HEADER + f'1,2,"{long}",x\n2,2,b,y\n3,2,"{long}\n{long}",z\n"4",2,"","q\n\n"\n'
    path = tmp_path / "a.csv"
    path.write_text(text, newline="")
    assert got(read_report(spark, str(path))) == wanted(path)
    records = read_records(spark, str(path)).orderBy("file", "block", "row").collect()
    assert [r.is_header for r in records] == [True] + [False] * 4


def test_header_over_lines_and_rows_that_are_too_long(spark, tmp_path, small_blocks):
    path = tmp_path / "a.csv"
    path.write_text('\n\n"Fo\nlio",Notas,x,x,\n1,"a\nb",3,4,5\n1,"a"b,3\n', newline="")
    df = read_report(spark, str(path))
    assert df.columns == ["Fo\nlio", "Notas", "x", "x.1", "Unnamed: 4", ORDER]
    assert got(df) == [("1", "a\nb", "3", "4", "5"), ("1", "ab", "3", None, None)]
    path.write_text(HEADER + '1,2,"a\nb",x,y\n2,2,c,d\n', newline="")
    with pytest.raises(Exception, match="more than 4 fields"):
        read_report(spark, str(path)).collect()
    assert [r[0] for r in got(read_report(spark, str(path), long_rows="keep"))] == ["1", "2"]


def test_a_megabyte_of_quotes(spark, tmp_path):
    """Cells of many quotes take time in proportion."""
    path = tmp_path / "a.csv"
    path.write_text(HEADER + '1,2,"' + '""' * 50_000 + '\n",x\n2,2,"a"b' + '"c' * 5_000 + ",y\n", newline="")
    assert got(read_report(spark, str(path))) == wanted(path)
