"""CSV sources and sinks, dictionaries, and the whole job on files."""

import json
import logging
import os

import pytest
from pyspark.sql import functions as F

from bitacora import (
    assign_precinct,
    component_table,
    load_phrases,
    load_precincts,
    process_report,
    process_rows,
    read_report,
    run,
    separate_to_files,
    write_csv,
)
from bitacora.fixed_values import MISSING_TOKENS, PRECINCTS
from bitacora.fixture import ROW, incidents
from bitacora.sources.reports import ORDER, file_traits

HEADER = "Folio,Tipo de Incidente,Notas,Municipio\n"


def put(path, data):
    path.write_bytes(data if isinstance(data, bytes) else data.encode("utf-8"))
    return str(path)


def rows(df):
    return [tuple(r) for r in df.orderBy(ORDER).drop(ORDER).collect()]


def text_of(folder):
    """Contents of the part files of a CSV folder, in name order."""
    parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    return [open(os.path.join(folder, p), "rb").read() for p in parts]


def test_quotes_lines_and_blanks(spark, tmp_path):
    body = '1,2,"a ""q"", b",x\n2,2,"two\nlines",y\n\n   \n3,2, sp ,\n4,2\n5,2,"  ",z\n'
    for bom in ("", "﻿"):
        path = put(tmp_path / f"a{len(bom)}.csv", bom + HEADER + body)
        df = read_report(spark, path)
        assert df.columns == ["Folio", "Tipo de Incidente", "Notas", "Municipio", ORDER]
        assert rows(df) == [
            ("1", "2", 'a "q", b', "x"),
            ("2", "2", "two\nlines", "y"),
            ("3", "2", " sp ", None),
            ("4", "2", None, None),
            ("5", "2", "  ", "z"),
        ]


def test_encoding_is_decided_per_file(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder / "a.csv", HEADER + "1,2,España,x\n2,2,b,y\n")
    put(folder / "b.csv", (HEADER + '3,2,"España ""\n",x\n4,2,é"\xa0,y\n').encode("latin-1"))
    put(folder / "c.csv", (HEADER + "5,2,Ñandú,x\n").encode("latin-1"))
    traits = {
        os.path.basename(r["file"]): (r["latin1"], r["multiline"])
        for r in file_traits(spark, str(folder)).collect()
    }
    assert traits == {"a.csv": (False, False), "b.csv": (True, True), "c.csv": (True, False)}
    assert rows(read_report(spark, str(folder))) == [
        ("1", "2", "España", "x"),
        ("2", "2", "b", "y"),
        ("3", "2", 'España "\n', "x"),
        ("4", "2", 'é"\xa0', "y"),
        ("5", "2", "Ñandú", "x"),
    ]
    path = put(tmp_path / "one.csv", (HEADER + "1,2,Ñ,x\n").encode("latin-1"))
    assert rows(read_report(spark, path))[0][2] == "Ñ"
    assert rows(read_report(spark, path, encoding="ISO-8859-1", multiline=False))[0][2] == "Ñ"


def test_row_order_over_blocks_and_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, first, count in (("a", 0, 50), ("b", 50, 3000), ("c", 3050, 400)):
        body = "".join(f"{i},2,nota {i},x\n" for i in range(first, first + count))
        put(folder / f"{name}.csv", HEADER + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = read_report(spark, str(folder))
        assert df.rdd.getNumPartitions() > 3
        assert [r[0] for r in rows(df)] == [str(i) for i in range(3450)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_missing_values(spark, tmp_path):
    body = "".join(f"{i},2,{token},\"{token}\"\n" for i, token in enumerate(MISSING_TOKENS))
    got = rows(read_report(spark, put(tmp_path / "a.csv", HEADER + body + "99,2,Nan,nane\n")))
    assert all(r[2] is None and r[3] is None for r in got[:-1])
    assert got[-1][2:] == ("Nan", "nane")


def test_long_rows(spark, tmp_path):
    path = put(tmp_path / "a.csv", HEADER + '1,2,"a,b",x\n2,2,"a,b",x,y\n3,2\n')
    with pytest.raises(Exception, match="more than 4 fields"):
        read_report(spark, path).collect()
    with pytest.raises(Exception, match="more than 4 fields"):
        read_report(spark, path).count()
    with pytest.raises(Exception, match="more than 4 fields"):
        read_report(spark, path).select("Folio").collect()
    assert [r[0] for r in rows(read_report(spark, path, long_rows="keep"))] == ["1", "2", "3"]


def test_headers(spark, tmp_path):
    path = put(tmp_path / "a.csv", "Folio,x,x,,Notas\n1,2,3,4,5\n")
    assert read_report(spark, path).columns == ["Folio", "x", "x.1", "Unnamed: 3", "Notas", ORDER]
    with pytest.raises(ValueError, match="case"):
        read_report(spark, put(tmp_path / "b.csv", "Folio,folio\n1,2\n"))
    with pytest.raises(ValueError, match="Notas"):
        process_report(spark, put(tmp_path / "c.csv", "Folio,Tipo de Incidente\n1,2\n"))
    with pytest.raises(ValueError, match="no header"):
        read_report(spark, put(tmp_path / "d.csv", ""))
    empty = process_report(spark, put(tmp_path / "e.csv", HEADER))
    assert empty.count() == 0 and "Nota" in empty.columns


@pytest.mark.parametrize("quoted", ["", '"a\nb"'])
@pytest.mark.parametrize("bom", ["", "\ufeff"])
def test_files_must_share_the_header(spark, tmp_path, quoted, bom):
    folder = tmp_path / "in"
    folder.mkdir()
    body = f"1,2,{quoted},x\n"
    put(folder / "a.csv", bom + HEADER + body)
    put(folder / "b.csv", bom + HEADER + body)
    assert read_report(spark, str(folder)).count() == 2
    put(folder / "c.csv", bom + "Folio,Notas,Tipo de Incidente,Municipio\n" + body)
    with pytest.raises(Exception, match="(?s)header"):
        read_report(spark, str(folder)).collect()


def test_excluded_types(spark, tmp_path):
    path = put(tmp_path / "a.csv", HEADER + "1,70104,a,x\n2,,b,x\n3,70104.0,c,x\n")
    assert [r["Folio"] for r in process_report(spark, path).orderBy("Folio").collect()] == ["2", "3"]


def test_csv_output_bytes(spark, tmp_path):
    df = spark.createDataFrame(
        [(2, ' a "b", c\n', ["1", "2"], None), (1, "ñ", [], "")],
        "n int, Folio string, l array<string>, m string",
    )
    out = str(tmp_path / "out")
    write_csv(df, out, bom=True, order="n", single_file=True)
    want = "﻿Folio,l,m\nñ,[],\n\" a \"\"b\"\", c\n\",\"['1', '2']\",\n".encode()
    assert text_of(out) == [want]
    write_csv(df.drop("n"), out)
    assert all(part.startswith(b"Folio,l,m\n") for part in text_of(out))
    # Read back: the text form of lists survives, the mark does not show.
    write_csv(df.withColumn("Notas", F.lit("x")), out, bom=True)
    back = read_report(spark, out)
    assert back.columns == ["n", "Folio", "l", "m", "Notas", ORDER]
    assert {(r["Folio"], r["l"], r["m"]) for r in back.collect()} == {
        (' a "b", c\n', "['1', '2']", None), ("ñ", "[]", None),
    }


def test_precincts(spark, tmp_path):
    names = ["apizaco", "Tlaxcala", "TLAXCALA ", None, "NO EXISTE", "muñoz de domingo arenas"]
    df = spark.createDataFrame([(n, "old") for n in names], "Municipio string, comisaria string")
    got = {r["Municipio"]: r["comisaria"] for r in assign_precinct(df).collect()}
    assert [got[n] for n in names] == ["3", "1", None, None, None, "12"]
    path = put(tmp_path / "p.json", json.dumps(PRECINCTS, ensure_ascii=False, indent=1))
    loaded = load_precincts(spark, path)
    assert loaded.is_small
    assert {tuple(r) for r in loaded.frame.collect()} == {
        (name.upper(), pid) for pid, group in PRECINCTS.items() for name in group
    }
    # A dictionary too large to ship gives the same result.
    loaded.is_small = False
    again = {r["Municipio"]: r["comisaria"] for r in assign_precinct(df, loaded).collect()}
    assert again == got
    # The last id wins for a name; a missing file means no precinct; a broken one fails.
    path = put(tmp_path / "q.json", '{"2": ["a", "b"], "1": ["B", "c"]}')
    assert {tuple(r) for r in load_precincts(spark, path).frame.collect()} == {
        ("A", "2"), ("B", "1"), ("C", "1"),
    }
    assert load_precincts(spark, str(tmp_path / "none.json")) is None
    assert [r["comisaria"] for r in assign_precinct(df, None).collect()] == [None] * 6
    assert assign_precinct(df.drop("Municipio")).first()["comisaria"] is None
    with pytest.raises(Exception):
        load_precincts(spark, put(tmp_path / "r.json", "{not json")).frame.collect()


def test_phrases(spark, tmp_path, caplog):
    assert "ssc_pms" in load_phrases(spark)
    path = put(tmp_path / "p.json", '{"cat": ["Foo bar", "foo"], " ": ["x"]}')
    loaded = load_phrases(spark, path)
    assert loaded == {"cat": ["Foo bar", "foo"], " ": ["x"]}
    with caplog.at_level(logging.WARNING):
        assert load_phrases(spark, str(tmp_path / "none.json")) is None
        assert load_phrases(spark, put(tmp_path / "q.json", "[1")) is None
    assert len(caplog.records) == 2
    report = put(tmp_path / "a.csv", HEADER + "1,2,FOO BAR y foo x,\n")
    assert process_report(spark, report, phrases=loaded).first()["Nota"] == "cat y cat"
    assert process_report(spark, report, phrases=None).first()["Nota"] == "foo bar y foo x"


def test_absent_columns_are_left_out(spark, tmp_path, caplog):
    path = put(tmp_path / "a.csv", "Folio,Tipo de Incidente,Notas,Fecha,otra\n1,2,a,f,z\n")
    with caplog.at_level(logging.WARNING):
        df = process_report(spark, path)
    assert df.columns == [
        "Folio", "Fecha", "Tipo de Incidente", "comisaria", "folios_ligados", "cancelados",
        "referencia_folio", "Nota",
    ]
    assert "Latitud" in caplog.text
    out = str(tmp_path / "out")
    process_report(spark, path, out)
    assert text_of(out) == [b"Folio,Fecha,Tipo de Incidente,comisaria,folios_ligados,cancelados,"
                            b"referencia_folio,Nota\n1,f,2,,[],[],[],a\n"]


@pytest.mark.parametrize("keep_order", [True, False])
def test_whole_job(spark, sf, tmp_path, keep_order):
    raw = str(tmp_path / "raw")
    write_csv(incidents(spark, sf), raw, order=ROW)
    out = {n: str(tmp_path / n) for n in ("final", "cancelled", "clean", "relations")}
    counts = run(
        spark, raw, out["final"], out["cancelled"] if keep_order else None,
        out["clean"] if keep_order else None, out["relations"], keep_order=keep_order,
    )
    assert counts == {
        "read": 1500, "discarded": 150, "kept": 1350, "cancelled_isolated": 133, "clean": 1217,
    }
    assert all(part.startswith(b"\xef\xbb\xbfFolio,") for name in out.values()
               if os.path.exists(name) for part in text_of(name))
    final = read_report(spark, out["final"])
    assert final.columns[-4:] == ["Folio_Key", "Grupo_ID", "Tamano_Grupo", ORDER]
    final = rows(final)
    assert len(final) == 1217
    folios = [r[0] for r in final]
    if keep_order:
        assert folios == sorted(folios)
        clean = read_report(spark, out["clean"])
        assert "Grupo_ID" not in clean.columns
        assert [r[0] for r in rows(clean)] == folios
        gone = read_report(spark, out["cancelled"])
        assert gone.count() == 133 and gone.columns == clean.columns
    relations = read_report(spark, out["relations"])
    assert relations.columns == ["Folio", "Grupo_ID", "Tamano_Grupo", ORDER]
    assert relations.count() == 1435
    groups = {r["Folio"]: (r["Grupo_ID"], r["Tamano_Grupo"]) for r in relations.collect()}
    assert all(groups[r[-3]] == (r[-2], r[-1]) for r in final)


def test_separation_to_files(spark, tmp_path):
    df = spark.createDataFrame(
        [("A", ["A"], ["B"]), ("C", ["C"], []), ("D", [], [])],
        "Folio string, cancelados array<string>, folios_ligados array<string>",
    )
    out = {n: str(tmp_path / n) for n in ("cancelled", "clean", "relations")}
    cancelled, clean = separate_to_files(df, component_table(df), *out.values())
    assert [tuple(r) for r in cancelled.collect()] == [("C", ["C"], [], "C", 2, 1)]
    assert sorted(r["Folio"] for r in clean.collect()) == ["A", "D"]
    assert b"".join(text_of(out["cancelled"])).count(b"C,['C'],[]\n") == 1
    assert b"".join(text_of(out["clean"])).count(b"A,['A'],['B']\n") == 1
    relations = read_report(spark, out["relations"]).drop(ORDER).collect()
    assert {tuple(r) for r in relations} == {
        ("A", "1", "2"), ("B", "1", "2"), ("C", "2", "1"), ("D", "3", "1"),
    }


def test_rows_of_a_stream(spark, sf, tmp_path):
    table = str(tmp_path / "in")
    incidents(spark, sf).write.parquet(table)
    batch = process_rows(spark.read.parquet(table), keep=(ROW,))
    stream = spark.readStream.schema(spark.read.parquet(table).schema).parquet(table)
    query = (
        process_rows(stream, keep=(ROW,)).writeStream.format("memory").queryName("seen").start()
    )
    query.processAllAvailable()
    query.stop()
    assert sorted(map(str, spark.table("seen").collect())) == sorted(map(str, batch.collect()))
