"""The streaming report job against the batch report."""

import pytest

from bitacora import process_rows, read_report
from bitacora.streaming import read_report_stream, stream_files, stream_report

COLUMNS = ["Folio", "Tipo de Incidente", "Notas", "Municipio"]


def test_each_file_is_processed_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def arrive(k):
        rows = [
            f"{k},2,Folio 100000000{k} cancelado por X,Apizaco",
            f"{k}9,70104,nada,x",
            f"{k}8,2,NA,",
        ]
        (folder / f"{k}.csv").write_text(",".join(COLUMNS) + "\n" + "\n".join(rows) + "\n")

    def work():
        raw = read_report_stream(spark, str(folder), COLUMNS, files_per_batch=1)
        stream_report(raw, out, str(tmp_path / "state"), once=True).awaitTermination(120)

    arrive(1)
    arrive(2)
    work()
    arrive(3)
    work()
    found = spark.read.csv(out, header=True, quote='"', escape='"').select("Folio", "comisaria", "cancelados")
    batch = process_rows(read_report(spark, str(folder)), keep=())
    expected = {(r.Folio, r.comisaria, str(list(r.cancelados))) for r in batch.collect()}
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == 6 and set(rows) == expected


def _stream(spark, tmp_path, text):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(text)
    raw = read_report_stream(spark, str(folder), COLUMNS)
    return stream_report(raw, str(tmp_path / "out"), str(tmp_path / "state"), once=True)


@pytest.mark.parametrize(
    "text, message",
    [
        ("Notas,Folio,Tipo de Incidente,Municipio\nhola,1,2,x\n", "header"),
        (",".join(COLUMNS) + "\n1,2,hola,x,y\n", "more than 4 fields"),
    ],
)
def test_odd_files_stop_the_stream(spark, tmp_path, text, message):
    with pytest.raises(Exception, match=f"(?is){message}"):
        _stream(spark, tmp_path, text).awaitTermination(120)


def test_files_of_all_kinds_as_a_stream(spark, tmp_path):
    """Encodings, records over lines and text after quotes: the same as the batch report."""
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    head = ",".join(COLUMNS) + "\n"
    files = {
        "a.csv": (head + "1,2,Folio 1000000001 cancelado por X,Apizaco\n").encode(),
        "b [1].csv": (head + '2,2,"España\ny más",MUÑOZ DE DOMINGO ARENAS\n').encode("latin-1"),
        "c.csv": (head + '3,2,"uno"dos,x\n4,70104,nada,x\n').encode(),
    }

    def work():
        stream_files(spark, str(folder), out, str(tmp_path / "state"), files_per_batch=1, once=True).awaitTermination(240)

    for name in ("a.csv", "b [1].csv"):
        (folder / name).write_bytes(files[name])
    work()
    (folder / "c.csv").write_bytes(files["c.csv"])
    work()
    work()
    found = spark.read.csv(out, header=True, quote='"', escape='"', multiLine=True)
    batch = process_rows(read_report(spark, str(folder)), keep=())
    columns = ["Folio", "comisaria", "Nota"]
    want = sorted(tuple(v or None for v in r) for r in batch.select(*columns).collect())
    assert sorted(map(tuple, found.select(*columns).collect())) == want
    assert {r.Nota for r in found.collect()} > {"españa y más", "unodos"}


def test_odd_header_stops_the_stream_of_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(",".join(COLUMNS) + "\n1,2,x,y\n")
    (folder / "b.csv").write_text("Notas,Folio,Tipo de Incidente,Municipio\nx,1,2,y\n")
    query = stream_files(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "state"), once=True)
    with pytest.raises(Exception, match="(?is)header"):
        query.awaitTermination(120)
