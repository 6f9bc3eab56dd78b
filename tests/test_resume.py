"""A job that is killed after its report and started again."""

import os

import pytest

from bitacora import load_phrase_table, run
from bitacora.plans import pipeline

HEADER = "Folio,Tipo de Incidente,Notas,Municipio,Divididos\n"


def put(path, n):
    rows = [f'{1000000000 + i},2,"El incidente {1000000000 + i} ha sido ligado al incidente {1000000001 + i}.\nx",Apizaco,\n' for i in range(n)]
    path.write_text(HEADER + "".join(rows))


def lost(*_, **__):
    raise OSError("killed")


def files(folder):
    return sorted(open(os.path.join(folder, f), "rb").read() for f in os.listdir(folder) if f.startswith("part-"))


def test_a_killed_job_goes_on_from_its_report(spark, tmp_path, monkeypatch):
    source, kept = tmp_path / "in.csv", str(tmp_path / "kept")
    put(source, 20)
    want = run(spark, str(source), str(tmp_path / "want"), keep_order=True)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "component_table", lost)
        with pytest.raises(OSError):
            run(spark, str(source), str(tmp_path / "out"), keep_order=True, resume_path=kept)
    assert len(os.listdir(kept)) == 1
    with monkeypatch.context() as m:
        # The report is there, so its rows are not processed again.
        m.setattr(pipeline, "process_rows", lost)
        assert run(spark, str(source), str(tmp_path / "out"), keep_order=True, resume_path=kept) == want
        assert files(tmp_path / "out") == files(tmp_path / "want")
        assert os.listdir(kept) == []
        # Nothing is left to go on from.
        with pytest.raises(OSError):
            run(spark, str(source), str(tmp_path / "again"), resume_path=kept)


def test_changed_files_or_options_start_anew(spark, tmp_path, monkeypatch):
    source, kept = tmp_path / "in.csv", str(tmp_path / "kept")
    put(source, 5)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "component_table", lost)
        with pytest.raises(OSError):
            run(spark, str(source), str(tmp_path / "out"), resume_path=kept)
        with pytest.raises(OSError):
            run(spark, str(source), str(tmp_path / "out"), phrases=None, resume_path=kept)
        assert len(os.listdir(kept)) == 2
    put(source, 7)
    assert run(spark, str(source), str(tmp_path / "out"), resume_path=kept)["read"] == 7
    path = tmp_path / "frases.json"
    path.write_text('{"a": ["b"]}')
    with pytest.raises(ValueError, match="phrases"):
        run(spark, str(source), str(tmp_path / "o"), phrases=load_phrase_table(spark, str(path)), resume_path=kept)
