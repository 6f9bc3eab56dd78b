"""What once was a limit or a switch: names, sizes, kinds of keys, numbers of phrases."""

import json
import os

import pytest
from pyspark.sql import functions as F

from bitacora import (
    analyze,
    assign_precinct,
    collapse_phrases,
    load_phrases,
    load_precincts,
    parse_list,
    process_rows,
    read_report,
    run,
    separate_cancelled,
    substitution_map,
)
from bitacora.fixed_values import PHRASES, PRECINCTS, SPANISH_STOP_WORDS
from bitacora.functions.phrases import dictionary_pattern, replace_phrases
from bitacora.operators.graph import connected_components
from bitacora.operators.separation import attach_groups
from tests import plain

HEADER = "Folio,Tipo de Incidente,Notas,Municipio\n"


def put(path, text, charset="utf-8"):
    path.write_bytes(text.encode(charset))
    return str(path)


def notes_of(df):
    return sorted(r["Notas"] for r in df.collect())


@pytest.mark.parametrize("name", ["con espacio", "100%", "a+b", "a[1]", "b{2}", "año ñandú", "q?*", "r#s"])
def test_file_and_folder_names(spark, tmp_path, name):
    folder = tmp_path / f"{name} in"
    folder.mkdir()
    put(folder / f"{name} 1.csv", HEADER + "1,2,ñ uno,x\n")
    put(folder / f"{name} 2.csv", HEADER + "2,2,ñ dos,x\n", "latin-1")
    put(folder / f"{name} 3.csv", HEADER + '3,2,"ñ\ntres",x\n')
    assert notes_of(read_report(spark, str(folder))) == ["ñ\ntres", "ñ dos", "ñ uno"]
    one = [str(folder / f"{name} {i}.csv") for i in (1, 2)]
    assert notes_of(read_report(spark, one)) == ["ñ dos", "ñ uno"]
    run(spark, str(folder), str(tmp_path / "out"))
    assert any(f.startswith("part-") for f in os.listdir(tmp_path / "out"))


def test_headers_with_repeated_names_are_compared(spark, tmp_path):
    head = "Folio,Tipo de Incidente,Notas,x,x\n"
    (tmp_path / "in").mkdir()
    put(tmp_path / "in/1.csv", head + "1,2,n,a,b\n")
    put(tmp_path / "in/2.csv", head + "2,2,m,a,b\n")
    assert notes_of(read_report(spark, str(tmp_path / "in"))) == ["m", "n"]
    put(tmp_path / "in/3.csv", "Tipo de Incidente,Folio,Notas,x,x\nq,p,n,a,b\n")
    with pytest.raises(ValueError, match="headers differ"):
        read_report(spark, str(tmp_path / "in"))


def test_dictionaries_of_several_files(spark, tmp_path):
    folder = tmp_path / "frases [1]"
    folder.mkdir()
    put(folder / "1.json", json.dumps({"c1": ["uno dos"], "c2": ["tres"]}))
    put(folder / "2.json", json.dumps({"c2": ["cuatro"], "c3": ["x" * 100] * 3}))
    assert load_phrases(spark, str(folder)) == {
        "c1": ["uno dos"], "c2": ["tres", "cuatro"], "c3": ["x" * 100] * 3,
    }
    names = tmp_path / "comisarias"
    names.mkdir()
    put(names / "1.json", '{"1": ["a", "b"]}')
    put(names / "2.json", '{"0": ["B", "c"]}')
    found = {tuple(r) for r in load_precincts(spark, str(names)).frame.collect()}
    assert found == {("A", "1"), ("B", "0"), ("C", "0")}


def test_large_dictionary_on_a_stream(spark, tmp_path):
    put(tmp_path / "p.json", json.dumps(PRECINCTS, ensure_ascii=False))
    large = load_precincts(spark, str(tmp_path / "p.json"))
    large.is_small = False
    rows = [("1", "2", "nota", "Apizaco"), ("2", "2", "nota", "nada")]
    df = spark.createDataFrame(rows, "Folio string, `Tipo de Incidente` string, Notas string, Municipio string")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        process_rows(stream, large, keep=()).writeStream.format("memory").queryName("precincts")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert {r.Folio: r.comisaria for r in spark.table("precincts").collect()} == {"1": "3", "2": None}
    # The same in batch, also where a municipality is frequent.
    for hot in (1, 1_000_000):
        found = assign_precinct(df, large, hot_rows=hot).collect()
        assert {r.Folio: r.comisaria for r in found} == {"1": "3", "2": None}


def test_thousands_of_phrases(spark):
    phrases = {f"frase {i} x": f"<<T{i}>>" for i in range(2000)}
    texts = [f"a frase {i} x b frase {i + 1} xx" for i in range(0, 2100, 100)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r.text for r in collapse_phrases(df, "text", phrases).collect()]
    expected = [t and plain.without(t, phrases, lambda p: f" {phrases[p]} ") for t in texts]
    assert found == expected


def test_long_and_nested_phrases(spark):
    words = {"palabra " * 200 + "fin": "larga"} | {"a" * n: f"n{n}" for n in range(1, 400)}
    assert dictionary_pattern(words)
    texts = ["x " + "palabra " * 200 + "fin y", "aaa b " + "a" * 399, "a" * 400]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r.out for r in replace_phrases(df, "text", words, "out").collect()]
    assert found == ["x larga y", "n3 b n399", "a" * 400]


def test_labels_are_integers(spark):
    schema = "src string, dst string"
    for edges in ([], [("1", "2")], [("007", "7"), ("7", "A 1"), ("x", "y"), ("10", "9")]):
        labels, _ = connected_components(spark.createDataFrame(edges, schema))
        assert labels.schema["label"].dataType.simpleString() == "bigint"
        roots = plain.components(edges)
        found = {r.folio: r.label for r in labels.collect()}
        assert set(found) == set(roots)
        assert all((found[a] == found[b]) == (roots[a] == roots[b]) for a in roots for b in roots)


def test_rows_are_counted_where_unknown(spark):
    rows = spark.createDataFrame([("1",)] * 50 + [("2",), (None,)], "Folio string")
    groups = spark.createDataFrame([("1", 1, 3), ("2", 2, 1)], "Folio string, Grupo_ID long, Tamano_Grupo long")
    for given in (None, 52):
        found = attach_groups(rows, groups, rows=given, hot_rows=10)
        assert found.where("Folio = '1' and Grupo_ID = 1").count() == 50
        assert found.count() == 52
    cancelled, clean = separate_cancelled(rows.withColumn("cancelados", F.array(F.lit("9"))), groups)
    assert (cancelled.count(), clean.count()) == (2, 50)


def test_token_map_in_the_order_given(spark):
    top = spark.createDataFrame(
        [("b", 5, 1), ("a", 9, 2), ("b", 1, 3), ("c", 2, 4)], "phrase string, freq long, place long"
    )
    found = {r.phrase: (r.token, r["rank"]) for r in substitution_map(top, "T", order="place").collect()}
    assert found == {"a": ("<<T_2>>", 2), "b": ("<<T_3>>", 3), "c": ("<<T_4>>", 4)}


def test_malformed_lists_keep_their_quotes(spark):
    texts = ['["1, 2]', '["1", "2"]', '["a" b]', "['a']", '[ "x" , y ]']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.x for r in df.select(parse_list(F.col("t")).alias("x")).collect()] == [
        ['"1', "2"], ["1", "2"], ['"a" b'], ["a"], ["x", "y"],
    ]


def test_plain_frame_and_closing(spark):
    rows = [("1", "2", "Folio 1000000001 cancelado por X", "Apizaco")]
    df = spark.createDataFrame(rows, "Folio string, `Tipo de Incidente` string, Notas string, Municipio string")
    result = analyze(df)
    assert result.rows.count() == 1
    folder = result.ws.path.removeprefix("file:")
    assert os.path.isdir(folder)
    result.close()
    assert not os.path.exists(folder)


def test_fixed_values():
    assert len(PRECINCTS) == 13 and sum(map(len, PRECINCTS.values())) == 67
    assert sum(map(len, PHRASES.values())) == 72
    assert {"de", "la", "que"} <= set(SPANISH_STOP_WORDS)
