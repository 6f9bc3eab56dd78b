"""Lists, edges, components, numbering, lookups and separation."""

import random

import pytest
from pyspark.sql import functions as F

from bitacora import (
    analyze,
    attach_groups,
    component_table,
    connected_components,
    folio_key,
    format_list,
    graph_edges,
    graph_nodes,
    parse_list,
    separate_cancelled,
)
from bitacora.fixture import ROW, incidents
from bitacora.operators.lookup import keyed_lookup
from bitacora.operators.numbering import number_rows
from bitacora.storage import Workspace
from tests.plain import components


def test_lists_and_keys(spark):
    texts = {
        "['1', '2']": ["1", "2"], "1, 2": ["1", "2"], "[]": [], None: [], "nan": [], "1,,2": ["1", "2"],
        "": [], " ": [], '["1", \'2\']': ["1", "2"], '"1", 2': ['"1"', "2"], "[1": ["1"], "[ ]": [],
        "\xa01 ,\t2 ": ["1", "2"], "[1, 2]": ["1", "2"], "NaN": ["NaN"],
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", parse_list(F.col("t")).alias("r")).collect():
        assert row["r"] == texts[row["t"]], row["t"]
    keys = {" 12 ": "12", "": None, "NaN": None, None: None, "\x1c1\xa0": "1", "nan": None, "nano": "nano"}
    df = spark.createDataFrame([(k,) for k in keys], "t string")
    for row in df.select("t", folio_key(F.col("t")).alias("r")).collect():
        assert row["r"] == keys[row["t"]]
    df = spark.createDataFrame([([],), (["a"],), (["a", "b"],)], "x array<string>")
    got = [r[0] for r in df.select(format_list(F.col("x"))).collect()]
    assert got == ["[]", "['a']", "['a', 'b']"]
    back = df.select(parse_list(format_list(F.col("x"))).alias("y"), "x").collect()
    assert all(r["x"] == r["y"] for r in back)


def edge_frame(spark, edges):
    rows = sorted({(min(e), max(e)) for e in edges if e[0] != e[1]})
    return spark.createDataFrame(rows, "src string, dst string")


def partition_of(labels):
    groups = {}
    for v, label in labels.items():
        groups.setdefault(label, set()).add(v)
    return {frozenset(g) for g in groups.values()}


def shapes():
    rng = random.Random(7)
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1000, 2000 + i) for i in range(300)]
    mixed = [(rng.randrange(3000, 3800), rng.randrange(3000, 3800)) for _ in range(500)]
    return chain + hub + mixed


@pytest.mark.parametrize(
    "name, hot_rows",
    [("1{:09d}", 1_000_000), ("1{:09d}", 20), ("F-{}", 1_000_000), ("{:010d}", 20)],
)
def test_components_match_union_find(spark, name, hot_rows):
    edges = [(name.format(a), name.format(b)) for a, b in shapes() if a != b]
    random.Random(8).shuffle(edges)
    labels, figures = connected_components(edge_frame(spark, edges), hot_rows=hot_rows)
    got = {r["folio"]: r["label"] for r in labels.collect()}
    assert partition_of(got) == partition_of(components(edges))
    assert figures["rounds"] < 16


def test_components_of_nothing(spark):
    labels, figures = connected_components(edge_frame(spark, []))
    assert labels.count() == 0 and figures == {"edges": 0, "rounds": 0}
    df = spark.createDataFrame([], "Folio string, Divididos string")
    assert component_table(df).count() == 0


def test_numbering(spark):
    values = random.Random(9).sample(range(10**6), 5000)
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    rows = number_rows(df, "v", "n", Workspace(spark)).collect()
    assert {r["v"]: r["n"] for r in rows} == {v: i + 1 for i, v in enumerate(sorted(values))}


def test_lookup_of_hot_and_null_keys(spark):
    rng = random.Random(10)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "zz", None, None])) for i in range(2000)]
    facts = spark.createDataFrame(rows, "i int, k string")
    table = spark.createDataFrame([("a", 1), ("b", 2), ("d", 4)], "k string, v int")
    want = {i: {"a": 1, "b": 2}.get(k) for i, k in rows}
    for hot in (None, table.where("k = 'a'"), table.where("false")):
        for null_keys in (True, False):
            out = keyed_lookup(facts, table, "k", F.col("i"), hot, null_keys)
            assert {r["i"]: r["v"] for r in out.collect()} == want
            assert out.count() == len(rows)


def test_hot_and_null_keys_are_spread(spark):
    rows = [(i, "a" if i % 3 == 0 else None if i % 3 == 1 else f"k{i}") for i in range(3000)]
    facts = spark.createDataFrame(rows, "i int, k string")
    table = spark.createDataFrame([("a", 1)] + [(f"k{i}", i) for i in range(3000)], "k string, v int")
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        out = keyed_lookup(facts, table, "k", F.col("i"), table.where("k = 'a'"), True)
        sizes = [
            r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        ]
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    assert len(sizes) == 8 and sum(sizes) == 3000
    assert max(sizes) < 2 * 3000 / 8


COLUMNS = (
    "n int, Folio string, cancelados array<string>, Divididos string, "
    "folios_ligados array<string>, referencia_folio array<string>"
)


def report(spark, *rows):
    full = [
        (i, r.get("f"), r.get("c", []), r.get("d"), r.get("l", []), r.get("r", []))
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, COLUMNS)


def separated(df, **options):
    cancelled, clean = separate_cancelled(df, component_table(df, "n"), **options)
    return (
        {r["n"]: (r["Grupo_ID"], r["Tamano_Grupo"]) for r in cancelled.collect()},
        {r["n"]: (r["Grupo_ID"], r["Tamano_Grupo"]) for r in clean.collect()},
    )


def test_separation_cases(spark):
    # Mentioned folios count; so A stays and C goes.
    df = report(spark, {"f": "A", "l": ["B"], "c": ["A"]}, {"f": "C", "c": ["C"]})
    assert separated(df) == ({1: (2, 1)}, {0: (1, 2)})
    # No folio: no node, no edges, but the row is kept and counts as isolated.
    df = report(spark, {"f": None, "c": ["X"], "l": ["B"]}, {"f": "B"})
    assert separated(df) == ({0: (None, None)}, {1: (1, 1)})
    # A link to itself is none.
    df = report(spark, {"f": "A", "l": ["A"], "c": ["A"]})
    assert separated(df) == ({0: (1, 1)}, {})
    # Rows are judged one by one, also rows of one folio.
    df = report(spark, {"f": "A", "c": ["A"]}, {"f": " A "})
    assert separated(df) == ({0: (1, 1)}, {1: (1, 1)})
    # The flag belongs to the row that carries it, whatever folio it names.
    df = report(spark, {"f": "A", "c": ["B"]}, {"f": "B"})
    assert separated(df) == ({0: (1, 1)}, {1: (2, 1)})
    # Groups are numbered by their first row; all relation columns make edges.
    df = report(
        spark, {"f": "Z", "d": "['Y']"}, {"f": "D"}, {"f": "X", "r": ["Y", "nan"]}, {"f": "A", "d": "Q, Q"}
    )
    assert separated(df) == ({}, {0: (1, 3), 2: (1, 3), 1: (2, 1), 3: (3, 2)})
    for options in ({"rows": 4, "hot_rows": 1}, {"rows": 4, "row_id": "n"}):
        assert separated(df, **options)[1][2] == (1, 3)


def test_cancelled_as_text_and_missing_relations(spark):
    df = spark.createDataFrame(
        [("A", "['A']"), ("B", "[]"), ("C", None)], "Folio string, cancelados string"
    )
    assert graph_edges(df).count() == 0
    cancelled, clean = separate_cancelled(df, component_table(df))
    assert [r["Folio"] for r in cancelled.collect()] == ["A"]
    assert sorted(r["Folio"] for r in clean.collect()) == ["B", "C"]


def brute_force(rows):
    """Group and size per folio from collected report rows, in row order."""
    edges, order = [], []
    for r in rows:
        order.append(r["Folio"])
        text = (r["Divididos"] or "").strip("[]").replace("'", "")
        related = [x.strip() for x in text.split(",") if x.strip()]
        for other in related + r["folios_ligados"] + r["referencia_folio"]:
            edges.append((r["Folio"], other))
    root = components(edges + [(f, f) for f in order])
    size, number = {}, {}
    for v in root:
        size[root[v]] = size.get(root[v], 0) + 1
    for f in order:
        number.setdefault(root[f], len(number) + 1)
    return {v: (number[root[v]], size[root[v]]) for v in root}


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_fixture_groups_match_brute_force(spark, sf, hot_rows):
    result = analyze(incidents(spark, sf), ROW, hot_rows=hot_rows)
    rows = result.rows.orderBy(ROW).collect()
    want = brute_force(rows)
    groups = {r["Folio"]: (r["Grupo_ID"], r["Tamano_Grupo"]) for r in result.groups.collect()}
    assert groups == want
    assert result.counts == {"read": 1500, "discarded": 150, "kept": 1350}
    assert len(rows) == 1350
    for r in rows:
        assert (r["Grupo_ID"], r["Tamano_Grupo"]) == want[r["Folio"]]
        assert r["_apart"] == (bool(r["cancelados"]) and want[r["Folio"]][1] == 1)
    assert result.cancelled.count() == 133
    assert (len(groups), max(g for g, _ in groups.values()), max(s for _, s in groups.values())) == (
        1435, 918, 17,
    )


def test_nodes_and_hub_report(spark):
    # One folio in a third of the rows, another linked from all of them.
    rows = [{"f": "H" if i % 3 == 0 else f"N{i}", "l": ["T"]} for i in range(300)]
    df = report(spark, *rows, {"f": "S", "c": ["S"]})
    assert graph_nodes(df).count() == 200 + 1 + 1 + 1
    groups = component_table(df, "n", hot_rows=10)
    out = attach_groups(df, groups, rows=301, row_id="n", hot_rows=10).collect()
    assert len(out) == 301
    assert {(r["Grupo_ID"], r["Tamano_Grupo"]) for r in out if r["n"] < 300} == {(1, 202)}
    assert [(r["Grupo_ID"], r["Tamano_Grupo"]) for r in out if r["n"] == 300] == [(2, 1)]


def test_only_folios_that_are_no_plain_numbers_are_numbered(spark, monkeypatch):
    from bitacora.operators import graph

    numbered, number = [], graph.number_rows

    def seen(df, *args):
        numbered.extend(r["folio"] for r in df.collect())
        return number(df, *args)

    monkeypatch.setattr(graph, "number_rows", seen)
    edges = [("1", "2"), ("2", "3"), ("01", "1x"), ("1x", "9" * 18), ("4", "9" * 19), ("-5", "0")]
    for given, odd in ((edges[:2], set()), (edges, {"01", "1x", "9" * 19, "-5", "0"})):
        numbered.clear()
        labels, _ = connected_components(edge_frame(spark, given))
        got = {r["folio"]: r["label"] for r in labels.collect()}
        assert partition_of(got) == partition_of(components(given))
        assert set(numbered) == odd
