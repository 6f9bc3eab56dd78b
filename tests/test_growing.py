"""Components that grow batch by batch against one run over all edges."""

import random

import pytest

from bitacora.operators.growing import GrowingComponents
from tests import plain


def frame(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string")


def wanted(edges):
    """Folio -> smallest folio of its component."""
    roots = plain.components(edges)
    least = {}
    for folio, root in roots.items():
        least[root] = min(least.get(root, folio), folio)
    return {folio: least[root] for folio, root in roots.items()}


def labels(store):
    rows = store.labels().collect()
    assert len({r.folio for r in rows}) == len(rows)
    return {r.folio: r.label for r in rows}


def test_batches_equal_one_run(spark, tmp_path):
    rng = random.Random(1)
    store = GrowingComponents(spark, str(tmp_path / "store"), buckets=8)
    assert labels(store) == {}
    every = []
    for size in (40, 1, 60):
        edges = [(f"f{rng.randrange(150):03}", f"f{rng.randrange(150):03}") for _ in range(size)]
        edges = [e for e in edges if e[0] != e[1]] or [("f001", "f002")]
        every += edges
        figures = store.add(frame(spark, edges + edges[:3]))
        assert labels(store) == wanted(every)
    assert figures["batch"] == 3
    # The same edges again add nothing, and neither does a batch without any.
    assert store.add(frame(spark, every)) == {"batch": 4, "folios": 0, "joined": 0}
    store.add(frame(spark, []))
    assert labels(GrowingComponents(spark, str(tmp_path / "store"), buckets=8)) == wanted(every)


def test_chains_of_joins(spark, tmp_path):
    """Each batch joins what the one before labelled to something smaller."""
    store = GrowingComponents(spark, str(tmp_path / "store"))
    every = []
    for k in (9, 8, 7):
        edges = [(f"a{k}", f"b{k}")] + ([(f"a{k}", f"a{k + 1}")] if k < 9 else [])
        every += edges
        store.add(frame(spark, edges))
    assert labels(store) == wanted(every) and set(labels(store).values()) == {"a7"}


def test_a_failed_batch_is_written_anew(spark, tmp_path, monkeypatch):
    store = GrowingComponents(spark, str(tmp_path / "store"), buckets=4)
    store.add(frame(spark, [("a", "b"), ("c", "d")]))
    with monkeypatch.context() as m:
        m.setattr(GrowingComponents, "_mark", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.add(frame(spark, [("b", "x"), ("q", "r")]))
    assert labels(store) == {"a": "a", "b": "a", "c": "c", "d": "c"}
    store.add(frame(spark, [("b", "c")]))
    assert labels(store) == {f: "a" for f in "abcd"}


def test_only_touched_buckets_are_read(spark, tmp_path):
    store = GrowingComponents(spark, str(tmp_path / "store"), buckets=64)
    store.add(frame(spark, [(f"a{i}", f"b{i}") for i in range(500)]))
    ends = spark.createDataFrame([("a1",), ("b1",)], "folio string")
    read = store._touched("labels", ends, "folio")
    assert len({f.split("bucket=")[1].split("/")[0] for f in read.inputFiles()}) >= 1
    files = read.select("folio").distinct()
    assert files.count() < 100
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:200]
