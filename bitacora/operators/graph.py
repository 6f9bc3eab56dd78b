"""Graph of related folios: nodes, edges, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.fixed_values import RELATION_COLUMNS
from bitacora.functions.lists import as_list, folio_key
from bitacora.operators.lookup import (
    HOT_ROWS,
    frequent_keys,
    hot_limit,
    keyed_lookup,
)
from bitacora.operators.numbering import number_rows
from bitacora.storage import Workspace


def graph_edges(df: DataFrame) -> DataFrame:
    """Undirected edges (src < dst), each once, from all relation columns.

    Relation columns may be arrays or list text; absent ones are skipped.
    """
    types = dict(df.dtypes)
    lists = [as_list(F.col(c), types[c]) for c in RELATION_COLUMNS if c in types]
    if not lists:
        return df.sparkSession.createDataFrame([], "src string, dst string")
    return (
        df.select(folio_key(F.col("Folio")).alias("a"), F.explode(F.concat(*lists)).alias("b"))
        .select("a", folio_key(F.col("b")).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
        .distinct()
    )


def graph_nodes(df: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Folios of the report together with those only mentioned by it."""
    edges = graph_edges(df) if edges is None else edges
    own = df.select(folio_key(F.col("Folio")).alias("folio")).where("folio is not null")
    ends = edges.select(F.explode(F.array("src", "dst")).alias("folio"))
    return own.union(ends).distinct()


def _renamed(name: Column) -> Column:
    """A fresh random order of integers in which taking a minimum is cheap.

    The hash maps 64-bit numbers one to one, so no two ever share a name.
    """
    return F.xxhash64(name)


def _is_plain(folio: Column) -> Column:
    """Whether the folio is a positive number as numbers are written, below 10^18."""
    return folio.rlike(r"^[1-9][0-9]{0,17}\z")


def _numbered_ends(
    edges: DataFrame, odd: int, ws: Workspace, hot_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """Edges between integers, and the folios that negative integers (``id``) stand for.

    Folios are any text.  A plain number is its own integer; only other folios, on ``odd`` of
    the edges, are numbered and looked up.
    """
    ends = ("src", "dst")
    own = [F.col(end).try_cast("bigint").alias(f"{end}_id") for end in ends]
    if not odd:
        return edges.select(*own), None
    both = _is_plain(F.col("src")) & _is_plain(F.col("dst"))
    others = edges.select(F.explode(F.array(*ends)).alias("folio")).where(~_is_plain(F.col("folio")))
    numbers = number_rows(others.distinct(), "folio", "_number", ws).select(
        "folio", (-F.col("_number")).cast("bigint").alias("id")
    )
    limit = hot_limit(odd, hot_rows)
    rest = found = edges.where(~both)
    for end in ends:
        table = numbers.select(F.col("folio").alias(end), F.col("id").alias(f"{end}_id"))
        hot = None
        if odd >= limit:
            keys = frequent_keys(rest, end, limit)
            hot = table.join(F.broadcast(keys), end, "left_semi")
        found = keyed_lookup(found, table, end, spread_by=F.struct("src", "dst"), hot=hot)
    looked_up = [F.coalesce(f"{end}_id", F.col(end).try_cast("bigint")).alias(f"{end}_id") for end in ends]
    return edges.where(both).select(*own).union(found.select(*looked_up)), numbers


def connected_components(
    edges: DataFrame, ws: Workspace | None = None, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, dict]:
    """Labels (folio, label) for every folio on an edge, and figures of the run.

    Randomised contraction (Boegeholz, Brand and Todor, "In-database connected
    component analysis", ICDE 2020).  A round orders the vertices at random and
    merges each into the smallest of itself and its neighbours; edges inside a
    merged vertex vanish.  A constant share of the vertices goes in each round
    whatever the shape of the graph, long chains and huge hubs included, so the
    tables shrink geometrically.  Labels come from following the merges back,
    smallest table first.

    ``edges`` holds (src, dst) of distinct strings; labels are integers.
    """
    ws = ws or Workspace(edges.sparkSession)
    odd = ~(_is_plain(F.col("src")) & _is_plain(F.col("dst")))
    given, seen = ws.stage(
        edges.select("src", "dst"), edges=F.count(F.lit(1)), odd=F.count_if(odd)
    )
    count = figures_edges = seen["edges"]
    if not count:
        empty = edges.sparkSession.createDataFrame([], "folio string, label bigint")
        return empty, {"edges": 0, "rounds": 0}
    ids, numbers = _numbered_ends(given, seen["odd"], ws, hot_rows)
    current = ids.select(
        _renamed(F.col("src_id")).alias("a"), _renamed(F.col("dst_id")).alias("b"), "src_id", "dst_id"
    )
    merges: list[tuple[DataFrame, int]] = []
    while count:
        limit = hot_limit(2 * count, hot_rows)
        # The first merges keep the integers, which can't be told from the names.
        ids = ("a", "b") if merges else ("src_id", "dst_id")
        merge = (
            current.selectExpr("stack(2, a, b, {}, b, a, {}) as (name, other, id)".format(*ids))
            .groupBy("name")
            .agg(
                F.min("other").alias("_least"),
                F.count(F.lit(1)).alias("degree"),
                F.min("id").alias("id"),
            )
            .select("name", F.least("name", "_least").alias("into"), "degree", "id")
        )
        is_hot = False
        if 2 * count >= limit:
            # Large enough for a hot vertex: look, and keep what was computed.
            merge, seen = ws.stage(merge, degree=F.max("degree"))
            is_hot = seen["degree"] >= limit
        merges.append((merge.select("name", "into", "id"), 2 * count))
        moved = current.select("a", "b")
        for end in ("a", "b"):
            table = merge.select(
                F.col("name").alias(end), F.col("into").alias(f"{end}_into"), "degree"
            )
            moved = keyed_lookup(
                moved,
                table.drop("degree"),
                end,
                spread_by=F.struct("a", "b"),
                hot=table.where(F.col("degree") >= limit).drop("degree") if is_hot else None,
            )
        a, b = (_renamed(F.col(f"{end}_into")) for end in ("a", "b"))
        current, seen = ws.stage(
            moved.where(F.col("a_into") != F.col("b_into"))
            .select(a.alias("x"), b.alias("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            edges=F.count(F.lit(1)),
        )
        count = seen["edges"]

    figures = {"edges": figures_edges, "rounds": len(merges)}
    # Labels are names of the last round.  A vertex whose edges are all gone does
    # not occur in the later rounds; renaming it up to the last one keeps its
    # label apart from every other.
    last = len(merges) - 1
    labels = merges[last][0].select("name", F.col("into").alias("label"), "id")
    for at in range(last - 1, -1, -1):
        merge, rows = merges[at]
        step = merge.select(
            F.col("name").alias("_from"), _renamed(F.col("into")).alias("name"), F.col("id").alias("_id")
        )
        complete = F.col("name")
        for _ in range(at + 2, last + 1):
            complete = _renamed(complete)
        hot, limit = None, hot_limit(rows, hot_rows)
        if rows >= limit:
            labels, _ = ws.stage(labels)
            keys = frequent_keys(step, "name", limit)
            hot = labels.join(F.broadcast(keys), "name", "left_semi")
        labels = keyed_lookup(step, labels.drop("id"), "name", spread_by=F.col("_from"), hot=hot).select(
            F.col("_from").alias("name"), F.coalesce("label", complete).alias("label"), F.col("_id").alias("id")
        )
    folio = F.col("id").cast("string")
    if numbers is not None:
        labels, folio = labels.join(numbers, "id", "left"), F.coalesce("folio", folio)
    return labels.select(folio.alias("folio"), "label"), figures


def component_table(
    df: DataFrame,
    order: str | None = None,
    ws: Workspace | None = None,
    hot_rows: int = HOT_ROWS,
    edges: DataFrame | None = None,
) -> DataFrame:
    """Components of the relation graph as (Folio, Grupo_ID, Tamano_Grupo).

    Components are numbered from 1 by their earliest report row, which
    ``order`` (a column distinct per row) defines; without it, by their
    smallest folio.  Folios that are only mentioned belong to the component of
    the row that mentions them.
    """
    ws = ws or Workspace(df.sparkSession)
    edges = graph_edges(df) if edges is None else edges
    rounds = Workspace(df.sparkSession)
    try:
        labels, _ = connected_components(edges, rounds, hot_rows)
        labels, seen = ws.stage(labels, folios=F.count(F.lit(1)))
    finally:
        rounds.remove()

    place = F.col(f"`{order}`") if order else folio_key(F.col("Folio"))
    own = (
        df.select(folio_key(F.col("Folio")).alias("folio"), place.alias("first"))
        .where(F.col("folio").isNotNull())
        .groupBy("folio")
        .agg(F.min("first").alias("first"))
    )
    placed = own.join(labels, "folio", "full")
    if not order:
        placed = placed.withColumn("first", F.col("folio"))
    # One aggregation for both kinds: a folio without edges is its own key.
    components = placed.groupBy(
        "label", F.when(F.col("label").isNull(), F.col("folio")).alias("Folio")
    ).agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("Tamano_Grupo"))
    numbered = number_rows(components, "first", "Grupo_ID", ws)

    groups = numbered.where(F.col("label").isNotNull()).select(
        "label", "Grupo_ID", "Tamano_Grupo"
    )
    limit = hot_limit(seen["folios"], hot_rows)
    hot = groups.where(F.col("Tamano_Grupo") >= limit) if seen["folios"] >= limit else None
    members = keyed_lookup(labels, groups, "label", spread_by=F.col("folio"), hot=hot)
    columns = ("Grupo_ID", "Tamano_Grupo")
    return numbered.where(F.col("label").isNull()).select("Folio", *columns).union(
        members.select(F.col("folio").alias("Folio"), *columns)
    )
