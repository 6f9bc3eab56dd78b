
from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bitacora import (  # noqa: E402
    assign_precinct,
    collapse_phrases,
    component_table,
    drop_excluded_types,
    drop_frequent,
    extract_notes,
    folio_key,
    format_list,
    graph_edges,
    graph_nodes,
    load_phrases,
    load_precincts,
    normalize_text,
    parse_list,
    remove_phrases,
    run,
    separate_to_files,
    substitution_map,
    tokenize_frequent,
    top_ngrams,
)
from bitacora.fixed_values import PRECINCTS, REQUIRED_COLUMNS  # noqa: E402
from bitacora.fixed_values import SPANISH_STOP_WORDS as STOP_WORDS  # noqa: E402
from bitacora.fixture import INCIDENTS_SQL, ROW, incidents  # noqa: E402
from bitacora.functions.lists import prioritized_distinct  # noqa: E402
from bitacora.functions.phrases import flatten_dictionary, replace_phrases  # noqa: E402
from bitacora.functions.text import repair_mojibake  # noqa: E402
from bitacora.operators.graph import connected_components  # noqa: E402
from bitacora.operators.growing import GrowingComponents  # noqa: E402
from bitacora.operators.rows import check_columns, spread_rows  # noqa: E402
from bitacora.operators.separation import attach_groups  # noqa: E402
from bitacora.plans.pipeline import analyze  # noqa: E402
from bitacora.plans.report import process_rows  # noqa: E402
from bitacora.sources.reports import ORDER, read_report  # noqa: E402
from bitacora.sources.sinks import write_csv  # noqa: E402
from bitacora.storage import Workspace  # noqa: E402

# The training-data operators stand apart: without them the rest works as before.
try:
    import corpus_pipeline
    from bitacora.llm import queries as llm
except ImportError as missing:
    # Removed, or without a library of theirs: the warning tells which.
    warnings.warn(f"without the training-data operators: {missing}", stacklevel=1)
    llm = corpus_pipeline = None

SMOKE = "/root/testdata/sf0.001"
TYPE = "Tipo de Incidente"


def entry(spark: SparkSession) -> DataFrame:
    """Every incident with its group, clean or cancelled and isolated."""
    return _flagship(spark, SMOKE)


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------


def _text(column: str):
    return format_list(F.col(column)).alias(column)


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread_rows(spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns))


def _notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_notes(incidents(spark, sf_dir).select(ROW, "Notas"))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_rows(incidents(spark, sf_dir), keep=(ROW,))


def _filter_excluded_types(spark, sf_dir):
    kept = drop_excluded_types(incidents(spark, sf_dir))
    return kept.select("Folio", F.col(f"`{TYPE}`").alias("tipo"))


def _extracted(*columns):
    def query(spark, sf_dir):
        return _notes(spark, sf_dir).select(ROW, *[_text(c) for c in columns])

    return query


# Four lists per line, with repeats inside and across them.
DEDUP_LISTS = {
    "ligados": ["l_suppkey % 7", "l_partkey % 7", "l_suppkey % 7"],
    "referencia": ["l_partkey % 9", "l_linenumber", "l_suppkey % 9", "l_linenumber"],
    "dividido_a": ["(l_suppkey + l_partkey) % 11", "l_linenumber", "l_suppkey % 7"],
    "dividido_de": ["l_partkey % 5", "l_suppkey % 13", "l_partkey % 5"],
}
DEDUP_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _cross_column_dedup(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lists = [
        F.array(*[F.expr(item).cast("string") for item in items])
        for items in DEDUP_LISTS.values()
    ]
    unique = prioritized_distinct(*lists)
    return lines.select(
        *DEDUP_KEYS, *[F.array_join(u, ",").alias(name) for u, name in zip(unique, DEDUP_LISTS)]
    )


def _clean_note(spark, sf_dir):
    return _notes(spark, sf_dir).select(ROW, "nota_limpia")


def _normalize_text(spark, sf_dir):
    return _documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", normalize_text(F.col("text")).alias("normal")
    )


def _normalize_notes(spark, sf_dir):
    return incidents(spark, sf_dir).select(ROW, normalize_text(F.col("Notas")).alias("normal"))


def _normalize_without_stop_words(spark, sf_dir):
    return _documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", normalize_text(F.col("text"), remove_stop_words=True).alias("normal")
    )


def _repair_mojibake(spark, sf_dir):
    return incidents(spark, sf_dir).select(ROW, repair_mojibake(F.col("Notas")).alias("reparada"))


def _assign_precinct(spark, sf_dir):
    return assign_precinct(incidents(spark, sf_dir)).select(ROW, "Municipio", "comisaria")


def _report_projection(spark, sf_dir):
    report = _report(spark, sf_dir)
    lists = ("folios_ligados", "cancelados", "referencia_folio")
    return report.select(
        ROW,
        "Folio",
        F.col(f"`{TYPE}`").alias("tipo"),
        "comisaria",
        "Municipio",
        "Divididos",
        *[_text(c) for c in lists],
        "Nota",
    )


def _csv_round_trip(spark, sf_dir):
    """The raw incidents written as CSV, read back as a report and processed."""
    folder = f"{Workspace(spark).path}/report.csv"
    write_csv(incidents(spark, sf_dir), folder)
    report = process_rows(read_report(spark, folder), keep=(ORDER,))
    lists = ("folios_ligados", "cancelados", "referencia_folio")
    return report.select(
        "Folio",
        F.col(f"`{TYPE}`").alias("tipo"),
        "comisaria",
        "Municipio",
        "Divididos",
        *[_text(c) for c in lists],
        "Nota",
    )


def _pipeline_files(spark, sf_dir):
    """The whole job from CSV to CSV: its final file read back."""
    ws = Workspace(spark)
    raw, out = f"{ws.path}/in.csv", f"{ws.path}/out.csv"
    write_csv(incidents(spark, sf_dir), raw, order=ROW)
    run(spark, raw, out)
    final = spark.read.csv(out, header=True, multiLine=True, quote='"', escape='"')
    return final.select(
        "Folio",
        F.col(f"`{TYPE}`").alias("tipo"),
        "comisaria",
        "Municipio",
        "Divididos",
        "Nota",
        "folios_ligados",
        "cancelados",
        "referencia_folio",
        "Folio_Key",
        F.col("Grupo_ID").cast("bigint").alias("Grupo_ID"),
        F.col("Tamano_Grupo").cast("bigint").alias("Tamano_Grupo"),
    )


def _parse_list(spark, sf_dir):
    parsed = parse_list(F.col("Divididos"))
    return incidents(spark, sf_dir).select(
        ROW, F.size(parsed).cast("bigint").alias("n"), F.array_join(parsed, "|").alias("items")
    )


def _format_list(spark, sf_dir):
    return incidents(spark, sf_dir).select(
        ROW, format_list(parse_list(F.col("Divididos"))).alias("texto")
    )


def _folio_key(spark, sf_dir):
    padded = F.concat(F.lit(" "), F.col("Folio"), F.lit("\t"))
    return incidents(spark, sf_dir).select(
        ROW, folio_key(padded).alias("folio"), folio_key(F.col("Notas")).alias("nota")
    )


def _graph_edges(spark, sf_dir):
    return graph_edges(_report(spark, sf_dir))


def _graph_nodes(spark, sf_dir):
    return graph_nodes(_report(spark, sf_dir))


def _connected_components(spark, sf_dir):
    """Every folio on an edge with the smallest folio it is connected to."""
    labels, _ = connected_components(graph_edges(_report(spark, sf_dir)))
    smallest = labels.groupBy("label").agg(F.min("folio").alias("componente"))
    return labels.join(smallest, "label").select("folio", "componente")


def _components_in_batches(spark, sf_dir):
    """The same components from edges that come in three batches, one after the other."""
    edges, _ = Workspace(spark).stage(graph_edges(_report(spark, sf_dir)))
    growing = GrowingComponents(spark, f"{Workspace(spark).path}/components")
    for k in range(3):
        growing.add(edges.where(F.pmod(F.xxhash64("src", "dst"), F.lit(3)) == k))
    return growing.labels().withColumnRenamed("label", "componente")


def _component_sizes(spark, sf_dir):
    groups = component_table(_report(spark, sf_dir), ROW)
    return groups.groupBy(F.col("Tamano_Grupo").alias("tamano")).agg(
        F.countDistinct("Grupo_ID").alias("componentes"), F.count(F.lit(1)).alias("folios")
    )


def _component_numbers(spark, sf_dir):
    return component_table(_report(spark, sf_dir), ROW)


def _component_numbers_by_folio(spark, sf_dir):
    return component_table(_report(spark, sf_dir))


def _flagship(spark, sf_dir):
    rows = analyze(incidents(spark, sf_dir), ROW).rows
    return rows.select(
        ROW,
        "Folio_Key",
        "comisaria",
        "Grupo_ID",
        "Tamano_Grupo",
        F.col("_apart").cast("bigint").alias("apartado"),
    )


def _clean_incidents(spark, sf_dir):
    clean = analyze(incidents(spark, sf_dir), ROW).clean
    return clean.select("Folio", "Grupo_ID", "Tamano_Grupo", "Nota")


def _cancelled_isolated(spark, sf_dir):
    cancelled = analyze(incidents(spark, sf_dir), ROW).cancelled
    return cancelled.select("Folio", "Grupo_ID", "Tamano_Grupo", _text("cancelados"))


def _stage_counts(spark, sf_dir):
    result = analyze(incidents(spark, sf_dir), ROW)
    done = result.rows.agg(
        F.count_if("_apart").alias("cancelados_aislados"),
        F.count_if(~F.col("_apart")).alias("limpios"),
    )
    counts = result.counts
    return done.select(
        F.lit(counts["read"]).cast("bigint").alias("leidas"),
        F.lit(counts["discarded"]).cast("bigint").alias("descartadas"),
        F.lit(counts["kept"]).cast("bigint").alias("conservadas"),
        "cancelados_aislados",
        "limpios",
    )


def _cancelled_by_precinct(spark, sf_dir):
    report = _report(spark, sf_dir)
    return (
        report.where(F.size("cancelados") > 0)
        .groupBy("comisaria")
        .agg(F.count(F.lit(1)).alias("cancelados"))
    )


def _top_ngrams(spark, sf_dir):
    return top_ngrams(_documents(spark, sf_dir, "text"))


def _top_ngrams_of_notes(spark, sf_dir):
    return top_ngrams(_notes(spark, sf_dir), "nota_limpia", (1, 3), 5, 40, use_stop_words=False)


def _token_map(spark, sf_dir):
    return substitution_map(top_ngrams(_documents(spark, sf_dir, "text")))


# Phrases that occur in the documents, one inside another, with and without accents.
PHRASES = ["of the", "the", "in the", "la elle", "le", "un la", "que", "à la", "é", "the of"]


def _remove_phrases(spark, sf_dir):
    return remove_phrases(_documents(spark, sf_dir, "doc_id", "text"), "text", PHRASES)


def _collapse_phrases(spark, sf_dir):
    tokens = {phrase: f"<<TOKEN_{i}>>" for i, phrase in enumerate(PHRASES, 1)}
    return collapse_phrases(_documents(spark, sf_dir, "doc_id", "text"), "text", tokens)


def _normal_documents(spark, sf_dir):
    return _documents(spark, sf_dir, "doc_id", "text").withColumn(
        "text", normalize_text(F.col("text"), remove_stop_words=True)
    )


def _tokenize_frequent(spark, sf_dir):
    return tokenize_frequent(_normal_documents(spark, sf_dir), "text")


def _drop_frequent(spark, sf_dir):
    return drop_frequent(_normal_documents(spark, sf_dir), "text")


def _read_latin1_report(spark, sf_dir):
    """Half of the incidents in UTF-8, half in Latin-1, under awkward names."""
    ws = Workspace(spark)
    raw = incidents(spark, sf_dir).withColumn("Notas", F.replace("Notas", F.lit("Ã±"), F.lit("ñ")))
    folders = []
    for odd, (name, charset) in enumerate(
        [("enero 1 [a] {b}", "UTF-8"), ("año 100%+ñ (2)", "ISO-8859-1")]
    ):
        folders.append(f"{ws.path}/{name}")
        half = raw.where(F.col(ROW) % 2 == odd)
        half.write.options(header=True, encoding=charset, quote='"', escape='"').csv(folders[-1])
    report = read_report(spark, folders)
    return report.select(F.col(ROW).cast("bigint").alias(ROW), "Folio", "Municipio", "Notas")


def _named_customers(spark, sf_dir):
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return nations, customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))


def _write_dictionary(nations, path, key):
    """JSON objects region -> [nation, ...], one file per region."""
    named = nations.groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_name")).alias("names"))
    entry = F.to_json(F.create_map(F.concat(F.lit(key), F.col("n_regionkey").cast("string")), "names"))
    named.select(entry.alias("value")).repartition(5).write.text(path)


def _precincts_from_json(spark, sf_dir):
    nations, customers = _named_customers(spark, sf_dir)
    path = f"{Workspace(spark).path}/comisarias.json"
    _write_dictionary(nations, path, "")
    named = customers.withColumn("Municipio", F.lower("n_name"))
    return assign_precinct(named, load_precincts(spark, path)).select(
        "c_custkey", "Municipio", "comisaria"
    )


def _phrases_from_json(spark, sf_dir):
    nations, customers = _named_customers(spark, sf_dir)
    path = f"{Workspace(spark).path}/frases.json"
    _write_dictionary(nations, path, "region_")
    phrases = flatten_dictionary(load_phrases(spark, path))
    text = F.concat(F.lit("cliente de "), F.initcap("n_name"), F.lit(", con saldo"))
    return replace_phrases(customers.withColumn("texto", text), "texto", phrases, "nota").select(
        "c_custkey", "nota"
    )


def _read_multiline_report(spark, sf_dir):
    """Incidents whose notes span lines, read in blocks."""
    folder = f"{Workspace(spark).path}/notes.csv"
    notes = F.concat(F.lit("uno\n"), "Notas", F.lit('\n"fin", dos'))
    raw = incidents(spark, sf_dir).withColumn("Notas", notes)
    raw.write.options(header=True, quote='"', escape='"').csv(folder)
    report = read_report(spark, folder)
    return report.select(F.col(ROW).cast("bigint").alias(ROW), "Folio", "Municipio", "Notas")


def _orders_of_customers(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customers, orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


def _replace_many_phrases(spark, sf_dir):
    """A dictionary of all customers: the longer of two phrases that begin alike counts."""
    customers, orders = _orders_of_customers(spark, sf_dir)
    member = F.concat_ws(" ", "c_name", "c_mktsegment")
    phrases = customers.select(
        "c_name", F.concat(F.lit("cliente "), F.col("c_nationkey").cast("string")).alias("new")
    ).union(
        customers.where("c_custkey % 3 = 0").select(
            member, F.concat(F.lit("socio "), F.col("c_custkey").cast("string"))
        )
    ).toDF("phrase", "new")
    word = F.when(F.col("o_orderkey") % 2 == 0, F.col("c_mktsegment")).otherwise("otro")
    text = F.concat(F.lit("pide "), F.upper("c_name"), F.lit(" "), word, F.lit(", urgente"))
    return replace_phrases(orders.withColumn("texto", text), "texto", phrases, "nota").select(
        "o_orderkey", "nota"
    )


def _collapse_many_phrases(spark, sf_dir):
    """A token for every customer; some tokens are part of phrases in turn."""
    customers, orders = _orders_of_customers(spark, sf_dir)
    number = F.col("c_custkey").cast("string")
    tokens = customers.select(
        "c_name", F.concat(F.lit("<<C_"), number, F.lit(">>")), (2 * F.col("c_custkey")).alias("at")
    ).union(
        customers.where("c_custkey % 5 = 0").select(
            F.concat(F.lit("C_"), number, F.lit(">>  ya")), F.lit("OK"), 2 * F.col("c_custkey") + 1
        )
    ).toDF("phrase", "token", "at")
    text = F.concat(F.lit("pide "), "c_name", F.lit(" ya, fin"))
    return collapse_phrases(orders.withColumn("nota", text), "nota", tokens).select("o_orderkey", "nota")


def _missing_dictionaries(spark, sf_dir):
    """Without dictionaries precincts stay empty and phrases stay in the text."""
    nowhere = f"{Workspace(spark).path}/none.json"
    report = process_rows(
        incidents(spark, sf_dir), load_precincts(spark, nowhere), load_phrases(spark, nowhere), (ROW,)
    )
    return report.select(ROW, "comisaria", "Nota")


def _three_outputs(spark, sf_dir):
    """Cancelled rows, clean rows and relations as files, with their columns."""
    ws = Workspace(spark)
    report = _report(spark, sf_dir)
    paths = {part: f"{ws.path}/{part}" for part in ("cancelados", "limpios", "relaciones")}
    separate_to_files(report, component_table(report, ROW), *paths.values())
    parts = []
    for part, path in paths.items():
        back = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
        group = "Grupo_ID" in back.columns
        parts.append(
            back.select(
                F.lit(part).alias("parte"),
                "Folio",
                F.lit(int(group)).cast("bigint").alias("con_grupo"),
                (F.col("Grupo_ID") if group else F.lit(None)).cast("bigint").alias("grupo"),
            )
        )
    return parts[0].union(parts[1]).union(parts[2])


def _absent_relation_column(spark, sf_dir):
    return graph_edges(_report(spark, sf_dir).drop("Divididos", "referencia_folio"))


def _repeated_folios(spark, sf_dir):
    """Every incident once per line of its order: all of them get its group."""
    report = _report(spark, sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    rows = report.select(ROW, "Folio").join(lines, F.col(ROW) == F.col("l_orderkey"))
    # Counted as they are written, not by joining them once more.
    rows, seen = Workspace(spark).stage(rows, rows=F.count(F.lit(1)))
    grouped = attach_groups(rows, component_table(report, ROW), seen["rows"] or 0)
    return grouped.select(ROW, "l_linenumber", "Folio_Key", "Grupo_ID", "Tamano_Grupo")


def _unknown_characters(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text").withColumn(
        "text", F.replace("text", F.lit("e "), F.lit("\ufffd"))
    )
    return docs.select(
        "doc_id",
        normalize_text(F.col("text")).alias("sin"),
        normalize_text(F.col("text"), keep_unk=True).alias("con"),
    )


def _required_columns(spark, sf_dir):
    """Rows of the incidents, and which required column its absence is noticed of."""
    raw = incidents(spark, sf_dir)
    noticed = []
    for column in REQUIRED_COLUMNS:
        try:
            check_columns(raw.drop(column))
        except ValueError as error:
            noticed += [c for c in REQUIRED_COLUMNS if repr(c) in str(error)]
    names = F.explode(F.array(*[F.lit(c) for c in noticed]))
    return check_columns(raw).select(names.alias("columna")).groupBy("columna").agg(
        F.count(F.lit(1)).alias("filas")
    )


def _components_of_mixed_folios(spark, sf_dir):
    """Relations to folios with letters and leading zeros among plain numbers."""
    mixed = (
        F.when(F.col(ROW) % 3 == 0, F.concat(F.lit("A"), (F.col(ROW) % 97).cast("string")))
        .when(F.col(ROW) % 3 == 1, F.concat(F.lit("00"), (F.col(ROW) % 89).cast("string")))
        .otherwise((1000000000 + F.col(ROW) + 6).cast("string"))
    )
    raw = incidents(spark, sf_dir).withColumn(
        "Divididos", F.when(F.col(ROW) % 5 == 0, mixed).otherwise(F.col("Divididos"))
    )
    labels, _ = connected_components(graph_edges(process_rows(raw, keep=(ROW,))))
    smallest = labels.groupBy("label").agg(F.min("folio").alias("componente"))
    return labels.join(smallest, "label").select("folio", "componente")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or composition."""
    return own_queries() | _llm_queries()


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {}


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "filter_excluded_types": _filter_excluded_types,
        "extract_split": _extracted("dividido_de", "dividido_a"),
        "extract_linked": _extracted("folios_ligados"),
        "extract_cancelled": _extracted("cancelado"),
        "extract_reference": _extracted("referencia_folio"),
        "cross_column_dedup": _cross_column_dedup,
        "clean_note": _clean_note,
        "normalize_text": _normalize_text,
        "normalize_notes": _normalize_notes,
        "normalize_without_stop_words": _normalize_without_stop_words,
        "repair_mojibake": _repair_mojibake,
        "assign_precinct": _assign_precinct,
        "report_projection": _report_projection,
        "csv_round_trip": _csv_round_trip,
        "parse_list": _parse_list,
        "format_list": _format_list,
        "folio_key": _folio_key,
        "graph_edges": _graph_edges,
        "graph_nodes": _graph_nodes,
        "connected_components": _connected_components,
        "components_in_batches": _components_in_batches,
        "component_sizes": _component_sizes,
        "component_numbers": _component_numbers,
        "component_numbers_by_folio": _component_numbers_by_folio,
        "separate_cancelled": _flagship,
        "clean_incidents": _clean_incidents,
        "cancelled_isolated": _cancelled_isolated,
        "stage_counts": _stage_counts,
        "cancelled_by_precinct": _cancelled_by_precinct,
        "pipeline_files": _pipeline_files,
        "top_ngrams": _top_ngrams,
        "top_ngrams_of_notes": _top_ngrams_of_notes,
        "token_map": _token_map,
        "remove_phrases": _remove_phrases,
        "collapse_phrases": _collapse_phrases,
        "tokenize_frequent": _tokenize_frequent,
        "drop_frequent": _drop_frequent,
        "read_latin1_report": _read_latin1_report,
        "precincts_from_json": _precincts_from_json,
        "phrases_from_json": _phrases_from_json,
        "missing_dictionaries": _missing_dictionaries,
        "three_outputs": _three_outputs,
        "absent_relation_column": _absent_relation_column,
        "repeated_folios": _repeated_folios,
        "unknown_characters": _unknown_characters,
        "required_columns": _required_columns,
        "components_of_mixed_folios": _components_of_mixed_folios,
        "read_multiline_report": _read_multiline_report,
        "replace_many_phrases": _replace_many_phrases,
        "collapse_many_phrases": _collapse_many_phrases,
    }


# --------------------------------------------------------------------------
# The same results in SQL
# --------------------------------------------------------------------------

_W = r"[\p{L}\p{N}_]"
_N = r"[^\p{L}\p{N}_]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sub(text: str, pattern: str, new: str, flags: str = "g") -> str:
    return f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(new)}, '{flags}')"


def _whole(text: str, pattern: str, new: str) -> str:
    """Whole-word replacement without look-around.

    A match takes the separators with it and puts them back, so of matches that
    share a separator every other one is left for a second run.
    """
    for _ in range(2):
        text = _sub(text, f"(^|{_N})(?:{pattern})($|{_N})", rf"\1{new}\2")
    return text


def _trimmed(text: str) -> str:
    spaces = r"[\s\v\x{1c}-\x{1f}\x{85}\p{Z}]+"
    return f"trim({_sub(text, spaces, ' ')})"


_DATE = r"\p{Nd}{1,2}[/-]\p{Nd}{1,2}[/-]\p{Nd}{2,4}"
_TIME = r"\p{Nd}{1,2}:\p{Nd}{2}(?::\p{Nd}{2})?"


def _normal(text: str) -> str:
    text = f"lower(replace(replace({text}, 'Ã±', 'ñ'), chr(65533), ' '))"
    for pattern in (_DATE, _TIME):
        text = _whole(text, pattern, " ")
    return f"coalesce(trim({_sub(text, _N + '+', ' ')}), '')"


def _in_list(words: list[str]) -> str:
    return "[" + ", ".join(_quoted(w) for w in words) + "]"


def _without_stop_words(words: str) -> str:
    return f"list_filter({words}, lambda w: NOT list_contains({_in_list(STOP_WORDS)}, w))"


# Written out here, not taken from the library: it is what they check.  Only valid
# references: no invalid one gets in the way in these notes.
_SPLIT = (
    r"(?:El incidente |Folio )?(\d{10})\s+se dividio\s+(?:a|al folio)\s+(\d{10})"
    r"(?:.*?por [\p{L}\p{N}_() ]+)?"
)
_LINKED = (
    r"(?:El incidente |Folio )?(\d{10})\s+(?:ha sido |se ha )?ligado\s+(?:al?|con el?)\s*"
    r"(?:incidente|folio)?\s*(\d{10})"
)
_CANCELLED = r"(?:El incidente |Folio )?(\d{10})\s+(?:fue )?cancelado\s+por\s+[\p{L}\p{N}_() ]+"
_REFERENCE = r"(?:EN )?REFERENCIA\s+(?:A\s+|AL\s+)?(?:FOLIO\s+)?(\d{10})"
# The dictionary phrases that occur in the incidents.
_PHRASES = [
    ("enterado monitoreo conforme", "monitoreo_seguimiento"),
    ("seguridad publica", "corporaciones_autoridades"),
    ("reporta que", " "),
    ("pide apoyo", "solicitud_atencion_apoyo"),
]


def _found(text: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract_all({text}, {_quoted(pattern)}, {group}, 'i')"


def _as_text(items: str) -> str:
    return (
        f"CASE WHEN len({items}) = 0 THEN '[]' "
        f"ELSE '[''' || array_to_string({items}, ''', ''') || ''']' END"
    )


def _columns(*lists: str) -> str:
    return ", ".join(f"{_as_text(c)} AS {c}" for c in lists)


def _rest(phrases: list[tuple[str, str]]) -> str:
    text = "n"
    for pattern in (_SPLIT, _LINKED, _CANCELLED, _REFERENCE):
        text = _sub(text, pattern, "", "gi")
    for phrase, category in phrases:
        text = _sub(text, rf"\b{phrase}\b", category, "gi")
    return _trimmed(text)


_RAW = f"raw AS ({INCIDENTS_SQL})"
_NOTES = f"""{_RAW},
noted AS (SELECT *, CASE WHEN Notas IS NULL OR Notas = 'nan' THEN '' ELSE Notas END AS n FROM raw),
pairs AS (SELECT *, {_found("n", _LINKED, 1)} AS l1, {_found("n", _LINKED, 2)} AS l2,
  {_found("n", _SPLIT, 1)} AS origin, {_found("n", _SPLIT, 2)} AS target,
  {_found("n", _CANCELLED)} AS cancelado, {_found("n", _REFERENCE)} AS referencia FROM noted),
notes AS (SELECT fila, Folio, tipo, Municipio, Divididos, cancelado,
  list_concat(l1, l2) AS folios_ligados,
  list_filter(referencia, lambda x: NOT list_contains(list_concat(l1, l2), x)) AS referencia_folio,
  target AS dividido_a, origin AS dividido_de, {_rest(_PHRASES)} AS nota_limpia, {_rest([])} AS sin_frases FROM pairs)"""
_PRECINCT_ROWS = ", ".join(
    f"({_quoted(name)}, {_quoted(pid)})" for pid, names in PRECINCTS.items() for name in names
)
_DIM = f"dim(municipio, comisaria) AS (VALUES {_PRECINCT_ROWS})"
_REPORT = f"""{_NOTES}, {_DIM},
report AS (SELECT fila, Folio, tipo, comisaria, notes.Municipio, Divididos, folios_ligados,
  cancelado AS cancelados, referencia_folio, {_normal("nota_limpia")} AS Nota
  FROM notes LEFT JOIN dim ON upper(notes.Municipio) = dim.municipio
  WHERE tipo IS NULL OR tipo <> '70104')"""
_BRACKETS = r"[\[\]']"
_LIST = (
    f"list_filter(list_transform(string_split({_sub("coalesce(Divididos, '')", _BRACKETS, '')}, ','), "
    "lambda x: trim(x)), lambda x: x <> '')"
)
_LINKS = f"list_concat({_LIST}, folios_ligados, referencia_folio)"
_EDGES = f"""{_REPORT},
links AS (SELECT Folio AS a, unnest({_LINKS}) AS b FROM report),
edges AS (SELECT DISTINCT least(a, b) AS src, greatest(a, b) AS dst FROM links WHERE a <> b),
nodes AS (SELECT Folio AS folio FROM report UNION SELECT src FROM edges UNION SELECT dst FROM edges)"""
_COMPONENTS = f"""RECURSIVE {_EDGES},
both_ways AS (SELECT src AS a, dst AS b FROM edges UNION ALL SELECT dst, src FROM edges),
reach(a, b) AS (SELECT folio, folio FROM nodes UNION
  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
labelled AS (SELECT a AS folio, min(b) AS root, count(*) AS size FROM reach GROUP BY a),
firsts AS (SELECT root, min(fila) AS first
  FROM report JOIN labelled ON report.Folio = labelled.folio GROUP BY root),
numbers AS (SELECT root, row_number() OVER (ORDER BY first) AS number FROM firsts),
groups AS (SELECT folio, root, number, size FROM labelled JOIN numbers USING (root)),
flagged AS (SELECT report.*, number, size, len(cancelados) > 0 AND coalesce(size, 1) = 1 AS apart
  FROM report LEFT JOIN groups ON report.Folio = groups.folio)"""


def _grams(source: str, text: str, doc: str, sizes: tuple[int, int], stop: bool) -> str:
    """Words by position, those ahead by a window, and the n-grams they form."""
    stops = ", ".join(_quoted(w) for w in STOP_WORDS)
    ahead = ", ".join(f"lead(word, {i}) OVER d AS w{i}" for i in range(sizes[1]))
    parts = " UNION ALL ".join(
        f"SELECT doc, {" || ' ' || ".join(f'w{i}' for i in range(n))} AS phrase FROM ahead"
        for n in range(sizes[0], sizes[1] + 1)
    )
    return f"""cut AS (SELECT {doc} AS doc, regexp_extract_all(lower({text}), '{_W}{{2,}}') AS ws FROM {source}),
words AS (SELECT doc, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM cut),
kept AS (SELECT * FROM words {f"WHERE word NOT IN ({stops})" if stop else ""}),
ahead AS (SELECT doc, {ahead} FROM kept WINDOW d AS (PARTITION BY doc ORDER BY pos)),
grams AS (SELECT * FROM ({parts}) WHERE phrase IS NOT NULL)"""


def _top(least: int, k: int) -> str:
    return (
        "top AS (SELECT phrase, count(*) AS freq FROM grams GROUP BY phrase "
        f"HAVING count(DISTINCT doc) >= {least} ORDER BY freq DESC, phrase LIMIT {k})"
    )


_RANKED = "ranked AS (SELECT phrase, row_number() OVER (ORDER BY freq DESC, phrase) AS rank FROM top)"
_TOP = f"{_grams('documents', 'text', 'doc_id', (2, 4), True)}, {_top(10, 30)}"
_WORDS = _without_stop_words(f"string_split({_normal('text')}, ' ')")
_PLAIN = f"plain AS (SELECT doc_id, array_to_string({_WORDS}, ' ') AS text FROM documents)"
_MINED = f"""{_PLAIN}, {_grams("plain", "text", "doc_id", (2, 4), True)}, {_top(10, 30)}, {_RANKED},
steps AS (SELECT list([phrase, rank::VARCHAR] ORDER BY length(phrase) DESC, rank) AS todo FROM ranked)"""


def _replaced(new: str) -> str:
    """Words get a space of their own on both sides, so plain replacement works."""
    wide = "' ' || replace(text, ' ', '  ') || ' '"
    found = "' ' || replace(s[1], ' ', '  ') || ' '"
    folded = f"list_reduce(todo, lambda acc, s: [replace(acc[1], {found}, {new})], [{wide}])"
    return f"WITH {_MINED} SELECT doc_id, {_trimmed(folded + '[1]')} AS text FROM plain, steps"


_MIXED = (
    "CASE WHEN fila % 5 <> 0 THEN Divididos WHEN fila % 3 = 0 THEN 'A' || fila % 97 "
    "WHEN fila % 3 = 1 THEN '00' || fila % 89 ELSE (1000000006 + fila)::VARCHAR END"
)


def _mixed_components() -> str:
    renamed = f"report AS (SELECT * REPLACE ({_MIXED} AS Divididos) FROM processed),\nlinks AS ("
    sql = _COMPONENTS.replace("\nreport AS (", "\nprocessed AS (").replace("\nlinks AS (", "\n" + renamed)
    return f"WITH {sql} SELECT folio, root AS componente FROM labelled WHERE size > 1"


def _phrases_replaced(new: Callable[[int], str]) -> str:
    text = "text"
    for phrase in sorted(PHRASES, key=len, reverse=True):
        text = _whole(text, phrase, new(PHRASES.index(phrase) + 1))
    return f"SELECT doc_id, {_trimmed(text)} AS text FROM documents"


def _dedup() -> str:
    given = ", ".join(
        f"[{', '.join(f'({item})::VARCHAR' for item in items)}] AS {name}"
        for name, items in DEDUP_LISTS.items()
    )
    kept, before = [], []
    for name in DEDUP_LISTS:
        taken = "".join(f" AND NOT list_contains({other}, x)" for other in before)
        first = f"list_filter({name}, lambda x, i: list_position({name}, x) = i{taken})"
        kept.append(f"array_to_string({first}, ',') AS {name}")
        before.append(name)
    keys = ", ".join(DEDUP_KEYS)
    return (
        f"WITH given AS (SELECT {keys}, {given} FROM lineitem) "
        f"SELECT {keys}, {', '.join(kept)} FROM given"
    )


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL with the same result, for every query that SQL can express."""
    return own_sql() | (llm.ORACLES if llm else {})


def own_sql() -> dict[str, str]:
    lists = _columns("folios_ligados", "cancelados", "referencia_folio")
    report = f"Folio, tipo, comisaria, Municipio, Divididos, {lists}, Nota"
    group = 'number AS "Grupo_ID", size AS "Tamano_Grupo"'
    return {
        "filter_excluded_types": f"WITH {_RAW} SELECT Folio, tipo FROM raw "
        "WHERE tipo IS NULL OR tipo <> '70104'",
        "extract_split": f"WITH {_NOTES} SELECT fila, {_columns('dividido_de', 'dividido_a')} FROM notes",
        "extract_linked": f"WITH {_NOTES} SELECT fila, {_columns('folios_ligados')} FROM notes",
        "extract_cancelled": f"WITH {_NOTES} SELECT fila, {_columns('cancelado')} FROM notes",
        "extract_reference": f"WITH {_NOTES} SELECT fila, {_columns('referencia_folio')} FROM notes",
        "cross_column_dedup": _dedup(),
        "clean_note": f"WITH {_NOTES} SELECT fila, nota_limpia FROM notes",
        "normalize_text": f"SELECT doc_id, {_normal('text')} AS normal FROM documents",
        "normalize_notes": f"WITH {_RAW} SELECT fila, {_normal('Notas')} AS normal FROM raw",
        "normalize_without_stop_words": f"WITH {_PLAIN} SELECT doc_id, text AS normal FROM plain",
        "repair_mojibake": f"WITH {_RAW} SELECT fila, replace(Notas, 'Ã±', 'ñ') AS reparada FROM raw",
        "assign_precinct": f"WITH {_RAW}, {_DIM} SELECT fila, raw.Municipio, comisaria FROM raw "
        "LEFT JOIN dim ON upper(raw.Municipio) = dim.municipio",
        "report_projection": f"WITH {_REPORT} SELECT fila, {report} FROM report",
        "csv_round_trip": f"WITH {_REPORT} SELECT {report} FROM report",
        "parse_list": f"WITH {_RAW} SELECT fila, len({_LIST}) AS n, "
        f"array_to_string({_LIST}, '|') AS items FROM raw",
        "format_list": f"WITH {_RAW} SELECT fila, {_as_text(_LIST)} AS texto FROM raw",
        "folio_key": f"WITH {_RAW} SELECT fila, Folio AS folio, "
        "CASE WHEN lower(trim(Notas)) NOT IN ('', 'nan') THEN trim(Notas) END AS nota FROM raw",
        "graph_edges": f"WITH {_EDGES} SELECT src, dst FROM edges",
        "graph_nodes": f"WITH {_EDGES} SELECT folio FROM nodes",
        "connected_components": f"WITH {_COMPONENTS} SELECT folio, root AS componente "
        "FROM labelled WHERE size > 1",
        "components_in_batches": f"WITH {_COMPONENTS} SELECT folio, root AS componente "
        "FROM labelled WHERE size > 1",
        "component_sizes": f"WITH {_COMPONENTS} SELECT size AS tamano, "
        "count(DISTINCT root) AS componentes, count(*) AS folios FROM labelled GROUP BY size",
        "component_numbers": f'WITH {_COMPONENTS} SELECT folio AS "Folio", {group} FROM groups',
        "component_numbers_by_folio": f'WITH {_COMPONENTS} SELECT folio AS "Folio", '
        'dense_rank() OVER (ORDER BY root) AS "Grupo_ID", size AS "Tamano_Grupo" FROM labelled',
        "separate_cancelled": f'WITH {_COMPONENTS} SELECT fila, Folio AS "Folio_Key", comisaria, '
        f"{group}, apart::BIGINT AS apartado FROM flagged",
        "clean_incidents": f"WITH {_COMPONENTS} SELECT Folio, {group}, Nota FROM flagged WHERE NOT apart",
        "cancelled_isolated": f"WITH {_COMPONENTS} SELECT Folio, {group}, {_columns('cancelados')} "
        "FROM flagged WHERE apart",
        "stage_counts": f"WITH {_COMPONENTS} SELECT (SELECT count(*) FROM raw) AS leidas, "
        "(SELECT count(*) FROM raw WHERE tipo = '70104') AS descartadas, count(*) AS conservadas, "
        "count(*) FILTER (apart) AS cancelados_aislados, count(*) FILTER (NOT apart) AS limpios "
        "FROM flagged",
        "cancelled_by_precinct": f"WITH {_REPORT} SELECT comisaria, count(*) AS cancelados "
        "FROM report WHERE len(cancelados) > 0 GROUP BY comisaria",
        "pipeline_files": f"WITH {_COMPONENTS} SELECT Folio, tipo, comisaria, Municipio, Divididos, "
        f"nullif(Nota, '') AS \"Nota\", {lists}, "
        f'Folio AS "Folio_Key", {group} FROM flagged WHERE NOT apart',
        "top_ngrams": f"WITH {_TOP} SELECT phrase, freq FROM top",
        "top_ngrams_of_notes": f"WITH {_NOTES}, "
        f"{_grams('notes', 'nota_limpia', 'fila', (1, 3), False)}, {_top(5, 40)} "
        "SELECT phrase, freq FROM top",
        "token_map": f"WITH {_TOP}, {_RANKED} SELECT phrase, "
        "'<<TOKEN_' || rank || '>>' AS token, rank FROM ranked",
        "remove_phrases": _phrases_replaced(lambda i: " "),
        "collapse_phrases": _phrases_replaced(lambda i: f" <<TOKEN_{i}>> "),
        "tokenize_frequent": _replaced("' <<TOKEN_' || s[2] || '>> '"),
        "drop_frequent": _replaced("' '"),
        "read_latin1_report": f"WITH {_RAW} SELECT fila, Folio, Municipio, "
        "CASE WHEN Notas <> 'nan' THEN replace(Notas, 'Ã±', 'ñ') END AS Notas FROM raw",
        "precincts_from_json": "SELECT c_custkey, lower(n_name) AS \"Municipio\", "
        "n_regionkey::VARCHAR AS comisaria FROM customer JOIN nation ON c_nationkey = n_nationkey",
        "phrases_from_json": "SELECT c_custkey, 'cliente de region_' || n_regionkey || ', con saldo' "
        "AS nota FROM customer JOIN nation ON c_nationkey = n_nationkey",
        "missing_dictionaries": f"WITH {_NOTES} SELECT fila, NULL::VARCHAR AS comisaria, "
        f"{_normal('sin_frases')} AS \"Nota\" FROM notes WHERE tipo IS NULL OR tipo <> '70104'",
        "three_outputs": f"WITH {_COMPONENTS} SELECT CASE WHEN apart THEN 'cancelados' "
        "ELSE 'limpios' END AS parte, Folio, 0::BIGINT AS con_grupo, NULL::BIGINT AS grupo FROM flagged "
        "UNION ALL SELECT 'relaciones', folio, 1, number FROM groups",
        "absent_relation_column": f"WITH {_EDGES.replace(_LINKS, 'folios_ligados')} "
        "SELECT src, dst FROM edges",
        "repeated_folios": f'WITH {_COMPONENTS} SELECT fila, l_linenumber, Folio AS "Folio_Key", {group} '
        "FROM flagged JOIN lineitem ON fila = l_orderkey",
        "unknown_characters": "WITH d AS (SELECT doc_id, replace(text, 'e ', chr(65533)) AS text "
        f"FROM documents) SELECT doc_id, {_normal('text')} AS sin, "
        f"{_normal("replace(text, chr(65533), ' <unk> ')")} AS con FROM d",
        "required_columns": f"WITH {_RAW} SELECT unnest(['Folio', 'Tipo de Incidente', 'Notas']) "
        "AS columna, count(*) AS filas FROM raw",
        "components_of_mixed_folios": _mixed_components(),
        "read_multiline_report": f"WITH {_RAW} SELECT fila, Folio, Municipio, "
        "'uno' || chr(10) || Notas || chr(10) || '\"fin\", dos' AS Notas FROM raw",
        "replace_many_phrases": "SELECT o_orderkey, 'pide ' || CASE WHEN c_custkey % 3 = 0 "
        "AND o_orderkey % 2 = 0 THEN 'socio ' || c_custkey ELSE 'cliente ' || c_nationkey || ' ' || "
        "CASE WHEN o_orderkey % 2 = 0 THEN c_mktsegment ELSE 'otro' END END || ', urgente' AS nota "
        "FROM orders JOIN customer ON c_custkey = o_custkey",
        "collapse_many_phrases": "SELECT o_orderkey, 'pide <<' || CASE WHEN c_custkey % 5 = 0 "
        "THEN ' OK , fin' ELSE 'C_' || c_custkey || '>> ya, fin' END AS nota "
        "FROM orders JOIN customer ON c_custkey = o_custkey",
    }
