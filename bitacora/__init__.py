"""Incident report analytics on Spark: notes, folio graph, phrase mining."""

from bitacora.functions.lists import folio_key, format_list, parse_list
from bitacora.functions.text import collapse_spaces, normalize_text
from bitacora.operators.graph import (
    component_table,
    connected_components,
    graph_edges,
    graph_nodes,
)
from bitacora.operators.ngrams import substitution_map, top_ngrams
from bitacora.operators.notes import extract_notes
from bitacora.operators.phrases import collapse_phrases, remove_phrases
from bitacora.operators.precincts import assign_precinct
from bitacora.operators.rows import drop_excluded_types, project_report
from bitacora.operators.separation import attach_groups, separate_cancelled
from bitacora.plans.mining import drop_frequent, mine_map, tokenize_frequent
from bitacora.plans.pipeline import analyze, run, separate_to_files
from bitacora.plans.report import process_report, process_rows
from bitacora.sources.dictionaries import (
    default_precincts,
    load_phrase_table,
    load_phrases,
    load_precincts,
)
from bitacora.sources.reports import read_report
from bitacora.sources.sinks import write_csv

__all__ = [
    "analyze",
    "assign_precinct",
    "attach_groups",
    "collapse_phrases",
    "collapse_spaces",
    "component_table",
    "connected_components",
    "default_precincts",
    "drop_excluded_types",
    "drop_frequent",
    "extract_notes",
    "folio_key",
    "format_list",
    "graph_edges",
    "graph_nodes",
    "load_phrase_table",
    "load_phrases",
    "load_precincts",
    "mine_map",
    "normalize_text",
    "parse_list",
    "process_report",
    "process_rows",
    "project_report",
    "read_report",
    "remove_phrases",
    "run",
    "separate_cancelled",
    "separate_to_files",
    "substitution_map",
    "tokenize_frequent",
    "top_ngrams",
    "write_csv",
]
