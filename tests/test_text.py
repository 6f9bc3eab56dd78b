"""Note extraction, dictionary, normalisation and phrase removal."""

import random

import pytest
from pyspark.sql import functions as F

from bitacora import collapse_phrases, extract_notes, normalize_text, remove_phrases
from bitacora.fixed_values import EXTRACTION_COLUMNS, PHRASES
from bitacora.functions.phrases import flatten_dictionary, replace_phrases
from bitacora.functions.text import collapse_spaces
from tests import plain

A, B, C, D, Z = (str(1000000000 + i) for i in (1, 2, 3, 4, 9))

GOLDEN = [
    # note, lists that are not empty, text left
    (f"El incidente {A} ha sido ligado al incidente {B}. Sigue", {"folios_ligados": [A, B]}, ". Sigue"),
    (f"{A} se dividio a {B} y {C} se dividio a {D} por MARIA, fin",
     {"dividido_de": [A], "dividido_a": [B]}, ", fin"),
    (f"{A} se dividio a {B}\n{C} se dividio al folio {D}",
     {"dividido_de": [A, C], "dividido_a": [B, D]}, ""),
    (f"123 se dividio a 456 luego {C} se dividio a {D} por X", {},
     f"123 se dividio a 456 luego {C} se dividio a {D} por X"),
    (f"Folio {A} cancelado por OP (2) referencia a folio {Z}", {"cancelado": [A]}, ""),
    (f"Folio {A} cancelado por OP (2). Referencia a folio {Z}",
     {"cancelado": [A], "referencia_folio": [Z]}, "."),
    (f"{A} cancelado por A. {A} cancelado por B", {"cancelado": [A, A]}, "."),
    (f"{A} ligado a {B}; referencia {B}; {B} se dividio a {C}.",
     {"folios_ligados": [A, B], "dividido_a": [C]}, "; ; ."),
    ("10000000012 cancelado por X", {}, "10000000012 cancelado por X"),
    (f"{A} ligado con el{B}", {"folios_ligados": [A, B]}, ""),
    (f"{A}  se dividio a folio {B}", {}, f"{A} se dividio a folio {B}"),
    (f"ab{A} cancelado por X.cd", {"cancelado": [A]}, "ab.cd"),
    (None, {}, ""),
    ("", {}, ""),
    ("nan", {}, ""),
    (f"{A} ligado a {A}", {"folios_ligados": [A]}, ""),
    ("  \t\n ", {}, ""),
    # dictionary
    ("efectos lugar continuar recorrido", {}, "efectos_situacion_previa continuar recorrido"),
    ("REPORTA QUE EL vecino", {}, "vecino"),
    ("seguridad  publica", {}, "seguridad publica"),
    ("policía municipal", {}, "policía municipal"),
    ("\ue000 reporta x", {}, "\ue000 x"),
]


def extracted(spark, notes, **options):
    df = spark.createDataFrame(list(enumerate(notes)), "i int, Notas string")
    return [r.asDict() for r in extract_notes(df, **options).orderBy("i").collect()]


def test_golden_notes(spark):
    rows = extracted(spark, [g[0] for g in GOLDEN])
    for (note, lists, text), row in zip(GOLDEN, rows):
        expected = {c: lists.get(c, []) for c in EXTRACTION_COLUMNS[:-1]}
        assert {c: row[c] for c in expected} == expected, note
        assert row["nota_limpia"] == text, note


PIECES = [
    A, B, C, D, Z, "123", "10000000012", "١٢٣٤٥٦٧٨٩٠", "123456789", " ", " ", "  ", "\t", "\r",
    "\n", "\xa0", "\x1d", "\x85", " ", ".", ",", "(2)", "El incidente ", "Folio ", "folio ",
    " se dividio a ", " se dividio al folio ", " SE DIVIDIO a", " por ", "por MARIA", "María Ñ",
    " ha sido ", " se ha ", " ligado a ", " ligado al incidente ", " LIGADO con el folio",
    "ligado al ", " fue ", " cancelado por ", "cancelado por OP", "CANCELADO POR ", " ſe dividio a ",
    "EN REFERENCIA AL FOLIO ", "referencia a ", "referencıa ", "REFERENCIA ", "reporta que ",
    "reporta", "efectos lugar", " lugar continuar", "SEGURIDAD PUBLICA", "est despachado unidad",
    "23 modul bases", " unidades unidad", "ést llegada", "ſsc acude", "\ue000", "x", "_", "é",
]


def random_texts(pieces, n, seed, longest=14):
    rng = random.Random(seed)
    return ["".join(rng.choices(pieces, k=rng.randint(1, longest))) for _ in range(n)]


def test_random_notes_match_plain_rules(spark):
    notes = random_texts(PIECES, 4000, 1)
    # Most random strings hold no relation at all: compose some that do.
    rng = random.Random(2)
    forms = [
        "{a} se dividio a {b}", "{a} se dividio al folio {b} x por OP (1)", "Folio {a} ligado a {b}",
        "El incidente {a} se ha ligado con el folio {b}", "{a} fue cancelado por OP_2 (x)",
        "EN REFERENCIA AL FOLIO {a}", "referencia a {a}",
    ]
    numbers = [A, B, C, D, "12", "12345678901"]
    for _ in range(3000):
        parts = [
            f.format(a=rng.choice(numbers), b=rng.choice(numbers))
            for f in rng.choices(forms, k=rng.randint(1, 4))
        ]
        glue = rng.choices(["", " ", ". ", "\n", ", reporta que ", " y "], k=len(parts))
        notes.append("".join(p + g for p, g in zip(parts, glue)))
    for note, row in zip(notes, extracted(spark, notes)):
        assert {c: row[c] for c in EXTRACTION_COLUMNS} == plain.note(note), repr(note)


def test_lists_hold_only_folios_and_are_disjoint(spark):
    for row in extracted(spark, random_texts(PIECES, 500, 3)):
        lists = [row[c] for c in EXTRACTION_COLUMNS[:-1]]
        assert all(len(f) == 10 and f.isdigit() for items in lists for f in items)
        shared = [row[c] for c in ("folios_ligados", "referencia_folio", "dividido_a", "dividido_de")]
        flat = [f for items in shared for f in items]
        assert len(flat) == len(set(flat))


def test_no_dictionary_keeps_phrases(spark):
    assert extracted(spark, ["reporta que x"], phrases=None)[0]["nota_limpia"] == "reporta que x"


def test_result_names_are_reserved(spark):
    df = spark.createDataFrame([("a", "b")], "Notas string, cancelado string")
    with pytest.raises(ValueError):
        extract_notes(df)


@pytest.mark.parametrize(
    "categories",
    [
        PHRASES,
        {"x": ["(a", "b.", "a b"], "y": ["b", "a", "ab", "a b a"]},
        {"x": ["σa", "ςb", "s"], "$1": ["a", "a b", "\\"]},
    ],
)
def test_dictionary_matches_plain_rules(spark, categories):
    pieces = ["a", "b", " ", " ", "(", ".", "ab", "Σ", "ς", "s", "ſ", "\\", "é", "_", "1", "\ue000"]
    if categories is PHRASES:
        pieces = PIECES
    texts = random_texts(pieces, 1500, 4)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = replace_phrases(df, "t", flatten_dictionary(categories), "r").orderBy("i").collect()
    for text, row in zip(texts, rows):
        assert row["r"] == plain.phrases(text, categories), repr(text)


NORMAL = [
    ("Arribo 12/05/2023 a las 10:30:05, zona 10.5", "arribo a las zona 10 5"),
    ("EspaÃ±ita", "españita"),
    ("EspaÃ±a €", "espaã a"),
    ("ni\ufffdo", "ni o"),
    ("pea_operaciones", "pea_operaciones"),
    ("10:12/05/2023 x", "10 x"),
    (None, ""),
    ("", ""),
]


def normalized(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", normalize_text(F.col("t"), **options).alias("r")).orderBy("i").collect()
    return [row["r"] for row in rows]


def test_golden_normalisation(spark):
    assert normalized(spark, [n[0] for n in NORMAL]) == [n[1] for n in NORMAL]
    assert normalized(spark, ["ni\ufffdo"], keep_unk=True) == ["ni unk o"]


@pytest.mark.parametrize("options", [{}, {"keep_unk": True}, {"remove_stop_words": True}])
def test_random_normalisation_matches_plain_rules(spark, options):
    pieces = [
        "12/05/2023", "1-2-23", "10:30", "9:05:59", "99:99", "/", "-", ":", "1", "23", "a", "B", "é",
        "Ñ", "Ã±", "Ã©", "Â ", "Â\xa0", "Ã", "€", "\ufffd", " ", "  ", "\n", "\x1c", "　", "_",
        "de", "la ", " que ", "tú", "!", "…", "é", "İ", "ß", "½", "²", "日本", "😀", "٣",
    ]
    texts = random_texts(pieces, 4000, 5)
    plainly = {"keep_unk": options.get("keep_unk"), "stop": options.get("remove_stop_words")}
    for text, got in zip(texts, normalized(spark, texts, **options)):
        assert got == plain.normal(text, **plainly), repr(text)


def test_phrase_removal_matches_plain_rules(spark):
    pieces = ["a", "b", "A", " ", " ", "a b", "b a", ".", "(", "a.", "é", "_", "$1", "\\", "\n", "ñ"]
    texts = random_texts(pieces, 1500, 6)
    found = ["a b", "a", "b a b", "(a", "a.", "é", "b.", " b", "$1", "ñ a"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = remove_phrases(df, "t", found).orderBy("i").collect()
    for text, row in zip(texts, rows):
        assert row["t"] == plain.without(text, found, lambda _: " "), repr(text)
    tokens = {p: f"<<T$\\_{i}>>" for i, p in enumerate(found)}
    rows = collapse_phrases(df, "t", tokens).orderBy("i").collect()
    for text, row in zip(texts, rows):
        assert row["t"] == plain.without(text, found, lambda p: f" {tokens[p]} "), repr(text)


def test_spaces(spark):
    texts = ["\x1c a   b\x85", "", "​ x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select(collapse_spaces(F.col("t")).alias("r"), "i").orderBy("i").collect()
    assert [r["r"] for r in rows] == [plain.spaces(t) for t in texts]
