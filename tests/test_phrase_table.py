"""Long phrase lists as tables: the same results as the pattern and the fold, at any length."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from bitacora import collapse_phrases, extract_notes, load_phrase_table, load_phrases, remove_phrases
from bitacora.functions import phrase_table
from bitacora.functions import phrases as by_pattern
from bitacora.functions.dialect import whole_phrase
from bitacora.functions.phrase_table import replace_from_table, whole_phrase_pattern
from bitacora.functions.phrases import flatten_dictionary, replace_phrases
from bitacora.operators import phrases as in_turn
from tests import plain

SIGNS = ["a", "b", "A", "Ñ", "ñ", "é", "_", "7", " ", " ", "  ", "-", ".", ",", "(", "\n", "$", "\\", "ab", "a b", "́", "ß"]


def noisy(rng, n):
    return "".join(rng.choice(SIGNS) for _ in range(rng.randrange(n)))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, t string, _entries string").repartition(3)


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_dictionary_table_matches_pattern_and_plain_rules(spark, seed):
    rng = random.Random(seed)
    categories = {c: [p for p in (noisy(rng, 7) for _ in range(25)) if p] for c in ("uno", "dos", " ", "a b")}
    texts = [noisy(rng, 40) for _ in range(1500)] + [None, "", "a", " a ", "a b" * 50]
    df = frame(spark, texts)
    flat = flatten_dictionary(categories)
    table = spark.createDataFrame(list(flat.items()), "phrase string, new string")
    found = replace_from_table(df.drop("_entries"), "t", table, "r")
    assert found.columns == ["i", "t", "r"]
    got = column(found, "r")
    assert got == column(replace_phrases(df, "t", flat, "r"), "r")
    for text, new in zip(texts, got):
        assert new == (text and plain.phrases(text, categories)), repr(text)


def test_result_may_be_the_text_itself(spark):
    df = spark.createDataFrame([(1, "Se fue A CASA hoy", 5)], "i int, t string, z int")
    table = spark.createDataFrame([("a casa", "<C>")], "phrase string, new string")
    found = replace_phrases(df, "t", table, "t")
    assert found.columns == ["i", "t", "z"] and found.first().t == "Se fue <C> hoy"
    none = table.where("phrase = ''")
    assert replace_phrases(df, "t", none, "t").first().t == "Se fue A CASA hoy"
    assert replace_phrases(df.limit(0), "t", table, "t").count() == 0


def test_long_dictionaries_become_tables(spark, monkeypatch):
    rng = random.Random(4)
    flat = {f"w{i} w{i % 7}": f"<{i}>" for i in range(300)}
    texts = [" ".join(f"W{rng.randrange(300)}" for _ in range(40)) for _ in range(200)]
    df = frame(spark, texts)
    want = column(replace_phrases(df, "t", flat, "r"), "r")
    monkeypatch.setattr(by_pattern, "MOST_IN_PATTERN", 10)
    found = replace_phrases(df, "t", flat, "r")
    assert "w299 w5" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert column(found, "r") == want


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_in_turn_from_a_table(spark, monkeypatch, seed):
    """Tokens that make new matches, phrases without words, ties, and empty ones."""
    rng = random.Random(seed)
    found = list(dict.fromkeys(noisy(rng, 7) for _ in range(60)))
    tokens = {p: rng.choice(["<<T_1>>", "b", "a b", "$1", "\\", "T_1 7"]) for p in found}
    tokens |= {"T_1 a": "<<T_2>>", "T_2 7": "fin", "T_1": "a"}
    texts = [noisy(rng, 40) for _ in range(400)] + [None, "", "a"]
    df = frame(spark, texts)
    removed, collapsed = column(remove_phrases(df, "t", found), "t"), column(collapse_phrases(df, "t", tokens), "t")
    monkeypatch.setattr(in_turn, "MOST_IN_FOLD", 0)
    assert column(remove_phrases(df, "t", found), "t") == removed
    assert column(collapse_phrases(df, "t", tokens), "t") == collapsed
    rows = [(p, t, k) for k, (p, t) in enumerate(tokens.items())]
    table = spark.createDataFrame(rows, "phrase string, token string, at bigint")
    assert column(collapse_phrases(df, "t", table), "t") == collapsed
    assert collapse_phrases(df, "t", table).columns == df.columns


def test_patterns_are_those_of_the_fold(spark):
    rng = random.Random(6)
    found = sorted({noisy(rng, 8) for _ in range(300)} | {"", "a\x00b", "tab\t"})
    df = spark.createDataFrame([(p,) for p in found], "p string")
    got = {r.p: r.x for r in df.select("p", whole_phrase_pattern(F.col("p")).alias("x")).collect()}
    assert got == {p: whole_phrase(p) for p in found}


def test_phrase_file_as_a_table(spark, tmp_path):
    path = tmp_path / "frases"
    path.mkdir()
    (path / "a.json").write_text(json.dumps({"UNO": ["En La", "x", ""], " ": ["fuera"], "DOS": ["x"]}))
    (path / "b.json").write_text(json.dumps({"TRES": ["EN LA"], "": ["y"]}))
    flat = flatten_dictionary(load_phrases(spark, str(path)))
    table = load_phrase_table(spark, str(path))
    assert {r.phrase: r.new for r in table.collect()} == flat
    notes = spark.createDataFrame([("En la casa x y fuera",)], "Notas string")
    want = extract_notes(notes, phrases=load_phrases(spark, str(path))).first()
    assert extract_notes(notes, phrases=table).first() == want
    assert load_phrase_table(spark, str(tmp_path / "none.json")) is None
    (path / "c.json").write_text("no json")
    assert load_phrase_table(spark, str(path)) is None


def test_time_does_not_grow_with_the_phrases(spark):
    rng = random.Random(1)
    words = [f"pal{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(1000)]
    df = frame(spark, texts).cache()
    df.count()

    def took(n, work):
        found = list(dict.fromkeys(" ".join(rng.choices(words, k=rng.randrange(2, 4))) for _ in range(n)))
        work(found[:50]).count()
        start = time.time()
        work(found).selectExpr("sum(hash(*))").collect()
        return time.time() - start

    def replaced(found):
        return replace_phrases(df, "t", {p: "<x>" for p in found}, "r")

    def removed(found):
        return remove_phrases(df, "t", found)

    few, many = took(1500, replaced), took(20_000, replaced)
    assert many < 3 * few + 2
    assert took(2000, removed) < 10
    assert took(20_000, removed) < 20
    df.unpersist()


def test_a_word_of_all_texts_brings_no_phrase_of_another(spark, monkeypatch):
    """Tokens are keys of later phrases too: "ya" is in all texts and in half of the phrases."""
    looked_up, most = phrase_table._looked_up, []

    def counted(df, text, found):
        most.append(found.agg(F.max(F.size("entries"))).first()[0])
        return looked_up(df, text, found)

    monkeypatch.setattr(phrase_table, "_looked_up", counted)
    rows = [(f"Cliente#{i:03d}", f"<<C_{i}>>", 2 * i) for i in range(60)]
    rows += [(f"C_{i}>>  ya", "OK", 2 * i + 1) for i in range(60)]
    table = spark.createDataFrame(rows, "phrase string, token string, at bigint")
    df = frame(spark, [f"pide Cliente#{i:03d} ya, fin" for i in range(60)])
    assert set(column(collapse_phrases(df, "t", table), "t")) == {"pide << OK , fin"}
    assert most == [2]


def test_frequent_words_of_no_phrase_are_not_moved(spark, monkeypatch):
    without_idle, keys = phrase_table._without_idle, []

    def seen(places, table):
        left = without_idle(places, table)
        keys.extend(r["key"] for r in left.select("key").distinct().collect())
        return left

    monkeypatch.setattr(phrase_table, "_without_idle", seen)
    monkeypatch.setattr(phrase_table, "HOT_ROWS", 50)
    table = spark.createDataFrame([(f"c#{i:03d}", f"<{i}>") for i in range(100)], "phrase string, new string")
    df = frame(spark, [f"pide C#{i:03d}, urgente" for i in range(100)])
    got = column(replace_phrases(df, "t", table, "r"), "r")
    assert got == [f"pide <{i}>, urgente" for i in range(100)]
    assert "007" in keys and not {"pide", "urgente", " "} & set(keys)
