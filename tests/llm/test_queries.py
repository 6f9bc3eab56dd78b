"""The registered queries against their SQL, or against brute force where there is none."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from bitacora.llm import pii, queries
from tests.check_queries import compare, database
from tests.llm import plain


@pytest.fixture(scope="module")
def db(sf):
    return database(sf)


def test_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, sf, db, name):
    assert compare(spark, db, sf, name, queries.QUERIES[name], queries.ORACLES[name]) is None


def test_language(spark, sf):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = queries.QUERIES["op2_language_id"](spark, sf).collect()
    assert len(found) == len(langs)
    assert all(r.held_out == (plain.crc(r.doc_id) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.98 * len(held)


def test_language_stage(spark, sf):
    """Texts like no language go, however long; clean ones of few words stay."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rng = random.Random(4)
    unlike = ["Все люди рождаются свободными и равными", "人人生而自由 在尊严和权利上一律平等", "שלום עולם"]
    unlike.append("Příliš žluťoučký kůň úpěl ďábelské ódy, a pak šel domů spát")
    for n in (20, 200, 2000):
        for _ in range(5):
            words = ("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(1, 10))) for _ in range(n))
            unlike.append(" ".join(words))
    clean = {(r.lang, " ".join(plain.WORD.findall(r.text)[:8])) for r in docs.collect() if "$" not in r.text}
    rows = [(10**6 + i, t, lang, "a", len(t)) for i, (lang, t) in enumerate(sorted(clean))]
    assert {r[2] for r in rows} == {"de", "en", "es", "fr"}
    more = rows + [(2 * 10**6 + i, t, None, "a", len(t)) for i, t in enumerate(unlike)]
    given = docs.unionByName(spark.createDataFrame(more, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, given, sf).select("doc_id").collect()}
    assert {i for i in kept if i >= 2 * 10**6} == set()
    assert {r[0] for r in rows} <= kept


def test_quality(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = queries.QUERIES["op3_quality_classifier"](spark, sf).collect()
    assert all(r.held_out == (plain.crc(r.doc_id) % 3 == 1) for r in found)
    assert all(r.predicted == (r.score >= 0.5) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def _noisy(rng):
    parts = ["@", ".", "+1 (", ") ", "-", " ", "555", "4111111111111111", "4111 1111 1111 1111", "a", "Z9",
             "x@y.z", "1.2.3.4", "300.1.1.1", "é", "\n", "https://u:p@h.org/x", "iban: DE44500", "%", "_", "0"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(40)))


def test_private_base():
    anchors = pii.automaton()
    rng = random.Random(7)
    texts = [_noisy(rng) for _ in range(20_000)]
    texts += ["".join(rng.choice("0123456789.@+- ()a") for _ in range(60)) for _ in range(20_000)]
    texts += [None, "", "1" * 5000 + ".1.1.1", "a" * 20_000 + "@", "+1" + " " * 20_000, "@" * 5000]
    for text in texts:
        base = [s for s in pii.spans(text, anchors) if s[1] in pii.KINDS[:4]]
        assert base == plain.private(text), text


def test_private_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op5_private_data"](spark, sf).collect()}
    assert len(found) == len(docs)
    for d in docs:
        spans = plain.private(d.text)
        r = found[d.doc_id]
        assert r.base_sha256 == plain.sha(",".join(f"{k}:{a}:{b}" for a, k, b in spans))
        for kind in pii.KINDS[:4]:
            assert r[f"n_{kind}"] == sum(k == kind for _, k, _ in spans)


def test_masked():
    anchors = pii.automaton()
    text = "to x@y.org, card 4111 1111 1111 1111 at 12 High Street"
    found = pii.spans(text, anchors)
    assert [k for _, k, _ in found] == ["email", "card", "address"]
    assert pii.masked(text, found) == "to [email], card [card] at [address]"


def test_long_account():
    """A value goes whole, wherever its first digit stands; one without a digit isn't found."""
    anchors = pii.automaton()
    for key in ("aB3_-" * 40, "k" * 199 + "7", "x" * 64 + "1", "q1" * 50_000):
        text = f"api_key={key} end"
        assert pii.spans(text, anchors) == [(8, "account", 8 + len(key))]
        assert pii.masked(text, pii.spans(text, anchors)) == "api_key=[account] end"
    assert pii.spans("secret: " + "k" * 200, anchors) == []
    # Cues inside a value without a digit don't read it again and again.
    assert pii.spans("token" * 100_000, anchors) == []


def test_pipeline(spark, sf):
    """Stage by stage: what goes is what must, and nothing else."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [tuple(d[c] for c in plain.COLUMNS) for d in docs]
    # Every document has a letter and a language, so the first stage keeps all.
    groups = plain.near_groups(rows, corpus_pipeline.SHINGLE)
    rows = [r for r, g in zip(rows, groups) if g[2] == r[0]]
    rows = [r for r, (_, n, h, _) in zip(rows, plain.hits(rows, items)) if not (h > 0 and 20 * h >= n)]
    _, _, target = plain.mixed(rows)
    result = corpus_pipeline.run(spark, sf)
    assert result.columns[:5] == plain.COLUMNS
    found = result.collect()
    taken = {}
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + len(plain.WORD.findall(r.text))
    for source, words in target.items():
        assert words - 1 < taken.get(source, 0) <= words + 1e-6
    texts = {r[0]: r[1] for r in rows}
    cut = [r for r in found if texts[r.doc_id] != r.text]
    assert len(cut) <= len(target)
    assert all(texts[r.doc_id].split()[: len(r.text.split())] == r.text.split() for r in cut)
