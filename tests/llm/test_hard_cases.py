"""Many rows of one id, repetitive texts, odd letters; learned operators against plain versions."""

import bisect
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitacora.llm import contamination, language, passages, pii, quality, shards
from tests.llm import plain


def sentence(rng, signs, n):
    return " ".join("".join(rng.choices(signs, k=rng.randrange(2, 8))) for _ in range(n))


# ----------------------------------------------------------------- language


def grams_of(text):
    """N-grams of 1 to 3 characters of words of letters, with a blank on either side."""
    found, word = set(), ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            spaced = f" {word} "
            found |= {spaced[i : i + n] for n in (1, 2, 3) for i in range(len(spaced) - n + 1)}
            word = ""
    return found - {" "}


def kernel(a, b):
    return len(a & b) / math.sqrt(len(a) * len(b)) if a and b else 0.0


def ridge(learned):
    """(languages, landmark sets, their weights) from (share, id, lang, text)."""
    langs = sorted({r[2] for r in learned})
    marks = []
    for lang in langs:
        mine = sorted((r for r in learned if r[2] == lang), key=lambda r: (len(r[3]) < 400, r[0], r[1]))
        marks += [grams_of(r[3]) for r in mine[:16]]
    sets = [grams_of(r[3]) for r in learned]
    own = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(own)
    root = vectors @ np.diag(np.maximum(values, 1e-6) ** -0.5) @ vectors.T
    phi = np.array([[kernel(s, m) for m in marks] for s in sets]) @ root
    each = {lang: sum(r[2] == lang for r in learned) for lang in langs}
    w = np.array([len(learned) / each[r[2]] / len(langs) for r in learned])
    y = np.array([[1.0 if r[2] == lang else -1.0 for lang in langs] for r in learned])
    gram = phi.T @ (phi * w[:, None]) + language.RIDGE * np.eye(len(marks))
    return langs, marks, root @ np.linalg.solve(gram, phi.T @ (y * w[:, None]))


def test_language_is_kernel_ridge_regression(spark):
    rng = random.Random(5)
    signs = {"aa": "abcdeé", "bb": "cdefgh", "cc": "xyzabñ"}
    rows = [(i, sentence(rng, signs[lang], rng.randrange(5, 120)), lang) for i in range(160) for lang in [rng.choice(list(signs))]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    share = F.xxhash64("doc_id", "text").alias("share")
    learned = [tuple(r) for r in docs.select(share, "doc_id", "lang", "text").collect() if plain.crc(r.doc_id) % 4 != 2]
    langs, marks, weights = ridge(learned)
    found = {r.row.doc_id: r for r in language.identify(docs, language.fit(docs)).collect()}
    for doc_id, text, _ in rows:
        scores = np.array([kernel(grams_of(text), m) for m in marks]) @ weights
        r = found[doc_id]
        assert r.score == pytest.approx(min(1, max(0, (scores.max() + 1) / 2)), abs=2e-3)
        first, second = np.sort(scores)[::-1][:2]
        if first - second > 1e-2:
            assert r.lang_pred == langs[scores.argmax()]


def test_no_language_hangs_on_one_id(spark):
    """Thousands of rows of one id are as many texts; equal rows are a sample too."""
    rng = random.Random(1)
    one = next(i for i in range(100) if plain.crc(i) % 4 != 2)
    rows = [(one, sentence(rng, "abcdefg", 8), "en") for _ in range(3000)]
    rows += [(i, sentence(rng, "nopqrst", 8), "fr") for i in range(400)]
    rows += [(one, "wxyz zyxw", "de")] * 1500
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["de", "en", "fr"]
    found = language.identify(docs.where("doc_id <> 0"), model)
    assert found.where("lang_pred <> row.lang").count() == 0


def test_two_hundred_languages(spark):
    """The model is bounded, whatever the number of languages."""
    rng = random.Random(2)
    letters = [chr(0x4E00 + i) for i in range(1200)]
    rows = []
    for k in range(300):
        mine = "".join(letters[4 * k : 4 * k + 4])
        rows += [(len(rows) + i, sentence(rng, mine, 6), f"l{k:03}") for i in range(4 + (k < 250))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs)
    assert len(model.languages) <= language.LANGUAGES
    assert len(model.landmarks.matrix[0]) <= language.LANDMARKS_IN_ALL
    found = language.identify(docs, model).where(F.col("row.lang").isin(model.languages[:200]))
    assert found.where("lang_pred = row.lang").count() >= 0.95 * found.count()


def test_letters_are_letters(spark):
    rows = [(1, "aa bb"), (2, "½ ② ²"), (3, "Ⅷ"), (4, "́"), (5, "123 _"), (6, "½a"), (7, None), (8, ""), (9, "ß")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit("xx"))
    found = {r.row.doc_id: r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()}
    assert found == {1: "xx", 2: "und", 3: "und", 4: "und", 5: "und", 6: "xx", 7: "und", 8: "und", 9: "xx"}


# ------------------------------------------------------------------ quality


def test_quality_is_a_sum_of_tables(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, "abcde.,!X1 ", rng.randrange(0, 60)) if i % 9 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(len(t or "") > 120)) for i, t in rows], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    assert any(np.abs(t).max() > 0 for t in model.tables)
    found = {r.row.doc_id: r.score for r in quality.score(docs, model).collect()}
    for doc_id, text in rows:
        x = quality.measurements(text)
        total = model.base
        for k, value in enumerate(x):
            total += model.tables[k][bisect.bisect_right(list(model.edges[k]), value)]
        for (i, j), table in model.pairs.items():
            a = bisect.bisect_right(list(model.pair_edges[i]), x[i])
            b = bisect.bisect_right(list(model.pair_edges[j]), x[j])
            total += table[a][b]
        assert found[doc_id] == pytest.approx(1 / (1 + math.exp(-total)))


def test_a_labelled_id_of_many_rows(spark):
    """The sample is of rows, however many share an id."""
    rng = random.Random(4)
    one = next(i for i in range(100) if plain.crc(i) % 3 != 1)
    rows = [(one, sentence(rng, "abc", 5)) for _ in range(3000)] + [(i + 200, sentence(rng, "xyz", 50)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(one, 0)] + [(i + 200, 1) for i in range(200)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels, rows=1000)
    scores = quality.score(docs, model)
    assert scores.where(f"row.doc_id = {one} and score < 0.5").count() == 3000
    assert scores.where(f"row.doc_id <> {one} and score >= 0.5").count() == 200


# --------------------------------------------------------------- linear time


@pytest.mark.parametrize("blank", [" ", "\t", " \t"])
def test_blanks_after_a_cue(blank):
    anchors = pii.automaton()
    run = blank * (10**6 // len(blank))
    start = time.time()
    assert pii.spans(f"token{run}", anchors) == []
    assert pii.spans(f"token:{run}x", anchors) == []
    # A value may stand far behind its cue.
    assert [k for _, k, _ in pii.spans(f"token{run}:{run}abc123", anchors)] == ["account"]
    assert [k for _, k, _ in pii.spans("iban number : DE4450010517 token\t=\tabcdef1", anchors)] == ["account"] * 2
    assert time.time() - start < 10


def test_texts_of_one_word(spark):
    """Occurrences are not paired with occurrences."""
    items = [("i", "same " * 50_000), ("j", "same " * 13 + "other"), ("k", "a b c d e f g h i j k l m n")]
    docs = [(1, "same " * 100_000), (2, "same " * 12), (3, "x " * 100 + "b c d e f g h i j k l m n"), (4, "other")]
    start = time.time()
    found = contamination.find_contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id string, text string"),
    ).collect()
    assert time.time() - start < 20
    got = {r.row.doc_id: (r.n_words, r.n_hit, r["items"], r.spans) for r in found}
    assert got[1] == (100_000, 100_000, ["i", "j"], [[0, 100_000]])
    assert got[2] == (12, 0, [], [])
    assert got[3] == (113, 13, ["k"], [[100, 113]])
    assert got[4] == (1, 0, [], [])


@pytest.mark.parametrize("block_words", [300, 10**9])
def test_blocks_of_items(spark, block_words):
    """One block or many: the same spans, also where several meet in one document."""
    rng = random.Random(6)
    items = [(str(i), " ".join(f"w{rng.randrange(12)}" for _ in range(rng.randrange(1, 30)))) for i in range(40)]
    rows = [(i % 30, " ".join(f"w{rng.randrange(12)}" for _ in range(rng.randrange(60))), None) for i in range(60)]
    rows += [(90, f"{items[3][1]} {items[4][1]} {items[5][1]}", None)] * 2
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    found = contamination.find_contamination(docs, spark.createDataFrame(items, "item_id string, text string"), block_words=block_words)
    got = sorted((r.row.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect())
    assert got == sorted(plain.hits(rows, items))


# ----------------------------------------------------------------- sharding


def test_texts_under_one_id_are_parted(spark):
    rng = random.Random(7)
    rows = [(1, sentence(rng, "abcdef", 180)) for _ in range(200)] + [(2, "same " * 400)] * 5 + [(None, "n" * 900)] * 9
    rows += [(None, sentence(rng, "xyz", 100)) for _ in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = shards.assign(docs, 5000).collect()
    members, size = {}, {}
    for r in found:
        members.setdefault(r.shard, set()).add((r.row.doc_id, r.row.text))
        size[r.shard] = r.shard_bytes
    assert sum(len(r.row.text) for r in found) == sum(sum(len(t) for _, t in m) for m in members.values()) + 2000 * 4 + 900 * 8
    assert all(n <= 5000 or len(members[s]) == 1 for s, n in size.items())


# ------------------------------------------------------------------ passages


@pytest.mark.parametrize("hot_most", [0, 10**6])
def test_common_windows_go_another_way(spark, monkeypatch, hot_most):
    """Windows that fill a bucket, but are a small share of all: broadcast, or joined beyond a size."""
    monkeypatch.setattr(passages, "SAMPLE", 2)
    monkeypatch.setattr(passages, "FILTER_BITS", 1 << 12)
    rng = random.Random(9)
    common = [" ".join(f"c{k}x{i}" for i in range(16)) for k in range(4)]
    rows = []
    for i in range(400):
        own = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
        rows.append((i % 390, f"{own} {common[i % 4]} {own[:40]}", None, None, None))
    rows += [(None, f"{common[0]} end", None, None, None)] * 3 + [(5, None, None, None, None), (6, "", None, None, None)]
    docs = plain.docs_of(spark, rows).repartition(3)
    # A quarter of a bucket is a dozen copies; one window in 10,000 would be fewer than one.
    found = passages.remove_passages(docs, bucket_windows=100, hot_windows=0, hot_most=hot_most)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found.collect()), key=repr)
    assert got == sorted(plain.without_passages(rows), key=repr)
