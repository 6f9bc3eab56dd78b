"""Every operator on odd documents and empty tables, against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bitacora.llm import (
    contamination,
    language,
    lines,
    mixing,
    near,
    passages,
    pii,
    quality,
    rules,
    shards,
)
from bitacora.llm.text import unpacked
from tests.llm import plain


@pytest.fixture(scope="module")
def rows():
    return plain.odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return plain.docs_of(spark, rows).repartition(4)


@pytest.fixture(scope="module")
def none(spark):
    return plain.docs_of(spark, [])


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_mixing(docs, rows, none):
    sizes, totals, target = plain.mixed(rows)
    found = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in found) == Counter(
        (r[0], r[3], n) for r, n in zip(rows, sizes)
    )
    taken = Counter()
    for r in found:
        assert r.source_size == totals[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for source, words in target.items():
        assert words - 1 < taken[source] <= words + 1e-6
    assert bag(mixing.mix(docs), "doc_id", "size", "taken") == Counter(
        (r.doc_id, r["size"], r.taken) for r in found
    )
    assert mixing.mix(none).count() == 0


def test_mixed_documents(docs, rows, none):
    _, _, target = plain.mixed(rows)
    found = mixing.mixed_documents(docs)
    assert found.columns == docs.columns
    words = Counter()
    for r in found.collect():
        words[r.source] += len(plain.WORD.findall(r.text))
    for source, wanted in target.items():
        # A repeated row counts as its fullest, so a few words more may be taken.
        assert wanted - 1 < words[source] <= wanted + 200
    assert mixing.mixed_documents(none).count() == 0


def test_language(docs, rows, none):
    model = language.fit(docs)
    assert set(model.languages) == {"en", "fr"}
    found = language.identify(docs, model)
    texts = Counter(r.text for r in unpacked(found, docs.columns).collect())
    assert texts == Counter(r[1] for r in rows)
    for r in found.collect():
        letter = any(c.isalpha() for c in r.row.text or "")
        assert (r.lang_pred == "und") == (not letter)
        assert 0 <= r.score <= 1
    empty = language.fit(none)
    assert language.identify(docs, empty).where("lang_pred <> 'und' or score <> 0").count() == 0
    assert language.identify(none, model).count() == 0


def test_quality(spark, docs, rows, none):
    pairs = [(r[0], i % 2) for i, r in enumerate(rows)] + [(None, 1), (3, None), (10_000, 0)]
    labels = spark.createDataFrame(pairs, "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    found = quality.score(docs, model)
    assert found.count() == len(rows)
    assert found.where("score < 0 or score > 1 or score is null").count() == 0
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.score(none, model).count() == 0
    one = quality.fit(docs, labels.where("quality = 1"))
    assert {r.score > 0.5 for r in quality.score(docs, one).collect()} == {True}


@pytest.mark.parametrize("size", [4, 5])
def test_near(docs, rows, none, size):
    expected = Counter(plain.near_groups(rows, size))
    assert bag(near.near_duplicates(docs, size), "doc_id", "n_shingles", "component_id") == expected
    assert near.near_duplicates(none, size).count() == 0
    kept = near.representatives(docs, size)
    assert kept.columns == docs.columns
    groups = plain.near_groups(rows, size)
    sets = {g[2] for g in groups if g[1] and g[2] is not None}
    ids = [r.doc_id for r in kept.where("doc_id is not null").collect()]
    assert sets <= set(ids)
    assert not {g[0] for g in groups if g[1]} - {g[2] for g in groups} & set(ids) - sets
    assert near.representatives(none, size).count() == 0


def test_near_chains(spark, monkeypatch):
    """Groups of copies that are near one another by steps only, in blocks."""
    monkeypatch.setattr(near, "BLOCK", 16)
    rng = random.Random(5)
    made = []
    for family in range(6):
        words = [f"f{family}x{i}" for i in range(120)]
        for k in range(70):
            # Slides away from where the family began; others are redrawn in part.
            slid = words[k : 60 + k] if family % 2 else [
                w if rng.random() > 0.03 * (family + 1) else f"r{rng.random()}" for w in words[:80]
            ]
            made.append(" ".join(slid))
    rng.shuffle(made)
    rows = [(i, t, None, None, None) for i, t in enumerate(made)]
    found = near.near_duplicates(plain.docs_of(spark, rows, False).repartition(4))
    assert bag(found, "doc_id", "n_shingles", "component_id") == Counter(plain.near_groups(rows, 4))


def test_private(docs, rows, none):
    found = pii.find_private(docs, mask=True)
    assert found.count() == len(rows)
    assert found.where("row.text is null and (masked is not null or size(spans) > 0)").count() == 0
    assert pii.find_private(none).count() == 0


def test_passages(docs, rows, none):
    expected = Counter(plain.without_passages(rows))
    for hot in (0, 1 << 40):
        found = passages.remove_passages(docs, bucket_windows=1000, hot_windows=hot)
        assert bag(found, "doc_id", "n_words", "n_removed", "kept") == expected
    assert passages.remove_passages(none).count() == 0


def test_common_passages(spark, monkeypatch):
    """Windows that are found to be common on the sample."""
    monkeypatch.setattr(passages, "SAMPLE", 2)
    monkeypatch.setattr(passages, "HOT_SHARE", 50)
    rng = random.Random(2)
    common = plain.sentence(rng, 15)
    rows = [(i, f"{plain.sentence(rng, 20)} {common} {plain.sentence(rng, 3)}", None, None, 0) for i in range(60)]
    rows += [(None, common, None, None, 0), (100, common, None, None, 0), (100, common + " x", None, None, 0)]
    found = passages.remove_passages(plain.docs_of(spark, rows).repartition(3), hot_windows=0)
    assert bag(found, "doc_id", "n_words", "n_removed", "kept") == Counter(plain.without_passages(rows))


def test_passages_of_one_id(spark):
    """Texts without an id whose hashes agree in their lower 24 bits stay apart."""
    passage = plain.sentence(random.Random(6), 40, 10**6)
    common = F.concat(F.lit(passage + " x"), F.col("id"))
    other = F.expr("array_join(transform(sequence(0, 199), j -> concat('u', id, 'x', j)), ' ')")
    texts = spark.range(30_000).select((F.col("id") % 2).alias("odd"), F.when(F.col("id") % 2 == 0, common).otherwise(other).alias("text"))
    short = texts.withColumn("d", F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFF)))
    pair = short.groupBy("d").agg(F.min(F.struct("odd", "text")).alias("a"), F.max(F.struct("odd", "text")).alias("b"))
    pair = pair.where("a.odd < b.odd").orderBy("d").first()
    rows = [(0, passage, None, None, 0), (None, pair.a.text, None, None, 0), (None, pair.b.text, None, None, 0)]
    found = passages.remove_passages(plain.docs_of(spark, rows))
    assert bag(found, "doc_id", "n_words", "n_removed", "kept") == Counter(plain.without_passages(rows))


def test_marks_of_equal_rows():
    """Equal rows get one row of marks in a bucket, not one each."""
    h = passages._packed(np.arange(5, dtype=np.uint64))
    ids, digests = [1, 2, 2, 2, None, None, None], [7, 8, 8, 9, 8, 8, 9]
    columns = [pa.array([0] * 7), pa.array(ids), pa.array(digests), pa.array([h] * 7)]
    batch = pa.RecordBatch.from_arrays(columns, ["bucket", "doc_id", "digest", "hashes"])
    marks = pa.Table.from_batches(passages._marked(iter([batch]))).to_pylist()
    assert [(m["doc_id"], m["digest"]) for m in marks] == [(2, 8), (2, 9), (None, 8), (None, 9)]
    assert {m["marks"] for m in marks} == {np.packbits(np.ones(5, bool)).tobytes()}


def test_contamination(spark, docs, rows, none):
    rng = random.Random(3)
    texts = [r[1] for r in rows if (r[1] or "").strip() and len(r[1]) < 3000]
    items = [(1, None), (2, ""), (None, texts[12]), (3, "a"), (4, "...")]
    for k in range(5, 40):
        words = rng.choice(texts).split()
        at = rng.randrange(len(words))
        items.append((k % 30, " ".join(words[at : at + rng.randrange(1, 30)]).upper()))
    items += items[6:9]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    expected = Counter((d, n, h, tuple(names)) for d, n, h, names in plain.hits(rows, items))
    for block in (10**6, 60):
        found = contamination.find_contamination(docs, frame, block_words=block)
        got = found.select("row.doc_id", "n_words", "n_hit", "items", "contaminated").collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == expected
        assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in got)
    assert contamination.find_contamination(none, frame).count() == 0
    clean = contamination.find_contamination(docs, frame.limit(0))
    assert clean.where("n_hit > 0 or contaminated").count() == 0


def test_rules(docs, rows, none):
    found = rules.ledger(docs).collect()
    expected = Counter()
    for doc_id, text, *_ in rows:
        words = plain.WORD.findall(text or "")
        runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        hit = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
        ls = [x for x in (text or "").split("\n") if plain.WORD.search(x)]
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        expected[doc_id, len(words), sum(map(len, words)), symbols, len(ls) - len(set(ls)), len(hit)] += 1
    assert expected == Counter(
        (r.row.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found
    )
    kept = sum(r.fail_bits & rules.mask("v2") == 0 for r in found)
    ablations = {r.rule: r for r in rules.ablations(rules.ledger(docs)).collect()}
    assert set(ablations) == set(rules.POLICIES["v2"])
    for rule, r in ablations.items():
        assert r.kept == kept
        assert r.failed == sum(bool(x.fail_bits & rules.bit(rule)) for x in found)
        assert r.failed_alone == sum(x.fail_bits & rules.mask("v2") == rules.bit(rule) for x in found)
    assert rules.ledger(none).count() == 0


def test_lines(docs, rows, none):
    order = plain.line_dedup(rows)
    expected = Counter()
    digest = {r.text: r.d for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("d")).collect()}
    first = {g: min(p, key=lambda x: (x[0], x[1], digest.get(x[2], 0), x[3])) for g, p in order.items()}
    for doc_id, text, *_ in rows:
        text = text or ""
        ls = text.split("\n")
        full = [(i, x) for i, x in enumerate(ls) if plain.WORD.search(x)]
        gone = set()
        for k in range(len(full) - 2):
            place = (doc_id is None, doc_id or 0, text, full[k][0])
            if first[tuple(x for _, x in full[k : k + 3])] != place:
                gone.update(i for i, _ in full[k : k + 3])
        kept = "\n".join(x for i, x in enumerate(ls) if i not in gone)
        expected[doc_id, len(ls) if text else 0, len(gone), kept] += 1
    found = lines.dedup_lines(docs)
    assert bag(found, "row.doc_id", "n_lines", "n_removed", "kept") == expected
    assert sum(k[2] for k in expected) > 0
    assert lines.dedup_lines(none).count() == 0


@pytest.mark.parametrize("limit", [1 << 40, 3000, 200, 1])
def test_shards(docs, rows, none, limit):
    found = shards.assign(docs, limit).collect()
    assert len(found) == len(rows)
    size, members = Counter(), {}
    for r in found:
        size[r.shard] += r.bytes
        members.setdefault(r.shard, set()).add((r.row.doc_id, r.row.text))
        assert r.bytes == len((r.row.text or "").encode()) and r.depth == len(r.shard)
    names = sorted(size)
    for r in found:
        assert r.shard_bytes == size[r.shard]
    for a, b in zip(names, names[1:]):
        assert not b.startswith(a)
    for name, total in size.items():
        assert total <= limit or len(members[name]) == 1
        if name:
            # Together with its other half it would be too large.
            half = name[:-1]
            assert sum(n for s, n in size.items() if s.startswith(half)) > limit
    assert shards.assign(none, limit).count() == 0


def test_write_shards(spark, docs, rows, tmp_path):
    shards.write_shards(docs.drop("shard"), str(tmp_path / "out"), 3000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(r.text for r in back.collect()) == Counter(r[1] for r in rows)


def test_stages(spark, docs, none, sf):
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, none):
            found = stage(spark, given, sf)
            assert found.columns[: len(docs.columns)] == docs.columns, name
            assert (found.count() > 0) == (given is docs)
