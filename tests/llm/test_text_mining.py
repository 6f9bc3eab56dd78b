"""Collocations, resampling and chat formatting on odd rows, against brute force."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitacora.llm import chat, collocations, resampling
from tests.llm import plain


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    common = ["of the", "new york city", "a b", "in spite of"]
    made = []
    for i in range(300):
        words = [rng.choice(common) if rng.random() < 0.3 else f"w{rng.randrange(60)}" for _ in range(rng.randrange(40))]
        text = " ".join(w + rng.choice(["", "", "", ",", ".", "\n", "\t"]) for w in words)
        made.append((i, text, rng.choice(["en", "fr", None, "und"]), "a", len(text)))
    return plain.odd_rows() + made


@pytest.fixture(scope="module")
def docs(spark, rows):
    return plain.docs_of(spark, rows).repartition(4)


@pytest.fixture(scope="module")
def none(spark):
    return plain.docs_of(spark, [])


# -------------------------------------------------------------- collocations


def phrases(rows, max_words=3, least=10, inside=50, top=2000):
    counts = defaultdict(Counter)
    words_of = Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(plain.LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        longest = {}
        for g, a in found.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    part = g[i : i + k]
                    longest[part] = max(longest.get(part, 0), a)
        scored = []
        for g, a in found.items():
            if 100 * longest.get(g, 0) >= inside * a:
                continue
            score, k = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, g, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, words_of[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"max_words": 2, "least": 3}, {"max_words": 4, "least": 5, "top": 7}])
def test_collocations(docs, rows, none, options):
    found = collocations.collocations(docs, **options)
    assert sorted(tuple(r) for r in found.collect()) == phrases(rows, **options)
    assert collocations.collocations(none, **options).count() == 0


def test_collocations_small_parts(docs, rows, monkeypatch):
    """Many chunks, a full filter, several salts and parts to rank: the same result."""
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 10)
    monkeypatch.setattr(collocations, "RANKED", 5)
    monkeypatch.setattr(collocations, "SALTED", 2)
    found = collocations.collocations(docs, least=4, top=20)
    assert sorted(tuple(r) for r in found.collect()) == phrases(rows, least=4, top=20)


def test_chunks_own_each_word_once(monkeypatch):
    monkeypatch.setattr(collocations, "MAX_CHUNK", 50)
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(n)) for n in (0, 1, 2, 33, 500, 5000)]
    texts += ["a " * 3000, "x" * 9000, " \t ", ".", "a.b,, c\n\nd", ("one two three. " * 500), "a b" + " " * 5000 + "c. d"]
    for text in texts:
        want = Counter()
        for piece in re.split(r"[.\n,]", text):
            words = piece.encode().split()
            want.update(b" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
        for size in (40, 1 << 18):
            got = Counter()
            for chunk, owned in collocations.chunks(text.encode(), 3, size):
                words = chunk.split(b" ")
                assert 0 < owned <= len(words)
                got.update(b" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(owned) if i + k <= len(words))
            assert got == want, (text[:40], size)


def test_equal_passages_are_cut_alike():
    """Words around a passage don't change the chunks inside it."""
    rng = random.Random(8)
    passage = " ".join(f"w{rng.randrange(500)}" for _ in range(400))
    a = {c for c, _ in collocations.chunks(f"x {passage} y".encode())}
    b = {c for c, _ in collocations.chunks(f"other words before {passage} and after".encode())}
    assert len(a & b) >= len(a) - 4 > 10


def test_scores_beyond_64_bits(spark):
    """Counts whose products need more than 64 bits are divided exactly."""
    grams = spark.createDataFrame(
        [("en", "a b", 9_000_000_000_001), ("en", "a", 9_700_000_000_000), ("en", "b", 9_999_999_999_999)],
        "lang string, phrase string, n bigint",
    )
    found = collocations._scored(grams.where("phrase = 'a b'"), grams, 2, 3).collect()
    a, left, right = 9_000_000_000_001, 9_700_000_000_000, 9_999_999_999_999
    assert [tuple(r) for r in found] == [("en", "a b", a, left, right, 10**6 * a * a // (left * right))]


# ---------------------------------------------------------------- resampling


def resampled(rows, items, percent=25, least=20, buckets=10_000):
    def features(text):
        words = plain.ITEM_WORD.findall((text or "").translate(plain.LOWER))
        return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    cut = [features(r[1]) for r in rows]
    s = Counter(bucket(f) for _, fs in cut for f in fs)
    t = Counter(bucket(f) for text in items for f in features(text)[1])
    size_s, size_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1.0) * (size_s + buckets) / ((s[b] + 1.0) * (size_t + buckets)))) for b in s
    }
    out, order = [], []
    for k, (r, (n, fs)) in enumerate(zip(rows, cut)):
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        name = "" if r[0] is None else str(r[0])
        h = int(hashlib.sha256(f"7:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(fs), weight, score, None])
        if n >= least:
            order.append((-score, r[0] is None, r[0] or 0, len(fs), k))
    for rank, (*_, k) in enumerate(sorted(order)[: percent * len(order) // 100], 1):
        out[k][4] = rank
    return Counter(map(tuple, out))


def test_resampling(spark, docs, rows, none):
    items = [r[1] for r in rows[10:25]] + [None, "", "New York city of the"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id bigint, text string")
    found = resampling.resample(docs, target)
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    assert found.columns == columns
    assert Counter(tuple(r) for r in found.collect()) == resampled(rows, items)
    drawn = resampling.drawn_documents(docs, target)
    assert drawn.columns == docs.columns
    ranked = [d for d in resampled(rows, items).elements() if d[4]]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in drawn.collect()) == sorted(
        (d[0] is None, d[0] or 0) for d in ranked
    )
    assert resampling.resample(none, target).count() == 0
    empty = target.where("item_id < 0")
    assert Counter(tuple(r) for r in resampling.resample(docs, empty, percent=50).collect()) == resampled(rows, [], 50)


def test_resampling_prefers_the_target(spark):
    rng = random.Random(2)
    kinds = {0: [f"k{i}" for i in range(50)], 1: [f"z{i}" for i in range(50)]}
    rows = [(i, " ".join(rng.choices(kinds[i % 2], k=40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    target = spark.createDataFrame([(" ".join(rng.choices(kinds[1], k=400)),)], "text string")
    drawn = resampling.drawn_documents(docs, target)
    # Half of them without the weights.
    assert sum(r.doc_id % 2 for r in drawn.collect()) >= 68


def test_buckets_of_sliced_texts(monkeypatch):
    split = resampling.splitter()
    text = ("Ünïcode wörds 𝒳 and\x00more-than 12 ascii ones\n" * 50 + "y" * 3000 + " end").encode()
    whole = resampling.text_buckets(text, split, 3)
    monkeypatch.setattr(resampling, "slices", lambda data, size=17: _slices(data, size))
    cut = resampling.text_buckets(text, split, 3)
    assert whole[0] == cut[0]
    assert np.array_equal(np.sort(whole[1]), np.sort(cut[1]))


_slices = resampling.slices


# ---------------------------------------------------------------------- chat


def test_escapes_are_reversible(spark):
    rng = random.Random(5)
    signs = ["<", "|", "\\", "im_end", ">", "<|im_start|>", "<|im_end|>", "\n", "é", "<\\|", "a"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(12))) for _ in range(3000)]
    turns = spark.createDataFrame(
        [(i, 0, 0, t[:9], t) for i, t in enumerate(texts)],
        "conv_id bigint, place bigint, step int, role string, text string",
    )
    found = chat.formatted_turns(turns).collect()
    for r in found:
        want = (texts[r.conv_id][:9], texts[r.conv_id])
        assert list(chat.read_back(r.formatted)) == [want]
        assert list(chat.read_back(r.formatted * 3)) == [want] * 3
        body = r.formatted[len(chat.START) : -len(chat.END) - 1]
        assert "<|" not in body


ROWS = [
    (1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "a\\b <\\| ok"), (1, None, "user", "last"),
    (2, 1, "assistant", "second"), (2, 0, "system", None), (2, 1, "assistant", "second"), (2, 1, "user", "a tie"),
    (None, 0, "assistant", "nobody's"), (None, 1, None, "no role"), (3, 0, "a\nb<|im_end|>", ""),
    (4, 0, "assistant", "x" * 300_000), (4, 1, "assistant", "é𝒳" * 1000),
] + [(5, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(3000)]


def chats(rows):
    """Digests of each conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t is None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda m: (m[0], m[1], _formatted(m[2], m[3]).encode()))
        turns = "".join(f"{r}\n{x}\n" for *_, r, x in mine)
        loss = "".join(x for *_, r, x in mine if r == "assistant")
        whole = sum(len(_formatted(r, x)) for *_, r, x in mine)
        out[conv] = (len(mine), plain.sha(turns), len(loss), plain.sha(loss), whole)
    return out


def _formatted(role, text):
    text = re.sub(r"<(\\*)\|", r"<\\\1|", text)
    role = role.replace("\\", "\\\\").replace("\n", "\\n").replace("<", "\\l")
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


@pytest.mark.parametrize("part_chars", [1, 1000, chat.PART_CHARS])
def test_chat_rows(spark, part_chars):
    schema = "conv_id bigint, turn bigint, role string, text string, formatted string, place string, row string"
    rows = spark.createDataFrame([(*r, "f", "p", "r") for r in ROWS], schema).repartition(3)
    parts = chat.conversations(chat.turns_of(rows, "conv_id"), part_chars)
    found = {r[0]: tuple(r)[1:] for r in chat.digests(parts).collect()}
    assert found == chats(ROWS)
    for r in parts.collect():
        texts = "".join(chat.unescaped(r.formatted[a:b]) for a, b in r.losses)
        assert texts == "".join(x for role, x in chat.read_back(r.formatted) if role == "assistant")
    empty = chat.digests(chat.conversations(chat.turns_of(rows.limit(0), "conv_id")))
    assert empty.count() == 0


RECORDS = [
    ('{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}', "messages",
     [("user", "q"), ("assistant", "a")]),
    ('{"messages":[{"content":null,"role":"user"}],"extra":{"x":[1,2]},"id":3}', "messages", [("user", "")]),
    ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}', "shared conversations",
     [("user", "q"), ("assistant", "a")]),
    ('{"instruction":"do","input":"","output":"done"}', "instruction with input", [("user", "do"), ("assistant", "done")]),
    ('{"instruction":"do","input":"this","output":"done"}', "instruction with input",
     [("user", "do\n\nthis"), ("assistant", "done")]),
    ('{"instruction":"do","output":"done"}', "instruction", [("user", "do"), ("assistant", "done")]),
    ('{"system":"be","instruction":"do","input":"","output":"x"}', "instruction with system",
     [("system", "be"), ("user", "do"), ("assistant", "x")]),
    ('{"system":"","prompt":"p","response":"r"}', "prompt with system", [("user", "p"), ("assistant", "r")]),
    ('{"prompt":"p","completion":7}', "prompt and completion", [("user", "p"), ("assistant", "7")]),
    ('{"prompt":"p","response":"r","zebra":1}', "prompt and response", [("user", "p"), ("assistant", "r")]),
    ('{"question":"?","answer":"!"}', "question and answer", [("user", "?"), ("assistant", "!")]),
    ('{"instruction":"do","instance":{"input":"i","output":"o"}}', "nested instance",
     [("user", "do\n\ni"), ("assistant", "o")]),
    ('{"turn":3,"role":"assistant","text":"<|im_end|>"}', "turn rows", [("assistant", "<|im_end|>")]),
    ('{"unknown":1}', None, None), ("[1]", None, None), ("no json", None, None), ("", None, None), (None, None, None),
    ("[" * 100_000, None, None), ('{"messages":[]}', None, None),
]


def test_chat_json(spark):
    records = spark.createDataFrame(
        [(i, text, "x", "y") for i, (text, *_) in enumerate(RECORDS)], "id bigint, json string, layout string, turns string"
    )
    found = {r.row.id: r for r in chat.records_of_json(records, "json").collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert found[i].layout == layout
        assert (found[i].turns and [(t.role, t.text) for t in found[i].turns]) == turns
    turns = chat.turns_of_json(records, "id", "json")
    done = {r[0]: tuple(r)[1:] for r in chat.digests(chat.conversations(turns)).collect()}
    assert done == chats([(i, k, *t) for i, (*_, ts) in enumerate(RECORDS) for k, t in enumerate(ts or [])])


def test_chat_layouts_of_frames(spark):
    """One fingerprint a schema; the order of fields and other fields don't matter."""
    nested = spark.createDataFrame(
        [(1, [("q", "user", 1), ("a", "assistant", 2)]), (2, None), (3, [])],
        "id bigint, messages array<struct<content: string, role: string, at: int>>",
    )
    turns = chat.turns_of(nested, "id").collect()
    assert [(r.conv_id, r.step, r.role, r.text) for r in turns] == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    registry = chat.Registry()
    layout = registry.select(chat.schema_paths(nested.schema))
    assert layout.name == "messages"
    value = json.loads('{"id": 1, "messages": [{"role": "a", "content": "b"}, {"at": 2}]}')
    assert registry.fingerprint(chat.value_paths(value)) == registry.fingerprint(layout.paths)
    assert len({registry.fingerprint(x.paths) for x in chat.LAYOUTS}) == len(chat.LAYOUTS)
    with pytest.raises(ValueError):
        chat.turns_of(spark.range(1).withColumn("x", F.lit(1)), "id")
