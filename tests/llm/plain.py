"""Brute-force versions of the operators in plain Python, and odd documents."""

import hashlib
import random
import re
import zlib

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Names that operators use inside or return.
CLASHING = (
    "row size key digest words lines bytes bits shard spans items taken kept score component "
    "id s once epoch range before target n_words hashes runs ranked gone h place _id _source"
).split()
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def docs_of(spark, rows, clashing=True):
    schema = DOCS
    if clashing:
        schema = T.StructType([*DOCS.fields, *[T.StructField(c, T.StringType()) for c in CLASHING]])
        rows = [(*r, *CLASHING) for r in rows]
    return spark.createDataFrame(rows, schema)


def sentence(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def odd_rows(seed=1):
    """Documents with everything missing, empty, long, repeated, alike or strange."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randrange(1, 60)) for _ in range(30)]
    passage = sentence(rng, 20)
    long = sentence(rng, 30_000, 50_000)
    texts = [None, "", " \t\n", " ", "a", "A b C", "...", "123 456", "x" * 50_000, long, long + " tail"]
    texts += base + base[:6] + [t.upper() for t in base[:4]]
    texts += [f"{sentence(rng, 5)} {passage} {sentence(rng, 5)}" for _ in range(8)]
    texts += ["one line here\ntwo line here\n\nthree line here\nfour\n" + sentence(rng, 3) for _ in range(4)]
    texts += ["a b c d e " * 30, "#*$ && %% || <>" * 9, "ñandú É́ 𝒳 ß\nñandú É́ 𝒳 ß"]
    for t in base[:10]:
        words = t.split()
        for _ in range(3):
            cut = list(words)
            cut[rng.randrange(len(cut))] = "changed"
            texts.append(" ".join(cut))
    rows = []
    for i, text in enumerate(texts):
        lang = rng.choice(["en", "fr", None])
        source = rng.choice(["a", "b", "Z", "é", None, "a"])
        rows.append((i * 7 % 211, text, lang, source, None if text is None else len(text)))
    rows += rows[3:6] + rows[12:14]  # repeated rows
    rows += [(None, base[0], "en", "a", 3), (None, None, None, None, None), (None, passage, "fr", None, 5)]
    rows += [(None, passage, "fr", None, 5), (5, base[1], "en", "b", 1)]  # an id twice
    return rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def shingle_set(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_groups(rows, size):
    """(doc_id, set size, smallest id reached) per row."""
    sets = [shingle_set(r[1], size) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets))]


def without_passages(rows, size=13):
    """(doc_id, words, removed, what stays) per row."""
    first = {}
    for doc_id, text, *_ in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - size + 1):
            g = tuple(words[i : i + size])
            if doc_id is not None:
                first[g] = min(first.get(g, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - size + 1):
            seen = first.get(tuple(words[i : i + size]))
            if seen is not None and (doc_id is None or seen < doc_id):
                gone.update(range(i, i + size))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc_id, len(words), len(gone), " ".join(kept)))
    return out


def hits(rows, items, size=13):
    """(doc_id, words, hit words, ids of items) per row."""
    out = []
    cut = [(i, ITEM_WORD.findall((t or "").translate(LOWER))) for i, t in items]
    windows = {}
    for item, words in cut:
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    for doc_id, text, *_ in rows:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                items_here = windows.get(tuple(words[i : i + n]))
                if items_here:
                    hit.update(range(i, i + n))
                    found |= items_here
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(words), len(hit), names))
    return out


# The base of personal data, as patterns over the whole text.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def private(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1])]
        if 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    kinds = ["email", "ip", "card", "phone"]
    return [(a, kinds[k], b) for a, k, b in sorted(found)]


def line_dedup(rows):
    """(doc_id, lines, removed lines, kept text) per row."""
    order = {}
    for doc_id, text, *_ in rows:
        place = (doc_id is None, doc_id or 0)
        text = text or ""
        lines = [(i, x) for i, x in enumerate(text.split("\n")) if WORD.search(x)]
        for k in range(len(lines) - 2):
            g = tuple(x for _, x in lines[k : k + 3])
            order.setdefault(g, set()).add((*place, text, lines[k][0]))
    return order


def mixed(rows):
    """(doc_id, size, source size, target, taken) per row."""
    sizes = [len(WORD.findall(r[1] or "")) for r in rows]
    totals = {}
    for r, n in zip(rows, sizes):
        totals[r[3]] = totals.get(r[3], 0) + n
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(totals.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * totals[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * totals[s]
            left -= target[s]
        free -= over
    return sizes, totals, target
