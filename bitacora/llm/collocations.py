"""Phrases whose words occur together more often than apart, by prefix-free parsing.

Texts, lower-cased in A-Z, are split into pieces at punctuation and line ends, pieces into
words.  Everything is counted per language; a null one is ``und``.

How: pieces are parsed into chunks that overlap by ``max_words - 1`` words.  A chunk ends where
the hash of that many consecutive words is a trigger, so equal passages are cut alike
wherever they stand; short pieces are one chunk.  The distinct chunks with their frequencies
are the dictionary, and it replaces the text.  An n-gram is counted in the chunk that owns
its first word, weighted by the chunk's frequency: a chunk owns all words but those it shares
with the next, so each occurrence counts once.

N-grams are counted exactly, length by length.  One of n words can't reach the least count
unless both its parts of n - 1 words did, so those that did set bits of a filter of at most
``FILTER_BITS`` bits, which is broadcast, and only what passes it is sent to be counted.  A
full filter lets more pass; it never changes a result.

Candidates of 2 to ``max_words`` words have a count of ``least`` or more.  Each is cut in every
way into a first part of count l and a rest of count r; the lowest floor(10^6 a a / (l r)), in
decimals, is its score.  Candidates inside a longer one that has at least ``inside`` percent
of their count are dropped.

Null and empty texts have no words, an empty table no phrases.  Repeated rows count as often
as they occur; ids are not looked at, so null and equal ones change nothing.  A language
named ``und`` and none are one.  Long texts pass in slices, long pieces without a trigger are
cut after ``MAX_CHUNK`` words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitacora.llm.text import mixed, word_hashes
from bitacora.storage import Workspace

MAX_WORDS = 3
LEAST = 10
INSIDE = 50
TOP = 2000
UNKNOWN = "und"

# One in so many places is a trigger; pieces of twice as many words are not parsed.
TRIGGER = 16
MAX_CHUNK = 4096
SLICE = 1 << 18
FILTER_BITS = 1 << 26
# Partial counts a task holds before it passes them on.
HELD = 200_000
# Bytes of chunks whose n-grams are counted together.
BYTES_AT_ONCE = 1 << 23
# Candidates of one language that are ranked together at first.
RANKED = 8192
# Candidates from which their parts are looked up under several salts.
SALTED = 1_000_000

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
_BLANK = re.compile(rb"[ \n]")
_GRAMS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
_BASE = np.uint64(0x9E3779B97F4A7C15)


# --------------------------------------------------------------------------
# Inside tasks
# --------------------------------------------------------------------------


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` word hashes."""
    n = max(0, len(hashes) - size + 1)
    found = np.zeros(n, np.uint64)
    for k in range(size):
        found = found * _BASE + hashes[k : k + n]
    return mixed(found)


def pieces(text: bytes | None, size: int = SLICE) -> Iterator[tuple[list[bytes], bool]]:
    """Words of every piece, and whether it ends there; a long one comes in several goes."""
    data = (text or b"").translate(_TABLE)
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > size:
            gap = _BLANK.search(data, at + size)
            end = gap.end() if gap else end
        parts = data[at:end].split(b"\n")
        # After a line end nothing is left open; the last part of a slice may go on.
        for part in parts[:-1]:
            yield part.split(), True
        if parts[-1]:
            yield parts[-1].split(), end == len(data)
        at = end


def _cuts(words: list[bytes], overlap: int) -> list[int]:
    """Places after the first where a chunk begins: at triggers, and in time."""
    found = gram_hashes(word_hashes(words), overlap)
    places = np.flatnonzero(found % np.uint64(TRIGGER) == 0)
    cuts, last = [], 0
    for place in [*places[places > 0].tolist(), len(words)]:
        while place - last > MAX_CHUNK:
            last += MAX_CHUNK
            cuts.append(last)
        if last < place < len(words):
            cuts.append(place)
            last = place
    return cuts


def chunks(text: bytes | None, max_words: int = MAX_WORDS, size: int = SLICE) -> Iterator[tuple[bytes, int]]:
    """Chunks of a text, words parted by a blank, and how many first words each owns."""
    overlap = max_words - 1
    held: list[bytes] = []
    for words, ends in pieces(text, size):
        if held:
            words = held + words
            held = []
        start = 0
        if len(words) > 2 * TRIGGER:
            for cut in _cuts(words, overlap):
                # What follows may still belong to the overlap.
                if cut + overlap > len(words):
                    break
                yield b" ".join(words[start : cut + overlap]), cut - start
                start = cut
        if not ends:
            held = words[start:]
        elif start < len(words):
            yield b" ".join(words[start:]), len(words) - start
    if held:
        yield b" ".join(held), len(held)


def _parsed(max_words: int):
    """Chunks of a task's texts, with partial frequencies."""
    names = ["lang", "chunk", "owned", "n"]

    def out(whole: dict[str, Counter], cut: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in whole.items():
            counts.pop(b"", None)
            owned = [c.count(b" ") + 1 for c in counts]
            yield batch_of(lang, list(counts), owned, list(counts.values()))
        for lang, counts in cut.items():
            texts, owned = zip(*counts)
            yield batch_of(lang, texts, owned, list(counts.values()))

    def batch_of(lang: str, texts, owned, n) -> pa.RecordBatch:
        columns = [pa.repeat(lang, len(texts)), pa.array(texts, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(owned, pa.int32()), pa.array(n, pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Pieces that are one chunk own all their words; of others that is counted too.
        whole: dict[str, Counter] = {}
        cut: dict[str, Counter] = {}
        for batch in batches:
            langs = batch["lang"].to_pylist()
            for lang, value in zip(langs, batch["text"].cast(pa.binary())):
                text = value.as_py()
                mine = whole.setdefault(lang, Counter())
                if text is not None and len(text) <= SLICE:
                    short, text = _short_pieces(text)
                    mine.update(map(b" ".join, map(bytes.split, short)))
                if text:
                    cut.setdefault(lang, Counter()).update(chunks(text, max_words))
                if sum(map(len, whole.values())) + sum(map(len, cut.values())) >= HELD:
                    yield from out(whole, {k: c for k, c in cut.items() if c})
                    whole, cut = {}, {}
        yield from out(whole, {k: c for k, c in cut.items() if c})

    return run


def _short_pieces(text: bytes) -> tuple[list[bytes], bytes]:
    """Pieces that can't have enough words to be parsed, and a text of the others."""
    parts = text.translate(_TABLE).split(b"\n")
    # A word and the blank before it are two bytes.
    short = [p for p in parts if len(p) < 4 * TRIGGER]
    if len(short) == len(parts):
        return short, b""
    return short, b"\n".join([p for p in parts if len(p) >= 4 * TRIGGER])


class Filter:
    """Which n-grams of one length may be frequent: a bit for each, by hash."""

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.size = bits, size

    @staticmethod
    def places(hashes: np.ndarray, n_bits: int) -> np.ndarray:
        return hashes >> np.uint64(64 - (n_bits.bit_length() - 1))

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = self.places(hashes, len(self.bits) * 64)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _lang_hash(lang: str) -> np.uint64:
    return word_hashes([lang.encode("utf-8", "surrogatepass")])[0]


def _bits(size: int, n_bits: int):
    """64-bit parts of the filter that a task's n-grams set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = [_lang_hash(x) for x in batch["lang"].to_pylist()]
            split = [p.split(b" ") for p in batch["phrase"].cast(pa.binary()).to_pylist()]
            found = np.zeros(len(split), np.uint64)
            for k in range(size):
                found = found * _BASE + word_hashes([w[k] for w in split])
            at = Filter.places(mixed(found) ^ np.array(langs, np.uint64), n_bits)
            part, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            order = np.argsort(part, kind="stable")
            if len(order):
                heads = np.flatnonzero(np.diff(part[order], prepend=-1))
                bits = np.bitwise_or.reduceat(bit[order], heads).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part[order][heads]), pa.array(bits)], ["part", "bits"])

    return run


def _grouped(codes: list[np.ndarray]) -> np.ndarray:
    """Numbers that are equal where all the codes are, exactly."""
    found = codes[0]
    for more in codes[1:]:
        found = np.unique(found * np.int64(int(more.max()) + 1) + more, return_inverse=True)[1]
    return found


def _counted(size: int, known):
    """N-grams of one length in the chunks of a task, with partial counts."""

    def grams(table: pa.Table) -> pa.RecordBatch:
        chunk = table["chunk"].combine_chunks()
        split = pc.split_pattern(chunk, " ")
        sizes = np.diff(split.offsets.to_numpy())
        words = split.flatten()
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        lang = table["lang"].combine_chunks().dictionary_encode()
        lang_of = np.repeat(lang.indices.to_numpy().astype(np.int64), sizes)
        # Of the words of a chunk those that it owns, if the n-gram fits.
        at = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        may = at < np.repeat(np.minimum(table["owned"].to_numpy(), sizes - size + 1), sizes)
        if known is not None:
            each = word_hashes(coded.dictionary.cast(pa.binary()).to_pylist())
            langs = np.array([_lang_hash(x) for x in lang.dictionary.to_pylist()], np.uint64)
            hashes = gram_hashes(each[code], size - 1)
            good = np.zeros(len(code) + 1, bool)
            good[: len(hashes)] = known.value.passes(hashes ^ langs[lang_of[: len(hashes)]])
            may &= good[:-1] & good[1:]
        found = np.flatnonzero(may)
        times = np.repeat(table["n"].to_numpy(), sizes)[found]
        if not len(found):
            return pa.RecordBatch.from_pydict({"lang": [], "phrase": [], "n": []}, _GRAMS)
        key = _grouped([lang_of[found], *(code[found + k] for k in range(size))])
        _, first, group = np.unique(key, return_index=True, return_inverse=True)
        counts = np.zeros(len(first), np.int64)
        np.add.at(counts, group, times)
        found = found[first]
        parts = [words.take(pa.array(found + k)) for k in range(size)]
        phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, " ")
        columns = [lang.dictionary.take(pa.array(lang_of[found])), phrase, pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, schema=_GRAMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        chars = 0
        for batch in batches:
            held.append(batch)
            chars += batch["chunk"].nbytes
            if chars >= BYTES_AT_ONCE:
                yield grams(pa.Table.from_batches(held))
                held, chars = [], 0
        if held:
            yield grams(pa.Table.from_batches(held))

    return run


# --------------------------------------------------------------------------
# On Spark
# --------------------------------------------------------------------------


def dictionary(docs: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """lang, chunk, how many first words it ``owned``, and ``n``, how often it occurs."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    return (
        texts.mapInArrow(_parsed(max_words), "lang string, chunk string, owned int, n bigint")
        .groupBy("lang", "chunk", "owned")
        .agg(F.sum("n").alias("n"))
    )


def frequent_filter(frequent: DataFrame, size: int, rows: int) -> Filter:
    """A filter of n-grams of one length, 16 bits for each as far as it may grow."""
    n_bits = min(FILTER_BITS, max(1 << 10, 1 << (16 * rows).bit_length()))
    parts = frequent.select("lang", "phrase").mapInArrow(_bits(size, n_bits), "part bigint, bits bigint")
    # At most FILTER_BITS / 64 rows, whatever there is to filter.
    found = parts.groupBy("part").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(n_bits // 64, np.uint64)
    bits[found["part"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Filter(bits, size)


def counts(
    docs: DataFrame, ws: Workspace, max_words: int = MAX_WORDS, least: int = LEAST
) -> tuple[list[tuple[DataFrame, int]], DataFrame]:
    """Frequent n-grams by length (lang, phrase, n) and their number; all words (lang, n)."""
    sc = docs.sparkSession.sparkContext
    chunked, _ = ws.stage(dictionary(docs, max_words))
    known = None
    found: list[tuple[DataFrame, int]] = []
    for size in range(1, max_words + 1):
        every = (
            chunked.mapInArrow(_counted(size, known), "lang string, phrase string, n bigint")
            .groupBy("lang", "phrase")
            .agg(F.sum("n").alias("n"))
        )
        frequent, seen = ws.stage(every.where(F.col("n") >= least), rows=F.count(F.lit(1)))
        rows = seen["rows"] or 0
        if known is not None:
            known.unpersist()
        found.append((frequent, rows))
        if size < max_words:
            known = sc.broadcast(frequent_filter(frequent, size, rows))
    words = chunked.groupBy("lang").agg(F.sum(F.col("owned").cast("bigint") * F.col("n")).alias("n"))
    return found, words


def _part(phrase: Column, start: int, end: int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start + 1, end - start), " ")


def _scored(candidates: DataFrame, grams: DataFrame, size: int, salts: int) -> DataFrame:
    """Candidates of one length with the counts and score of their lowest cut."""
    cut = F.explode(
        F.array(
            *[
                F.struct(F.lit(k).alias("k"), _part(F.col("phrase"), 0, k).alias("left"),
                         _part(F.col("phrase"), k, size).alias("right"))
                for k in range(1, size)
            ]
        )
    ).alias("cut")
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), cut).select("lang", "phrase", "a", "cut.*")
    # A common word is part of many candidates: they are dealt under salts, and so is its count.
    cuts = cuts.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    salted = grams.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    for side, name in (("left", "l"), ("right", "r")):
        other = salted.select("lang", F.col("phrase").alias(side), "salt", F.col("n").alias(name))
        cuts = cuts.join(other, ["lang", side, "salt"])
    exact = "decimal(15,0)"
    top = F.col("a").cast(exact) * F.col("a").cast(exact) * F.lit(1_000_000).cast("decimal(7,0)")
    cuts = cuts.withColumn("_top", top.cast("decimal(38,0)")).withColumn(
        "_bottom", (F.col("l").cast(exact) * F.col("r").cast(exact)).cast("decimal(31,0)")
    )
    score = F.expr("_top div _bottom").cast("bigint")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("lowest")
    return cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), lowest).select(
        "lang", "phrase", "a", "lowest.l", "lowest.r", "lowest.score"
    )


def _inside(longer: list[DataFrame], sizes: list[int], size: int) -> DataFrame | None:
    """Phrases of a length that stand in longer candidates, with the highest count of those."""
    found = None
    for grams, n in zip(longer, sizes):
        parts = F.explode(F.array(*[_part(F.col("phrase"), k, k + size) for k in range(n - size + 1)]))
        mine = grams.select("lang", parts.alias("phrase"), F.col("n").alias("longer"))
        found = mine if found is None else found.unionByName(mine)
    return found and found.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))


def collocations(
    docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, inside: int = INSIDE, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases."""
    if max_words < 2:
        raise ValueError("a phrase has two words at least")
    ws = Workspace(docs.sparkSession)
    found, words = counts(docs, ws, max_words, least)
    grams = [frequent for frequent, _ in found]
    every = grams[0]
    for more in grams[1:]:
        every = every.unionByName(more)
    kept = None
    for size in range(2, max_words + 1):
        mine = grams[size - 1]
        scored = _scored(mine, every, size, max(1, min(64, found[size - 1][1] // SALTED)))
        longer = _inside(grams[size:], list(range(size + 1, max_words + 1)), size)
        if longer is not None:
            scored = (
                scored.join(longer, ["lang", "phrase"], "left")
                .where(F.coalesce(100 * F.col("longer") < inside * F.col("a"), F.lit(True)))
                .drop("longer")
            )
        kept = scored if kept is None else kept.unionByName(scored)
    kept, seen = ws.stage(kept, rows=F.count(F.lit(1)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # The first of a language are among the first of its parts.
    parts = max(1, (seen["rows"] or 0) // RANKED)
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    first = Window.partitionBy("lang", "part").orderBy(*order)
    last = Window.partitionBy("lang").orderBy(*order)
    ranked = (
        kept.withColumn("part", part)
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(last).cast("bigint"))
        .where(F.col("rank") <= top)
    )
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
