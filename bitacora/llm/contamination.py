"""Benchmark contamination by winnowing.

Words are runs of letters and digits in lower case (A-Z only; all but ASCII counts as
letters).  A window is ``SPAN`` consecutive words of an item; an item of fewer words is
one window as a whole.  A document word inside an occurrence of a window is hit.

Of every ``SPAN - GRAM + 1`` consecutive grams of ``GRAM`` words the one with the smallest
hash is a fingerprint.  Whatever the document and the item share over ``SPAN`` words holds
such a run of grams, so both have its fingerprint: each shared fingerprint is extended to
the left and right to the windows around it, and those that are windows of an item count.
Each distinct window is looked up once, so texts that repeat a word or a passage cost no more.
Items shorter than ``SPAN`` have grams and runs that fit their own length.

Items are dealt into blocks of at most some ``BLOCK_WORDS`` words, by a hash, of which one is
built and broadcast at a time.  A benchmark of one block, the common case, takes one pass in
which documents are never moved, so neither common passages nor hot items meet anywhere.
With more, each pass writes what it found and the last gathers it per document.

Null and empty texts have no words, an empty benchmark hits nothing.  Items without an id hit
words but are no item of the list; rows that share an item_id are one item.  Repeated rows of
documents are judged alone and get the same result, whether or not they share an id.  Columns
of any name pass in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.llm.text import packed, text_function, text_hashes, window_hashes
from bitacora.storage import Workspace

SPAN, GRAM = 13, 7
BLOCK_WORDS = 2_000_000

_KEPT = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def hashed(text: str | None) -> np.ndarray:
    """Hashes of the words of a text."""
    return text_hashes((text or "").encode("utf-8", "surrogatepass").translate(_KEPT))


def winnowed(hashes: np.ndarray, gram: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a text and their places: the smallest of every run of grams."""
    grams = window_hashes(hashes, gram)
    run = span - gram + 1
    if len(grams) < run:
        return np.zeros(0, np.intp), np.zeros(0, np.uint64)
    views = np.lib.stride_tricks.sliding_window_view(grams, run)
    places = np.unique(views.argmin(1) + np.arange(len(views)))
    return places, grams[places]


@dataclass
class Index:
    """Items whose windows are ``span`` words long: their fingerprints, and windows with items."""

    span: int
    gram: int
    fingerprints: np.ndarray  # sorted, each once
    windows: np.ndarray  # sorted, each once
    ends: np.ndarray  # per window the end of its items, after a leading 0
    items: np.ndarray  # by window
    names: list[str | None]

    @classmethod
    def of(cls, span: int, gram: int, items: list[tuple[str | None, np.ndarray]]) -> Index:
        fingerprints = np.unique(np.concatenate([winnowed(h, gram, span)[1] for _, h in items]))
        found = [np.unique(window_hashes(h, span)) for _, h in items]
        windows = np.concatenate(found)
        owners = np.repeat(np.arange(len(items)), [len(f) for f in found])
        order = np.argsort(windows, kind="stable")
        distinct, starts = np.unique(windows[order], return_index=True)
        ends = np.append(starts, len(windows))
        return cls(span, gram, fingerprints, distinct, ends, owners[order], [name for name, _ in items])

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, set[str]]:
        """Starts of the windows of a text that are windows of items, and names of these."""
        at, prints = winnowed(words, self.gram, self.span)
        at = at[_known(prints, self.fingerprints)[0]]
        if not len(at):
            return at, set()
        windows = window_hashes(words, self.span)
        # Every window around a shared fingerprint.
        starts = np.unique(at[:, None] - np.arange(self.span - self.gram + 1)[None, :])
        starts = starts[(starts >= 0) & (starts < len(windows))]
        same, _ = _known(windows[starts], self.windows)
        starts = starts[same]
        _, places = _known(np.unique(windows[starts]), self.windows)
        mine = [self.items[self.ends[k] : self.ends[k + 1]] for k in places.tolist()]
        found = np.unique(np.concatenate(mine)).tolist() if mine else []
        return starts, {self.names[k] for k in found if self.names[k] is not None}


def _known(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are among the sorted ones, and the places of those."""
    places = np.searchsorted(among, values)
    inside = places < len(among)
    inside[inside] = among[places[inside]] == values[inside]
    return inside, places[inside]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, texts = (c.to_pylist() for c in batch.columns)
        rows = [(n, h.view(np.int64)) for n, h in zip(names, map(hashed, texts)) if len(h)]
        columns = [
            pa.array([n for n, _ in rows], pa.string()),
            pa.array([len(h) for _, h in rows], pa.int64()),
            pa.array([h.tobytes() for _, h in rows], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["name", "n", "words"])


def index_blocks(
    items: DataFrame, ws: Workspace, span: int = SPAN, gram: int = GRAM, block_words: int = BLOCK_WORDS
) -> Iterator[list[Index]]:
    """The indices of each block of items, one block at a time."""
    hashed_items = items.select(F.col("item_id").cast("string").alias("name"), "text").mapInArrow(
        _item_words, "name string, n bigint, words binary"
    ).distinct()
    hashed_items, seen = ws.stage(hashed_items, total=F.sum("n"))
    total = seen["total"] or 0
    blocks = 1 if total <= block_words else 2 * -(-total // block_words)
    for k in range(blocks):
        mine = hashed_items.where(F.pmod(F.xxhash64("name", "words"), F.lit(blocks)) == k)
        by_span: dict[int, list] = {}
        for r in mine.select("name", "words").toLocalIterator():
            h = np.frombuffer(bytes(r.words), np.uint64)
            by_span.setdefault(min(span, len(h)), []).append((r.name, h))
        # A short item has grams of about half its length.
        yield [Index.of(n, gram if n == span else (n + 1) // 2, of) for n, of in sorted(by_span.items())]


def covered(starts: list[tuple[np.ndarray, int]]) -> list[list[int]]:
    """Spans that windows of several lengths cover, given their starts: apart and in order."""
    found = [np.stack([s, s + n], 1) for s, n in starts if len(s)]
    if not found:
        return []
    spans = np.concatenate(found)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    cuts = np.flatnonzero(spans[1:, 0] > reach[:-1]) + 1
    firsts, lasts = spans[np.r_[0, cuts], 0], reach[np.r_[cuts - 1, len(spans) - 1]]
    return np.stack([firsts, lasts], 1).tolist()


_FOUND = "n_words bigint, spans array<array<bigint>>, items array<string>"


def _searched(index):
    """Words of a text, spans that are hit and names of the items of one block."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            counts, spans, items = [], [], []
            for text in texts:
                words = hashed(text.as_py())
                hits = [(*one.hits(words), one.span) for one in index.value]
                counts.append(len(words))
                spans.append(covered([(starts, span) for starts, _, span in hits]))
                items.append(sorted(set().union(*(names for _, names, _ in hits))))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["n_words", "spans", "items"],
            )

    return text_function(run, _FOUND)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """Something is hit, and at least a twentieth of the words."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def _merged(spans: Column) -> Column:
    """Spans of several blocks, apart and in order."""

    def add(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.array(F.get(last, 0), F.greatest(F.get(last, 1), span[1]))))
        return F.when(F.get(last, 1) >= span[0], joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<array<bigint>>"), add)


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    span: int = SPAN,
    gram: int = GRAM,
    block_words: int = BLOCK_WORDS,
    ws: Workspace | None = None,
) -> DataFrame:
    """``row`` with the document, n_words, n_hit, hit ``spans`` of words and ``items``."""
    spark = docs.sparkSession
    ws = ws or Workspace(spark)
    df = packed(docs, text=F.col("text"))
    blocks = index_blocks(items, ws, span, gram, block_words)
    first = next(blocks)
    found = df.select("row", _searched(spark.sparkContext.broadcast(first))("text").alias("found"))
    for k, block in enumerate(blocks):
        # A row is told by its place in a written table.
        if k == 0:
            found, _ = ws.stage(found.withColumn("seq", F.monotonically_increasing_id()))
            rows = found.select("row", "seq")
            parts = found.select("seq", "found")
        shared = spark.sparkContext.broadcast(block)
        search = _searched(shared)(F.col("row").getField("text")).alias("found")
        more, _ = ws.stage(rows.select("seq", search).where(F.size("found.spans") > 0))
        shared.unpersist()
        parts = parts.unionByName(more)
    if len(found.columns) == 3:
        together = parts.groupBy("seq").agg(
            F.struct(
                F.max("found.n_words").alias("n_words"),
                _merged(F.flatten(F.collect_list("found.spans"))).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("found.items")))).alias("items"),
            ).alias("found")
        )
        found = rows.join(together, "seq").select("row", "found")
    hit = F.aggregate(
        F.transform("spans", lambda s: s[1] - s[0]), F.lit(0).cast("bigint"), lambda a, n: a + n
    )
    df = found.select("row", "found.*").select("row", "n_words", hit.alias("n_hit"), "spans", "items")
    return df.withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))
