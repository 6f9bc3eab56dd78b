"""Removal of passages that documents share with earlier ones.

A window is ``WINDOW`` consecutive words, as they are, of one document.  Every word
of a document is removed that is covered by a window whose words also start in a
document with a smaller doc_id, judged on the input, not on what is left.

How: every window gets its Rabin-Karp hash; hashes are dealt by their leading bits
into buckets of at most some ``2 * BUCKET_WINDOWS`` windows, where equal ones are counted and
those of later documents marked.  A document sends one row per bucket, its hashes
packed, and gets back one row per bucket with a mark per hash; it knows the places,
and merges marked windows into maximal intervals.

Windows so common that they would fill a bucket (a quarter of it, or a ``1 / HOT_SHARE`` of
all windows; found on a sample, which only decides the way, not the result) don't travel:
their first document is found by partial minima, and broadcast as long as there are
``HOT_MOST`` of them at most.  Beyond that a filter of ``FILTER_BITS`` bits tells which windows
go the other way; each document sends those once, partial minima find the first documents,
and a join that Spark can split at hot windows brings back what is later.

Hashes have 64 bits (62 where there are only 64 buckets): a window among 10^13 others is
taken for an equal one with a chance of 5e-7.  Texts of one doc_id, or of none, are told
apart by 64 bits as well.  A null text has no words, an empty table no rows.  Documents without an id come after all
others, so nothing is removed for their sake from others or among themselves.  Rows
that agree in doc_id and text are one document given several times and get the same
result.  Columns other than id and text are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitacora.llm.text import given, window_hashes, word_hashes, words
from bitacora.storage import Workspace

WINDOW = 13
BUCKET_WINDOWS = 1 << 21
# Bits of the bucket at least, so that a small table is dealt out too.
LEAST_BITS = 6
HOT_SHARE = 10_000
# Windows from which the search for common ones is worth it, and rows it looks at.
HOT_WINDOWS = 1 << 20
SAMPLE = 64
# Common windows that are broadcast, 16 bytes each; bits of the filter beyond.
HOT_MOST = 1 << 20
FILTER_BITS = 1 << 26

# Bytes of a hash that travel.
_BYTES = 7
# Stands for a missing id: after all others.
_NONE = np.iinfo(np.int64).max


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def text_windows(text: str | None, size: int) -> np.ndarray:
    return window_hashes(word_hashes(text_words(text)), size)


def _packed(hashes: np.ndarray) -> bytes:
    """The lower 56 bits of each hash; the bucket stands for the upper ones."""
    return hashes.view(np.uint8).reshape(-1, 8)[:, :_BYTES].tobytes()


def _unpacked(rows: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, _BYTES)
    whole = np.zeros((len(raw), 8), np.uint8)
    whole[:, :_BYTES] = raw
    return whole.view(np.uint64).ravel()


def _bucket_order(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each hash, and the hashes' order by bucket."""
    buckets = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    return buckets, np.argsort(buckets, kind="stable")


class Hot:
    """Which windows are common: those of a sorted list, or all that a filter lets pass."""

    def __init__(self, known: np.ndarray, bits: np.ndarray | None = None):
        self.known, self.bits = known, bits

    def which(self, hashes: np.ndarray) -> np.ndarray:
        if self.bits is not None:
            at = hashes >> np.uint64(64 - (len(self.bits).bit_length() + 5))
            return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        if not len(self.known):
            return np.zeros(len(hashes), bool)
        return self.known[self.places(hashes)] == hashes

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Places in the list, for those that are in it."""
        return np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)


def _every(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                h, n = np.unique(text_windows(text, size), return_counts=True)
                if len(h):
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    return run


def _firsts(size: int, hot):
    """Smallest id of each hot window, per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hot.value.known
        least = np.full(len(known), _NONE, np.int64)
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                h = text_windows(text, size)
                h = h[hot.value.which(h)]
                if doc_id is not None and len(h):
                    np.minimum.at(least, hot.value.places(h), doc_id)
        seen = least < _NONE
        columns = [pa.array(known[seen].view(np.int64)), pa.array(least[seen])]
        yield pa.RecordBatch.from_arrays(columns, ["h", "first"])

    return run


def _hot_rows(size: int, hot):
    """Per document each of its windows that the filter lets pass, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, digest, text in zip(*(c.to_pylist() for c in batch.columns)):
                h = text_windows(text, size)
                h = np.unique(h[hot.value.which(h)])
                if len(h):
                    columns = [
                        pa.array(h.view(np.int64)), pa.array([doc_id] * len(h), pa.int64()),
                        pa.array([digest] * len(h), pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["h", "doc_id", "digest"])

    return run


def _dealt(size: int, bits: int, hot):
    """Per document and bucket: the packed hashes of its windows that aren't hot."""
    names = ["bucket", "doc_id", "digest", "hashes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for doc_id, digest, text in zip(*(c.to_pylist() for c in batch.columns)):
                h = text_windows(text, size)
                h = h[~hot.value.which(h)]
                buckets, order = _bucket_order(h, bits)
                h, buckets = h[order], buckets[order]
                cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
                rows[0].extend(buckets[cuts].tolist())
                rows[1].extend([doc_id] * len(cuts))
                rows[2].extend([digest] * len(cuts))
                rows[3].extend(_packed(h[x:y]) for x, y in zip(cuts, [*cuts[1:], len(h)]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names)

    return run


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row of a bucket a mark for each hash that an earlier document has too.

    Rows come sorted by bucket; one bucket is held at a time.
    """

    def marks(rows: pa.Table) -> pa.RecordBatch | None:
        packed = rows["hashes"].to_pylist()
        ids = rows["doc_id"].fill_null(_NONE).to_numpy()
        sizes = np.array([len(p) // _BYTES for p in packed])
        h = _unpacked(packed)
        owner = np.repeat(np.arange(len(packed)), sizes)
        order = np.argsort(h, kind="stable")
        sorted_h = h[order]
        heads = np.flatnonzero(np.concatenate([[True], sorted_h[1:] != sorted_h[:-1]]))
        if len(heads) == len(h):
            return None
        ids_of = ids[owner]
        least = np.minimum.reduceat(ids_of[order], heads)
        lengths = np.diff([*heads, len(h)])
        mark = np.zeros(len(h), np.uint8)
        mark[order] = np.repeat(least, lengths) < ids_of[order]
        ends = np.cumsum(sizes)
        hit = np.flatnonzero(np.add.reduceat(mark.astype(np.int64), ends - sizes))
        if not len(hit):
            return None
        # Equal rows have equal marks: they are given once.
        kept = rows.take(pa.array(hit))
        once = dict(zip(zip(kept["doc_id"].to_pylist(), kept["digest"].to_pylist()), hit.tolist()))
        hit = sorted(once.values())
        kept = rows.take(pa.array(hit))
        masks = [np.packbits(mark[ends[r] - sizes[r] : ends[r]]).tobytes() for r in hit]
        columns = [kept["bucket"], kept["doc_id"], kept["digest"], pa.array(masks, pa.binary())]
        return pa.RecordBatch.from_arrays(
            [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns],
            ["bucket", "doc_id", "digest", "marks"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        buckets = batch["bucket"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
        for x, y in zip(edges, edges[1:]):
            if held and held[-1]["bucket"][0].as_py() != int(buckets[x]):
                if done := marks(pa.Table.from_batches(held)):
                    yield done
                held = []
            held.append(batch.slice(x, y - x))
    if held:
        if done := marks(pa.Table.from_batches(held)):
            yield done


def intervals(starts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal intervals that windows of a size cover, from their sorted starts."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > size) + 1
    firsts, lasts = np.r_[starts[:1], starts[cuts]], np.r_[starts[cuts - 1], starts[-1:]]
    return [(int(a), int(b) + size) for a, b in zip(firsts, lasts)]


def _cut(size: int, bits: int, hot, hot_first):
    """Per document its words, what goes, and the text that stays."""

    def gone(doc_id, text, marks, later) -> tuple[list[bytes], list[tuple[int, int]]]:
        ws = text_words(text)
        h = window_hashes(word_hashes(ws), size)
        is_hot = hot.value.which(h)
        own = _NONE if doc_id is None else doc_id
        bad = np.zeros(len(h), bool)
        if hot.value.bits is None:
            bad[is_hot] = hot_first.value[hot.value.places(h[is_hot])] < own
        elif later:
            bad = np.isin(h, np.array(later, np.int64).view(np.uint64))
        if marks:
            cold = np.flatnonzero(~is_hot)
            buckets, order = _bucket_order(h[cold], bits)
            ordered = buckets[order]
            for row in marks:
                x, y = np.searchsorted(ordered, [row["bucket"], row["bucket"] + 1])
                mask = np.unpackbits(np.frombuffer(row["marks"], np.uint8), count=y - x)
                bad[cold[order[x:y]]] = mask.astype(bool)
        return ws, intervals(np.flatnonzero(bad), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for row in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "marks", "later"))):
                doc_id = row[0]
                ws, spans = gone(*row)
                n = len(ws)
                for a, b in reversed(spans):
                    del ws[a:b]
                kept = b" ".join(ws).decode("utf-8", "surrogatepass")
                rows.append((doc_id, n, n - len(ws), kept, [list(s) for s in spans]))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.list_(pa.int64()))]
            names = ["doc_id", "n_words", "n_removed", "kept", "spans"]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _filter(common: DataFrame) -> np.ndarray:
    """64 bits a number: a bit for each window's leading bits, set for common ones."""
    place = F.shiftrightunsigned("h", 64 - (FILTER_BITS.bit_length() - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    parts = common.groupBy(F.shiftright(place, 6).alias("part")).agg(F.bit_or(bit).alias("bits"))
    found = parts.toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[found["part"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bits


def remove_passages(
    docs: DataFrame, size: int = WINDOW, bucket_windows: int = BUCKET_WINDOWS,
    hot_windows: int = HOT_WINDOWS, hot_most: int = HOT_MOST,
) -> DataFrame:
    """doc_id, n_words, n_removed, ``kept`` text and removed ``spans`` of words."""
    spark = docs.sparkSession
    ws = Workspace(spark)
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        # Tells texts with one doc_id apart.
        F.xxhash64(given(F.col("text"))).alias("digest"),
        "text",
    )
    total = docs.select(F.size(words(F.col("text"))).alias("n")).agg(F.sum("n")).first()[0] or 0
    bits = max(LEAST_BITS, (total // bucket_windows).bit_length() - 1)
    found, n_common = None, 0
    if total >= hot_windows:
        sample = docs.where(F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SAMPLE)) == 0)
        counts, seen = ws.stage(
            sample.select("text").mapInArrow(_every(size), "h bigint, n bigint")
            .groupBy("h").agg(F.sum("n").alias("n")),
            n=F.sum("n"),
        )
        # So many copies in the sample stand for a quarter of a bucket.
        limit = max(2, min((seen["n"] or 0) // HOT_SHARE, bucket_windows // (4 * SAMPLE)))
        found = counts.where(F.col("n") > limit).select("h")
        n_common = found.count()
    sc = spark.sparkContext
    first = np.zeros(0, np.int64)
    later = None
    if n_common > hot_most:
        hot = sc.broadcast(Hot(np.zeros(0, np.uint64), _filter(found)))
        common, _ = ws.stage(docs.mapInArrow(_hot_rows(size, hot), "h bigint, doc_id bigint, digest bigint"))
        firsts, _ = ws.stage(common.groupBy("h").agg(F.min("doc_id").alias("first")))
        # Written tables: in their join Spark can split the rows of a window.
        late = F.col("first") < F.coalesce("doc_id", F.lit(int(_NONE)))
        later = (
            common.join(firsts, "h").where(late).groupBy("doc_id", "digest")
            .agg(F.collect_set("h").alias("later"))
        )
    else:
        known = np.zeros(0, np.uint64)
        if n_common:
            known = np.sort(found.toArrow()["h"].to_numpy().view(np.uint64))
        hot = sc.broadcast(Hot(known))
        if n_common:
            rows = (
                docs.select("doc_id", "text")
                .mapInArrow(_firsts(size, hot), "h bigint, first bigint")
                .groupBy("h").agg(F.min("first").alias("first")).toArrow()
            )
            first = np.full(len(known), _NONE, np.int64)
            first[np.searchsorted(known, rows["h"].to_numpy().view(np.uint64))] = rows["first"].to_numpy()
    hot_first = sc.broadcast(first)
    dealt = docs.mapInArrow(
        _dealt(size, bits, hot), "bucket bigint, doc_id bigint, digest bigint, hashes binary"
    )
    # No task gets more than two buckets, however many there are.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << max(0, bits - 1))
    marks = (
        dealt.repartition(tasks, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_marked, "bucket bigint, doc_id bigint, digest bigint, marks binary")
    )
    key = [F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")]
    returned = marks.groupBy("doc_id", "digest").agg(
        F.collect_list(F.struct("bucket", "marks")).alias("marks")
    ).select(*key, "marks")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    rows = docs.join(returned, same, "left").drop("_id", "_digest")
    if later is None:
        rows = rows.withColumn("later", F.lit(None).cast("array<bigint>"))
    else:
        rows = rows.join(later.select(*key, "later"), same, "left")
    return rows.select("doc_id", "text", "marks", "later").mapInArrow(
        _cut(size, bits, hot, hot_first),
        "doc_id bigint, n_words bigint, n_removed bigint, kept string, spans array<array<bigint>>",
    )
