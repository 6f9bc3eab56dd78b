"""Importance resampling of documents towards a target set of texts.

Texts, lower-cased in A-Z, are cut by an untrained Regex Split into words with their
offsets.  Windows of one to ``WINDOW`` offset pairs are the features: words joined by a
blank, repeats counted.  The CRC of a feature's bytes gives its bucket; histograms of all
documents and of all target texts give every bucket a gain, the log of how much more of the
target falls there; a document weighs the mean gain of its features.  Weight plus Gumbel noise
drawn from a hash of its id is its score, and the highest scores are drawn, which is sampling
without replacement in proportion to the weights.

How: one pass over the texts writes the buckets of every document, two bytes a feature;
histogram and gain sums read those.  A histogram has a row per bucket, so it is gathered and
the gains are broadcast whatever the size of the corpus.  Scores are ranked by range
partitioning.  Long texts are cut in slices of ``SLICE`` bytes between words.

A null or empty text has no feature, weight 0 and a score of noise only.  A null id is hashed
as an empty one and comes last among equal scores.  Repeated rows are documents of their
own, with one score.  Without any document nothing is drawn.  A target without words makes
every gain the same function of the documents' own counts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from bitacora.llm.text import text_function
from bitacora.operators.numbering import number_rows
from bitacora.storage import Workspace

BUCKETS = 10_000
WINDOW = 2
SEED = 7
LEAST_WORDS = 20
PERCENT = 25
SLICE = 1 << 16

# Bytes stand for characters here, so that offsets are places in the bytes.
_WORD = "[0-9a-z\x80-\xff]+"
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def splitter() -> pre_tokenizers.PreTokenizer:
    return pre_tokenizers.Split(Regex(_WORD), behavior="removed", invert=True)


def slices(data: bytes, size: int = SLICE) -> Iterator[bytes]:
    """A text in pieces that end between words."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, min(at + size, len(data)))
        end = gap.end() if gap else len(data)
        yield data[at:end]
        at = end


def text_buckets(text: bytes | None, split, window: int = WINDOW, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """How many words a text has, and the bucket of every feature."""
    crc, n, parts = zlib.crc32, 0, []
    before: list[bytes] = []
    for data in slices((text or b"").lower()):
        offsets = [at for _, at in split.pre_tokenize_str(data.decode("latin-1"))]
        words = [data[a:b] for a, b in offsets]
        n += len(words)
        known = len(before)
        words = before + words
        hashes = list(map(crc, words))
        parts.append(np.array(hashes[known:], np.uint32))
        for size in range(2, window + 1):
            # Windows that start in this slice, or in the one before and end here.
            hashes = [crc(w, crc(b" ", h)) for h, w in zip(hashes, words[size - 1 :])]
            parts.append(np.array(hashes[max(0, known - size + 1) :], np.uint32))
        before = words[-(window - 1) :] if window > 1 else []
    found = np.concatenate([np.zeros(0, np.uint32), *parts])
    return n, (found % np.uint32(buckets)).astype(np.uint16)


def _bucketed(window: int, buckets: int):
    """Words and buckets of a text, as a function of the column that alone leaves the JVM."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        split = splitter()
        for texts in batches:
            found = [text_buckets(t, split, window, buckets) for t in texts.cast(pa.binary()).to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array([f.tobytes() for _, f in found], pa.binary())],
                ["n_words", "buckets"],
            )

    return text_function(run, "n_words bigint, buckets binary")


def _counted(buckets: int):
    """The histogram of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch["buckets"].to_pylist():
                counts += np.bincount(np.frombuffer(found, np.uint16), minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])

    return run


def _weighed(gains):
    """Features and weight of packed buckets."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gain = gains.value
        for packed in batches:
            found = [np.frombuffer(f, np.uint16) for f in packed.to_pylist()]
            weights = [int(gain[f].sum()) // len(f) if len(f) else 0 for f in found]
            yield pa.StructArray.from_arrays(
                [pa.array([len(f) for f in found], pa.int64()), pa.array(weights, pa.int64())],
                ["n_features", "weight"],
            )

    return text_function(run, "n_features bigint, weight bigint")


def bucketed(texts: DataFrame, *keep: Column, window: int = WINDOW, buckets: int = BUCKETS) -> DataFrame:
    """``keep``, ``n_words`` and the packed ``buckets`` of every row with a ``text``."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are numbered by two bytes")
    found = _bucketed(window, buckets)(F.col("text").cast("string")).alias("_found")
    return texts.select(*keep, found).select("*", "_found.*").drop("_found")


def histogram(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket."""
    counts = np.zeros(buckets, np.int64)
    found = features.select("buckets").mapInArrow(_counted(buckets), "bucket bigint, n bigint")
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much likelier a bucket is in the target, floored."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    size = float(len(s))
    ratio = (t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, floored, from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    window: int = WINDOW,
    buckets: int = BUCKETS,
    seed: int = SEED,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every document's ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank``.

    ``rank`` counts the drawn ones from 1 and is null for the others.  ``row`` holds
    the columns of ``carry``.
    """
    spark = docs.sparkSession
    ws = Workspace(spark)
    keep = [F.col(f"`{doc_id}`").alias("doc_id")]
    if carry:
        keep.append(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"))
    features, seen = ws.stage(
        bucketed(docs, *keep, window=window, buckets=buckets),
        able=F.sum((F.col("n_words") >= least_words).cast("bigint")),
    )
    aims, _ = ws.stage(bucketed(target, window=window, buckets=buckets))
    gain = spark.sparkContext.broadcast(gains(histogram(features, buckets), histogram(aims, buckets)))
    found = _weighed(gain)(F.col("buckets")).alias("_found")
    kept = [c for c in features.columns if c != "buckets"]
    scored, _ = ws.stage(
        features.select(*kept, found)
        .select(*kept, "_found.*")
        .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    )
    gain.unpersist()
    drawn = (seen["able"] or 0) * percent // 100
    able = F.col("n_words") >= least_words
    order = F.struct(-F.col("score"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("n_features"))
    ranked = number_rows(scored.where(able).withColumn("_order", order), "_order", "rank", ws)
    columns = ["doc_id", "n_features", "weight", "score"]
    row = ["row"] if carry else []
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint").alias("rank")
    rest = scored.where(~able).select(*columns, F.lit(None).cast("bigint").alias("rank"), *row)
    return ranked.select(*columns, rank, *row).unionByName(rest)


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, with all their columns."""
    found = resample(docs, target, carry=tuple(docs.columns), **options).where(F.col("rank").isNotNull())
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
