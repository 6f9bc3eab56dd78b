"""Language identification with string kernels.

The kernel of two texts counts the n-grams of 1 to 3 characters that occur in both,
however often (a blended spectrum of presences), over the root of the product of how
many occur in either.  ``LANDMARKS`` texts per language stand for all (Nyström): a text
is what its kernels with the landmarks say, and one ridge regression per language against
the rest weighs them.  Texts are scored in batches: presences times landmarks, times weights.

Fitting looks at a bounded sample: of the ``LANGUAGES`` languages with the most rows, ``ROWS``
labelled rows each, ``ROWS_IN_ALL`` at most, those with the smallest hashes of id and text; and
only at text and lang.  Landmarks are ``LANDMARKS_IN_ALL`` at most.  So the model, which is built
on the driver and broadcast, doesn't grow with the rows or the languages.  Every whole text is
scored.  N-grams lie within words, which are runs of letters (Unicode categories L), in lower
case with a blank on either side.

A score only ranks the languages against one another: a text like none of them has
kernels of 0 and a score of about a half.  Whether it is like any says its ``likeness``:
the share of its n-grams of 3 characters that at least two landmarks of a language have,
over the median of that share among the rows fitted for the language; the largest counts.

A text that is null or has no letter is ``und`` with score and likeness 0, as is every text where
there was nothing to learn from.  Rows without an id are scored but not learned from.
Each row is judged alone, so repeated rows get the same result; equal rows are learned from as
often as they are among the sample.  An empty table has no result and teaches nothing.  Columns
of any name pass in ``row``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitacora.llm.text import packed, text_function
from bitacora.storage import Workspace

ROWS, LANDMARKS = 256, 16
LANGUAGES, ROWS_IN_ALL, LANDMARKS_IN_ALL = 256, 8192, 256
# Landmarks are sought among texts of at least so many characters.
LANDMARK_CHARS = 400
RIDGE = 0.1
BATCH = 64
UNKNOWN = "und"

# Letters with numerals of other kinds than digits, which are taken out where there are any.
_WORD = re.compile(r"[^\W\d_]+")
# N-grams of 3 characters come after all shorter ones.
_THREE = 1 << 42


def presences(text: str | None) -> np.ndarray:
    """The n-grams of a text as sorted integers, each once; 21 bits a character."""
    found = set(_WORD.findall((text or "").lower()))
    words = {w for w in found if w.isalpha()}
    for mixed in found - words:
        words.update("".join(c if c.isalpha() else " " for c in mixed).split())
    if not words:
        return np.zeros(0, np.int64)
    spaced = " " + "  ".join(sorted(words)) + " "
    c = np.frombuffer(spaced.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    two = (c[:-1] << 21) | c[1:]
    blank = c == 32
    # Not across words: two blanks stand between any two.
    apart = blank[:-1] & blank[1:]
    three = (two[:-1] << 21) | c[2:]
    return np.unique(np.concatenate([c[~blank], two[~apart], three[~(apart[:-1] | apart[1:])]]))


@dataclass
class Landmarks:
    grams: np.ndarray  # all n-grams of the landmarks, sorted
    matrix: np.ndarray  # n-grams by landmarks: presence over the root of their number
    known: np.ndarray  # n-grams of 3 characters, the last in order, by languages: 1 or 0

    @classmethod
    def of(cls, sets: list[np.ndarray], langs: list[str]) -> Landmarks:
        grams = np.unique(np.concatenate([np.zeros(0, np.int64), *sets]))
        matrix = np.zeros((len(grams), len(sets)), np.float32)
        for k, s in enumerate(sets):
            matrix[np.searchsorted(grams, s), k] = len(s) ** -0.5
        three = matrix[np.searchsorted(grams, _THREE) :] > 0
        known = []
        for lang in sorted(set(langs)):
            n = three[:, [x == lang for x in langs]].sum(1)
            # A single landmark, or such as have nothing in common, count alone.
            known.append(n >= (2 if (n > 1).any() else 1))
        shape = (len(three), len(known))
        return cls(grams, matrix, np.array(known, np.float32).T.reshape(shape))

    def kernels(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Kernels of a batch of texts with every landmark, as one matrix product, and
        by language the share of their n-grams of 3 characters that is known."""
        x = np.zeros((len(sets), len(self.grams)), np.float32)
        for row, s in zip(x, sets):
            at = np.searchsorted(self.grams, s)
            at = at[at < len(self.grams)]
            row[at[self.grams[at] == s[: len(at)]]] = max(1, len(s)) ** -0.5
        n = np.array([[len(s), len(s) - np.searchsorted(s, _THREE)] for s in sets]).reshape(-1, 2)
        hits = x[:, len(self.grams) - len(self.known) :] @ self.known
        return x @ self.matrix, hits * (np.sqrt(n[:, :1]) / np.maximum(1, n[:, 1:])).astype(np.float32)


@dataclass
class Model:
    landmarks: Landmarks | None
    weights: np.ndarray  # landmarks by languages
    languages: list[str]
    typical: np.ndarray  # by language: the median share of known n-grams

    def predict(self, texts: pa.Array) -> list[tuple[str, float, float]]:
        """(language, score from 0 to 1, likeness) of each text."""
        out: list[tuple[str, float, float]] = []
        for k in range(0, len(texts), BATCH):
            sets = [presences(t) for t in texts[k : k + BATCH].to_pylist()]
            if not self.languages:
                out += [(UNKNOWN, 0.0, 0.0)] * len(sets)
                continue
            kernels, shares = self.landmarks.kernels(sets)
            scores = kernels @ self.weights
            best = scores.argmax(1)
            likeness = (shares / self.typical).max(1)
            for s, row, b, like in zip(sets, scores, best.tolist(), likeness.tolist()):
                score = min(1.0, max(0.0, (float(row[b]) + 1) / 2))
                out.append((self.languages[b], score, like) if len(s) else (UNKNOWN, 0.0, 0.0))
        return out


def remainder(doc_id: Column, of: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id, 4) == 2, F.lit(False))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [presences(t).tobytes() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(found, pa.binary())], ["lang", "v"])


def _kernels(landmarks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH):
                part = batch.slice(k, BATCH)
                sets = [presences(t) for t in part["text"].to_pylist()]
                v, shares = ([row.tobytes() for row in m] for m in landmarks.value.kernels(sets))
                yield pa.RecordBatch.from_arrays(
                    [part["lang"], pa.array(v, pa.binary()), pa.array(shares, pa.binary())], ["lang", "v", "shares"]
                )

    return run


def fit(
    docs: DataFrame, rows: int = ROWS, landmarks: int = LANDMARKS, ws: Workspace | None = None
) -> Model:
    """Learns from the rows that aren't held out and have a language and a letter."""
    sc = docs.sparkSession.sparkContext
    # Of equal ids each text has a hash of its own, so no language hangs on one hash.
    share = F.xxhash64("doc_id", "text").alias("share")
    learned = docs.where(
        F.col("lang").isNotNull() & (remainder(F.col("doc_id"), 4) != 2) & F.col("text").rlike(r"\p{L}")
    ).select("doc_id", "lang", "text", share)
    ws = ws or Workspace(docs.sparkSession)
    hashes, _ = ws.stage(learned.select("lang", "share"))
    common = hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    common, seen = ws.stage(common, languages=F.count(F.lit(1)))
    found_languages = max(1, seen["languages"] or 0)
    rows = max(2, min(rows, ROWS_IN_ALL // found_languages))
    landmarks = max(1, min(landmarks, LANDMARKS_IN_ALL // found_languages))
    # The hash that the last wanted row has: with it the texts are thinned out before any is
    # moved.  No more than LANGUAGES rows are broadcast.
    least = Window.partitionBy("lang").orderBy("share")
    limits, _ = ws.stage(
        hashes.join(F.broadcast(common.select("lang")), "lang")
        .withColumn("at", F.row_number().over(least))
        .where(F.col("at") <= rows)
        .groupBy("lang").agg(F.max("share").alias("limit"))
    )
    order = Window.partitionBy("lang").orderBy("share", "doc_id")
    sample, _ = ws.stage(
        learned.join(F.broadcast(limits), "lang")
        .where(F.col("share") <= F.col("limit"))
        .withColumn("at", F.row_number().over(order))
        .where(F.col("at") <= rows)
        .select("lang", "text", "at")
    )
    first = Window.partitionBy("lang").orderBy(F.length("text") < LANDMARK_CHARS, "at")
    marks = (
        sample.withColumn("k", F.row_number().over(first)).where(F.col("k") <= landmarks)
        .select("lang", "text").mapInArrow(_grams, "lang string, v binary").collect()
    )
    languages = sorted({r.lang for r in marks})
    if not languages:
        return Model(None, np.zeros((0, 0)), [], np.zeros(0))
    found = Landmarks.of([np.frombuffer(bytes(r.v), np.int64) for r in marks], [r.lang for r in marks])
    shared = sc.broadcast(found)
    fitted = (
        sample.select("lang", "text")
        .mapInArrow(_kernels(shared), "lang string, v binary, shares binary").collect()
    )
    shared.destroy()
    k = np.stack([np.frombuffer(bytes(r.v), np.float32) for r in fitted]).astype(np.float64)
    y = np.where(np.array([[r.lang == lang for lang in languages] for r in fitted]), 1.0, -1.0)
    # Every language weighs the same, however many rows it has.
    each = np.array([[r.lang == lang for lang in languages] for r in fitted]).sum(0)
    weight = np.array([len(fitted) / each[languages.index(r.lang)] / len(languages) for r in fitted])
    among = (found.matrix > 0).astype(np.float32)
    size = among.sum(0)
    own = (among.T @ among).astype(np.float64) / np.sqrt(size[:, None] * size[None, :])
    values, vectors = np.linalg.eigh(own)
    root = vectors @ np.diag(np.maximum(values, 1e-6) ** -0.5) @ vectors.T
    phi = k @ root
    gram = phi.T @ (phi * weight[:, None]) + RIDGE * np.eye(len(root))
    weights = root @ np.linalg.solve(gram, phi.T @ (y * weight[:, None]))
    shares = np.stack([np.frombuffer(bytes(r.shares), np.float32) for r in fitted])
    typical = np.array(
        [np.median(shares[[r.lang == lang for r in fitted], at]) for at, lang in enumerate(languages)]
    )
    return Model(found, weights.astype(np.float32), languages, np.where(typical > 0, typical, 1.0))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` with the document, ``lang_pred``, ``score`` and ``likeness``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = shared.value.predict(texts)
            columns = [
                pa.array([lang for lang, _, _ in found], pa.string()),
                pa.array([score for _, score, _ in found], pa.float64()),
                pa.array([like for _, _, like in found], pa.float64()),
            ]
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score", "likeness"])

    predicted = text_function(run, "lang_pred string, score double, likeness double")
    df = packed(docs, text=F.col("text"))
    return df.select("row", predicted("text").alias("found")).select("row", "found.*")
