"""Quality scores from a generalised additive model with pairwise interactions.

A text becomes some twenty measurements of its words, lines and characters, each cut
into bins.  Boosting goes through the measurements in turn, again and again: a shallow
tree on one of them adds a little to its lookup table.  What is left is fitted by tables
over the pairs that promise most.  A score is the sum of one value per table.

Fitting looks at a bounded sample of ``ROWS`` labelled rows, chosen by a hash of their
ids, and learns from their texts only.  Every whole text is scored.  Null and empty texts
are measured like others (nothing of anything).  Without labels the score is 0.5.  Rows
without an id are scored but not learned from; labels without a value are passed over.
Each row is judged alone, so repeated rows get the same result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitacora.llm.language import remainder
from bitacora.llm.passages import intervals
from bitacora.llm.text import packed, text_function, window_hashes, word_hashes

ROWS = 20_000
BINS, PAIR_BINS = 48, 12
TURNS, RATE, PAIRS, PAIR_TURNS = 120, 0.1, 10, 60
RIDGE = 1.0

SYMBOLS = "#*$%&|<>"


def measurements(text: str | None) -> list[float]:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = max(1, len(words))
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    m = max(1, len(chars))
    lower = (chars >= 97) & (chars <= 122) | (chars >= 223)
    upper = (chars >= 65) & (chars <= 90) | (chars >= 192) & (chars < 223)
    digits = (chars >= 48) & (chars <= 57)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    hashes = word_hashes(words)
    _, counts = np.unique(hashes, return_counts=True)
    runs = window_hashes(hashes, 5)
    _, back, times = np.unique(runs, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(times[back] > 1) if len(runs) else np.zeros(0, int)
    repeated = sum(b - a for a, b in intervals(twice, 5))
    lines = [x for x in text.split("\n") if x.strip()]
    stops = text.count(".") + text.count("!") + text.count("?")
    letters = int(lower.sum() + upper.sum())
    return [
        np.log1p(len(words)),
        lengths.mean(),
        lengths.std(),
        lengths.max(),
        (lengths <= 3).sum() / n,
        letters / m,
        digits.sum() / m,
        upper.sum() / max(1, letters),
        (chars > 127).sum() / m,
        sum(map(text.count, SYMBOLS)) / n,
        text.count("|") / n,
        text.count("!") / n,
        text.count(",") / n,
        stops / n,
        len(words) / max(1, stops),
        len(counts) / n,
        counts.max() / n if len(counts) else 0.0,
        repeated / n,
        len(words) / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(x.rstrip()[-1:] in ".!?:;" for x in lines) / max(1, len(lines)),
        sum(w.isdigit() for w in words) / n,
    ]


N_MEASUREMENTS = len(measurements(""))


def _leaves(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Values per bin of a tree that cuts the bins where sums of gradients differ most."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    whole = cg[-1] / (ch[-1] + RIDGE)
    if depth == 0 or len(g) < 2:
        return np.full(len(g), whole)
    left, right = cg[:-1] ** 2 / (ch[:-1] + RIDGE), (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + RIDGE)
    gain = left + right - cg[-1] ** 2 / (ch[-1] + RIDGE)
    cut = int(gain.argmax()) + 1
    if gain[cut - 1] <= 1e-9:
        return np.full(len(g), whole)
    return np.concatenate([_leaves(g[:cut], h[:cut], depth - 1), _leaves(g[cut:], h[cut:], depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a table into four quadrants: its gain and the values."""

    def corners(x: np.ndarray) -> list[np.ndarray]:
        c = x.cumsum(0).cumsum(1)
        a, top, side, all_ = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [a, top - a, side - a, all_ - top - side + a]

    gs, hs = corners(g), corners(h)
    gain = sum(x**2 / (y + RIDGE) for x, y in zip(gs, hs))
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    values = [x[i, j] / (y[i, j] + RIDGE) for x, y in zip(gs, hs)]
    table = np.empty_like(g)
    table[: i + 1, : j + 1], table[: i + 1, j + 1 :] = values[0], values[1]
    table[i + 1 :, : j + 1], table[i + 1 :, j + 1 :] = values[2], values[3]
    return float(gain[i, j] - g.sum() ** 2 / (h.sum() + RIDGE)), table


@dataclass
class Model:
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def binned(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        fine = [np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)]
        return fine, [np.searchsorted(e, c, "right") for e, c in zip(self.pair_edges, x.T)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The sum of what the tables say, as a share."""
        fine, coarse = self.binned(x)
        total = np.full(len(x), self.base)
        for table, bins in zip(self.tables, fine):
            total += table[bins]
        for (i, j), table in self.pairs.items():
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of one table per measurement, then of tables over pairs."""
    model = Model()
    if not len(y):
        return model
    share = (y.sum() + 0.5) / (len(y) + 1)
    model.base = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return model
    model.edges = [_edges(c, BINS) for c in x.T]
    model.pair_edges = [_edges(c, PAIR_BINS) for c in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine, coarse = model.binned(x)
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(TURNS):
        for table, bins in zip(model.tables, fine):
            g, h = slopes()
            n = len(table)
            step = RATE * _leaves(np.bincount(bins, g, n), np.bincount(bins, h, n), 2)
            table += step
            total += step[bins]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def sums(i: int, j: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, shape = coarse[i] * sizes[j] + coarse[j], (sizes[i], sizes[j])
        n = sizes[i] * sizes[j]
        return np.bincount(at, g, n).reshape(shape), np.bincount(at, h, n).reshape(shape)

    g, h = slopes()
    able = [k for k in range(x.shape[1]) if sizes[k] > 1]
    ranked = sorted(
        itertools.combinations(able, 2), key=lambda ij: -_quadrants(*sums(*ij, g, h))[0]
    )
    model.pairs = {ij: np.zeros((sizes[ij[0]], sizes[ij[1]])) for ij in ranked[:PAIRS]}
    for _ in range(PAIR_TURNS):
        for (i, j), table in model.pairs.items():
            step = RATE * _quadrants(*sums(i, j, *slopes()))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id, 3) == 1, F.lit(False))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.array(measurements(t)).tobytes() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["quality"], pa.array(rows, pa.binary())], ["quality", "x"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    """Learns from labelled rows that aren't held out."""
    usable = labels.where(F.col("quality").isin(0, 1) & (remainder(F.col("doc_id"), 3) != 1)).select(
        "doc_id", F.col("quality").cast("int").alias("quality")
    )
    # Ids in the order of a hash; the sort keeps no more than the sample anywhere.
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    # As many rows as the sample at most: it can be broadcast.  An id may have any number of
    # texts: the sample is taken again of what was found, by a hash of both.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.orderBy(F.xxhash64("doc_id", "text"), "doc_id", "quality").limit(rows)
    found = texts.select("quality", "text").mapInArrow(_measured, "quality int, x binary").collect()
    found.sort(key=lambda r: (bytes(r.x), r.quality))
    x = np.array([np.frombuffer(bytes(r.x)) for r in found]).reshape(-1, N_MEASUREMENTS)
    return train(x, np.array([r.quality for r in found], float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` with the document and its ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x = np.array([measurements(t.as_py()) for t in texts])
            yield pa.array(shared.value.scores(x.reshape(-1, N_MEASUREMENTS)))

    df = packed(docs, text=F.col("text"))
    return df.select("row", text_function(run, "double")("text").alias("score"))
