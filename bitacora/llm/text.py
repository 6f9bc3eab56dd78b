"""Words and lines as Spark expressions, and hashed words for code inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space that parts words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"

_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def given(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Words in order; none for a null text."""
    spaced = F.translate(given(text), BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def has_word(text: Column) -> Column:
    return F.translate(text, BLANKS, "") != ""


def at(array: Column, index: Column) -> Column:
    """The element at a 0-based index, null outside the array."""
    return F.get(array, index)


def row_digest(doc_id: Column, text: Column) -> Column:
    """32 hexadecimal digits that tell rows apart unless they agree in id and text."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.md5(F.concat(name, F.lit(":"), F.md5(given(text))))


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """``docs`` with each row as one struct ``row``: no name can clash with ``more``."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        *[value.alias(name) for name, value in more.items()],
    )


def unpacked(df: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """The rows that ``packed`` packed."""
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in columns], *more)


def text_function(run, schema: str):
    """``run``, which maps Arrow arrays of texts, as a function of a column.

    Only the texts leave the JVM; the other columns of a row wait there.  It runs once a
    row, whatever is asked of its result.
    """
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, schema).asNondeterministic()


# --------------------------------------------------------------------------
# Inside tasks
# --------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of byte strings."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


# Bytes of a text that are cut into words together.
SLICE = 1 << 20
_GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")


def text_hashes(data: bytes, size: int = SLICE) -> np.ndarray:
    """Hashes of the words of a text, which is cut between words if it is long."""
    parts, at = [np.zeros(0, np.uint64)], 0
    while at < len(data):
        gap = _GAP.search(data, at + size) if len(data) - at > size else None
        end = gap.end() if gap else len(data)
        parts.append(word_hashes(data[at:end].split()))
        at = end
    return np.concatenate(parts)


# Windows that are hashed together.
_WINDOWS = 1 << 16


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hashes of all runs of ``size`` word hashes.

    The polynomial hash of every prefix comes from one running sum over inverse
    powers of an odd base; a window is the difference of two prefixes.
    """
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    if n > _WINDOWS:
        # The place of a window is not part of its hash.
        cuts = range(0, n, _WINDOWS)
        return np.concatenate([window_hashes(hashes[k : min(n, k + _WINDOWS) + size - 1], size) for k in cuts])
    up, down = _powers(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * down, out=sums[1:])
    return mixed((sums[size:] - sums[:n]) * up[size - 1 :])


_BASE = 0x9E3779B97F4A7C15
_tables: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the base and of its inverse modulo 2**64."""
    if len(_tables[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _tables[k] = np.cumprod(factors, dtype=np.uint64)
    return _tables[0][:n], _tables[1][:n]
