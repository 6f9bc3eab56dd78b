"""Near-duplicate documents by fast similarity sketches, banding and exact checks.

A document's set holds its distinct shingles of ``SHINGLE`` words in lower case (A-Z
only); a shorter text is one shingle as a whole; a text without words, or none, has
an empty set and is linked with nothing.  Documents whose sets share at least
``PERCENT`` per cent of their union are linked, and groups are what links connect.

How links are found:

1. Sketch.  Round after round drops every element into one of ``COORDINATES`` bins;
   a bin keeps its smallest value of the first round that reached it.  Rounds past
   ``COORDINATES`` fill the bins one by one, so after twice as many none is empty.
2. Classes.  Equal sets become one class; all that follows works on classes, so a
   large group of copies is one row.
3. Bands of ``ROWS`` coordinates each give buckets.  At the least similarity a link
   is missed by all bands with a chance of (1 - 0.8^4)^32 = 5e-8.
4. Stars.  Each class is checked against the first class of its buckets that it shares
   most bands with, on full sets: linear in a bucket, whatever its size.
5. Rest.  Buckets that links do not yet hold together are cut into blocks, and every
   two blocks meet in a task, full sets included.  Classes of different groups are
   compared there by sketch, and those that may be linked on full sets; what comes out
   are the links that join groups, at most one per class.  Pairs inside one group need
   no check as they change nothing.

Every row is a node of its own, also where rows share a doc_id.  Rows without an id
are linked like others; a group of such rows only has no component id.  Null and empty texts
are linked with nothing, an empty table gives no row.  Only id and text are looked at:
``near_duplicates`` returns columns of its own, ``representatives`` those of its input,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitacora.llm.components import components
from bitacora.llm.text import given, mixed, packed, unpacked, window_hashes, word_hashes
from bitacora.storage import Workspace

SHINGLE, PERCENT = 4, 80
COORDINATES, ROWS = 128, 4
BANDS = COORDINATES // ROWS
# Sketches of linked sets agree in 80 % of the coordinates, give or take 3.5; below
# this share, five times that away, two classes are not compared on full sets.
LEAST_AGREEING = 0.62
# Classes of a bucket in one block, and shingles of these, whatever is reached first.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
# Ids of documents to check on full sets that are broadcast; more are shuffled.
BROADCAST_IDS = 200_000

_LOW = np.uint64((1 << 48) - 1)
_SEEDS = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit shingle hashes of a text, sorted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    # A short text is one window; its length goes into the hash.
    size = min(size, len(words))
    return np.unique(window_hashes(word_hashes(words), size) ^ _SEEDS[size])


_EMPTY = np.uint64((1 << 64) - 1)


def _thrown(elements: np.ndarray, first: int, last: int, bins: np.ndarray) -> None:
    """Rounds ``first`` to ``last`` - 1, each dropping all elements into the bins."""
    turns = np.arange(first, last, dtype=np.uint64)
    h = mixed(elements[None, :] ^ _SEEDS[first:last, None])
    values = (h & _LOW) | (turns << np.uint64(48))[:, None]
    np.minimum.at(bins, (h >> np.uint64(57)).astype(np.intp).ravel(), values.ravel())


def sketch(elements: np.ndarray) -> np.ndarray:
    """COORDINATES values of which two sets share about as many as their similarity says."""
    t = COORDINATES
    bins = np.full(t, _EMPTY, np.uint64)
    turn = 0
    while turn < t and (bins == _EMPTY).any():
        # Few elements need many rounds; more at once change nothing.
        ahead = min(t, turn + max(1, 1024 // len(elements)))
        _thrown(elements, turn, ahead, bins)
        turn = ahead
    for k in np.flatnonzero(bins == _EMPTY):
        h = mixed(elements ^ _SEEDS[t + k])
        bins[k] = ((h & _LOW) | np.uint64((t + int(k)) << 48)).min()
    return bins


def bands(bins: np.ndarray) -> np.ndarray:
    """The sketch as one integer per band: the lowest 16 bits of its coordinates."""
    return bins.astype(np.uint16).view(np.int64)


_SKETCHED = (
    "doc_id bigint, digest bigint, n_shingles bigint, set1 bigint, set2 bigint, bands array<bigint>"
)
_SETS = "doc_id bigint, set1 bigint, set2 bigint, elements array<bigint>"


def _digest(elements: np.ndarray) -> list[int]:
    """128 bits that stand for a set."""
    sums = [mixed(elements).sum(), mixed(elements ^ _SEEDS[0]).sum()]
    return np.array(sums, np.uint64).view(np.int64).tolist()


def _sketched(size: int):
    def row(doc_id, digest, text) -> tuple:
        s = shingles(text, size)
        if not len(s):
            return doc_id, digest, 0, 0, 0, []
        return doc_id, digest, len(s), *_digest(s), bands(sketch(s)).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())]
        names = ["doc_id", "digest", "n_shingles", "set1", "set2", "bands"]
        for batch in batches:
            rows = [row(*given) for given in zip(*(c.to_pylist() for c in batch.columns))]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            sets = [shingles(t, size) for t in texts]
            digests = [_digest(s) for s in sets]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            columns = [
                pa.array(ids, pa.int64()),
                pa.array([d[0] for d in digests], pa.int64()),
                pa.array([d[1] for d in digests], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "set1", "set2", "elements"])

    return run


def _alike(group: pa.Table) -> list[tuple[int, int]]:
    """Links that join groups, between two blocks of one bucket, on full sets.

    Only pairs of different groups whose sketches agree enough are looked at, each in
    the first bucket that both share, the likeliest first; pairs that links found
    here hold together already are passed over.
    """
    ids, groups, sizes, block, i, j = (
        group[c].to_numpy() for c in ("id", "component", "n_shingles", "block", "i", "j")
    )
    if groups.min() == groups.max():
        return []
    banded = group["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    sketches = banded.view(np.uint16)
    here = group["band"][0].as_py()
    right = np.flatnonzero(block == j[0])
    pairs: list[np.ndarray] = []
    for a in np.flatnonzero(block == i[0]):
        b = right[groups[right] != groups[a]]
        if i[0] == j[0]:
            b = b[ids[b] > ids[a]]
        small, large = np.minimum(sizes[b], sizes[a]), np.maximum(sizes[b], sizes[a])
        b = b[100 * small >= PERCENT * large]
        b = b[(banded[b] == banded[a]).argmax(1) == here]
        agreeing = (sketches[b] == sketches[a]).sum(1)
        good = agreeing >= LEAST_AGREEING * COORDINATES
        pairs.append(np.stack([agreeing[good], np.full(good.sum(), a), b[good]], 1))
    found = np.concatenate(pairs)
    sets: dict[int, np.ndarray] = {}
    parent = {int(g): int(g) for g in np.unique(groups)}

    def root(g: int) -> int:
        while parent[g] != g:
            parent[g] = g = parent[parent[g]]
        return g

    def elements(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = group["elements"][k].values.to_numpy()
        return sets[k]

    links = []
    for _, a, b in found[np.argsort(-found[:, 0], kind="stable")].tolist():
        x, y = root(int(groups[a])), root(int(groups[b]))
        if x == y:
            continue
        common = len(np.intersect1d(elements(a), elements(b), assume_unique=True))
        if 100 * common >= PERCENT * (int(sizes[a]) + int(sizes[b]) - common):
            parent[max(x, y)] = min(x, y)
            links.append((int(ids[a]), int(ids[b])))
    return links


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_alike`` of each run of rows with one (bucket, i, j); one run is held at a time."""
    held: list[pa.RecordBatch] = []

    def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = _alike(pa.Table.from_batches(rows))
        columns = [pa.array([pair[k] for pair in found], pa.int64()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    before = None
    for batch in batches:
        key = np.stack([batch[c].to_numpy() for c in ("bucket", "i", "j")])
        edges = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1).tolist()]
        for x, y in zip(edges, [*edges[1:], batch.num_rows]):
            now = key[:, x].tolist()
            if held and now != before:
                yield links(held)
                held = []
            before = now
            held.append(batch.slice(x, y - x))
    if held:
        yield links(held)


def _text_digest(text: Column) -> Column:
    return F.xxhash64(given(text))


class _Search:
    """The tables of one search for near duplicates."""

    def __init__(self, docs: DataFrame, size: int):
        self.ws = Workspace(docs.sparkSession)
        self.size = size
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        given_rows = self.docs.select("doc_id", _text_digest(F.col("text")).alias("digest"), "text")
        sketched = given_rows.mapInArrow(_sketched(size), _SKETCHED)
        self.rows, _ = self.ws.stage(sketched.withColumn("seq", F.monotonically_increasing_id()))
        key = ["set1", "set2", "n_shingles"]
        first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "seq")).getField("seq")
        heads = self.rows.where("n_shingles > 0").groupBy(*key).agg(first.alias("id"))
        self.classes, _ = self.ws.stage(
            self.rows.join(heads.select("id"), F.col("seq") == F.col("id"), "inner").drop("seq")
        )
        banded = self.classes.select("id", F.posexplode("bands").alias("band", "value")).select(
            "id", "band", F.xxhash64("band", "value").alias("bucket")
        )
        shared = banded.groupBy("bucket").agg(
            F.min("id").alias("leader"), F.count(F.lit(1)).alias("n")
        )
        self.members, _ = self.ws.stage(banded.join(shared.where("n > 1"), "bucket"))

    def sets(self, ids: DataFrame) -> DataFrame:
        """The full sets of the classes ``ids``: id, elements."""
        needed, seen = self.ws.stage(
            self.classes.join(ids, "id", "left_semi").select("id", "doc_id", "set1", "set2"),
            n=F.count(F.lit(1)),
        )
        wanted = needed.select(F.col("doc_id").alias("_id")).distinct()
        if seen["n"] <= BROADCAST_IDS:
            wanted = F.broadcast(wanted)
        texts = self.docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        found = texts.mapInArrow(_sets(self.size), _SETS).withColumnRenamed("doc_id", "_id")
        same = F.col("doc_id").eqNullSafe(F.col("_id"))
        return self.ws.stage(
            found.join(needed, ["set1", "set2"]).where(same).select("id", "elements")
        )[0]

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes whose full sets are alike enough."""
        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        one = sets.select(F.col("id").alias("a"), F.col("elements").alias("x"))
        two = sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
        both = pairs.join(one, "a").join(two, "b")
        common = F.size(F.array_intersect("x", "y"))
        union = F.size("x") + F.size("y") - common
        links = both.where(F.lit(100) * common >= F.lit(PERCENT) * union).select("a", "b")
        return self.ws.stage(links)[0]

    def grouped(self, links: DataFrame, groups: DataFrame | None = None) -> DataFrame:
        """Every class with its component (id, component), ``groups`` joined by links."""
        if groups is None:
            groups = self.classes.select("id", F.col("id").alias("component"))
        else:
            # Links between groups are far fewer than classes.
            a = groups.select(F.col("id").alias("a"), F.col("component").alias("x"))
            b = groups.select(F.col("id").alias("b"), F.col("component").alias("y"))
            links = links.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        found = components(links, self.ws).select(
            F.col("id").alias("component"), F.col("component").alias("joined")
        )
        return self.ws.stage(
            groups.join(found, "component", "left").select(
                "id", F.coalesce("joined", "component").alias("component")
            )
        )[0]

    def stars(self) -> DataFrame:
        """Each class with the first class of its buckets that it shares most bands with."""
        shares = (
            self.members.where("id <> leader")
            .groupBy("id", "leader")
            .agg(F.count(F.lit(1)).alias("bands"))
        )
        best = F.max(F.struct(F.col("bands"), -F.col("leader"))).alias("best")
        return shares.groupBy("id").agg(best).select(
            (-F.col("best.col2")).alias("a"), F.col("id").alias("b")
        )

    def rest(self, groups: DataFrame) -> DataFrame:
        """Links between the groups that are left in one bucket."""
        members = self.members.join(groups, "id").join(
            self.classes.select("id", "n_shingles", "bands"), "id"
        )
        several = (
            members.groupBy("bucket")
            .agg(
                F.min("component").alias("x"),
                F.max("component").alias("y"),
                F.ceil(
                    F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
                ).cast("int").alias("blocks"),
            )
            .where("x <> y")
            .select("bucket", "blocks")
        )
        rows, _ = self.ws.stage(members.join(several, "bucket"))
        rows = rows.join(self.sets(rows.select("id").distinct()), "id")
        rows = (
            rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                "bucket",
                F.least("block", "other").alias("i"),
                F.greatest("block", "other").alias("j"),
                "id", "component", "n_shingles", "block", "band", "bands", "elements",
            )
        )
        key = ["bucket", "i", "j"]
        compared = rows.repartition(*key).sortWithinPartitions(*key)
        return self.ws.stage(compared.mapInArrow(_compared, "a bigint, b bigint"))[0]

    def groups(self) -> DataFrame:
        groups = self.grouped(self.linked(self.ws.stage(self.stars())[0]))
        return self.grouped(self.rest(groups), groups)


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Beside them ``digest`` (of the text) and ``component``, which is also told apart
    where ids are missing.
    """
    search = _Search(docs, size)
    groups = search.groups()
    named = groups.join(search.classes.select("id", "doc_id"), "id")
    # Written before it is joined, so that Spark can split a large group there.
    smallest, _ = search.ws.stage(
        named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    )
    key = ["set1", "set2", "n_shingles"]
    labels = (
        search.classes.select("id", *key)
        .join(groups, "id")
        .join(smallest, "component")
        .select(*key, "component", "component_id")
    )
    return search.rows.join(labels, key, "left").select(
        "doc_id",
        "digest",
        "n_shingles",
        F.coalesce("component", "seq").alias("component"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def representatives(docs: DataFrame, size: int) -> DataFrame:
    """One document of each group: that with the smallest id, whole.

    Rows that agree in id and text stay once.
    """
    ws = Workspace(docs.sparkSession)
    found, _ = ws.stage(near_duplicates(docs, size).select("component", "doc_id", "digest"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first")
    heads, _ = ws.stage(found.groupBy("component").agg(first))
    is_head = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (
        F.col("digest") == F.col("first.digest")
    )
    gone, seen = ws.stage(
        found.join(heads, "component").where(~is_head).select(
            F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")
        ),
        n=F.count(F.lit(1)),
    )
    df = packed(docs, id=F.col("doc_id").cast("bigint"), digest=_text_digest(F.col("text")))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    repeated = found.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if seen["n"] <= BROADCAST_IDS and repeated.isEmpty():
        kept = df.join(F.broadcast(gone), same, "left_anti")
    else:
        chosen = heads.select(
            F.col("first.doc_id").alias("_id"), F.col("first.digest").alias("_digest")
        ).distinct()
        once = F.row_number().over(Window.partitionBy("id", "digest").orderBy("digest"))
        kept = df.join(chosen, same).withColumn("once", once).where("once = 1")
    return unpacked(kept, docs.columns)
