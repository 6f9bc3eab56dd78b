"""Chat formatting: records of any known layout become canonical turns, then one template.

A record is known by its fingerprint, a hash of its nested field paths (``messages[].role``).
The fingerprint selects a ``Layout``: a declaration of which paths hold whose words, from
which the expressions that read the turns are built.  Frames with a schema have one
fingerprint, found while planning (``turns_of``); JSON text has one per record
(``turns_of_json``).  Paths that no layout names don't count, so extra columns change
nothing; where no layout has just these paths, the first takes it whose paths are all there.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts every ``<|`` gets a
backslash in between, and one more where some stand there already (``escaped``), so that no
control string is left and the way back is exact.  Assistant texts are under the loss mask.

Turns are formatted where they are.  Those of one conversation meet sorted, and pass as a
stream: neither a long conversation nor a hot id is ever held, it comes in parts of whole
turns (``PART_CHARS``; a single turn is never parted).  What SHA-256 over a conversation asks
for, one task reads one conversation.

Null roles and texts are empty.  Turns without a place come last; those of equal place are
ordered by their formatted text, and repeated rows are repeated turns.  Rows without a
conversation are one conversation, whose id is null.  Records of no known layout have no
turns: of a frame that is an error, in JSON ``layout`` is null.  Empty tables give none.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitacora.llm.text import given, packed

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
# Characters from which a conversation goes on in another part.
PART_CHARS = 1 << 20


# --------------------------------------------------------------------------
# Layouts
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Said:
    """Who says what: a path of the role, or ``=name``, and paths of the text.

    The texts of several paths are joined by an empty line; empty ones are left out.
    """

    role: str
    text: tuple[str, ...]
    # A turn that is left out where it has no text.
    optional: bool = False


@dataclass(frozen=True)
class Layout:
    name: str
    said: tuple[Said, ...]
    # Path of an array whose elements hold the turns, and of the place of a one-turn record.
    each: str = ""
    place: str = ""
    # Names of roles that mean another.
    roles: tuple[tuple[str, str], ...] = ()

    def fields(self) -> list[str]:
        """Paths inside the record, or inside an element of ``each``."""
        roles = [s.role for s in self.said if not s.role.startswith("=")]
        return list(dict.fromkeys([*roles, *chain(*(s.text for s in self.said))]))

    @property
    def paths(self) -> frozenset[str]:
        inside = f"{self.each}[]." if self.each else ""
        return frozenset([inside + f for f in self.fields()] + ([self.place] if self.place else []))


_SHARED_ROLES = (("human", "user"), ("gpt", ASSISTANT), ("bot", ASSISTANT), ("model", ASSISTANT))

LAYOUTS = (
    Layout("turn rows", (Said("role", ("text",)),), place="turn"),
    Layout("messages", (Said("role", ("content",)),), each="messages"),
    Layout("shared conversations", (Said("from", ("value",)),), each="conversations", roles=_SHARED_ROLES),
    Layout(
        "instruction with system",
        (Said("=system", ("system",), True), Said("=user", ("instruction", "input")), Said("=assistant", ("output",))),
    ),
    Layout("instruction with input", (Said("=user", ("instruction", "input")), Said("=assistant", ("output",)))),
    Layout("instruction", (Said("=user", ("instruction",)), Said("=assistant", ("output",)))),
    Layout("prompt with system", (
        Said("=system", ("system",), True), Said("=user", ("prompt",)), Said("=assistant", ("response",)))),
    Layout("prompt and response", (Said("=user", ("prompt",)), Said("=assistant", ("response",)))),
    Layout("prompt and completion", (Said("=user", ("prompt",)), Said("=assistant", ("completion",)))),
    Layout("prompt and chosen", (Said("=user", ("prompt",)), Said("=assistant", ("chosen",)))),
    Layout("question and answer", (Said("=user", ("question",)), Said("=assistant", ("answer",)))),
    Layout("nested instance", (
        Said("=user", ("instruction", "instance.input")), Said("=assistant", ("instance.output",)))),
)


def schema_paths(schema: T.DataType, path: str = "") -> set[str]:
    """Paths of the leaves of a schema."""
    if isinstance(schema, T.StructType):
        dot = f"{path}." if path else ""
        return set().union(*(schema_paths(f.dataType, dot + f.name) for f in schema.fields))
    if isinstance(schema, T.ArrayType):
        return schema_paths(schema.elementType, f"{path}[]")
    return {path}


def value_paths(value, path: str = "") -> set[str]:
    """Paths of the leaves of a value read from JSON."""
    found: set[str] = set()
    # No recursion: nesting may be deep.
    open_ = [(value, path)]
    while open_:
        value, path = open_.pop()
        if isinstance(value, dict):
            open_ += [(v, f"{path}.{k}" if path else k) for k, v in value.items()]
        elif isinstance(value, list):
            open_ += [(v, f"{path}[]") for v in value]
        else:
            found.add(path)
    return found


class Registry:
    """Layouts by the fingerprints of their paths."""

    def __init__(self, layouts: Iterable[Layout] = LAYOUTS):
        self.layouts = tuple(layouts)
        self._named = frozenset().union(*(x.paths for x in self.layouts))
        self._known: dict[int, Layout | None] = {}
        for layout in reversed(self.layouts):
            self._known[self.fingerprint(layout.paths)] = layout

    def fingerprint(self, paths: Iterable[str]) -> int:
        """64 bits of the paths that any layout names."""
        mine = sorted(self._named.intersection(paths))
        return xxhash.xxh3_64_intdigest(json.dumps(mine).encode())

    def select(self, paths: Iterable[str]) -> Layout | None:
        """The layout for these paths; searched once per fingerprint."""
        paths = set(paths)
        key = self.fingerprint(paths)
        if key not in self._known:
            self._known[key] = next((x for x in self.layouts if x.paths <= paths), None)
        return self._known[key]


# --------------------------------------------------------------------------
# Turns
# --------------------------------------------------------------------------

_TURN = "struct<place: bigint, step: int, role: string, text: string>"


def _inside(record: Column, path: str) -> Column:
    for name in path.split("."):
        record = record.getField(name)
    return record


def _turns(layout: Layout, get) -> Column:
    """The turns of one record, whose fields ``get`` reads."""
    place = get(layout.place).cast("bigint") if layout.place else F.lit(0).cast("bigint")
    other = {old: new for old, new in layout.roles}

    def turns(read, step: Column) -> Column:
        made = []
        for k, said in enumerate(layout.said):
            role = F.lit(said.role[1:]) if said.role.startswith("=") else given(read(said.role).cast("string"))
            for old, new in other.items():
                role = F.when(role == old, F.lit(new)).otherwise(role)
            texts = [given(read(p).cast("string")) for p in said.text]
            text = texts[0]
            if len(texts) > 1:
                text = F.array_join(F.filter(F.array(*texts), lambda t: t != ""), "\n\n")
            turn = F.struct(
                place.alias("place"), (step + F.lit(k)).cast("int").alias("step"),
                role.alias("role"), text.alias("text"),
            )
            left_out = (text == "") if said.optional else F.lit(False)
            made.append(F.when(~left_out, turn))
        return F.filter(F.array(*made), lambda t: t.isNotNull())

    if not layout.each:
        return turns(get, F.lit(0)).cast(f"array<{_TURN}>")
    n = len(layout.said)
    each = F.flatten(
        F.transform(get(layout.each), lambda e, i: turns(lambda p: _inside(e, p), i * n))
    )
    return F.coalesce(each, F.array()).cast(f"array<{_TURN}>")


def turns_of(records: DataFrame, conv_id: str, registry: Registry | None = None) -> DataFrame:
    """conv_id, place, step, role and text of every turn of a frame with a known layout."""
    registry = registry or Registry()
    layout = registry.select(schema_paths(records.schema))
    if layout is None:
        raise ValueError(f"no layout for the fields {sorted(schema_paths(records.schema))}")

    def get(path: str) -> Column:
        first, *rest = path.split(".")
        column = F.col(f"`{first}`")
        return _inside(column, ".".join(rest)) if rest else column

    turn = F.explode(_turns(layout, get)).alias("turn")
    return records.select(F.col(f"`{conv_id}`").alias("conv_id"), turn).select("conv_id", "turn.*")


def _json_schema(layout: Layout) -> T.StructType:
    """Just the fields that a layout reads, all as text."""
    tree: dict = {}
    for path in layout.fields():
        node = tree
        for name in path.split("."):
            node = node.setdefault(name, {})

    def build(node: dict) -> T.DataType:
        if not node:
            return T.StringType()
        return T.StructType([T.StructField(k, build(v)) for k, v in node.items()])

    schema = build(tree)
    if layout.each:
        schema = T.StructType([T.StructField(layout.each, T.ArrayType(schema))])
    if layout.place:
        schema = schema.add(layout.place, T.LongType())
    return schema


def records_of_json(records: DataFrame, json_text: str, registry: Registry | None = None) -> DataFrame:
    """``row`` with the record, the name of its ``layout`` and its ``turns``.

    Both are null for what is no JSON object or has no known layout.
    """
    registry = registry or Registry()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: list[str | None] = []
            for text in batch["text"].to_pylist():
                try:
                    value = json.loads(text or "")
                except (ValueError, RecursionError):
                    value = None
                layout = registry.select(value_paths(value)) if isinstance(value, dict) else None
                names.append(layout and layout.name)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["text"], pa.array(names, pa.string())], ["row", "text", "layout"]
            )

    df = packed(records, text=F.col(f"`{json_text}`").cast("string"))
    found = df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("layout", T.StringType())]))
    turns = F.lit(None).cast(f"array<{_TURN}>")
    for layout in registry.layouts:
        record = F.from_json("text", _json_schema(layout))
        read = _turns(layout, lambda path, record=record: _inside(record, path))
        turns = F.when(F.col("layout") == layout.name, read).otherwise(turns)
    return found.select("row", "layout", turns.alias("turns"))


def turns_of_json(
    records: DataFrame, conv_id: str, json_text: str, registry: Registry | None = None
) -> DataFrame:
    """conv_id, place, step, role and text of every turn of records of known layouts."""
    found = records_of_json(records, json_text, registry)
    turn = F.explode("turns").alias("turn")
    return found.select(F.col(f"row.`{conv_id}`").alias("conv_id"), turn).select("conv_id", "turn.*")


# --------------------------------------------------------------------------
# Template
# --------------------------------------------------------------------------


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    """A role on one line without the start of a control string."""
    lines = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.replace(lines, F.lit("<"), F.lit("\\l"))


_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE = re.compile(r"\\(.)")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def unescaped_role(role: str) -> str:
    return _ROLE.sub(lambda m: {"n": "\n", "l": "<"}.get(m[1], m[1]), role)


def formatted_turns(turns: DataFrame) -> DataFrame:
    """Every turn as ``formatted`` text with the characters of it under the loss mask.

    ``loss_start`` and ``loss_end`` count code points inside the turn; null where
    nothing is under the mask.
    """
    role, text = escaped_role(given(F.col("role"))), escaped(given(F.col("text")))
    begin = F.length(role) + F.lit(len(START) + 1)
    learned = given(F.col("role")) == ASSISTANT
    return turns.select(
        "conv_id",
        "place",
        "step",
        F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n")).alias("formatted"),
        F.when(learned, begin).cast("bigint").alias("loss_start"),
        F.when(learned, begin + F.length(text)).cast("bigint").alias("loss_end"),
    )


def _parts(limit: int):
    """Turns that come in order, as parts of conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        texts: list[str] = []
        losses: list[list[int]] = []
        conv_id, part, chars, held = None, 0, 0, 0
        kinds = [pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]
        kind = None

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal rows, held
            columns = list(zip(*rows))
            arrays = [pa.array(columns[0], kind), *(pa.array(c, k) for c, k in zip(columns[1:], kinds))]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "part", "formatted", "losses"])
            rows, held = [], 0

        def close(new_part: int) -> None:
            nonlocal texts, losses, part, chars, held
            rows.append((conv_id, part, "".join(texts), losses))
            held += chars
            texts, losses, part, chars = [], [], new_part, 0

        for batch in batches:
            kind = batch["conv_id"].type
            for this, text, a, b in zip(*(batch[c].to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))):
                if texts and this != conv_id:
                    close(0)
                elif chars >= limit:
                    close(part + 1)
                elif this != conv_id:
                    part = 0
                conv_id = this
                if a is not None:
                    losses.append([chars + a, chars + b])
                texts.append(text)
                chars += len(text)
                if held >= limit:
                    yield from done()
        if texts:
            close(0)
        if rows:
            yield from done()

    return run


def conversations(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """conv_id, part, formatted text and ``losses``, the spans under the loss mask.

    The parts of a conversation stand one after the other in one partition.
    """
    made = formatted_turns(turns)
    kind = made.schema["conv_id"].dataType
    ordered = made.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("place").asc_nulls_last(), "step", "formatted"
    )
    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("part", T.LongType()),
            T.StructField("formatted", T.StringType()),
            T.StructField("losses", T.ArrayType(T.ArrayType(T.LongType()))),
        ]
    )
    return ordered.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(_parts(part_chars), schema)


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of every turn of formatted text."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        yield unescaped_role(formatted[at + len(START) : line]), unescaped(formatted[line + 1 : end])
        at = end + len(END) + 1


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    rows: list[tuple] = []
    open_ = None  # conv_id, turns, their hash, loss characters, their hash, characters
    kind = None

    def closed() -> tuple:
        conv_id, n, turns, loss, text, chars = open_
        return conv_id, n, turns.hexdigest(), loss, text.hexdigest(), chars

    for batch in batches:
        kind = batch["conv_id"].type
        for conv_id, part, formatted, losses in zip(*(c.to_pylist() for c in batch.columns)):
            if part == 0:
                if open_:
                    rows.append(closed())
                open_ = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_back(formatted):
                open_[1] += 1
                open_[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for a, b in losses:
                text = unescaped(formatted[a:b])
                open_[3] += len(text)
                open_[4].update(text.encode("utf-8", "surrogatepass"))
            open_[5] += len(formatted)
        if rows:
            columns = list(zip(*rows))
            arrays = [pa.array(columns[0], kind), *(pa.array(c, k) for c, k in zip(columns[1:], kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names)
            rows = []
    if open_:
        columns = list(zip(closed()))
        arrays = [pa.array(columns[0], kind), *(pa.array(c, k) for c, k in zip(columns[1:], kinds))]
        yield pa.RecordBatch.from_arrays(arrays, names)


def digests(parts: DataFrame) -> DataFrame:
    """What ``conversations`` made, read back: one row of counts and digests each.

    Rows must come as they left ``conversations``.
    """
    kind = parts.schema["conv_id"].dataType
    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )
    return parts.select("conv_id", "part", "formatted", "losses").mapInArrow(_digests, schema)
