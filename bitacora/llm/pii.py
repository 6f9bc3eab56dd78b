"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds anchors: at-signs, digits and
what stands beside them, schemes, and cues of accounts and street addresses.  From
each anchor a local parser expands to the boundaries of what it may stand in and
validates it; it never looks at the rest of the text.

Kinds, in this order:

* ``email``, ``ip`` (parts to 255), ``card`` (14 to 19 digits, Luhn), ``phone``
  (10 to 15 digits after a plus): leftmost matches without overlap per kind; one that
  fails its test is dropped and not tried again;
* ``url``: an address with a user or password before its host;
* ``account``: a cue such as ``iban`` or ``api_key``, then a value of 6 characters or more,
  however long, with a digit;
* ``address``: a house number and a name, then a word for a street.

Places count code points, the end is exclusive.  A null text is empty.  Each row is
judged alone, so repeated rows get the same result.  An empty table gives no row; columns of
any name pass in ``row``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bitacora.llm.text import packed, text_function

KINDS = ("email", "ip", "card", "phone", "url", "account", "address")

# Cues of identifiers and of street addresses.
ACCOUNT_CUES = (
    "account", "acct", "iban", "ssn", "passport", "routing", "api_key", "apikey", "api-key",
    "token", "secret", "password", "passwd",
)
STREET_CUES = (
    "street", "avenue", "road", "boulevard", "lane", "drive", "court", "square", "straße", "strasse",
)

_DIGITS = "0123456789"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Of a run of digits only its start can begin an address.
_QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_LOGIN = re.compile(r"[^\s/@:<>\"]+(?::[^\s/@<>\"]*)?@[A-Za-z0-9.-]+[^\s<>\"']*")
_VALUE = re.compile(r"(?:[ _-]?(?:number|no\.?|nr\.?|id|key|code))?[ \t]*+(?:[:=#][ \t]*+)?[\"']?([A-Za-z0-9][A-Za-z0-9_-]{5})", re.I)
# What a value goes on with.
_VALUE_RUN = re.compile(r"[A-Za-z0-9_-]*", re.I)
_HOUSE = re.compile(r"(?<!\w)[0-9]{1,5}[A-Za-z]?(?: [A-Z][\w'.-]{0,30}){1,4} ?$")


def automaton() -> ahocorasick.Automaton:
    """Anchors with (what parses them, their length)."""
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("://", ("url", 3))
    for d in _DIGITS:
        found.add_word(d, ("card", 1))
        found.add_word(f"{d}.", ("ip", 2))
        found.add_word(f"+{d}", ("phone", 2))
    for kind, cues in (("account", ACCOUNT_CUES), ("address", STREET_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _back(text: str, place: int, least: int, chars: frozenset[str]) -> int:
    """Start of the run of ``chars`` that ends at ``place``, not before ``least``."""
    while place > least and text[place - 1] in chars:
        place -= 1
    return place


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def _email(text: str, at: int, done: int) -> Iterator[tuple[int, int]]:
    start = _back(text, at, done, _LOCAL)
    domain = _DOMAIN.match(text, at + 1)
    if start < at and domain:
        yield start, domain.end()


_QUAD_CHARS, _CARD_CHARS = frozenset(_DIGITS + "."), frozenset(_DIGITS + " -")
_QUAD_RUN, _CARD_RUN = re.compile(r"[0-9.]*"), re.compile(r"[0-9 -]*")


def _ips(text: str, start: int, end: int) -> Iterator[tuple[int, int, bool]]:
    for m in _QUAD.finditer(text, start, end):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        yield m.start(), m.end(), all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def _cards(text: str, start: int, end: int) -> Iterator[tuple[int, int, bool]]:
    for m in _CARD.finditer(text, start, end):
        digits = _only_digits(m.group())
        yield m.start(), m.end(), 14 <= len(digits) <= 19 and _luhn(digits)


def spans(text: str | None, anchors: ahocorasick.Automaton) -> list[tuple[int, str, int]]:
    """(start, kind, end) in the order of start, then kind."""
    found: list[tuple[int, int, int]] = []
    if not text:
        return []
    done = dict.fromkeys(KINDS, 0)
    # End of the last account value without a digit: what starts inside has none either.
    bare = 0

    def add(kind: str, start: int, end: int) -> None:
        found.append((start, KINDS.index(kind), end))

    for last, (kind, length) in anchors.iter(text):
        first, end = last + 1 - length, last + 1
        if kind in ("ip", "card"):
            if first < done[kind]:
                continue
            # The whole run around the anchor is parsed at once.
            chars, run, parse = (
                (_QUAD_CHARS, _QUAD_RUN, _ips) if kind == "ip" else (_CARD_CHARS, _CARD_RUN, _cards)
            )
            a, b = _back(text, first, done[kind], chars), run.match(text, first).end()
            for x, y, good in parse(text, a, b):
                if good:
                    add(kind, x, y)
            done[kind] = b
        elif kind == "email":
            for x, y in _email(text, first, done[kind]):
                add(kind, x, y)
                done[kind] = y
        elif kind == "phone":
            if m := _PHONE.match(text, first):
                if 10 <= len(_only_digits(m.group())) <= 15:
                    add(kind, m.start(), m.end())
        elif kind == "url":
            start = _back(text, first, done[kind], _SCHEME)
            m = _LOGIN.match(text, end)
            if start < first and m:
                add(kind, start, m.end())
                done[kind] = m.end()
        elif kind == "account":
            m = _VALUE.match(text, end)
            if m and first >= done[kind] and m.start(1) >= bare:
                stop = _VALUE_RUN.match(text, m.end(1)).end()
                if any(c in _DIGITS for c in text[m.start(1) : stop]):
                    add(kind, m.start(1), stop)
                    done[kind] = stop
                else:
                    bare = stop
        elif end == len(text) or not text[end].isalpha():
            least = max(done[kind], first - 140)
            if m := _HOUSE.search(text[least:first]):
                add(kind, least + m.start(), end)
                done[kind] = end
    return [(start, KINDS[k], end) for start, k, end in sorted(found)]


def masked(text: str | None, found: list[tuple[int, str, int]]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlaps become one."""
    if text is None:
        return None
    parts, place = [], 0
    for start, kind, end in found:
        if start >= place:
            parts += [text[place:start], f"[{kind}]"]
        place = max(place, end)
    return "".join(parts) + text[place:]


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


def find_private(docs: DataFrame, mask: bool = False) -> DataFrame:
    """``row`` with the document, its ``spans``, and its ``masked`` text if asked for."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        anchors = automaton()
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            rows, texts = [], []
            for text in (t.as_py() for t in batch):
                found = spans(text, anchors)
                rows.append([{"kind": k, "start": a, "end": b} for a, k, b in found])
                if mask:
                    texts.append(masked(text, found))
            columns = [pa.array(rows, pa.list_(kind)), *([pa.array(texts, pa.string())] if mask else [])]
            yield pa.StructArray.from_arrays(columns, ["spans", "masked"][: len(columns)])

    schema = T.StructType([T.StructField("spans", T.ArrayType(SPAN))])
    if mask:
        schema = schema.add("masked", T.StringType())
    df = packed(docs, text=docs["text"])
    return df.select("row", text_function(run, schema)("text").alias("found")).select("row", "found.*")
