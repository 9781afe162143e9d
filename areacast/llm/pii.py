"""Personal data: proposed by patterns, confirmed by checksums, weighed by
context.

1. Regular expressions propose spans of each kind.
2. A kind's validator confirms or drops them: Luhn for cards, mod 97 for IBANs,
   ranges of numbers for IP addresses and social security numbers, digit counts
   for phones. A dropped match is not tried again at another place.
3. A span's score is the kind's own, raised by ``NEAR`` if one of the kind's
   words stands within ``REACH`` code points before or after it, lowered by as
   much if a word of ``AGAINST`` does, and held within 0 and 1.

Kinds of `BASE` are kept at any score; those of `ADDED` from ``KEEP`` on, and
the weak ones of these (``ssn``, ``local_phone``) only where they overlap no
span of the other kinds. A document is searched in its own task, in time linear
in its length, without a shuffle.

Defined cases: a null text is empty; an empty one has no spans. Offsets count
code points, ends are exclusive. Rows are judged one by one, so repeated and
null ids keep their own rows. A column ``pii`` of the input is replaced; other
columns are carried. An empty table stays empty.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from areacast.llm.common import pieces

PIECE_BYTES = 8 << 20
NEAR, KEEP, REACH = 0.3, 0.5, 40

# The kinds, in the order of equal starts, and the patterns of
# the contract for the first four.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local_phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(( [A-Z0-9]{4}){2,7}( [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "local_phone": r"\b[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}\b",
}
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "local_phone": 0.3}
#: Words that speak for a kind, in lower case.
WORDS = {
    "email": ("mail", "email", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "telefono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "telefono"),
}
AGAINST = ("isbn", "issn", "version", "invoice", "order", "serial")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


# The patterns as they are searched: the same matches, but a failing start is
# given up at once, so that long runs of one class take linear time.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}")  # of the runs, only those of 12 digits and more can pass
_OTHERS = {k: re.compile(PATTERNS[k], re.ASCII) for k in ("phone", *ADDED)}


def _word_pattern(words: tuple[str, ...]) -> str:
    return "(^|[^a-z])(" + "|".join(words) + ")([^a-z]|$)"


CONTEXT = {k: _word_pattern(w) for k, w in WORDS.items()}
COUNTER = _word_pattern(AGAINST)
_CONTEXT = {k: re.compile(p) for k, p in CONTEXT.items()}
_COUNTER = re.compile(COUNTER)
_LOWER = {c: c + 32 for c in range(65, 91)}


def digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def luhn(number: str) -> bool:
    """Whether the digits, each second one from the right doubled, add up to a
    multiple of ten."""
    odd = sum(map(int, number[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in number[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN, its first four characters moved to the end and letters
    written as 10 to 35, is 1 modulo 97."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def valid(kind: str, text: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(map(_small, text.split(".")))
    if kind == "card":
        number = digits(text)
        return 12 <= len(number) <= 19 and luhn(number)
    if kind == "phone":
        return 9 <= len(digits(text)) <= 15
    if kind == "iban":
        iban = text.replace(" ", "")
        return 15 <= len(iban) <= 34 and mod97(iban)
    if kind == "ssn":
        area, group, serial = text.split("-")
        return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
    return text[0] in "23456789"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # From each @domain to the left, up to the last @ or the last match.
    free, at = 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at)
        if found:
            before = text[free:at]
            local = len(before) - len(before.rstrip(_LOCAL))
            if local:
                yield at - local, found.end()
                free = found.end()
        free = max(free, at + 1)
        at = text.find("@", at + 1)


def _proposed(kind: str, text: str) -> Iterator[tuple[int, int]]:
    if kind == "email":
        return _emails(text)
    pattern = _IP if kind == "ip" else _CARD if kind == "card" else _OTHERS[kind]
    return (m.span() for m in pattern.finditer(text))


def score(kind: str, text: str, start: int, end: int) -> float:
    around = [text[max(start - REACH, 0) : start].translate(_LOWER), text[end : end + REACH].translate(_LOWER)]
    near = any(_CONTEXT[kind].search(t) for t in around)
    against = any(_COUNTER.search(t) for t in around)
    return min(max(SCORES[kind] + NEAR * (near - against), 0.0), 1.0)


def find(text: str | None) -> list[Span]:
    """The spans of a text, by start, then kind."""
    if not text:
        return []
    found: list[Span] = []
    for kind in (*BASE, "iban"):
        spans = [(s, e) for s, e in _proposed(kind, text) if valid(kind, text[s:e])]
        scored = [Span(kind, s, e, score(kind, text, s, e)) for s, e in spans]
        found += scored if kind in BASE else [x for x in scored if x.score >= KEEP]
    # Spans of the sure kinds, merged, to find overlaps with the others.
    sure: list[list[int]] = []
    for s, e in sorted((x.start, x.end) for x in found):
        if sure and s <= sure[-1][1]:
            sure[-1][1] = max(sure[-1][1], e)
        else:
            sure.append([s, e])
    ends = [e for _, e in sure]
    for kind in ADDED[1:]:
        for s, e in _proposed(kind, text):
            at = bisect_left(ends, s + 1)
            if at < len(sure) and sure[at][0] < e or not valid(kind, text[s:e]):
                continue
            own = Span(kind, s, e, score(kind, text, s, e))
            if own.score >= KEEP:
                found.append(own)
    order = {k: i for i, k in enumerate((*BASE, *ADDED))}
    return sorted(found, key=lambda x: (x.start, order[x.kind]))


_SPANS = ArrayType(StructType().add("kind", "string").add("start", "integer").add("end", "integer").add("score", "double"))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with pii: the spans of each text as an array of
    kind, start, end and score."""
    base = docs.select(*(f"`{c}`" for c in docs.columns if c.lower() != "pii"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text, PIECE_BYTES):
            found = [[x._asdict() for x in find(t)] for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, _ARROW)], [*b.schema.names, "pii"])

    return base.mapInArrow(run, StructType([*base.schema.fields]).add("pii", _SPANS))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text written as its kind in angle
    brackets; overlapping spans become one, of the kind that starts first."""

    def masked(t: str | None) -> str | None:
        if t is None:
            return None
        out, at = [], 0
        for x in find(t):
            if x.start >= at:
                out += [t[at : x.start], f"<{x.kind}>"]
            at = max(at, x.end)
        return "".join([*out, t[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text, PIECE_BYTES):
            at = b.schema.get_field_index(text)
            columns = list(b.columns)
            columns[at] = pa.array([masked(t) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _joined(spans) -> Column:
    one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def pii_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every
    document."""
    found = find_pii(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii", lambda x: x["kind"].isin(*BASE))
    return found.select("doc_id", *(count(k) for k in BASE), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"))
