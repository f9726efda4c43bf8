"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust the score.

Every expression is searched in time proportional to the text: runs are entered at their first character only, are never
given back, and an address is looked for from its ``@``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.scratch import ship_package

#: Kinds in the order in which spans are listed. The first four are the base; the method adds the others.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Characters of an IBAN by country, without blanks.
_IBAN_LENGTHS = {
    country: int(length)
    for length, countries in (
        row.split(":")
        for row in (
            "15:NO", "16:BE", "18:DK FI FK FO GL NL SD", "19:MK SI", "20:AT BA EE KZ LT LU MN XK", "21:CH CR HR LI LV",
            "22:BG BH DE GB GE IE ME RS", "23:AE GI IL IQ OM SO TL", "24:AD CZ ES MD PK RO SA SE SK TN VG",
            "25:LY PT ST", "26:IS TR", "27:BI DJ FR GR IT MC MR SM", "28:AL AZ BY CY DO GT HN HU LB NI PL SV",
            "29:BR EG PS QA UA", "30:JO KW MU YE", "31:MT SC", "32:LC", "33:RU",
        )
    )
    for country in countries.split()
}

#: How sure a proposed and, where there is a checksum, confirmed span is by itself.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.95, "ssn": 0.4}
#: Words that make a kind likelier when they stand close to a span.
CONTEXT = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment", "cvv"),
    "phone": ("call", "phone", "tel", "mobile", "fax", "contact", "whatsapp"),
    "iban": ("iban", "account", "bank", "transfer", "konto", "bic"),
    "ssn": ("ssn", "social", "security"),
}
#: Words that make any kind less likely.
AGAINST = ("version", "order", "serial", "isbn", "part", "sample", "test")
#: Code points on both sides of a span that are looked at, what a word adds or takes, and the score an added span needs.
REACH, RAISE, LOWER, NEEDED = 40, 0.2, 0.2, 0.5
_WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Span:
    kind: str
    begin: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of ISO 7064 over letters as two-digit numbers, the first four characters moved to the end."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # end of the last address
    for domain in _DOMAIN.finditer(text):
        begin = domain.start()
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < domain.start():
            free = domain.end()
            yield begin, free


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Of a stretch that begins like an IBAN, as many characters as its country's have, blanks aside, if a word ends
    there and the checksum holds; other countries have none. A word or number that follows is no part of it. A stretch
    without any gives way to those that begin within it. Each has 34 characters at most."""
    at = 0
    while m := _IBAN.search(text, at):
        begin, at = m.start(), m.start() + 4
        length, size, end = _IBAN_LENGTHS.get(m[0][:2], 0), 0, begin
        while end < m.end() and size < length:
            size += text[end] != " "
            end += 1
        follower = text[end : end + 1]
        ends_here = size == length > 0 and not (follower.isascii() and follower.isalnum())
        if ends_here and mod97(text[begin:end].replace(" ", "")):
            at = end
            yield begin, end


def proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans by kind, then place."""
    yield from (("email", *s) for s in emails(text))
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield "phone", *m.span()
    yield from (("iban", *s) for s in ibans(text))
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *m.span()


def score(text: str, kind: str, begin: int, end: int) -> float:
    around = _WORD.findall((text[max(0, begin - REACH) : begin] + " " + text[end : end + REACH]).lower())
    value = PRIOR[kind] + RAISE * any(w.startswith(CONTEXT[kind]) for w in around) - LOWER * any(w in AGAINST for w in around)
    return min(1.0, max(0.0, round(value, 6)))


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text. Base spans always stay, whatever their score; an added one needs ``NEEDED`` and must not
    overlap a base span. Null and empty texts have none."""
    if not text:
        return []
    spans = [Span(kind, b, e, score(text, kind, b, e)) for kind, b, e in proposed(text)]
    base = sorted((s.begin, s.end) for s in spans if s.kind in BASE)
    return [s for s in spans if s.kind in BASE or s.score >= NEEDED and not _overlaps(base, s)]


def _overlaps(base: list[tuple[int, int]], span: Span) -> bool:
    return any(b < span.end and span.begin < e for b, e in base)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named after the first."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.begin, -s.end)):
        if s.begin >= at:
            out += [text[at : s.begin], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


_SPANS = "array<struct<kind:string,begin:int,end:int,score:double>>"
_ARROW_SPAN = pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])


def with_spans(documents: DataFrame, text: str = "text", spans: str = "pii_spans", redacted: str | None = None) -> DataFrame:
    """The frame with a column ``spans``, and one more, ``redacted``, if it is named: the text without its personal
    data (null stays null). Row by row, nothing is shuffled. Texts of any length are searched whole, repeated rows each
    for itself; an empty table stays empty. Columns of these names are replaced; all others are kept as they are."""
    ship_package(documents.sparkSession)
    documents = documents.drop(spans, *([redacted] if redacted and redacted != text else []))
    names = documents.columns
    place = names.index(text)
    parts = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name != redacted]
    schema = ", ".join([*parts, f"`{spans}` {_SPANS}", *([f"`{redacted}` string"] if redacted else [])])

    def batches(stream):
        for batch in stream:
            texts = batch.column(place).to_pylist()
            found = [find_spans(t) for t in texts]
            rows = [[{"kind": s.kind, "begin": s.begin, "end": s.end, "score": s.score} for s in own] for own in found]
            columns = [c for c, n in zip(batch.columns, names, strict=True) if n != redacted]
            out = [n for n in names if n != redacted]
            columns.append(pa.array(rows, pa.list_(_ARROW_SPAN)))
            out.append(spans)
            if redacted:
                columns.append(pa.array([t if not s else redact(t, s) for t, s in zip(texts, found, strict=True)], pa.string()))
                out.append(redacted)
            yield pa.RecordBatch.from_arrays(columns, names=out)

    return documents.mapInArrow(batches, schema)
