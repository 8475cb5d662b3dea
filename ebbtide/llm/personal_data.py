"""Personal data in texts: patterns propose spans, checksums confirm them, context words move their score."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import extended, narrow

KINDS = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local_phone")
ACCEPTED = 0.6

# What a kind's spans score by themselves, and the words that raise it nearby.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.35, "local_phone": 0.4}
CONTEXT = {
    "email": "email mail e-mail contact",
    "ip": "ip address host server",
    "card": "card credit visa mastercard amex payment",
    "phone": "phone tel telephone call mobile fax",
    "iban": "iban account bank transfer",
    "ssn": "ssn social security",
    "local_phone": "phone tel telephone call mobile fax",
}
CONTEXT = {kind: frozenset(words.split()) for kind, words in CONTEXT.items()}
BOOST = 0.3

# Lengths of account numbers by country.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AT=20, BE=16, BG=22, CH=21, CY=28, CZ=24, DE=22, DK=18, EE=20, ES=24, FI=18, FR=27, GB=22, GR=27,
    HR=21, HU=28, IE=22, IL=23, IS=26, IT=27, LI=21, LT=20, LU=20, LV=21, MC=27, MT=31, NL=18, NO=15, PL=28, PT=25,
    RO=24, SA=24, SE=24, SI=19, SK=24, SM=27, TR=26,
)

# None of these goes back over what it has read, so a text of any length takes time in proportion.
_DIGIT = re.compile("[0-9]")
_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_WORD = re.compile(r"[A-Za-z-]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(number: str) -> bool:
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_PART:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    for m in _IP.finditer(text):
        if all(len(part := p.lstrip("0")) <= 3 and int(part or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str):
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str):
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield m.span()


def _ibans(text: str):
    for m in _IBAN.finditer(text):
        length, end, number = IBAN_LENGTHS.get(m[0][:2], 0), m.end(), m[0]
        while len(number) < length and end < len(text):
            c = text[end]
            if c == " " and text[end - 1] != " ":
                pass
            elif c.isascii() and (c.isdigit() or c.isupper()):
                number += c
            else:
                break
            end += 1
        if length and len(number) == length and not text[end : end + 1].isalnum() and mod97(number):
            yield m.start(), end


def _ssns(text: str):
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _local_phones(text: str):
    for m in _LOCAL_PHONE.finditer(text):
        yield m.span()


_FINDERS = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones,
    "iban": _ibans, "ssn": _ssns, "local_phone": _local_phones,
}


def find(text: str) -> list[tuple[str, int, int, float]]:
    """``kind, start, end, score`` of all spans, by start, then kind; code points, end exclusive.

    Spans of the four base kinds stay whatever they score; others need ``ACCEPTED``, and give way
    to a base span they overlap.
    """
    digits = _DIGIT.search(text) is not None
    if not digits and "@" not in text:
        return []
    found, base = [], []
    for kind in KINDS + ADDED:
        if kind != "email" and not digits:
            continue
        for start, end in _FINDERS[kind](text):
            near = _WORD.findall(text[max(0, start - 48) : start].lower() + " " + text[end : end + 24].lower())
            score = min(1.0, SCORES[kind] + BOOST * (not CONTEXT[kind].isdisjoint(near)))
            if kind in KINDS:
                base.append((start, end))
            elif score < ACCEPTED or any(start < e and s < end for s, e in base):
                continue
            found.append((kind, start, end, score))
    order = {kind: i for i, kind in enumerate(KINDS + ADDED)}
    return sorted(found, key=lambda x: (x[1], order[x[0]]))


def masked(text: str, spans) -> str:
    """``text`` with each span, or run of overlapping ones, replaced by the first one's kind in brackets."""
    out, done = [], 0
    for kind, start, end, _ in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


_SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"
_SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row, in one pass: what ``find`` gives for the whole text.

    A null or empty text has no spans; null ids stay null; repeated rows are searched each; an empty
    table gives an empty result; texts of any length take time in proportion to it.
    """

    def run(batches):
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e, "score": x} for k, s, e, x in find(t.as_py() or "")]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS_ARROW)], ["doc_id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow(docs, doc_id=id_col, text=text_col).mapInArrow(run, f"doc_id {kind}, spans {_SPANS}")


def mask_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans found in ``text_col`` masked; nulls and other columns stay as they are."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = [None if (t := x.as_py()) is None else masked(t, find(t)) for x in batch.column(at)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return extended(docs, run, {})


def span_list(spans) -> F.Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")
