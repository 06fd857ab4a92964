"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, ``://`` and cue words for account numbers. At each
anchor a small deterministic parser expands to the left and right and validates what it got. Parsers of one kind never
look at characters that an earlier match of that kind took, so matches are leftmost and do not overlap within a kind.

Base kinds: ``email``, ``ip``, ``card``, ``phone``. Added by the method: ``address`` (scheme, host with a dot or a port or
user part, path) and ``account`` (an IBAN with right check digits, or a number of 6 to 30 characters after a cue word).

Defined cases. A null or empty text has no spans. Offsets are code points, the end exclusive. Candidates that fail their
check (part over 255, digit count, Luhn, mod 97) are dropped and not tried again. Work is linear in the text, whatever
its length. Repeated rows are searched alike. An empty table gives an empty result. Columns of the input named like a
result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.words import add_fields

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["address", "account"]
#: Words before an account number, each also capitalised and in capitals.
CUES = ["iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta"]
SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_REST_OF_URL = re.compile(r"[^\s\"'<>|]+")
_HOST = re.compile(r"(?:[^@/?#]*@)?(?:[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|[A-Za-z0-9-]+(?=:[0-9]))(?::[0-9]{1,5})?(?=[/?#]|$)")
_NUMBER = re.compile(r"(?:[ ]?(?:[Nn][Rr°o]|[Nn]umber|[Nn]ummer)\.?)?[ ]?[:#=]?[ ]?([A-Z0-9](?:[ -]?[A-Z0-9]){5,40})(?![A-Za-z0-9])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban(code: str) -> bool:
    return bool(_IBAN.fullmatch(code)) and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    for anchor, kind in [("@", "@"), ("+", "+"), ("://", "/"), *((d, "0") for d in "0123456789")]:
        anchors.add_word(anchor, (kind, len(anchor)))
    for cue in CUES:
        for form in (cue, cue.capitalize(), cue.upper()):
            anchors.add_word(form, ("#", len(form)))
    anchors.make_automaton()
    return anchors


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans as (kind, start, end), by kind as listed, then by start."""
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in BASE_KINDS + ADDED_KINDS}
    email_from = ip_from = card_from = phone_from = address_from = account_from = 0
    for last, (anchor, length) in anchors.iter(text):
        if anchor == "0":
            if last >= ip_from:
                if match := _IP.match(text, last):
                    ip_from = match.end()
                    if all(len(part.lstrip("0")) < 4 and int(part) <= 255 for part in match[0].split(".")):
                        spans["ip"].append(match.span())
                else:
                    ip_from = _DIGITS.match(text, last).end()
            if last >= card_from:
                match = _CARD.match(text, last)
                card_from = match.end() if match else last + 1
                # 19 digits have at most 18 separators between them.
                if match and 16 <= match.end() - last <= 37:
                    digits = re.sub(r"[ -]", "", match[0])
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(match.span())
        elif anchor == "@":
            start = last
            while start > email_from and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and (match := _DOMAIN.match(text, last + 1)):
                email_from = match.end()
                spans["email"].append((start, email_from))
        elif anchor == "+":
            if last >= phone_from and (match := _PHONE.match(text, last)):
                phone_from = match.end()
                if 8 <= sum(c in "0123456789" for c in match[0]) <= 15:
                    spans["phone"].append(match.span())
        elif anchor == "/":
            start = last - length + 1
            while start > address_from and text[start - 1] in _SCHEME:
                start -= 1
            while start < last and not text[start].isalpha():
                start += 1
            if start <= last - length and (match := _REST_OF_URL.match(text, last + 1)):
                rest = match[0].rstrip(".,;:!?)*$#%&")
                address_from = match.end()
                if _HOST.match(rest):
                    spans["address"].append((start, last + 1 + len(rest)))
        elif last >= account_from and not text[last + 1 : last + 2].isalpha() and (match := _NUMBER.match(text, last + 1)):
            account_from = match.end()
            code = re.sub(r"[ -]", "", match[1])
            if iban(code) or (6 <= len(code) <= 30 and sum(c.isdigit() for c in code) >= 6 and not code[:2].isalpha()):
                spans["account"].append(match.span(1))
    return [(kind, start, end) for kind, found in spans.items() for start, end in found]


def _spans_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    anchors = automaton()
    for texts in batches:
        yield pd.Series(
            [
                [{"kind": k, "start": s, "end": e, "value": text[s:e]} for k, s, e in find(text, anchors)] if text else []
                for text in texts
            ],
            dtype=object,
        )


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: kind, start, end and value of each, by kind as listed above, then by start."""
    found = F.pandas_udf(_spans_of, SPANS)(F.col(text))
    return add_fields(docs, F.struct(found.alias("spans")), ["spans"])


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` whose text has ``<kind>`` in place of each span; of overlapping spans the first, then the longest, counts."""

    @F.pandas_udf("string")
    def replaced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        anchors = automaton()
        for texts in batches:
            yield pd.Series([None if x is None else mask(x, anchors) for x in texts], dtype=object)

    return docs.withColumn(text, replaced(F.col(text)))


def mask(text: str, anchors: ahocorasick.Automaton) -> str:
    parts, end = [], 0
    for kind, start, stop in sorted(find(text, anchors), key=lambda x: (x[1], -x[2])):
        if start >= end:
            parts += [text[end:start], f"<{kind}>"]
            end = stop
    return "".join([*parts, text[end:]])


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long")


def joined(spans: Column) -> Column:
    """The spans as kind:start:end, comma-joined."""
    return F.concat_ws(
        ",", F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x["end"].cast("string")))
    )
