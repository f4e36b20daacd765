"""Operator 5: personal data. Regular expressions propose, checksums confirm, context words adjust the score.

Kinds of the base: email, ip, card (Luhn), phone. The method adds iban (mod-97) and id numbers of nine digits that a
context word announces. Every span has a score: what its shape and checksum are worth, plus a bonus for a word nearby
that announces its kind, minus one for a word that speaks against it. Base spans are kept whatever their score; added
ones need `min_score`.

Positions count code points from 0, the end is exclusive. Defined results: NULL is an empty text; a text without
spans gives an empty list; spans of one kind don't overlap; rows are independent, so repeated rows repeat their result.
Every search is linear in the text, also on hostile ones (one run of a million digits).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tillspan.llm.common import map_batches

# Kinds in the order of the contract, then those the method adds.
KINDS = ("email", "ip", "card", "phone", "iban", "id")

# The part of an address after its `@`.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
# Characters of the account numbers of countries.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}
_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# What a shape with its checksum is worth, before the words around it are read.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "id": 0.3}
# Words that announce a kind.
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "payment", "paid", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "whatsapp"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "id": ("ssn", "social", "security", "tax", "identity", "passport"),
}
# Words that speak against any personal data.
AGAINST = ("version", "example", "order", "invoice", "isbn", "test")
CONTEXT_CHARS = 40
BONUS = 0.2
MALUS = 0.3
MIN_SCORE = 0.5
_WORD = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    rest = 0
    for char in turned:
        rest = (rest * (100 if char > "9" else 10) + int(char, 36)) % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # nothing before this place can belong to another address
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        parts = list(_PART.finditer(text, run.start(), run.end()))
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or "0") <= 255 for p in four):
                yield four[0].start(), four[3].end()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for run in _CARD.finditer(text):
        if run.end() - run.start() > 37:  # 19 digits and the 18 signs between them
            continue
        digits = _NOT_DIGIT.sub("", run[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield run.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("+")
    while at >= 0:
        run = _PHONE.match(text, at)
        if run and 9 <= len(_NOT_DIGIT.sub("", run[0])) <= 15:
            yield run.span()
        at = text.find("+", run.end() if run else at + 1)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    run = _IBAN.search(text)
    while run:
        # What follows may belong to it by its shape: every reading that ends with a word, the country's length first, then longest first.
        words = run[0].split(" ")
        readings = [" ".join(words[:k]) for k in range(len(words), 0, -1)]
        readings.sort(key=lambda r: len(r.replace(" ", "")) != IBAN_LENGTH.get(r[:2]))
        compact = ((r, r.replace(" ", "")) for r in readings)
        end = next((run.start() + len(r) for r, c in compact if len(c) >= 15 and mod97(c)), None)
        if end is not None:
            yield run.start(), end
        run = _IBAN.search(text, end or run.start() + 2)


def _ids(text: str) -> Iterator[tuple[int, int]]:
    for run in _ID.finditer(text):
        yield run.span()


FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "id": _ids}


def score(text: str, kind: str, start: int, end: int) -> float:
    """The worth of a span, between 0 and 1, with the words around it."""
    near = f"{text[max(0, start - CONTEXT_CHARS) : start]} {text[end : end + CONTEXT_CHARS]}".lower()
    words = set(_WORD.findall(near))
    worth = BASE_SCORE[kind]
    worth += BONUS * (not words.isdisjoint(CONTEXT[kind]))
    worth -= MALUS * (not words.isdisjoint(AGAINST))
    return min(1.0, max(0.0, worth))


def spans_of(text: str | None, min_score: float = MIN_SCORE) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of all personal data, by start, then by kind."""
    text = text or ""
    found = []
    for order, kind in enumerate(KINDS):
        for start, end in FINDERS[kind](text):
            worth = score(text, kind, start, end)
            if order < 4 or worth >= min_score:
                found.append((start, order, end, kind, worth))
    return [(start, end, kind, worth) for start, _, end, kind, worth in sorted(found)]


def mask(text: str | None, spans: list[tuple[int, int, str, float]]) -> str | None:
    """The text with every span replaced by the name of its kind; of overlapping spans the first one names it."""
    if text is None or not spans:
        return text
    parts, at = [], 0
    for start, end, kind, _ in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _listed(spans: list[tuple[int, int, str, float]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in spans)


OUT = "doc_id {id}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores string"


def pii_spans(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per row of `documents` (doc_id, text): counts and digest of the base spans, all spans, their scores."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                spans = spans_of(text.as_py(), min_score)
                base = [s for s in spans if s[2] in KINDS[:4]]
                counts = [sum(s[2] == kind for s in base) for kind in KINDS[:4]]
                digest = hashlib.sha256(_listed(base).encode()).hexdigest()
                rows.append((*counts, digest, _listed(spans), ",".join(f"{s[3]:.2f}" for s in spans)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores"],
            )

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return map_batches(documents.select("doc_id", "text"), work, OUT.format(id=id_type))


def mask_pii(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """`documents` with personal data in `text` replaced; every other column and every row stays as it is."""
    place = documents.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(place)]
            masked = [mask(t, spans_of(t, min_score)) for t in texts]
            yield batch.set_column(place, batch.schema.field(place), pa.array(masked, batch.schema.field(place).type))

    return map_batches(documents, work, documents.schema)
