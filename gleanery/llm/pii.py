"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import spans
from gleanery.llm.spans import Span

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "card_part", "phone_part", "phone_local", "ssn")

# Each pattern runs in time linear in the text: a run of its characters is read a fixed number of times.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[. -])[0-9]{3}[. -][0-9]{4}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_GROUP = re.compile(r"[0-9]+")
_WORD = re.compile(r"[a-z]+")

#: Score of a proposal, what a checksum adds, what a word nearby adds or takes, and from which score a span counts.
START, CONFIRMED, WORD_NEAR, KEEP = 0.5, 0.4, 0.3, 0.6
#: How far words count as near, in code points.
NEAR = 40
#: Words that make a kind likelier, and words that make any kind less likely. Fixed values.
HINTS = {
    "email": {"mail", "email", "contact", "contacto", "kontakt", "courriel", "correo"},
    "ip": {"ip", "address", "host", "server", "from", "client"},
    "card": {"card", "visa", "mastercard", "credit", "carte", "karte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "llamar"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
}
AGAINST = {"version", "isbn", "order", "invoice", "id", "build", "serial"}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of international account numbers: letters count as 10 to 35, the first four characters go last."""
    rest = 0
    for c in code[4:] + code[:4]:
        value = int(c, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def emails(text: str) -> list[tuple[int, int]]:
    out, floor = [], 0
    at = text.find("@")
    while at >= 0:
        after = at + 1
        if domain := _DOMAIN.match(text, after):
            start = at
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, domain.end()))
                floor = after = domain.end()
        at = text.find("@", after)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    def small(part: str) -> bool:
        part = part.lstrip("0")
        return len(part) < 4 and int(part or "0") <= 255

    return [m.span() for m in _IP.finditer(text) if all(map(small, m.group().split(".")))]


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def numbers(text: str, pattern: re.Pattern, least: int, most: int, check=None) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Matches whose digits are in range and pass; and those with too many digits or a failed check."""
    good, failed = [], []
    for m in pattern.finditer(text):
        start, end = m.span()
        if end - start < least:
            continue
        digits = _digits(m.group())
        if least <= len(digits) <= most and (check is None or check(digits)):
            good.append((start, end))
        elif len(digits) > least:
            failed.append((start, end))
    return good, failed


def card_parts(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """In a failed run, stretches of whole digit groups that are a card number; leftmost, longest, without overlap."""
    groups = [m.span() for m in _GROUP.finditer(text, start, end)]
    k = 0
    while k < len(groups):
        best, size, digits = None, 0, ""
        for j in range(k, len(groups)):
            size += groups[j][1] - groups[j][0]
            if size > 19:
                break
            digits += text[groups[j][0] : groups[j][1]]
            if size >= 14 and luhn(digits):
                best = j
        if best is None:
            k += 1
        else:
            yield groups[k][0], groups[best][1]
            k = best + 1


def phone_part(text: str, start: int, end: int) -> tuple[int, int] | None:
    """In a failed match, the fewest leading digit groups with 10 to 15 digits."""
    size = 0
    for m in _GROUP.finditer(text, start, end):
        size += m.end() - m.start()
        if size > 15:
            return None
        if size >= 10:
            return start, m.end()
    return None


def _near(text: str, kind: str, start: int, end: int) -> float:
    words = set(_WORD.findall(f"{text[max(0, start - NEAR) : start]} {text[end : end + NEAR // 2]}".lower()))
    return WORD_NEAR * bool(words & HINTS[kind.partition("_")[0]]) - WORD_NEAR * bool(words & AGAINST)


def find(text: str) -> list[Span]:
    """All spans of a text. The base kinds are always reported, with a score; the added kinds only from a score of KEEP."""
    out: list[Span] = []

    def add(kind: str, where, confirmed: bool, always: bool) -> None:
        start, end = where
        score = min(1.0, max(0.0, START + CONFIRMED * confirmed + _near(text, kind, start, end)))
        if always or score >= KEEP:
            out.append((kind, start, end, round(score, 3)))

    for where in emails(text):
        add("email", where, True, True)
    for where in ips(text):
        add("ip", where, False, True)
    cards, failed = numbers(text, _CARD, 14, 19, luhn)
    for where in cards:
        add("card", where, True, True)
    for where in failed:
        for part in card_parts(text, *where):
            add("card_part", part, True, False)
    phones, failed = numbers(text, _PHONE, 10, 15)
    for where in phones:
        add("phone", where, False, True)
    for where in failed:
        if part := phone_part(text, *where):
            add("phone_part", part, True, False)
    taken = spans.Taken(out)
    for m in _IBAN.finditer(text):
        code = m.group().replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            add("iban", m.span(), True, False)
    for kind, pattern in (("phone_local", _LOCAL_PHONE), ("ssn", _SSN)):
        for m in pattern.finditer(text):
            if not taken.meets(*m.span()):
                add(kind, m.span(), False, False)
    return out


def find_documents(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end, score, value) of every whole text.

    A null or empty text has no spans; equal rows give equal rows; an empty table gives none; other columns don't matter.
    """
    return spans.find_in(docs, find)


def digest_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row; nulls and empty texts as in find_documents."""
    return spans.digest_of(docs, find, BASE, ADDED)


def redacted(text: str) -> str:
    """The text with the name of its kind in place of each span; where spans overlap, the first and longest names it."""
    out, at = [], 0
    for kind, start, end, _ in sorted(find(text), key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.partition('_')[0].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, column: str = "text") -> DataFrame:
    """All rows and columns, with personal data in the text replaced; n_chars, if there, follows the new text.

    A null text stays null.
    """
    at = docs.columns.index(column)

    def run(where: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([None if x is None else redacted(x) for x in batch.column(where).to_pylist()], batch.column(where).type)
            yield batch.set_column(where, batch.schema.field(where), new)

    out = docs.mapInArrow(partial(run, at), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(column).isNull(), F.col("n_chars")).otherwise(F.length(column)).cast(docs.schema["n_chars"].dataType))
    return out
