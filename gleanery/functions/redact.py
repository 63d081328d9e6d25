"""Redaction of e-mail addresses and private phone numbers in records, as column functions.

A text is cut at page addresses, which stay as they are. Between them e-mail addresses are replaced by a mark, then what looks like a phone number is
cut out, judged by its national digits, and put back or replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space of the texts' origin, patterns, marks, and how mobile and landline numbers of the country begin.
SPACE = "\\t\\n\\x0B\\f\\r \\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}"
ADDRESS = f"https?://[^{SPACE}]+"
EMAIL = "[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+(?:\\.[A-Za-z0-9_-]+)+"
PHONE = f"(?:(?:\\+|00)?[{SPACE}]?48[{SPACE}-]?)?[0-9](?:[{SPACE}.-]?[0-9]){{7,10}}"
EMAIL_MARK, PHONE_MARK = "[e-mail w źródle]", "[tel. w źródle]"
MOBILE = ("45", "50", "51", "53", "57", "60", "66", "69", "72", "73", "78", "79", "88")
LANDLINE = ("12", "13", "14", "15", "16", "17", "18", "22", "23", "24", "25", "29", "32", "33", "34", "41", "42", "43", "44", "46", "48", "52", "54", "55", "56", "58", "59", "61", "62", "63", "65", "67", "68", "71", "74", "75", "76", "77", "81", "82", "83", "84", "85", "86", "87", "89", "91", "94", "95")


def national(number: Column) -> Column:
    """The nine digits of a number without the country's prefix; null for any other length."""
    digits = F.regexp_replace(number, F.lit("[^0-9]"), F.lit(""))
    return F.nullif(F.regexp_extract(digits, "^(?:0048|48)?([0-9]{9})$", 1), F.lit(""))


def phone_kind(number: Column) -> Column:
    """'mobile', 'landline' or 'other'; null for what has no nine digits."""
    start = F.substring(national(number), 1, 2)
    return F.when(start.isin(*MOBILE), "mobile").when(start.isin(*LANDLINE), "landline").when(start.isNotNull(), "other")


def is_private(number: Column) -> Column:
    """Whether a number goes: any of nine digits that isn't a landline, which belongs to an institution."""
    return F.coalesce(~F.substring(national(number), 1, 2).isin(*LANDLINE), F.lit(False))


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _put(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """The text with each match of the pattern changed."""
    after = F.concat(F.transform(_found(text, pattern), change), F.array(F.lit("")))
    return F.array_join(F.zip_with(F.split(text, pattern, -1), after, lambda kept, changed: F.concat(kept, changed)), "")


def _between(text: Column) -> Column:
    """The parts between page addresses, e-mail addresses replaced."""
    return F.transform(F.split(text, ADDRESS, -1), lambda part: F.regexp_replace(part, F.lit(EMAIL), F.lit(EMAIL_MARK)))


def redacted(text: Column) -> Column:
    """The text with marks. Page addresses and landlines stay; null stays null."""
    parts = F.transform(_between(text), lambda part: _put(part, PHONE, lambda number: F.when(is_private(number), F.lit(PHONE_MARK)).otherwise(number)))
    changed = F.array_join(F.zip_with(parts, F.concat(_found(text, ADDRESS), F.array(F.lit(""))), lambda part, address: F.concat(part, address)), "")
    # most texts hold neither: one look at the whole tells
    return F.when(~text.contains("@") & ~text.rlike(PHONE), text).otherwise(changed)


def emails_in(text: Column) -> Column:
    """How many e-mail addresses redaction replaces."""
    found = F.size(F.flatten(F.transform(F.split(text, ADDRESS, -1), lambda part: _found(part, EMAIL))))
    return F.when(text.contains("@"), found).otherwise(0)


def phones_in(text: Column) -> Column:
    """How many phone numbers redaction replaces."""
    found = F.size(F.flatten(F.transform(_between(text), lambda part: F.filter(_found(part, PHONE), is_private))))
    return F.when(text.rlike(PHONE), found).otherwise(0)


def redact_events(events: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with the named text columns redacted, and n_emails and n_phones of all of them; a column may be an array of texts."""
    kinds = dict(events.dtypes)
    emails = phones = F.lit(0)
    changed = {}
    for c in columns:
        if kinds[c].startswith("array"):
            total = lambda count, c=c: F.coalesce(F.aggregate(F.transform(c, count), F.lit(0), lambda a, b: a + b), F.lit(0))
            emails, phones = emails + total(emails_in), phones + total(phones_in)
            changed[c] = F.transform(c, redacted)
        else:
            emails, phones = emails + emails_in(F.col(c)), phones + phones_in(F.col(c))
            changed[c] = redacted(F.col(c))
    return events.withColumns({"n_emails": emails, "n_phones": phones}).withColumns(changed)


def email_count(text: Column) -> Column:
    return F.size(_found(text, EMAIL))
