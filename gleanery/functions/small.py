"""Small column functions: tags, ellipses, keys of posters, ladders of addresses, shares and steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.urls import host

#: Words before a page's number in a path, and parameters that hold one, as patterns. Fixed values.
PAGED = "[?&](?:page|p|strona|pg|start|offset)=[0-9]+|/(?:page|strona|pg)/[0-9]+"


def strip_tags(html: Column) -> Column:
    """The text without tags, white space made single."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]*>", " "), "[ \\t\\n\\r\\f]+", " "))


def shortened(text: Column, most: int) -> Column:
    """At most so many characters, the last an ellipsis if some are left out."""
    return F.when(F.length(text) > most, F.concat(F.rtrim(F.substring(text, 1, most - 1)), F.lit("…"))).otherwise(text)


def escaped(text: Column) -> Column:
    """The text with the five characters that markup reserves written out."""
    out = text
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def poster_key(url: Column) -> Column:
    """Under which a poster is remembered: host and path, so that signed parameters don't count; null for what is no address."""
    where = F.regexp_extract(url, "^https?://([^?#]+)", 1)
    return F.when(where != "", F.concat(F.lit("fbposter:"), where))


def is_paged(url: Column) -> Column:
    """Whether an address is a page of a list: by a parameter or by its path."""
    return url.rlike(PAGED)


def variants(url: Column) -> Column:
    """The address with its scheme and its www. as they are and flipped, itself first."""
    rest = F.regexp_replace(url, "^https?://(www\\.)?", "")
    secure, www = url.startswith("https://"), F.regexp_replace(url, "^https?://", "").startswith("www.")
    scheme = lambda own: F.when(secure == F.lit(own), "https://").otherwise("http://")
    prefix = lambda own: F.when(www == F.lit(own), "www.").otherwise("")
    return F.array(*[F.concat(scheme(s), prefix(w), rest) for s, w in ((True, True), (True, False), (False, True), (False, False))])


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """Part of a whole; nought of nothing."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(part / whole, digits))


def nice_step(most: Column, steps: int = 4) -> Column:
    """The least of 1, 2 and 5 times a power of ten that reaches ``most`` in so many steps."""
    raw = most / steps
    power = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    ratio = raw / power
    return F.when(most <= 0, F.lit(1.0)).otherwise(power * F.when(ratio <= 1, 1).when(ratio <= 2, 2).when(ratio <= 5, 5).otherwise(10))


def daily_share(monthly: Column, others_daily: Column) -> Column:
    """What is left of a month's budget for a day after what the rest spends; never below nought."""
    return F.greatest(F.lit(0.0), monthly / 30 - others_daily)


def fetch_price(cost: Column, fetches: Column, limit: Column, rate: float) -> Column:
    """What a fetch costs: as measured, or else by the limit of records and their rate."""
    return F.when(fetches > 0, cost / fetches).otherwise(limit * rate)


def holds_either(fields: list[Column], town: Column) -> Column:
    """Whether one of the fields holds the town's name, or the name holds it; empty fields hold nothing."""
    out = F.lit(False)
    for f in fields:
        out = out | F.coalesce((F.length(f) > 0) & (F.lower(f).contains(F.lower(town)) | F.lower(town).contains(F.lower(f))), F.lit(False))
    return out


def looks_like_town(text: Column) -> Column:
    """One to three words that start with a capital and hold letters and hyphens alone."""
    return text.rlike("^\\p{Lu}[\\p{L}-]+( \\p{Lu}?[\\p{L}-]+){0,2}$")


def same_host(url: Column, other: Column) -> Column:
    return (host(url) != "") & (host(url) == host(other))


def dates_in(text: Column) -> Column:
    """All days written as yyyy-mm-dd, or as dd.mm.yyyy, in the text; what is no day is left out."""
    iso = F.transform(F.regexp_extract_all(text, F.lit("(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}"), F.lit(0)), lambda d: F.try_to_timestamp(d, F.lit("yyyy-MM-dd")).cast("date"))
    dotted = F.transform(F.regexp_extract_all(text, F.lit("[0-9]{2}\\.[0-9]{2}\\.(19|20)[0-9]{2}"), F.lit(0)), lambda d: F.try_to_timestamp(d, F.lit("dd.MM.yyyy")).cast("date"))
    return F.filter(F.concat(iso, dotted), lambda d: d.isNotNull())


def worth_reading(dates: Column, today: Column) -> Column:
    """A page with dates is worth it if one isn't past; one without dates always is."""
    return (F.size(dates) == 0) | F.exists(dates, lambda d: d >= today)
