"""Addresses: keys, hosts and templates, column to column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that come before a page's number in a path, and parameters that hold one. Fixed values.
PAGE_WORDS = ("page", "strona", "pg")
PAGE_PARAMS = ("page", "p", "strona", "pg", "start", "offset")


def host(url: Column) -> Column:
    """Lower-case host and port without a leading www.; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), "^www\\.", "")


def path(url: Column) -> Column:
    """The path without trailing slashes."""
    return F.regexp_replace(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")


def params(url: Column) -> Column:
    """The parameters as an array of name=value."""
    return F.filter(F.split(F.regexp_extract(url, "\\?([^#]*)", 1), "&"), lambda p: p != "")


def url_key(url: Column) -> Column:
    """What tells pages apart: host, lower-case path and sorted parameters but for page templates; no scheme, www., fragment or trailing slash."""
    kept = F.array_sort(F.filter(params(url), lambda p: ~p.contains("{page}")))
    full = F.concat(host(url), F.lower(path(url)), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    plain = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "^[hH][tT][tT][pP][sS]?://", ""), "^[wW][wW][wW]\\.", ""), "/+$", ""))
    return F.when(host(url) != "", full).otherwise(plain)


def _slot(segment: Column) -> Column:
    ext = F.regexp_extract(segment, "(?i)^.*?(\\.[a-z0-9]{2,5})?$", 1)
    stem = F.regexp_replace(segment, "(?i)\\.[a-z0-9]{2,5}$", "")
    kind = (
        F.when(stem.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "{date}")
        .when(stem.rlike("^[0-9]+$"), "{id}")
        .when(stem.contains("-") & ((F.length(stem) >= 10) | stem.rlike("[0-9]")), "{slug}")
        .when(F.length(stem) >= 24, "{slug}")
    )
    return F.coalesce(F.concat(kind, ext), segment)


def url_template(url: Column) -> Column:
    """The path with values as slots and the sorted parameter names; a page's number is a slot of its own."""
    segments = F.filter(F.split(F.lower(path(url)), "/"), lambda s: s != "")

    def slot(segment: Column, at: Column) -> Column:
        before = F.when(at > 0, F.get(segments, at - 1))
        page = before.isin(*PAGE_WORDS) & segment.rlike("^[0-9]+$")
        return F.when(F.coalesce(page, F.lit(False)), F.lit("{page}")).otherwise(_slot(segment))

    def param(p: Column) -> Column:
        name = F.substring_index(p, "=", 1)
        return F.when(F.lower(name).isin(*PAGE_PARAMS), F.concat(name, F.lit("={page}"))).otherwise(p)

    query = F.array_join(F.transform(F.array_sort(params(url)), param), "&")
    return F.concat(F.lit("/"), F.array_join(F.transform(segments, slot), "/"), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def template_score(n_urls: Column, content_ratio: Column, template: Column) -> Column:
    """How likely a group of addresses is a list of entries: many, outside of menus, below a section, not a calendar."""
    depth = F.size(F.filter(F.split(F.substring_index(template, "{", 1), "/"), lambda s: s != ""))
    only_date = template.contains("{date}") & ~template.rlike("\\{(?:id|slug)\\}")
    return F.log2(1 + n_urls) * (F.lit(0.35) + F.lit(0.65) * content_ratio) * F.when(depth >= 1, 1.0).otherwise(0.55) * F.when(only_date, 0.4).otherwise(1.0)
