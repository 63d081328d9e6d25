"""Loose values to typed ones, and JSON that models cut short."""

from __future__ import annotations

import html
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Named entities that are undone; others stay. Fixed values.
ENTITIES = ("amp", "lt", "gt", "quot", "apos", "nbsp", "ndash", "mdash", "hellip", "bdquo", "rdquo", "ldquo", "rsquo", "lsquo", "oacute")
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|(?:" + "|".join(ENTITIES) + r"));")


def decode_entities(text: str | None) -> str | None:
    """Numeric and the known named entities undone, white space squeezed."""
    if text is None:
        return None
    return re.sub(r"\s+", " ", _ENTITY.sub(lambda m: html.unescape(m.group()), text)).strip()


def decoded(text: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(decode_entities), "string")(text)


def salvage(text: str | None) -> list[str]:
    """Complete objects of a JSON array that may be cut or damaged: braces are matched outside of strings; after damage it goes on at the next object
    that begins a line. Each comes back as its own text, in order."""
    out: list[str] = []
    if not text:
        return out
    at = text.find("[")
    at = text.find("{", at + 1)
    while at >= 0:
        depth, quoted, escaped, end = 0, False, False, -1
        for k in range(at, len(text)):
            c = text[k]
            if quoted:
                quoted = escaped or c != '"'
                escaped = c == "\\" and not escaped
            elif c == '"':
                quoted, escaped = True, False
            elif c == "{":
                depth += 1
            elif c == "}":
                depth -= 1
                if not depth:
                    end = k + 1
                    break
        piece = text[at:end] if end > 0 else ""
        try:
            json.loads(piece)
        except ValueError:
            after = text.find("\n{", at + 1)
            at = after + 1 if after >= 0 else -1
            continue
        out.append(piece)
        at = text.find("{", end)
    return out


def salvaged(text: Column) -> Column:
    """Array of the complete objects' texts. Texts are long, so they go to Python a hundred at a time and not in Arrow's batches of ten thousand."""
    return F.udf(salvage, "array<string>", useArrow=False)(text)


def parse_verdict(text: Column) -> Column:
    """'no-json', 'truncated', 'bad-json' or 'ok' of a model's answer."""
    body = F.regexp_extract(F.coalesce(text, F.lit("")), "(?s)(\\{.*\\}|\\{.*)", 1)
    good = F.try_parse_json(body).isNotNull()
    return F.when(body == "", "no-json").when(good, "ok").when(~body.endswith("}"), "truncated").otherwise("bad-json")


def clock_parts(value: Column) -> Column:
    """Struct (day, time) of an ISO moment, a day with a time, or Unix seconds; the time only where it was told."""
    iso = F.regexp_extract(value, "^([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    time = F.nullif(F.regexp_extract(value, "^[0-9-]{10}[T ]([0-9]{2}:[0-9]{2})", 1), F.lit(""))
    seconds = F.when(value.rlike("^[0-9]{9,10}$"), F.timestamp_seconds(value.try_cast("long")))
    day = F.when(iso != "", F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date")).otherwise(seconds.cast("date"))
    return F.struct(day.alias("day"), F.when(iso != "", time).otherwise(F.date_format(seconds, "HH:mm")).alias("time"))


def strip_all_day(start: Column, end: Column) -> tuple[Column, Column]:
    """No times for an event from 00:00 to 23:59 or to nothing."""
    whole = (start == "00:00") & (end.isNull() | (end == "23:59"))
    return F.when(~F.coalesce(whole, F.lit(False)), start), F.when(~F.coalesce(whole, F.lit(False)), end)


def venue_of(name: Column, address: Column) -> Column:
    """The name with the address, unless one holds the other."""
    n, a = F.coalesce(name, F.lit("")), F.coalesce(address, F.lit(""))
    return F.when(n.contains(a), n).when(a.contains(n), a).otherwise(F.concat_ws(", ", n, a))


def fix_calendar_links(text: Column) -> Column:
    """Links into calendars whose start is their end lose their time."""
    return F.regexp_replace(text, "(dates=)([0-9]{8})T([0-9]{6})Z?(/|%2F)\\2T\\3Z?", "$1$2$4$2")


def validated(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with reasons: the names of the rules they break."""
    return rows.withColumn("reasons", F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])))


def filled(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Missing values by the default of their field."""
    return rows.withColumns({c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)) for c, v in defaults.items()})
