"""Loose proposals to registry rows: an ordered table of rules, each of which may mend a row, and the list of those that did."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import slug

#: Kinds of sources and ways to fetch them that the registry knows. Fixed values.
KINDS = ("city_portal", "culture_center", "library", "sports", "venue", "fb_page", "fb_group", "rss", "api", "pdf_program")
WAYS = ("plain", "headless", "pdf", "api", "fb", "fb_group", "fb_event", "rss")


@dataclass(frozen=True)
class Rule:
    """A fix: its name, the rows that need it, and the fields that it sets, as functions of the row so far."""

    name: str
    needed: str
    sets: dict[str, str]


_GROUP = "(?i)^https?://(?:www\\\\.)?facebook\\\\.com/groups/([^/?#]+)"
#: The rules in the order in which they apply; later ones see what earlier ones have set.
RULES: tuple[Rule, ...] = (
    Rule("scheme", "not url rlike '(?i)^https?://'", {"url": "concat('https://', url)"}),
    Rule("group-root", f"url rlike '{_GROUP}' and url <> concat('https://www.facebook.com/groups/', regexp_extract(url, '{_GROUP}', 1))", {"url": f"concat('https://www.facebook.com/groups/', regexp_extract(url, '{_GROUP}', 1))"}),
    Rule("group-fetch", "url rlike '(?i)facebook\\\\.com/groups/' and fetch <> 'fb_group'", {"fetch": "'fb_group'"}),
    Rule("group-type", "url rlike '(?i)facebook\\\\.com/groups/' and type <> 'fb_group'", {"type": "'fb_group'"}),
    Rule("page-fetch", "url rlike '(?i)^https?://(?:www\\\\.)?facebook\\\\.com/' and not url rlike '(?i)facebook\\\\.com/groups/' and fetch <> 'fb'", {"fetch": "'fb'"}),
    Rule("unknown-fetch", f"fetch not in {WAYS}", {"fetch": "'plain'"}),
    Rule("unknown-type", f"type not in {KINDS}", {"type": "'venue'"}),
)

#: Why a proposal is turned down: the first that holds. Fixed values, in order.
REFUSALS = ("not-object", "no-url", "not-an-address", "unparsable", "no-name", "no-id")


def mended(rows: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows after all rules, with the names of those that applied as ``fixes``, in order. A rule whose condition is null doesn't apply."""
    flags = [f"_fix_{k}" for k in range(len(rules))]
    for flag, rule in zip(flags, rules):
        rows = rows.withColumn(flag, F.coalesce(F.expr(rule.needed), F.lit(False)))
        rows = rows.withColumns({field: F.when(F.col(flag), F.expr(to)).otherwise(F.col(field)) for field, to in rule.sets.items()})
    fixes = F.array_compact(F.array(*[F.when(F.col(f), F.lit(r.name)) for f, r in zip(flags, rules)]))
    return rows.withColumn("fixes", fixes).drop(*flags)


def _text(record: Column, name: str) -> Column:
    """A field that is a text and isn't blank, trimmed."""
    value = F.try_variant_get(record, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.nullif(F.trim(F.try_variant_get(record, f"$.{name}", "string")), F.lit("")))


def proposals(raw: DataFrame, rules: Sequence[Rule] = RULES, body: str = "body", town: str = "town") -> DataFrame:
    """The rows of ``raw`` with id, name, type, url, place, fetch, confidence, notes, fixes and refused: proposals (JSON, and the town that was asked about) as registry rows.

    refused names the first reason against a row, and is null for good ones; the other columns of refused rows are null. A proposal's own town comes before the
    one that was asked about; the id is a slug of the proposed one, or of town and name; a confidence that is a number is cut to 0 to 1. ``{page}`` in an
    address stands for a number.
    """
    r = F.try_parse_json(F.col(body))
    number = F.try_variant_get(F.col("_r"), "$.confidence", "variant")
    confident = F.when(F.schema_of_variant(number).rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(F.col("_r"), "$.confidence", "double"))
    told = raw.withColumn("_r", r)
    text = lambda n: _text(F.col("_r"), n)
    told = told.select(*raw.columns, F.schema_of_variant("_r").startswith("OBJECT").alias("_object"), text("url").alias("url"), text("name").alias("name"), F.coalesce(text("fetch"), F.lit("")).alias("fetch"), F.coalesce(text("type"), F.lit("")).alias("type"), text("id").alias("_id"), text("town").alias("_town"), F.when(confident.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), confident))).alias("confidence"), text("notes").alias("notes"))
    place = F.coalesce("_town", F.col(town))
    told = told.withColumn("_told", F.col("url")).withColumn("id", F.nullif(slug(F.coalesce("_id", F.concat_ws("-", F.col(town), "name"))), F.lit(""))).withColumn("place", place)
    fixed = mended(told, rules)
    scheme = F.col("_told").rlike("(?i)^https?://")
    whole = F.replace(F.col("url"), F.lit("{page}"), F.lit("1")).rlike("^[A-Za-z]+://[^/?#\\s]+([/?#]|$)")
    checks = (~F.coalesce("_object", F.lit(False)), F.col("_told").isNull(), ~(scheme | F.col("_told").rlike("(?i)^[\\w.-]+\\.[a-z]{2,}")), ~whole, F.col("name").isNull(), F.col("id").isNull())
    refused = F.coalesce(*[F.when(F.coalesce(c, F.lit(True)), F.lit(name)) for name, c in zip(REFUSALS, checks)])
    fixed = fixed.withColumn("refused", refused)
    good = lambda c: F.when(F.col("refused").isNull(), F.col(c)).alias(c)
    return fixed.select(*raw.columns, *[good(c) for c in ("id", "name", "type", "url", "place", "fetch", "confidence", "notes", "fixes")], "refused")
