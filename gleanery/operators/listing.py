"""Which links of a page are its entries: the winning shape of addresses, with reasons, and what that says of further pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions.urls import PAGE_PARAMS, path, template_score, url_template

#: What entries below the page's own section are worth more.
SAME_SECTION = 2.2


def _plain(segments: Column) -> Column:
    return F.transform(segments, lambda s: F.lower(F.regexp_replace(s, "(?i)\\.[a-z0-9]{2,5}$", "")))


def sections(url_path: Column) -> Column:
    """The segments of a path, in lower case, without file endings."""
    return _plain(F.filter(F.split(F.substring_index(url_path, "?", 1), "/"), lambda s: s != ""))


def literal_prefix(template: Column) -> Column:
    """The segments of a template before its first slot."""
    every = F.filter(F.split(F.substring_index(template, "?", 1), "/"), lambda s: s != "")
    marks = F.array_position(F.transform(every, lambda s: s.startswith("{")), True)
    return _plain(F.when(marks == 0, every).otherwise(F.slice(every, F.lit(1), F.greatest(marks - 1, F.lit(0)).cast("int"))))


def slot_count(template: Column) -> Column:
    """Slots of a template other than that of a page's number."""
    return F.size(F.regexp_extract_all(template, F.lit("\\{(?:id|date|slug)\\}"), F.lit(0)))


def affinity(template: Column, page_path: Column) -> Column:
    """More than 1 if one of the template's section and the page's path leads to the other; else 1. A template or page at the root says nothing."""
    prefix, base = literal_prefix(template), sections(page_path)
    n = F.least(F.size(prefix), F.size(base))
    return F.when((n > 0) & (F.slice(prefix, F.lit(1), n) == F.slice(base, F.lit(1), n)), SAME_SECTION).otherwise(1.0)


def groups(links: DataFrame) -> DataFrame:
    """page, template, n_urls, content_ratio, slots, section, score of the shapes of each page's links (page, page_url, url, in_nav).

    An address that stands in the menu and in the text counts as text. Score: many addresses, outside of the menu, below a section, in the page's own one, no calendar of days.
    """
    one = links.groupBy("page", "page_url", "url").agg(F.bool_and("in_nav").alias("in_nav"))
    shaped = one.withColumn("template", url_template(F.col("url")))
    told = shaped.groupBy("page", "page_url", "template").agg(F.count("*").alias("n_urls"), F.avg(F.when(F.col("in_nav"), 0.0).otherwise(1.0)).alias("content_ratio"), F.min("url").alias("first_url"))
    near = affinity(F.col("template"), path(F.col("page_url")))
    return told.select("page", "template", "n_urls", "content_ratio", "first_url", slot_count(F.col("template")).alias("slots"), (near > 1).alias("same_section"), (template_score(F.col("n_urls"), F.col("content_ratio"), F.col("template")) * near).alias("score"))


def winners(told: DataFrame, least: int = CONFIG.template_group) -> DataFrame:
    """The shape of each page's entries, one a page, and why: n_rivals shapes were large enough and had slots, and lead is how much better it is than the next.

    Ties go to the larger group, then to the first template by name. Pages without such a shape have no row.
    """
    able = told.where((F.col("n_urls") >= least) & (F.col("slots") >= 1)).withColumn("score", F.round("score", 9))
    order = Window.partitionBy("page").orderBy(F.desc("score"), F.desc("n_urls"), "template")
    ranked = able.withColumn("r", F.row_number().over(order)).withColumn("next", F.lead("score").over(order)).withColumn("n_rivals", F.count("*").over(Window.partitionBy("page")) - 1)
    return ranked.where("r = 1").withColumn("lead", F.col("score") - F.coalesce("next", F.lit(0.0))).drop("r", "next")


def page_candidates(pages: DataFrame) -> DataFrame:
    """page, place, template: addresses of further pages that a page (page, page_url) without a linked pager may have, a parameter each, with {page} for the number.

    A parameter that is there gets the slot as its value; a fragment goes.
    """
    url = F.regexp_replace("page_url", "#.*$", "")
    names = F.array(*[F.struct(F.lit(k).alias("place"), F.lit(n).alias("name")) for k, n in enumerate(PAGE_PARAMS)])
    each = pages.select("page", url.alias("_u"), F.explode(names).alias("c")).select("page", "_u", "c.place", "c.name")
    head, kept = F.substring_index("_u", "?", 1), F.filter(F.split(F.regexp_extract("_u", "\\?(.*)$", 1), "&"), lambda p: p != "")
    mine = lambda p: F.substring_index(p, "=", 1) == F.col("name")
    slot = F.concat("name", F.lit("={page}"))
    there = F.exists(kept, mine)
    changed = F.when(there, F.transform(kept, lambda p: F.when(mine(p), slot).otherwise(p))).otherwise(F.concat(kept, F.array(slot)))
    return each.select("page", "place", F.concat(head, F.lit("?"), F.array_join(F.array_distinct(changed), "&")).alias("template"))


def next_pages(base: DataFrame, candidates: DataFrame, shapes: DataFrame, least_new: int = CONFIG.new_links) -> DataFrame:
    """page, candidate, n_entries, n_new, verdict: is a captured candidate (page, candidate, url: a link each) a further page of the listing whose links are base (page, url)?

    Entries are links of the page's own shape. "next" with enough that the page doesn't have; "same" with too few; "none" if the candidate has no entries; "no-listing" if the page has no shape.
    """
    shape = shapes.select("page", "template")
    entries = lambda links, *by: links.withColumn("template", url_template(F.col("url"))).join(shape, ["page", "template"]).select(*by, "url").distinct()
    own = entries(base, "page").withColumn("known", F.lit(True))
    found = entries(candidates, "page", "candidate").join(own, ["page", "url"], "left")
    counted = found.groupBy("page", "candidate").agg(F.count("*").alias("n_entries"), F.count_if(F.col("known").isNull()).alias("n_new"))
    every = candidates.select("page", "candidate").distinct().join(counted, ["page", "candidate"], "left").join(shape, "page", "left")
    n, new = F.coalesce("n_entries", F.lit(0)), F.coalesce("n_new", F.lit(0))
    verdict = F.when(F.col("template").isNull(), "no-listing").when(n == 0, "none").when(new < least_new, "same").otherwise("next")
    return every.select("page", "candidate", n.alias("n_entries"), new.alias("n_new"), verdict.alias("verdict"))


def entrypoints(measured: DataFrame, asked: DataFrame, least_confidence: float = CONFIG.min_confidence) -> DataFrame:
    """source_id, url, via, confidence: a source's way in, decided on a ladder.

    Measured candidates (source_id, url, n_entries, n_dated, hint) come first: the one with most dated entries, if it has any, then the one with most entries of at least a group, both "measured" with a confidence by the share of dated ones. Only where nothing measures, a model's answer (source_id,
    url, confidence) is taken if it is sure enough and among the candidates: "asked". Ties go to the better hint, then to the shorter address, then to the first by name. Sources with neither have no row.
    """
    good = measured.where((F.col("n_dated") > 0) | (F.col("n_entries") >= CONFIG.template_group))
    order = Window.partitionBy("source_id").orderBy(F.desc("n_dated"), F.desc("n_entries"), F.desc("hint"), F.length("url"), "url")
    sure = F.least(F.lit(1.0), F.when(F.col("n_dated") > 0, 0.5 + 0.5 * F.col("n_dated") / F.greatest("n_entries", "n_dated")).otherwise(0.5))
    best = good.withColumn("r", F.row_number().over(order)).where("r = 1").select("source_id", "url", F.lit("measured").alias("via"), sure.alias("confidence"))
    answers = asked.where(F.col("confidence") >= least_confidence).join(measured.select("source_id", "url").distinct(), ["source_id", "url"], "left_semi").join(best.select("source_id"), "source_id", "left_anti")
    first = Window.partitionBy("source_id").orderBy(F.desc("confidence"), F.length("url"), "url")
    told = answers.withColumn("r", F.row_number().over(first)).where("r = 1").select("source_id", "url", F.lit("asked").alias("via"), F.col("confidence").cast("double").alias("confidence"))
    return best.unionByName(told)
