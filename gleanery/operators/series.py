"""Recurring events: rhythms to days, and days of one event back to one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.dates import occurrences, parse_repeat


def expand_repeat(events: DataFrame, today: Column) -> DataFrame:
    """A row for each day of a readable rhythm from today on; a rhythm that gives no two days leaves one day; others pass through.

    Columns: date_start, date_end, repeat. Rhythms are read row by row: few are distinct, so a join on them would deal all events to few tasks.
    """
    events = events.withColumn("_rule", parse_repeat(F.col("repeat")))
    rule = F.col("_rule")
    readable = rule.isNotNull() & F.col("date_end").isNotNull() & (F.col("date_end") > F.col("date_start"))
    days = F.when(readable, occurrences(rule, F.greatest(F.col("date_start"), today), F.col("date_end")))
    has = F.coalesce(F.col("repeat"), F.lit("")) != ""
    marked = events.withColumn("_days", days).withColumn("_has", has)
    listed = F.when(F.size("_days") > 1, F.col("_days")).otherwise(F.array(F.coalesce(F.try_element_at("_days", F.lit(1)), F.col("date_start"))))
    out = marked.withColumn("_day", F.explode(F.when(F.col("_has"), listed).otherwise(F.array(F.col("date_start")))))
    end = F.when(F.col("_has"), F.lit(None).cast("date")).otherwise(F.col("date_end"))
    return out.withColumn("date_start", F.col("_day")).withColumn("date_end", end).withColumn("repeat", F.when(F.col("_has"), F.lit("")).otherwise(F.col("repeat"))).drop("_day", "_days", "_has", "_rule")


def fold_series(events: DataFrame, identity: list[str]) -> DataFrame:
    """Rows that differ in their day alone become one with all days: that of the earliest day. Spans stay as they are.

    Returns identity, date_start, date_end, dates (null for a lone row), pos and n_rows. Columns: pos, date_start, date_end.
    """
    single = events.where(F.col("date_end").isNull())
    first = F.min_by(F.struct("date_start", "pos"), F.struct("date_start", "pos"))
    folded = single.groupBy(*identity).agg(first.alias("f"), F.array_sort(F.collect_set("date_start")).alias("days"), F.count("*").alias("n_rows"))
    one = folded.select(*identity, F.col("f.date_start").alias("date_start"), F.lit(None).cast("date").alias("date_end"), F.when(F.col("n_rows") > 1, F.col("days")).alias("dates"), F.col("f.pos").alias("pos"), "n_rows")
    spans = events.where(F.col("date_end").isNotNull()).select(*identity, "date_start", "date_end", F.lit(None).cast("array<date>").alias("dates"), "pos", F.lit(1).cast("long").alias("n_rows"))
    return one.unionByName(spans)
