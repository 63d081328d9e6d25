"""Days, rhythms and the days they fall on, column to column. Today is always given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions.text import deascii

#: How the names of days begin, Sunday first (0). Fixed values.
DAY_STARTS = (("nd", "niedz"), ("pn", "pon"), ("wt",), ("sr",), ("cz",), ("pt", "pia"), ("sb", "sob"))
#: The days' plural names, Sunday first. Fixed values.
DAY_NAMES = ("niedziele", "poniedziałki", "wtorki", "środy", "czwartki", "piątki", "soboty")


def day_of_week(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(day) - 1


def short_day(day: Column) -> Column:
    """Day and two-digit month."""
    return F.concat(F.dayofmonth(day).cast("string"), F.lit("."), F.lpad(F.month(day).cast("string"), 2, "0"))


def span_days(start: Column, end: Column) -> Column:
    """Days from start to end, both counted; null without an end."""
    return F.datediff(end, start) + 1


def last_day(dates: Column | None, start: Column, end: Column) -> Column:
    last = F.try_element_at(dates, F.lit(-1)) if dates is not None else F.lit(None).cast("date")
    return F.coalesce(last, end, start)


def parse_repeat(raw: Column) -> Column:
    """Sorted days of the week of a rhythm (all seven: daily), or null: one word that isn't a day voids it all."""
    text = F.trim(deascii(F.coalesce(raw, F.lit(""))))
    parts = F.filter(F.split(text, "[,;/\\s]+"), lambda w: w != "")

    def number(word: Column) -> Column:
        out = F.lit(None).cast("int")
        for day, starts in enumerate(DAY_STARTS):
            hit = F.lit(False)
            for start in starts:
                hit = hit | word.startswith(start)
            out = F.coalesce(out, F.when(hit, F.lit(day)))
        return out

    days = F.array_sort(F.array_distinct(F.transform(parts, number)))
    every = F.array(*[F.lit(d) for d in range(7)])
    return F.when(text.startswith("codzienn"), every).when((F.size(parts) > 0) & ~F.exists(days, lambda d: d.isNull()), days)


def occurrences(days: Column, start: Column, end: Column, cap: int = CONFIG.series_cap) -> Column:
    """The days from start to end that fall on the given days of the week, at most ``cap``; empty if the range is."""
    every = F.sequence(start, F.greatest(start, end))
    hit = F.slice(F.filter(every, lambda d: F.array_contains(days, day_of_week(d))), 1, cap)
    return F.when(start <= end, hit).otherwise(F.array().cast("array<date>"))


def series_label(dates: Column, listed: int = CONFIG.listed_dates, most: int = CONFIG.label_weekdays) -> Column:
    """A rhythm's name where it yields exactly these days, else the first days; empty for fewer than two.

    Daily, or at most ``most`` days of the week, Monday first.
    """
    first, last = F.try_element_at(dates, F.lit(1)), F.try_element_at(dates, F.lit(-1))
    until = F.concat(F.lit(" do "), short_day(last))
    size = F.size(dates)
    days = F.array_distinct(F.transform(dates, day_of_week))
    every = F.array(*[F.lit(d) for d in range(7)])
    fits = lambda rule: F.slice(F.filter(F.sequence(first, last), lambda d: F.array_contains(rule, day_of_week(d))), 1, 61) == dates
    ordered = F.filter(F.array(*[F.when(F.array_contains(days, (d + 1) % 7), F.lit(DAY_NAMES[(d + 1) % 7])) for d in range(7)]), lambda n: n.isNotNull())
    named = F.when(F.size(ordered) == 1, ordered[0]).otherwise(F.concat(F.array_join(F.slice(ordered, 1, F.size(ordered) - 1), ", "), F.lit(" i "), F.try_element_at(ordered, F.lit(-1))))
    plain = F.concat(F.array_join(F.transform(F.slice(dates, 1, listed), short_day), ", "), F.when(size > listed, F.lit(" …")).otherwise(F.lit("")))
    return F.when(F.coalesce(size, F.lit(0)) < 2, F.lit("")).when(fits(every), F.concat(F.lit("codziennie"), until)).when((F.size(days) <= most) & fits(days), F.concat(named, until)).otherwise(plain)


def occurs_in(dates: Column, start: Column, end: Column, window_start: Column, window_end: Column) -> Column:
    """The days of an event within a window: its listed days there, or one day, clamped to the window, where its span touches it."""
    last = F.coalesce(end, start)
    touching = (start <= window_end) & (last >= window_start)
    return F.when(F.size(F.coalesce(dates, F.array().cast("array<date>"))) > 0, F.filter(dates, lambda d: d.between(window_start, window_end))).when(touching, F.array(F.greatest(start, window_start))).otherwise(F.array().cast("array<date>"))


def overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Whether two closed ranges of days meet; a missing end is the start."""
    return (start_a <= F.coalesce(end_b, start_b)) & (start_b <= F.coalesce(end_a, start_a))
