"""State between daily runs, replayed from a log: streaks, first sights, pairs of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def streaks(log: DataFrame, key: str, order: list[str], bad: Column, good: Column) -> DataFrame:
    """The log with streak: how many bad rows in a row end here; a good row ends a streak, others neither count nor end it."""
    w = Window.partitionBy(key).orderBy(*order)
    marked = log.withColumn("_bad", bad.cast("int")).withColumn("_island", F.sum(good.cast("int")).over(w))
    inner = Window.partitionBy(key, "_island").orderBy(*order)
    return marked.withColumn("streak", F.sum("_bad").over(inner)).drop("_bad", "_island")


def first_seen(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Rows with new: whether this is the first day on which the key is seen."""
    return rows.join(rows.groupBy(*keys).agg(F.min(at).alias("_first")), keys).withColumn("new", F.col(at) == F.col("_first")).drop("_first")


def day_pairs(rows: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Each row with the value of the key's row before it."""
    return rows.withColumn("before", F.lag(value).over(Window.partitionBy(key).orderBy(at)))
