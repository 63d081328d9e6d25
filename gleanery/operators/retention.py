"""Which rows of a growing collection stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def retain(rows: DataFrame, group: list[str], at: list[Column], recent: Column, least: int, most: int) -> DataFrame:
    """Recent rows of each group, or its newest ``least`` if fewer are recent; of these the newest ``most``. newest counts from 1."""
    order = Window.partitionBy(*group).orderBy(*[c.desc() for c in at])
    marked = rows.withColumn("_recent", F.coalesce(recent, F.lit(False))).withColumn("newest", F.row_number().over(order)).withColumn("_n", F.count_if(F.col("_recent")).over(Window.partitionBy(*group)))
    kept = marked.where(F.when(F.col("_n") >= least, F.col("_recent")).otherwise(F.col("newest") <= least))
    return kept.withColumn("newest", F.row_number().over(order)).where(F.col("newest") <= most).drop("_recent", "_n")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The new rows, and the old ones whose key isn't among them."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
