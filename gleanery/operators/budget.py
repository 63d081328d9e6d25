"""Budgets over ranked rows, packing, floors and limits."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from gleanery.config import CONFIG


def greedy_budget(rows: DataFrame, order: list[str], cost: str, budget: float) -> DataFrame:
    """Rows with rank and fits: in order, a row that fits what is left takes its cost, and one that doesn't is passed over.

    The walk is sequential by nature: a registry's rows, sorted, stream through one task that holds a sum and no rows.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spent, rank = 0.0, 0
        for batch in batches:
            ranks, fits = [], []
            for x in batch[cost]:
                rank += 1
                ok = spent + x <= budget
                spent = spent + x if ok else spent
                ranks.append(rank)
                fits.append(ok)
            yield batch.assign(rank=ranks, fits=fits).astype({"rank": "int32"})

    schema = StructType([*rows.schema.fields, StructField("rank", IntegerType()), StructField("fits", BooleanType())])
    return rows.repartition(1).sortWithinPartitions(*order).mapInPandas(walk, schema)


def greedy_chunks(sizes: Column, cap: int) -> Column:
    """For an array of sizes the number of the chunk of each: a new one begins where the sum would pass the cap."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("chunk"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        new = (acc["sum"] > 0) & (acc["sum"] + x > cap)
        chunk = F.when(new, acc["chunk"] + 1).otherwise(acc["chunk"])
        return F.struct(F.when(new, x).otherwise(acc["sum"] + x).cast("long").alias("sum"), chunk.alias("chunk"), F.array_append(acc["out"], chunk).alias("out"))

    return F.aggregate(sizes, start, step)["out"]


def town_floor(rows: DataFrame, town: str, alive: Column, rescuable: Column, order: list[Column], floor: int = CONFIG.town_floor) -> DataFrame:
    """Rows with verdict 'town-floor' where a town has fewer live sources than the floor: the cheapest that can be rescued."""
    marked = rows.withColumn("_alive", alive).withColumn("_can", rescuable & ~alive)
    n = F.count_if(F.col("_alive")).over(Window.partitionBy(town))
    rank = F.row_number().over(Window.partitionBy(town, "_can").orderBy(*order))
    rescued = F.col("_can") & (rank <= F.lit(floor) - n)
    return marked.withColumn("rescued", rescued).drop("_alive", "_can")


def next_limit(records: Column, used: Column, span: Column, at_limit: Column, gap: Column, config=CONFIG) -> Column:
    """How many posts to ask of a group next time, from how many came, over which days, and whether the limit was met."""
    margin = 1 + config.group_margin
    need = F.greatest(F.lit(1.0), F.round(gap)) * margin
    raw = F.when(~at_limit, F.ceil(records * margin)).when(span >= need, F.ceil(records / span * need)).otherwise(F.ceil(used * margin * need / F.greatest(span, F.lit(0.1))))
    return F.least(F.greatest(raw, F.lit(config.group_limit_min)), F.lit(config.group_limit_max)).cast("long")
