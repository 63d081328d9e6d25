"""The ledger written anew from reports of runs: entries by category, and totals attributed to tasks so that sums stay exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG

#: Tasks of a run and the categories they are booked under. Fixed values.
CATEGORIES = {"extract": "llm-extract", "poster": "llm-vision", "discover": "llm-discover", "verify": "llm-verify"}


def backfilled(lines: DataFrame, record_rate: float = CONFIG.record_rate) -> DataFrame:
    """run_id, category, usd, estimated, inferred, units, unit, tokens_in, tokens_out, n_drivers of each run's report.

    Lines (run_id, source_id, task, calls, usd, tokens_in, tokens_out, records) are a run's sources by task. A run with tasks is booked by them. An older one, all of
    whose tasks are null, is booked under "llm-extract" as inferred: the sum is true, where it belongs is not known. Records of a provider are booked at their rate, as an estimate. Lines without calls or
    records book nothing.
    """
    told = Window.partitionBy("run_id")
    known = lines.withColumn("_known", F.max(F.col("task").isNotNull()).over(told))
    category = F.create_map(*[F.lit(x) for pair in CATEGORIES.items() for x in pair])
    calls = known.where("calls > 0 and (task is not null or not _known)").withColumn("category", F.coalesce(category[F.col("task")], F.lit("llm-extract")))
    models = calls.groupBy("run_id", "category", (~F.col("_known")).alias("inferred")).agg(F.sum("usd").alias("usd"), F.sum("calls").cast("long").alias("units"), F.sum("tokens_in").cast("long").alias("tokens_in"), F.sum("tokens_out").cast("long").alias("tokens_out"), F.count_distinct("source_id").alias("n_drivers"))
    records = lines.where("records > 0").groupBy("run_id").agg((F.sum("records") * record_rate).alias("usd"), F.sum("records").cast("long").alias("units"), F.count_distinct("source_id").alias("n_drivers"))
    none = F.lit(None).cast("long")
    columns = ("run_id", "category", "usd", "estimated", "inferred", "units", "unit", "tokens_in", "tokens_out", "n_drivers")
    models = models.withColumn("estimated", F.lit(False)).withColumn("unit", F.lit("calls")).select(*columns)
    booked = records.select("run_id", F.lit("fb").alias("category"), "usd", F.lit(True).alias("estimated"), F.lit(False).alias("inferred"), "units", F.lit("records").alias("unit"), none.alias("tokens_in"), none.alias("tokens_out"), "n_drivers")
    return models.unionByName(booked.select(*columns))


def attributed(totals: DataFrame, weights: DataFrame, keys: list[str], part: str, amount: str = "cents") -> DataFrame:
    """The keys, part, amount and inferred of each total, dealt out to its parts by weight, in whole units, so that the parts add up to the total exactly.

    Totals: the keys (once each) and a whole amount, which may be negative; weights: the keys, part and weight. Each part gets its share rounded down, and what is left goes, a unit each,
    to the parts with the largest remainders, ties by name. Null, negative and non-finite weights count as none; where all are none, all parts share alike; a total without parts keeps its row with a null
    part. inferred is true throughout: the sum is told, its parts are a reconstruction.
    """
    weight = F.when((F.col("weight") > 0) & (F.col("weight") < float("inf")) & ~F.isnan(F.col("weight").cast("double")), F.col("weight").cast("double")).otherwise(0.0)
    parts = weights.where(F.col(part).isNotNull()).groupBy(*keys, part).agg(F.sum(weight).alias("_w"))
    joined = totals.select(*keys, F.col(amount).cast("long").alias(amount)).join(parts, keys, "left")
    group = Window.partitionBy(*keys)
    all_of = F.sum("_w").over(group)
    fair = F.coalesce(F.when(all_of > 0, F.try_divide("_w", all_of)), F.try_divide(F.lit(1.0), F.count(part).over(group)))
    exact = joined.withColumn("_exact", F.abs(amount) * fair).withColumn("_low", F.floor("_exact"))
    left = F.abs(amount) - F.sum("_low").over(group)
    # rounded, so that remainders that are alike but for the last bits are ties
    place = F.row_number().over(group.orderBy(F.desc(F.round(F.col("_exact") - F.col("_low"), 9)), F.asc(part)))
    whole = F.col("_low") + F.when(place <= left, 1).otherwise(0)
    told = exact.withColumn("_left", left).withColumn("_whole", whole)
    return told.select(*keys, part, F.when(F.col(part).isNull(), F.col(amount)).otherwise(F.signum(F.col(amount).cast("double")).cast("long") * F.col("_whole")).alias(amount), F.lit(True).alias("inferred"))


def shares_of_history(entries: DataFrame, part: str = "category") -> DataFrame:
    """part, weight: what each part had of all entries whose parts are known."""
    return entries.where("not inferred and not estimated").groupBy(part).agg(F.sum("usd").alias("weight"))


def cents(usd: Column) -> Column:
    """Dollars as whole cents of a cent (a ten-thousandth), rounded half up."""
    return F.round(usd * 10_000).cast("long")
