"""Queries of the ledger written anew, and of totals attributed to the cent."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.operators import costs
from gleanery.plans.registry import query
from gleanery.sources.tables import RUNS_SQL, runs

#: A day is a run; days before this one have no tasks in their reports.
SINCE = "2024-01-15"
LINES_SQL = f"""{RUNS_SQL}, lines AS (SELECT day AS run_id, source AS source_id, CASE WHEN day >= DATE '{SINCE}' THEN CASE status WHEN 'ok' THEN 'extract' WHEN 'produced' THEN 'poster' ELSE 'verify' END END AS task, CASE WHEN status <> 'unchanged' THEN 1 ELSE 0 END AS calls, cost AS usd, k * 10 AS tokens_in, k AS tokens_out, CASE WHEN status = 'produced' THEN coalesce(k, 0) ELSE 0 END AS records FROM runs)"""
_CATEGORY = "CASE coalesce(task, 'extract') WHEN 'extract' THEN 'llm-extract' WHEN 'poster' THEN 'llm-vision' ELSE 'llm-verify' END"


def lines(spark, sf_dir):
    """The reports of runs: a line for each event of the log."""
    status = F.col("status")
    task = F.when(F.col("day") >= F.lit(SINCE).cast("date"), F.when(status == "ok", "extract").when(status == "produced", "poster").otherwise("verify"))
    return runs(spark, sf_dir).select(F.col("day").alias("run_id"), F.col("source").alias("source_id"), task.alias("task"), F.when(status != "unchanged", 1).otherwise(0).alias("calls"), F.col("cost").alias("usd"), (F.col("k") * 10).alias("tokens_in"), F.col("k").alias("tokens_out"), F.when(status == "produced", F.coalesce("k", F.lit(0))).otherwise(0).alias("records"))


@query(f"""WITH {LINES_SQL} SELECT run_id, {_CATEGORY} AS category, round(sum(usd), 6) AS usd, false AS estimated, bool_and(task IS NULL) AS inferred, count(*) AS units, 'calls' AS unit, CAST(sum(tokens_in) AS BIGINT) AS tokens_in, CAST(sum(tokens_out) AS BIGINT) AS tokens_out, count(DISTINCT source_id) AS n_drivers FROM lines WHERE calls > 0 GROUP BY 1, 2
UNION ALL SELECT run_id, 'fb', round(sum(records) * {CONFIG.record_rate}, 6), true, false, CAST(sum(records) AS BIGINT), 'records', NULL, NULL, count(DISTINCT source_id) FROM lines WHERE records > 0 GROUP BY run_id""")
def ledger_backfill(spark, sf_dir):
    """The ledger's entries, written anew from the reports; what older reports don't tell apart is marked as inferred."""
    return costs.backfilled(lines(spark, sf_dir)).withColumn("usd", F.round("usd", 6))


@query(f"""WITH {LINES_SQL}, w AS (SELECT {_CATEGORY} AS category, sum(usd) AS weight FROM lines WHERE calls > 0 AND task IS NOT NULL GROUP BY 1), t AS (SELECT run_id, CAST(round(round(sum(usd), 6) * 10000) AS BIGINT) AS cents FROM lines WHERE calls > 0 AND task IS NULL GROUP BY run_id),
x AS (SELECT run_id, category, cents, cents * weight / (SELECT sum(weight) FROM w) AS e FROM t, w), f AS (SELECT *, CAST(floor(e) AS BIGINT) AS low, row_number() OVER (PARTITION BY run_id ORDER BY round(e - floor(e), 9) DESC, category) AS p, cents - sum(CAST(floor(e) AS BIGINT)) OVER (PARTITION BY run_id) AS remains FROM x)
SELECT run_id, category, CAST(low + CASE WHEN p <= remains THEN 1 ELSE 0 END AS BIGINT) AS cents, true AS inferred FROM f""")
def attributed_costs(spark, sf_dir):
    """What older runs may have spent on each category: their sums, dealt out as later runs spent, whole and exact."""
    booked = costs.backfilled(lines(spark, sf_dir)).where("unit = 'calls'")
    old = booked.where("inferred").groupBy("run_id").agg(costs.cents(F.round(F.sum("usd"), 6)).alias("cents"))
    shares = costs.shares_of_history(booked)
    every = old.select("run_id").crossJoin(F.broadcast(shares))  # one row for each of four categories
    return costs.attributed(old, every, ["run_id"], "category")


@query(f"""WITH {LINES_SQL} SELECT run_id, CAST(round(round(sum(usd), 6) * 10000) AS BIGINT) AS cents FROM lines WHERE calls > 0 AND task IS NULL GROUP BY run_id""")
def attributed_sums(spark, sf_dir):
    """The attributed parts of every older run added up again: the run's sum to the hundredth of a cent."""
    return attributed_costs(spark, sf_dir).groupBy("run_id").agg(F.sum("cents").alias("cents"))
