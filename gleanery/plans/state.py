"""Queries over state that runs carry on, replayed from a log, and their streaming twins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.plans.registry import query
from gleanery.sources.tables import RUNS_SQL, runs, table


@query(f"""WITH {RUNS_SQL}, d AS (SELECT source, k, day, min(event_id) AS e FROM runs WHERE k IS NOT NULL GROUP BY ALL), l AS (SELECT *, lag(day) OVER (PARTITION BY source, k ORDER BY day) AS before FROM d)
SELECT source, count(*) AS n, count(*) FILTER (WHERE day - before <= {CONFIG.group_limit_min}) AS n_hits, count(*) FILTER (WHERE before IS NULL) AS n_first FROM l GROUP BY source""")
def cache_replay(spark, sf_dir):
    """Hits of a cache whose entries are forgotten when unseen for some days."""
    d = runs(spark, sf_dir).where("k is not null").groupBy("source", "k", "day").agg(F.min("event_id").alias("e"))
    seen = d.withColumn("before", F.lag("day").over(Window.partitionBy("source", "k").orderBy("day")))
    hit = F.coalesce(F.datediff("day", "before") <= CONFIG.group_limit_min, F.lit(False))
    return seen.groupBy("source").agg(F.count("*").alias("n"), F.count_if(hit).alias("n_hits"), F.count_if(F.col("before").isNull()).alias("n_first"))


@query(f"""WITH {RUNS_SQL}, w AS (SELECT *, sum(CASE WHEN status IN ('ok', 'produced') THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY event_id) AS island FROM runs), s AS (SELECT *, sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY source, island ORDER BY event_id) AS streak FROM w)
SELECT source, CAST(arg_max(streak, event_id) AS BIGINT) AS streak, arg_max(streak, event_id) >= {CONFIG.blocked_limit} AS blocked FROM s GROUP BY source""")
def blocked_replay(spark, sf_dir):
    """Each source's streak of errors at the end of the log."""
    from gleanery.operators.replay import streaks

    s = streaks(runs(spark, sf_dir), "source", ["event_id"], F.col("status") == "error", F.col("status").isin("ok", "produced"))
    last = s.groupBy("source").agg(F.max_by("streak", "event_id").alias("streak"))
    return last.withColumn("blocked", F.col("streak") >= CONFIG.blocked_limit)


@query(f"""WITH {RUNS_SQL}, s AS (SELECT source, status, day, event_id, lag(status) OVER (PARTITION BY source ORDER BY event_id) AS before FROM runs)
SELECT source, count(*) FILTER (WHERE status = 'error' AND before IS DISTINCT FROM 'error') AS n_muted, max(day + {CONFIG.mute_days}) FILTER (WHERE status = 'error' AND before IS DISTINCT FROM 'error') AS until FROM s GROUP BY source""")
def mute_windows(spark, sf_dir):
    """How often a verdict first fell, and until when the last one mutes."""
    s = runs(spark, sf_dir).withColumn("before", F.lag("status").over(Window.partitionBy("source").orderBy("event_id")))
    first = (F.col("status") == "error") & ~F.col("before").eqNullSafe(F.lit("error"))
    return s.groupBy("source").agg(F.count_if(first).alias("n_muted"), F.max(F.when(first, F.date_add("day", CONFIG.mute_days))).alias("until"))


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def hourly_counts(spark, sf_dir):
    """Events by hour and type: the batch twin of the windowed stream."""
    w = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))
    return w.select(F.col("w.start").alias("hour"), "event_type", "n", "value")


@query("""WITH g AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM s GROUP BY ALL""")
def recheck_sessions(spark, sf_dir):
    """Visits of a user with no gap over six hours between them."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = F.lag("ts").over(w)
    new = F.when(F.col("ts") - before <= F.expr("INTERVAL 6 HOURS"), 0).otherwise(1)
    s = table(spark, sf_dir, "events").withColumn("new", new).withColumn("session", F.sum("new").over(w))
    return s.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
