"""Queries over runs: totals, costs, waste, volumes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.operators import replay, retention, yields
from gleanery.plans.registry import query
from gleanery.sources.tables import RUNS_SQL, runs

STATUSES = ("ok", "unchanged", "error", "empty", "produced")


@query(f"""WITH {RUNS_SQL}, p AS (SELECT DISTINCT source, key FROM runs WHERE status = 'produced'), k AS (SELECT key, count(*) AS n FROM p GROUP BY key),
y AS (SELECT source, count(*) AS n_distinct, count(*) FILTER (WHERE n = 1) AS n_exclusive FROM p JOIN k USING (key) GROUP BY source),
r AS (SELECT source, count(*) AS n_runs, count(*) FILTER (WHERE status IN ('ok', 'unchanged', 'error', 'empty')) AS n_fetched, round(sum(cost), 4) AS cost FROM runs GROUP BY source)
SELECT r.source, n_runs, n_fetched, cost, coalesce(n_distinct, 0) AS n_distinct, coalesce(n_exclusive, 0) AS n_exclusive, CASE WHEN n_exclusive > 0 THEN round(cost / n_exclusive, 4) END AS cost_per_exclusive FROM r LEFT JOIN y ON r.source = y.source""")
def source_yield(spark, sf_dir):
    """Runs, cost, keys and the price of an exclusive key, by source."""
    r = runs(spark, sf_dir)
    y = yields.exclusivity(r.where("status = 'produced'").select("source", "key"))
    n = r.groupBy("source").agg(F.count("*").alias("n_runs"), F.count_if(F.col("status").isin("ok", "unchanged", "error", "empty")).alias("n_fetched"), F.round(F.sum("cost"), 4).alias("cost"))
    exclusive = F.coalesce("n_exclusive", F.lit(0))
    return n.join(y, "source", "left").select("source", "n_runs", "n_fetched", "cost", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), exclusive.alias("n_exclusive"), F.when(exclusive > 0, F.round(F.col("cost") / exclusive, 4)).alias("cost_per_exclusive"))


@query(f"""WITH {RUNS_SQL}, c AS (SELECT source, status, count(*) AS n, min(event_id) AS f FROM runs GROUP BY ALL) SELECT source, status, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, f) AS r FROM c) WHERE r = 1""")
def dominant_status(spark, sf_dir):
    return yields.dominant(runs(spark, sf_dir), "source", "status", "event_id")


@query(f"""WITH {RUNS_SQL} SELECT day, count(*) AS n, {', '.join(f"count(*) FILTER (WHERE status = '{s}') AS n_{s}" for s in STATUSES)}, round(sum(cost), 4) AS cost FROM runs GROUP BY day""")
def run_totals(spark, sf_dir):
    return runs(spark, sf_dir).groupBy("day").agg(F.count("*").alias("n"), *yields.conditional(F.col("status"), STATUSES), F.round(F.sum("cost"), 4).alias("cost"))


@query(f"""WITH {RUNS_SQL}, c AS (SELECT day, status, source, round(sum(cost), 6) AS usd, count(*) AS units FROM runs GROUP BY ALL) SELECT day, status, source, usd, units, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY day, status ORDER BY usd DESC, units DESC, source) AS rank FROM c WHERE usd <> 0) WHERE rank <= 5""")
def cost_entries_topk(spark, sf_dir):
    """The five dearest sources of each day and category."""
    c = runs(spark, sf_dir).groupBy("day", "status", "source").agg(F.round(F.sum("cost"), 6).alias("usd"), F.count("*").alias("units")).where("usd <> 0")
    return yields.top_k(c, ["day", "status"], [F.desc("usd"), F.desc("units"), F.col("source")], 5)


@query(f"""WITH {RUNS_SQL}, g AS (SELECT CAST(d AS DATE) AS day, s AS status FROM (SELECT unnest(range(CAST(min(day) AS TIMESTAMP), max(day) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM runs), (SELECT DISTINCT status AS s FROM runs)), v AS (SELECT day, status, sum(cost) AS c FROM runs GROUP BY ALL),
f AS (SELECT g.day, g.status, coalesce(v.c, 0) AS value FROM g LEFT JOIN v ON g.day = v.day AND g.status = v.status)
SELECT day, {', '.join(f"round(sum(value) FILTER (WHERE status = '{s}'), 4) AS {s}" for s in STATUSES)}, round(sum(sum(value)) OVER (ORDER BY day), 2) AS month_to_date FROM f GROUP BY day""")
def money_daily_pivot(spark, sf_dir):
    """Every day from the first to the last, a column for each category, and the sum so far. The running sum is over days, whose number is fixed."""
    grid = yields.dense_days(runs(spark, sf_dir), ["status"], "day", F.sum("cost"))
    wide = grid.groupBy("day").pivot("status", list(STATUSES)).agg(F.round(F.sum("value"), 4))
    total = grid.groupBy("day").agg(F.sum("value").alias("v"))
    so_far = total.select("day", F.round(F.sum("v").over(Window.orderBy("day")), 2).alias("month_to_date"))
    return wide.join(so_far, "day")


@query(f"""WITH {RUNS_SQL} SELECT source, status, round(sum(cost), 4) AS usd, count(DISTINCT day) AS n_days, count(*) AS units FROM runs GROUP BY source, status""")
def cost_drivers(spark, sf_dir):
    return runs(spark, sf_dir).groupBy("source", "status").agg(F.round(F.sum("cost"), 4).alias("usd"), F.count_distinct("day").alias("n_days"), F.count("*").alias("units"))


@query(f"""WITH {RUNS_SQL}, r AS (SELECT source, day, count(*) AS calls, count(*) FILTER (WHERE status = 'produced') AS events, sum(cost) AS cost FROM runs GROUP BY ALL)
SELECT source, count(*) AS n_runs, CAST(sum(events) AS BIGINT) AS events, round(sum(cost), 4) AS cost, count(*) FILTER (WHERE events = 0) AS zero_runs, round(coalesce(sum(cost) FILTER (WHERE events = 0), 0), 4) AS zero_cost, count(*) >= 2 AND sum(events) = 0 AND sum(cost) > 0 AS chronic FROM r GROUP BY source""")
def zero_yield(spark, sf_dir):
    """What runs without events cost, and which sources never give any."""
    r = runs(spark, sf_dir).groupBy("source", "day").agg(F.count_if(F.col("status") == "produced").alias("events"), F.sum("cost").alias("cost"))
    none = F.col("events") == 0
    return r.groupBy("source").agg(
        F.count("*").alias("n_runs"), F.sum("events").alias("events"), F.round(F.sum("cost"), 4).alias("cost"), F.count_if(none).alias("zero_runs"),
        F.round(F.coalesce(F.sum(F.when(none, F.col("cost"))), F.lit(0.0)), 4).alias("zero_cost"), ((F.count("*") >= 2) & (F.sum("events") == 0) & (F.sum("cost") > 0)).alias("chronic"),
    )


@query(f"""WITH {RUNS_SQL}, s AS (SELECT source, day, sum(k) FILTER (WHERE status = 'empty') AS silent, sum(k) FILTER (WHERE status IN ('ok', 'produced')) AS fresh, sum(cost) AS usd, bool_or(k IS NULL) AS unknown FROM runs GROUP BY ALL)
SELECT source, CAST(sum(silent) AS BIGINT) AS silent, CAST(sum(fresh) AS BIGINT) AS fresh, round(sum(CASE WHEN fresh > 0 THEN usd * coalesce(silent, 0) / fresh END), 4) AS wasted, NOT bool_or(unknown) AS measured FROM s GROUP BY source""")
def block_waste(spark, sf_dir):
    """What was paid for text without events; what was not measured stays null and isn't zero."""
    s = runs(spark, sf_dir).groupBy("source", "day").agg(F.sum(F.when(F.col("status") == "empty", F.col("k"))).alias("silent"), F.sum(F.when(F.col("status").isin("ok", "produced"), F.col("k"))).alias("fresh"), F.sum("cost").alias("usd"), F.bool_or(F.col("k").isNull()).alias("unknown"))
    wasted = F.when(F.col("fresh") > 0, F.col("usd") * F.coalesce("silent", F.lit(0)) / F.col("fresh"))
    return s.groupBy("source").agg(F.sum("silent").alias("silent"), F.sum("fresh").alias("fresh"), F.round(F.sum(wasted), 4).alias("wasted"), (~F.bool_or("unknown")).alias("measured"))


@query(f"""WITH {RUNS_SQL}, a AS (SELECT source, arg_max(status, event_id) AS status, count(*) AS n FROM runs WHERE day = DATE '2024-01-10' GROUP BY source), b AS (SELECT source, arg_max(status, event_id) AS status, count(*) AS n FROM runs WHERE day = DATE '2024-01-11' GROUP BY source)
SELECT coalesce(a.source, b.source) AS source, a.status AS before, b.status AS after, a.n AS n_before, b.n AS n_after FROM a FULL JOIN b ON a.source = b.source WHERE NOT (a.status IS NOT DISTINCT FROM b.status AND a.n IS NOT DISTINCT FROM b.n)""")
def diff_runs(spark, sf_dir):
    """What changed from one day to the next."""
    day = lambda d: runs(spark, sf_dir).where(F.col("day") == F.lit(d).cast("date")).groupBy("source").agg(F.max_by("status", "event_id").alias("status"), F.count("*").alias("n"))
    a, b = day("2024-01-10").alias("a"), day("2024-01-11").alias("b")
    joined = a.join(b, F.col("a.source") == F.col("b.source"), "full_outer")
    same = F.col("a.status").eqNullSafe(F.col("b.status")) & F.col("a.n").eqNullSafe(F.col("b.n"))
    return joined.where(~same).select(F.coalesce("a.source", "b.source").alias("source"), F.col("a.status").alias("before"), F.col("b.status").alias("after"), F.col("a.n").alias("n_before"), F.col("b.n").alias("n_after"))


@query(f"""WITH {RUNS_SQL}, w AS (SELECT *, sum(CASE WHEN status IN ('ok', 'produced') THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY day, event_id) AS island FROM runs), s AS (SELECT *, sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY source, island ORDER BY day, event_id) AS streak FROM w)
SELECT source, CAST(max(streak) AS BIGINT) AS longest, count(*) FILTER (WHERE streak >= 3 AND status = 'error') AS n_blocked FROM s GROUP BY source""")
def streaks(spark, sf_dir):
    """The longest run of errors of each source, and how often it would be blocked."""
    s = replay.streaks(runs(spark, sf_dir), "source", ["day", "event_id"], F.col("status") == "error", F.col("status").isin("ok", "produced"))
    return s.groupBy("source").agg(F.max("streak").alias("longest"), F.count_if((F.col("streak") >= 3) & (F.col("status") == "error")).alias("n_blocked"))


@query(f"""WITH {RUNS_SQL}, d AS (SELECT source, day, round(sum(cost), 4) AS cost FROM runs GROUP BY ALL) SELECT source, day, cost, lag(cost) OVER (PARTITION BY source ORDER BY day) AS before FROM d""")
def day_pairs(spark, sf_dir):
    d = runs(spark, sf_dir).groupBy("source", "day").agg(F.round(F.sum("cost"), 4).alias("cost"))
    return replay.day_pairs(d, "source", "day", "cost")


@query(f"""WITH {RUNS_SQL}, d AS (SELECT DISTINCT source, key, k, day FROM runs WHERE status <> 'error') SELECT source, count(*) AS n, count(*) FILTER (WHERE day = f) AS n_new FROM (SELECT *, min(day) OVER (PARTITION BY source, k) AS f FROM d) GROUP BY source""")
def first_seen_blocks(spark, sf_dir):
    """How many of a source's values are new on their day."""
    d = runs(spark, sf_dir).where("status <> 'error'").select("source", "key", "k", "day").distinct()
    return replay.first_seen(d, ["source", "k"], "day").groupBy("source").agg(F.count("*").alias("n"), F.count_if("new").alias("n_new"))


@query(f"""WITH {RUNS_SQL}, o AS (SELECT source, day, status, cost FROM runs WHERE day <= DATE '2024-01-15'), n AS (SELECT source, day, status, cost + 1 AS cost FROM runs WHERE day >= DATE '2024-01-15')
SELECT source, day, status, round(sum(cost), 4) AS cost, count(*) AS n FROM (SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.source = o.source AND n.day = o.day)) GROUP BY ALL""")
def upsert_by_key(spark, sf_dir):
    """New rows in place of old ones of their source and day."""
    r = runs(spark, sf_dir).select("source", "day", "status", "cost")
    cut = F.lit("2024-01-15").cast("date")
    merged = retention.upsert(r.where(F.col("day") <= cut), r.where(F.col("day") >= cut).withColumn("cost", F.col("cost") + 1), ["source", "day"])
    return merged.groupBy("source", "day", "status").agg(F.round(F.sum("cost"), 4).alias("cost"), F.count("*").alias("n"))


@query(f"""WITH {RUNS_SQL}, s AS (SELECT source, count(*) FILTER (WHERE status = 'error') AS e, max(day) AS seen, count(*) AS n FROM runs GROUP BY source), h AS (SELECT *, hash_bucket FROM (SELECT *, CAST(substr(source, 2) AS BIGINT) % 5 AS hash_bucket FROM s))
SELECT status, count(*) AS n FROM (SELECT CASE WHEN hash_bucket = 0 THEN 'fb-unavailable' WHEN e * 4 > n THEN 'dead' WHEN seen < DATE '2024-01-29' THEN 'inactive' WHEN hash_bucket = 1 THEN 'muted' WHEN e * 5 > n THEN 'blocked' ELSE 'process' END AS status FROM h) GROUP BY status""")
def skip_ladder(spark, sf_dir):
    """Why sources aren't visited: the first reason that holds."""
    from gleanery.operators.filters import skip_status

    s = runs(spark, sf_dir).groupBy("source").agg(F.count_if(F.col("status") == "error").alias("e"), F.max("day").alias("seen"), F.count("*").alias("n"))
    b = F.substring("source", 2, 20).cast("long") % 5
    status = skip_status(F.when(b == 0, "fb_group").otherwise("plain"), F.col("e") * 4 > F.col("n"), F.col("seen") < F.lit("2024-01-29").cast("date"), b == 1, F.col("e") * 5 > F.col("n"), F.lit(False))
    return s.groupBy(status.alias("status")).agg(F.count("*").alias("n"))
