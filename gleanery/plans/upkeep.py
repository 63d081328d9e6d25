"""Queries over what runs keep up: counters and their deltas, marks of dead sources, memories with a time to live, places attached, batches routed."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.operators import ledger
from gleanery.plans.registry import query
from gleanery.sources.tables import CATALOG_SQL, DUMPS_SQL, RUNS_SQL, catalog, dumps, runs, table

STATUSES = ("ok", "unchanged", "error", "empty", "produced")


@query(f"""WITH {RUNS_SQL}, d AS (SELECT source, day, count(*) AS n, round(sum(cost), 2) AS usd FROM runs GROUP BY ALL)
SELECT source, day, n, usd, CAST(n - coalesce(lag(n) OVER w, 0) AS BIGINT) AS more, round(usd - coalesce(lag(usd) OVER w, 0), 2) AS more_usd FROM d WINDOW w AS (PARTITION BY source ORDER BY day)""")
def usage_deltas(spark, sf_dir):
    """A source's use of each day, and how it differs from that of its day before."""
    d = runs(spark, sf_dir).groupBy("source", "day").agg(F.count("*").alias("n"), F.round(F.sum("cost"), 2).alias("usd"))
    w = Window.partitionBy("source").orderBy("day")
    return d.select("source", "day", "n", "usd", (F.col("n") - F.coalesce(F.lag("n").over(w), F.lit(0))).alias("more"), F.round(F.col("usd") - F.coalesce(F.lag("usd").over(w), F.lit(0.0)), 2).alias("more_usd"))


@query(f"WITH {RUNS_SQL} SELECT day, count(*) AS n, {', '.join(f'''count(*) FILTER (WHERE status = '{s}') AS n_{s}''' for s in STATUSES)}, round(count(*) FILTER (WHERE status = 'error') / count(*), 4) AS failed FROM runs GROUP BY day")
def fetch_stats(spark, sf_dir):
    """How each day's fetches ended, and the share that failed."""
    status = F.col("status")
    return runs(spark, sf_dir).groupBy("day").agg(F.count("*").alias("n"), *[F.count_if(status == s).alias(f"n_{s}") for s in STATUSES], F.round(F.count_if(status == "error") / F.count("*"), 4).alias("failed"))


@query(f"""WITH {RUNS_SQL}, l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY event_id DESC) AS r FROM runs) SELECT source, bool_and(status = 'error') AND count(*) = {CONFIG.miss_limit} AS dead, min(day) AS since, arg_max(status, event_id) AS last_status FROM l WHERE r <= {CONFIG.miss_limit} GROUP BY source""")
def dead_marks(spark, sf_dir):
    """A source is dead once its last tries all failed; any that works brings it back."""
    last = runs(spark, sf_dir).withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("event_id")))).where(F.col("r") <= CONFIG.miss_limit)
    dead = F.bool_and(F.col("status") == "error") & (F.count("*") == CONFIG.miss_limit)
    return last.groupBy("source").agg(dead.alias("dead"), F.min("day").alias("since"), F.max_by("status", "event_id").alias("last_status"))


@query(f"""WITH {CATALOG_SQL}, g AS (SELECT n_name, CASE n_regionkey WHEN 3 THEN 'region' WHEN 0 THEN 'abroad' ELSE 'far' END AS locality FROM nation WHERE n_nationkey % 5 <> 0), o AS (SELECT 's' || s_suppkey AS source_id, 'region' AS locality FROM supplier WHERE s_suppkey % 4 = 0)
SELECT town, coalesce(o.locality, g.locality, 'unknown') AS locality, count(*) AS n, count(o.locality) AS n_own FROM catalog LEFT JOIN g ON town = n_name LEFT JOIN o ON catalog.source_id = o.source_id GROUP BY ALL""")
def places_attached(spark, sf_dir):
    """Where events are: as their origin says, else as the cache of places has it, else unknown."""
    region = F.when(F.col("n_regionkey") == 3, "region").when(F.col("n_regionkey") == 0, "abroad").otherwise("far")
    cache = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_name").alias("town"), region.alias("cached"))
    own = table(spark, sf_dir, "supplier").where("s_suppkey % 4 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("source_id"), F.lit("region").alias("own"))
    joined = catalog(spark, sf_dir).join(cache, "town", "left").join(own, "source_id", "left")
    return joined.groupBy("town", F.coalesce("own", "cached", F.lit("unknown")).alias("locality")).agg(F.count("*").alias("n"), F.count("own").alias("n_own"))


@query(f"""WITH {CATALOG_SQL}, c AS (SELECT n_name, n_nationkey % 2 AS version FROM nation) SELECT venue, town, count(*) AS n, bool_and(version = 1) AS valid FROM catalog JOIN c ON town = n_name GROUP BY ALL""")
def place_cache(spark, sf_dir):
    """Cached places by the version of the region under which they were found: those of another version are void."""
    cache = table(spark, sf_dir, "nation").select(F.col("n_name").alias("town"), (F.col("n_nationkey") % 2).alias("version"))
    return catalog(spark, sf_dir).join(cache, "town").groupBy("venue", "town").agg(F.count("*").alias("n"), F.bool_and(F.col("version") == 1).alias("valid"))


@query(f"""WITH {RUNS_SQL}, d AS (SELECT DISTINCT source || '|' || k AS page, day FROM runs WHERE k IS NOT NULL),
f AS (SELECT page, list_reduce(list({{'day': day, 'n': 0, 'm': 0}} ORDER BY day), lambda s, x: CASE WHEN s.day IS NULL OR x.day >= s.day + {CONFIG.blocked_recheck_days} THEN {{'day': x.day, 'n': s.n + 1, 'm': s.m}} ELSE {{'day': s.day, 'n': s.n, 'm': s.m + 1}} END, {{'day': NULL::DATE, 'n': 0, 'm': 0}}) AS s FROM d GROUP BY page)
SELECT page, s.day AS checked, s.n AS n_checks, s.m AS n_remembered FROM f""")
def page_memory(spark, sf_dir):
    """What is remembered of a page holds for some days; then it is checked again."""
    log = runs(spark, sf_dir).where("k is not null").select(F.concat_ws("|", "source", F.col("k").cast("string")).alias("page"), "day").distinct()
    return ledger.remembered(log, "page", CONFIG.blocked_recheck_days)


@query(f"""WITH {RUNS_SQL}, p AS (SELECT source, k, count(*) AS runs FROM runs WHERE day < DATE '2024-01-16' AND status IN ('empty', 'error') GROUP BY ALL), f AS (SELECT DISTINCT source, k FROM runs WHERE day >= DATE '2024-01-16') SELECT source, k, coalesce(runs, 0) AS barren FROM f LEFT JOIN p USING (source, k)""")
def carried_barren(spark, sf_dir):
    """Entries found anew keep the count of barren runs that their address had."""
    r = runs(spark, sf_dir)
    cut = F.lit("2024-01-16").cast("date")
    before = r.where((F.col("day") < cut) & F.col("status").isin("empty", "error")).groupBy("source", "k").agg(F.count("*").alias("runs"))
    return r.where(F.col("day") >= cut).select("source", "k").distinct().join(before, ["source", "k"], "left").select("source", "k", F.coalesce("runs", F.lit(0)).alias("barren"))


@query("SELECT s_suppkey, CAST(row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS INTEGER) AS place FROM supplier QUALIFY place <= 9500 // 700")
def planned_probes(spark, sf_dir):
    """As many sources as a budget of records pays for at the limit of each, the richest first."""
    order = [F.desc("s_acctbal"), F.col("s_suppkey")]
    return table(spark, sf_dir, "supplier").orderBy(*order).limit(9500 // 700).select("s_suppkey", F.row_number().over(Window.orderBy(*order)).alias("place"))


@query("""WITH b AS (SELECT o_orderkey, o_orderstatus = 'P' AS cut, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL), r AS (SELECT l_orderkey, l_linenumber AS block, l_linenumber > 5 AS orphan FROM lineitem WHERE l_returnflag = 'R'),
a AS (SELECT l_orderkey, count(*) FILTER (WHERE NOT orphan) AS n_routed, count(*) FILTER (WHERE orphan) AS n_orphans, max(block) FILTER (WHERE NOT orphan) AS last FROM r GROUP BY 1)
SELECT o_orderkey, coalesce(n_routed, 0) AS n_routed, coalesce(n_orphans, 0) AS n_orphans, CAST(CASE WHEN cut THEN n - greatest(coalesce(last, 0) - 1, 0) ELSE 0 END AS BIGINT) AS n_unsafe FROM b LEFT JOIN a ON o_orderkey = l_orderkey""")
def batch_routes(spark, sf_dir):
    """Results of a batch to its blocks: those of no block are dropped, and of a batch cut short the blocks from the last seen on are unsafe."""
    returned, orphan, line = F.col("l_returnflag") == "R", F.col("l_linenumber") > 5, F.col("l_linenumber")
    # items are counted before they meet their order, so that no item is sorted
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("items"), F.count_if(returned & ~orphan).alias("r"), F.count_if(returned & orphan).alias("o"), F.max(F.when(returned & ~orphan, line)).alias("last"))
    asked = table(spark, sf_dir, "orders").groupBy("o_orderkey", (F.col("o_orderstatus") == "P").alias("cut")).agg(F.count("*").alias("orders"))
    n = F.col("orders") * F.col("items")
    unsafe = F.when(F.col("cut"), n - F.greatest(F.coalesce("last", F.lit(0)) - 1, F.lit(0))).otherwise(0)
    return asked.join(per, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", F.col("r").alias("n_routed"), F.col("o").alias("n_orphans"), unsafe.cast("long").alias("n_unsafe"))


@query("""SELECT conv_id, turn, CASE WHEN coalesce(trim(text), '') = '' THEN 'empty' WHEN starts_with(text, 'Error:') AND length(text) < 40 THEN 'error' ELSE 'post' END AS kind FROM conversations""")
def post_kinds(spark, sf_dir):
    """A provider's row is a post unless it is empty or says nothing but an error."""
    t = F.col("text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.trim(F.coalesce(t, F.lit(""))) == "", "empty").when(t.startswith("Error:") & (F.length(t) < 40), "error").otherwise("post").alias("kind"))


@query(f"""WITH {DUMPS_SQL}, b AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS block FROM dumps) SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE NOT regexp_matches(block, '[0-9]')) AS n_silent, CAST(coalesce(sum(length(block)) FILTER (WHERE NOT regexp_matches(block, '[0-9]')), 0) AS BIGINT) AS chars_silent, CAST(sum(length(block)) AS BIGINT) AS chars FROM b GROUP BY doc_id""")
def page_waste(spark, sf_dir):
    """What of each page was read for nothing: blocks without a number can tell no day."""
    b = dumps(spark, sf_dir).select("doc_id", F.explode(F.split("text", "\n")).alias("block"))
    silent = ~F.col("block").rlike("[0-9]")
    return b.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(silent).alias("n_silent"), F.sum(F.when(silent, F.length("block")).otherwise(0)).cast("long").alias("chars_silent"), F.sum(F.length("block")).cast("long").alias("chars"))


@query(f"""WITH {CATALOG_SQL} SELECT title, date_start, arg_max(pos, (length('{{"venue":"' || venue || '","town":"' || town || '","quantity":' || quantity || '}}') * 1000000000000000 - pos)) AS pos, CAST(max(length('{{"venue":"' || venue || '","town":"' || town || '","quantity":' || quantity || '}}')) AS INTEGER) AS richness FROM catalog GROUP BY title, date_start""")
def richest(spark, sf_dir):
    """Of records of one title and day the one that says most, written out; of equal ones the first."""
    rich = F.length(F.to_json(F.struct("venue", "town", "quantity")))
    best = F.min_by(F.struct("pos", rich.alias("richness")), F.struct(-rich, F.col("pos")))
    return catalog(spark, sf_dir).groupBy("title", "date_start").agg(best.alias("b")).select("title", "date_start", "b.pos", "b.richness")


@query(f"""WITH {RUNS_SQL}, s AS (SELECT source, count(DISTINCT day) AS fetched, round(sum(cost), 2) AS usd, count(*) FILTER (WHERE status = 'produced') AS n FROM runs GROUP BY source) SELECT source, fetched >= {CONFIG.min_runs} AS measured, n > 0 AS attributed, fetched >= {CONFIG.min_runs} AND usd > 0 AS governed FROM s""")
def source_traits(spark, sf_dir):
    """Whether a source is measured, has anything to its name, and stands under the budget."""
    s = runs(spark, sf_dir).groupBy("source").agg(F.count_distinct("day").alias("fetched"), F.round(F.sum("cost"), 2).alias("usd"), F.count_if(F.col("status") == "produced").alias("n"))
    measured = F.col("fetched") >= CONFIG.min_runs
    return s.select("source", measured.alias("measured"), (F.col("n") > 0).alias("attributed"), (measured & (F.col("usd") > 0)).alias("governed"))
