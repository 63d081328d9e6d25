"""Queries over event records: keys, filters, de-duplication, series, joins, yield."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.functions import dates as D
from gleanery.functions import geo, text
from gleanery.operators import budget, dedupe, filters, retention, series, yields
from gleanery.plans.registry import query
from gleanery.sources.tables import CATALOG_SQL, catalog, table

KEY_SQL = "substr(regexp_replace(lower(title), '[^a-zA-Z0-9_]+', '', 'g'), 1, 40) || '|' || CAST(date_start AS VARCHAR)"
TODAY = "1998-06-15"


def keyed(spark, sf_dir):
    return catalog(spark, sf_dir).withColumn("key", text.event_key(F.col("title"), F.col("date_start")))


KEYED_SQL = f"{CATALOG_SQL}, keyed AS (SELECT *, {KEY_SQL} AS key FROM catalog)"


@query(f"""WITH {KEYED_SQL}, p AS (SELECT DISTINCT source_id, key FROM keyed WHERE NOT is_noise), k AS (SELECT key, count(*) AS n FROM p GROUP BY key)
SELECT source_id AS source, count(*) AS n_distinct, count(*) FILTER (WHERE n = 1) AS n_exclusive, count(*) FILTER (WHERE n > 1) AS n_shared FROM p JOIN k USING (key) GROUP BY source_id""")
def source_yield_catalog(spark, sf_dir):
    """Distinct, exclusive and shared event keys of every source, noise left out."""
    return yields.exclusivity(keyed(spark, sf_dir).where("not is_noise").select(F.col("source_id").alias("source"), "key"))


@query(f"WITH {KEYED_SQL} SELECT key, count(*) AS n_rows, min(pos) AS first_pos FROM keyed GROUP BY key")
def event_key(spark, sf_dir):
    return keyed(spark, sf_dir).groupBy("key").agg(F.count("*").alias("n_rows"), F.min("pos").alias("first_pos"))


@query(f"""WITH {KEYED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY length(venue) DESC, pos) AS rn, min(pos) OVER (PARTITION BY key) AS first_pos, count(*) OVER (PARTITION BY key) AS n_rows FROM keyed)
SELECT key, first_pos, n_rows, pos AS winner_pos, venue FROM r WHERE rn = 1""")
def dedupe_key(spark, sf_dir):
    """One row for each key, the richest (here: the longest venue), at the first row's place."""
    events = catalog(spark, sf_dir).select("pos", "title", "venue", "date_start", F.length("venue").alias("richness"))
    return dedupe.by_key(events).select("key", "first_pos", "n_rows", "winner_pos", "venue")


RULES = (("turned", "(?i)burnished|antique"), ("metal", "(?i)brass|steel"), ("large", "(?i)large"))


@query(f"""WITH {CATALOG_SQL} SELECT why, count(*) AS n, count(DISTINCT source_id) AS n_sources FROM (
SELECT source_id, CASE WHEN regexp_matches(title, '(?i)burnished|antique') OR regexp_matches(p_type, '(?i)burnished|antique') THEN 'turned'
 WHEN regexp_matches(title, '(?i)brass|steel') OR regexp_matches(p_type, '(?i)brass|steel') THEN 'metal'
 WHEN regexp_matches(title, '(?i)large') OR regexp_matches(p_type, '(?i)large') THEN 'large' ELSE 'kept' END AS why FROM catalog) GROUP BY why""")
def non_events(spark, sf_dir):
    """Rows that a rule drops, by the first rule that does; the rules are this table's."""
    why = F.coalesce(filters.reason_of(RULES, [F.col("title")], F.array("p_type")), F.lit("kept"))
    return catalog(spark, sf_dir).groupBy(why.alias("why")).agg(F.count("*").alias("n"), F.count_distinct("source_id").alias("n_sources"))


@query(f"WITH {CATALOG_SQL} SELECT town, count(*) AS n, min(date_start) AS first_day, max(coalesce(date_end, date_start)) AS last_day FROM catalog WHERE coalesce(date_end, date_start) >= DATE '{TODAY}' GROUP BY town")
def drop_past(spark, sf_dir):
    kept = filters.drop_past(catalog(spark, sf_dir), F.lit(TODAY).cast("date"))
    return kept.groupBy("town").agg(F.count("*").alias("n"), F.min("date_start").alias("first_day"), F.max(F.coalesce("date_end", "date_start")).alias("last_day"))


@query(f"""WITH {CATALOG_SQL}, loc AS (SELECT *, CASE p_size % 5 WHEN 0 THEN 'far' WHEN 1 THEN 'abroad' WHEN 2 THEN 'region' WHEN 3 THEN 'unknown' END AS locality FROM catalog)
SELECT town, count(*) AS n, count(locality) AS n_known FROM loc WHERE coalesce(locality, 'unknown') NOT IN ('far', 'abroad') GROUP BY town""")
def within_region(spark, sf_dir):
    m = F.col("p_size") % 5
    marked = catalog(spark, sf_dir).withColumn("locality", F.when(m == 0, "far").when(m == 1, "abroad").when(m == 2, "region").when(m == 3, "unknown"))
    return filters.within_region(marked).groupBy("town").agg(F.count("*").alias("n"), F.count("locality").alias("n_known"))


@query(f"WITH {CATALOG_SQL} SELECT pos, CAST(date_end - date_start + 1 AS INTEGER) AS days FROM catalog WHERE date_end - date_start + 1 >= 8")
def container_suspects(spark, sf_dir):
    suspect = filters.container_suspect(F.col("date_start"), F.col("date_end"), None, None, None)
    return catalog(spark, sf_dir).where(suspect).select("pos", D.span_days(F.col("date_start"), F.col("date_end")).alias("days"))


@query(f"""WITH {CATALOG_SQL}, a AS (SELECT *, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size % 10 END AS lo, CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_size % 10 + 5 END AS hi FROM catalog)
SELECT source_id, count(*) AS n FROM a WHERE (lo IS NULL OR 6 >= lo) AND (hi IS NULL OR 6 <= hi) GROUP BY source_id""")
def age_filter(spark, sf_dir):
    lo, hi = F.when(F.col("p_size") % 7 != 0, F.col("p_size") % 10), F.when(F.col("p_size") % 11 != 0, F.col("p_size") % 10 + 5)
    return catalog(spark, sf_dir).where(filters.age_ok(F.lit(6), lo, hi)).groupBy("source_id").agg(F.count("*").alias("n"))


@query(f"""WITH {CATALOG_SQL} SELECT pos, date_start, CASE WHEN contains(lower(title), 'e') AND contains(lower(title), '1') THEN CASE WHEN starts_with(lower(title), 'e') THEN 3 ELSE 2 END ELSE 1 END AS score
FROM catalog WHERE (contains(lower(title), 'e') OR contains(lower(venue || ' ' || town), 'e')) AND (contains(lower(title), '1') OR contains(lower(venue || ' ' || town), '1'))""")
def listing_search(spark, sf_dir):
    """All words in the title or the rest, with the score of the place they are in."""
    return filters.search(catalog(spark, sf_dir), "E 1", F.col("title"), F.concat_ws(" ", "venue", "town")).select("pos", "date_start", "score")


REPEATS = ("", "codziennie", "sb,nd", "pn; śr", "co drugi tydzień", "Wt, czwartek")


@query(f"""WITH {CATALOG_SQL}, r AS (SELECT pos, date_start, date_end, CASE p_size % 6 WHEN 0 THEN NULL WHEN 1 THEN [0,1,2,3,4,5,6] WHEN 2 THEN [0,6] WHEN 3 THEN [1,3] WHEN 4 THEN NULL ELSE [2,4] END AS rule, p_size % 6 <> 0 AS has FROM catalog),
e AS (SELECT *, greatest(date_start, DATE '1996-01-10') AS f FROM r),
d AS (SELECT *, CASE WHEN has AND rule IS NOT NULL AND date_end > date_start THEN list_filter(list_transform(range(0, CAST(greatest(0, date_end - f + 1) AS BIGINT)), lambda i: CAST(f + CAST(i AS INTEGER) AS DATE)), lambda x: list_contains(rule, CAST(dayofweek(x) AS INTEGER)))[1:60] END AS days FROM e),
x AS (SELECT pos, has, CASE WHEN has THEN NULL ELSE date_end END AS date_end, unnest(CASE WHEN NOT has THEN [date_start] WHEN len(days) > 1 THEN days ELSE [coalesce(days[1], date_start)] END) AS day FROM d)
SELECT pos, day AS date_start, date_end, count(*) AS n FROM x GROUP BY ALL""")
def expand_repeat(spark, sf_dir):
    """Rhythms to days."""
    rule = F.get(F.array(*[F.lit(r) for r in REPEATS]), F.col("p_size") % 6)
    events = catalog(spark, sf_dir).select("pos", "date_start", "date_end", rule.alias("repeat"))
    out = series.expand_repeat(events, F.lit("1996-01-10").cast("date"))
    return out.groupBy("pos", "date_start", "date_end").agg(F.count("*").alias("n"))


@query(f"""WITH {CATALOG_SQL}, o AS (SELECT source_id, title, town, min(date_start) AS date_start, CASE WHEN count(*) > 1 THEN len(list_distinct(list(date_start))) END AS n_dates, count(*) AS n_rows FROM catalog WHERE date_end IS NULL GROUP BY ALL)
SELECT source_id, title, town, date_start, CAST(n_dates AS INTEGER) AS n_dates, n_rows FROM o UNION ALL SELECT source_id, title, town, date_start, NULL, 1 FROM catalog WHERE date_end IS NOT NULL""")
def fold_series(spark, sf_dir):
    """Days of one event to one row."""
    events = catalog(spark, sf_dir).select("pos", "source_id", "title", "town", "date_start", "date_end")
    out = series.fold_series(events, ["source_id", "title", "town"])
    return out.select("source_id", "title", "town", "date_start", F.when(F.col("dates").isNotNull(), F.size("dates")).alias("n_dates"), "n_rows")


@query()
def series_label(spark, sf_dir):
    """The label of every folded series."""
    events = catalog(spark, sf_dir).select("pos", "source_id", "title", "town", F.col("ship_day").alias("date_start"), F.lit(None).cast("date").alias("date_end"))
    out = series.fold_series(events, ["title", "town"]).where("size(dates) > 1")
    return out.select("title", "town", F.size("dates").alias("n"), D.series_label(F.col("dates")).alias("label"))


@query(f"""WITH {CATALOG_SQL}, t AS (SELECT DISTINCT source_id, title, date_start, date_end FROM catalog WHERE date_end IS NOT NULL)
SELECT a.source_id, count(*) AS n FROM t a JOIN t b ON a.title = b.title AND a.source_id < b.source_id AND a.date_start <= coalesce(b.date_end, b.date_start) AND b.date_start <= coalesce(a.date_end, a.date_start) GROUP BY a.source_id""")
def interval_overlap(spark, sf_dir):
    """Pairs of sources with one title on meeting spans, by the first source. The title is the equality that deals the rows."""
    t = catalog(spark, sf_dir).where("date_end is not null").select("source_id", "title", "date_start", "date_end").distinct()
    a, b = t.alias("a"), t.alias("b")
    meet = D.overlap(F.col("a.date_start"), F.col("a.date_end"), F.col("b.date_start"), F.col("b.date_end"))
    joined = a.join(b, (F.col("a.title") == F.col("b.title")) & (F.col("a.source_id") < F.col("b.source_id")) & meet)
    return joined.groupBy("a.source_id").agg(F.count("*").alias("n"))


@query(f"WITH {KEYED_SQL}, p AS (SELECT DISTINCT source_id, key FROM keyed WHERE NOT is_noise) SELECT a.source_id AS a, b.source_id AS b, count(*) AS n FROM p a JOIN p b ON a.key = b.key AND a.source_id <> b.source_id GROUP BY 1, 2")
def source_overlaps(spark, sf_dir):
    return yields.overlaps_of(keyed(spark, sf_dir).where("not is_noise").select(F.col("source_id").alias("source"), "key"))


@query(f"""WITH {KEYED_SQL}, a AS (SELECT key, count(*) AS n_a FROM keyed WHERE is_noise GROUP BY key), b AS (SELECT key, count(*) AS n_b FROM keyed WHERE NOT is_noise GROUP BY key)
SELECT coalesce(a.key, b.key) AS key, coalesce(n_a, 0) AS n_produced, coalesce(n_b, 0) AS n_published FROM a FULL JOIN b ON a.key = b.key""")
def event_index_full_outer(spark, sf_dir):
    """Produced and published keys side by side, with those of one side alone."""
    k = keyed(spark, sf_dir)
    a = k.where("is_noise").groupBy("key").agg(F.count("*").alias("n_a"))
    b = k.where("not is_noise").groupBy("key").agg(F.count("*").alias("n_b"))
    return a.join(b, "key", "full_outer").select("key", F.coalesce("n_a", F.lit(0)).alias("n_produced"), F.coalesce("n_b", F.lit(0)).alias("n_published"))


@query(f"""WITH {KEYED_SQL}, web AS (SELECT DISTINCT key FROM keyed WHERE p_size % 2 = 0), grp AS (SELECT DISTINCT key FROM keyed WHERE p_size % 3 = 0), pg AS (SELECT DISTINCT source_id, key FROM keyed WHERE p_size % 2 = 1)
SELECT source_id, count(*) AS n_keys, count(*) FILTER (WHERE key NOT IN (SELECT key FROM web)) AS n_novel, count(*) FILTER (WHERE key IN (SELECT key FROM grp)) AS n_in_groups FROM pg GROUP BY source_id""")
def novelty(spark, sf_dir):
    """How much of each page's keys is new against the web, and how much groups have. Key sets are joined by key, not sent about."""
    k = keyed(spark, sf_dir).withColumn("web", F.col("p_size") % 2 == 0).withColumn("grp", F.col("p_size") % 3 == 0)
    flags = k.groupBy("key").agg(F.max("web").alias("web"), F.max("grp").alias("grp"))
    pages = k.where("not web").select("source_id", "key").distinct().join(flags, "key")
    return pages.groupBy("source_id").agg(F.count("*").alias("n_keys"), F.count_if(~F.col("web")).alias("n_novel"), F.count_if("grp").alias("n_in_groups"))


@query(f"""WITH {KEYED_SQL}, pub AS (SELECT DISTINCT key FROM keyed WHERE NOT is_noise) SELECT venue, bool_or(key IN (SELECT key FROM pub)) AS yielded FROM keyed WHERE is_noise GROUP BY venue""")
def host_yield_semi(spark, sf_dir):
    """Whether any key of a host was published."""
    k = keyed(spark, sf_dir)
    hit = k.where("is_noise").join(k.where("not is_noise").select("key").distinct(), "key", "left_semi").select("venue").distinct().withColumn("hit", F.lit(True))
    return k.where("is_noise").select("venue").distinct().join(hit, "venue", "left").select("venue", F.coalesce("hit", F.lit(False)).alias("yielded"))


@query("""WITH RECURSIVE e AS (SELECT CAST(o_orderkey AS BIGINT) AS loser, CAST(o_orderkey // 2 AS BIGINT) AS winner FROM orders WHERE o_orderkey % 3 <> 0), w AS (SELECT loser, winner AS f, 1 AS hop FROM e UNION ALL SELECT w.loser, e.winner, hop + 1 FROM w JOIN e ON w.f = e.loser WHERE e.winner <> w.f AND hop < 100)
SELECT loser, arg_max(f, hop) AS final FROM w GROUP BY loser""")
def winner_chain(spark, sf_dir):
    """Losers to their final winners. Orders of every third key are nobody's losers, so that chains end."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0")
    edges = o.select(F.col("o_orderkey").cast("long").alias("loser"), F.expr("o_orderkey div 2").cast("long").alias("winner"))
    return dedupe.final_winners(edges)


SUPPLIER_COST_SQL = f"""{KEYED_SQL}, c AS (SELECT 'm' || (p_size % 50) AS source, round(sum(price), 2) AS cost FROM keyed GROUP BY 1)"""


@query(f"""WITH RECURSIVE {SUPPLIER_COST_SQL}, o AS (SELECT source, cost, row_number() OVER (ORDER BY cost, source) AS rank FROM c),
f AS (SELECT 0 AS rank, CAST(0 AS DOUBLE) AS s, false AS fits UNION ALL SELECT CAST(o.rank AS INTEGER), CASE WHEN f.s + o.cost <= (SELECT sum(cost) * 0.3 FROM c) THEN f.s + o.cost ELSE f.s END, f.s + o.cost <= (SELECT sum(cost) * 0.3 FROM c) FROM f JOIN o ON o.rank = f.rank + 1)
SELECT o.source, o.cost, CAST(o.rank AS INTEGER) AS rank, f.fits FROM o JOIN f ON o.rank = f.rank""")
def budget_rank(spark, sf_dir):
    """Sources in order of cost under a budget of three tenths of all; one that doesn't fit is passed over."""
    c = catalog(spark, sf_dir).groupBy(F.concat(F.lit("m"), (F.col("p_size") % 50).cast("string")).alias("source")).agg(F.round(F.sum("price"), 2).alias("cost"))
    limit = c.agg(F.sum("cost") * 0.3).first()[0] or 0.0
    return budget.greedy_budget(c, ["cost", "source"], "cost", limit).select("source", "cost", "rank", "fits")


@query(f"""WITH {CATALOG_SQL}, s AS (SELECT town, source_id, round(avg(price), 4) AS p FROM catalog GROUP BY ALL), m AS (SELECT *, p > 25500 AS muted FROM s), r AS (SELECT *, count(*) FILTER (WHERE NOT muted) OVER (PARTITION BY town) AS alive, row_number() OVER (PARTITION BY town, muted ORDER BY p, source_id) AS k FROM m)
SELECT town, source_id, muted AND k <= 2 - alive AS rescued FROM r""")
def town_floor(spark, sf_dir):
    s = catalog(spark, sf_dir).groupBy("town", "source_id").agg(F.round(F.avg("price"), 4).alias("p")).withColumn("muted", F.col("p") > 25500)
    return budget.town_floor(s, "town", ~F.col("muted"), F.col("muted"), [F.col("p"), F.col("source_id")], 2).select("town", "source_id", "rescued")


@query()
def drop_simulation(spark, sf_dir):
    """Which sources could go without losing a key, from the dearest on."""
    k = keyed(spark, sf_dir)
    costs = k.groupBy(F.col("source_id").alias("source")).agg(F.round(F.sum("price"), 2).alias("cost"))
    return yields.simulate_drops(k.where("not is_noise").select(F.col("source_id").alias("source"), "key"), costs)


@query(f"""WITH {CATALOG_SQL}, p AS (SELECT town, pos, quantity, row_number() OVER (PARTITION BY town, date_start ORDER BY (CASE WHEN p_size % 3 = 0 THEN 0 ELSE 1 END), pos) AS k, date_start FROM catalog)
SELECT town, date_start, pos, CAST(k AS INTEGER) AS rank FROM p WHERE k <= 7""")
def followup_queue(spark, sf_dir):
    """The first seven of each town and day, wanted ones first, then in order."""
    c = catalog(spark, sf_dir)
    wanted = F.when(F.col("p_size") % 3 == 0, 0).otherwise(1)
    return yields.top_k(c, ["town", "date_start"], [wanted, F.col("pos")], 7).select("town", "date_start", "pos", "rank")


@query(f"""WITH {CATALOG_SQL}, s AS (SELECT * FROM (VALUES ('tomorrow', DATE '1997-05-02', DATE '1997-05-02'), ('weekend', DATE '1997-05-03', DATE '1997-05-04')) t(section, f, l)),
h AS (SELECT section, pos, CASE WHEN date_end IS NULL THEN date_start ELSE greatest(date_start, f) END AS day, p_size % 4 = 0 AS family FROM catalog, s WHERE date_start <= l AND coalesce(date_end, date_start) >= f)
SELECT section, pos, day, CAST(row_number() OVER (PARTITION BY section ORDER BY family DESC, day, pos) AS INTEGER) AS place FROM h""")
def digest_pick(spark, sf_dir):
    """What a digest shows in its sections, in order: family first, then by the first day in the section."""
    sections = spark.createDataFrame([("tomorrow", "1997-05-02", "1997-05-02"), ("weekend", "1997-05-03", "1997-05-04")], "section string, f string, l string").select("section", F.col("f").cast("date"), F.col("l").cast("date"))
    days = D.occurs_in(F.lit(None).cast("array<date>"), F.col("date_start"), F.col("date_end"), F.col("f"), F.col("l"))
    hit = catalog(spark, sf_dir).join(F.broadcast(sections), (F.col("date_start") <= F.col("l")) & (F.coalesce("date_end", "date_start") >= F.col("f"))).withColumn("day", days[0]).withColumn("family", F.col("p_size") % 4 == 0)
    place = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("family"), "day", "pos"))
    return hit.select("section", "pos", "day", place.alias("place"))


@query(f"""WITH {CATALOG_SQL}, r AS (SELECT source_id, pos, ship_day, ship_day >= DATE '2001-09-01' AS recent, row_number() OVER (PARTITION BY source_id ORDER BY ship_day DESC, pos DESC) AS k FROM catalog),
n AS (SELECT *, count(*) FILTER (WHERE recent) OVER (PARTITION BY source_id) AS c FROM r), kept AS (SELECT * FROM n WHERE CASE WHEN c >= 5 THEN recent ELSE k <= 5 END)
SELECT source_id, pos, newest FROM (SELECT source_id, pos, CAST(row_number() OVER (PARTITION BY source_id ORDER BY ship_day DESC, pos DESC) AS INTEGER) AS newest FROM kept) WHERE newest <= 20""")
def retention_window(spark, sf_dir):
    """Recent rows of each source, at least five and at most twenty."""
    c = catalog(spark, sf_dir).select("source_id", "pos", "ship_day")
    return retention.retain(c, ["source_id"], [F.col("ship_day"), F.col("pos")], F.col("ship_day") >= F.lit("2001-09-01").cast("date"), 5, 20).select("source_id", "pos", "newest")


@query("""SELECT s_suppkey, n_name, round(sqrt(pow(greatest(0.0, 52.2 - lat, lat - 52.6) * 111.32, 2) + pow(greatest(0.0, 16.6 - lon, lon - 17.2) * 111.32 * cos(radians(lat)), 2)), 6) AS km,
CAST(floor(s_suppkey % 7) AS INTEGER) AS ring FROM (SELECT *, 50.0 + (s_suppkey * 37 % 500) / 100.0 AS lat, 15.0 + (s_suppkey * 53 % 400) / 100.0 AS lon FROM supplier) JOIN nation ON s_nationkey = n_nationkey""")
def bbox_distance(spark, sf_dir):
    """Kilometres of every place from the region's box."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    lat, lon = F.lit(50.0) + (F.col("s_suppkey") * 37 % 500) / 100.0, F.lit(15.0) + (F.col("s_suppkey") * 53 % 400) / 100.0
    km = geo.distance_to_bounds(lat, lon, F.lit(52.2), F.lit(16.6), F.lit(52.6), F.lit(17.2))
    return s.select("s_suppkey", "n_name", F.round(km, 6).alias("km"), (F.col("s_suppkey") % 7).cast("int").alias("ring"))


@query(f"""WITH {CATALOG_SQL}, g AS (SELECT source_id, count(*) AS records, CAST(max(date_start) - min(date_start) AS INTEGER) / 30.0 AS span, count(*) % 2 = 0 AS at_limit FROM catalog GROUP BY source_id), n AS (SELECT *, greatest(1.0, round(2.0)) * 1.2 AS need FROM g)
SELECT source_id, CAST(least(greatest(CASE WHEN NOT at_limit THEN ceil(records * 1.2) WHEN span >= need THEN ceil(records / span * need) ELSE ceil(30 * 1.2 * need / greatest(span, 0.1)) END, 5), 50) AS BIGINT) AS next_limit FROM n""")
def limit_regulator(spark, sf_dir):
    g = catalog(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("records"), (F.datediff(F.max("date_start"), F.min("date_start")) / 30.0).alias("span"), (F.count("*") % 2 == 0).alias("at_limit"))
    return g.select("source_id", budget.next_limit(F.col("records"), F.lit(30), F.col("span"), F.col("at_limit"), F.lit(2.0)).alias("next_limit"))


@query(f"""WITH {CATALOG_SQL}, p AS (SELECT DISTINCT town, source_id, venue, title FROM catalog), k AS (SELECT town, source_id, count(DISTINCT title) AS n FROM p GROUP BY ALL)
SELECT town, source_id, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY town ORDER BY n DESC, source_id) AS rank FROM k) WHERE rank <= 5""")
def best_peer(spark, sf_dir):
    """The five sources of each town with the most titles."""
    k = catalog(spark, sf_dir).groupBy("town", "source_id").agg(F.count_distinct("title").alias("n"))
    return yields.top_k(k, ["town"], [F.desc("n"), F.col("source_id")], 5).select("town", "source_id", "n", "rank")


@query(f"""WITH {CATALOG_SQL}, w AS (SELECT DISTINCT town, unnest(list_filter(string_split(replace(lower(title), '#', ''), ' '), lambda x: length(x) >= 3)) AS word FROM catalog), s AS (SELECT DISTINCT town, substr(word, 1, 5) AS stem FROM w)
SELECT stem, count(*) AS n_towns FROM s GROUP BY stem""")
def stem_frequency(spark, sf_dir):
    """In how many towns each word stem occurs in titles."""
    t = catalog(spark, sf_dir).select("town", "title").distinct()
    return t.select("town", F.explode(text.stems(F.regexp_replace("title", "#", ""))).alias("stem")).distinct().groupBy("stem").agg(F.count("*").alias("n_towns"))
