"""Queries of de-duplication in all its passes, with SQL that finds components and folds them step by step."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions.text import event_key, norm, tokens
from gleanery.operators import dedupe, graph
from gleanery.operators.durable import release, settle
from gleanery.plans.registry import query
from gleanery.sources.tables import CATALOG_SQL, catalog

#: Every third supplier puts its name before the title, every fourth size is a share of an original: its part.
LISTED_SQL = f"""{CATALOG_SQL}, listed AS (SELECT pos, CASE WHEN CAST(substr(source_id, 2) AS BIGINT) % 3 = 0 THEN venue || ': ' || title ELSE title END AS title, venue, town,
CASE WHEN p_size % 4 = 0 THEN 'o' || (pos % 1000000) END AS origin, date_start, date_end, length(venue) + length(title) + (pos // 1000000) % 7 AS richness FROM catalog WHERE NOT is_noise
QUALIFY row_number() OVER (PARTITION BY pos ORDER BY title, venue, date_start, date_end NULLS FIRST) = 1)"""


def listed(spark, sf_dir):
    """Events as several sources list them: with the organiser before the title or not, some of them shares of one post. Of one pos one row."""
    supplier = F.substring("source_id", 2, 20).cast("long")
    title = F.when(supplier % 3 == 0, F.concat("venue", F.lit(": "), "title")).otherwise(F.col("title"))
    origin = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("o"), (F.col("pos") % 1000000).cast("string")))
    richness = F.length("venue") + F.length("title") + F.expr("pos div 1000000") % 7
    own = ["pos", title.alias("title"), "venue", "town", origin.alias("origin"), "date_start", "date_end", richness.alias("richness"), event_key(title, F.col("date_start")).alias("key")]
    told = settle(catalog(spark, sf_dir).where("not is_noise").select(*own, F.col("title").alias("plain"), "source_id", "p_size"))
    # only rows that share their pos meet: it alone is dealt out
    shared = settle(told.groupBy("pos").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("pos").alias("at")))
    meet = F.col("pos").eqNullSafe(F.col("at"))
    first = F.row_number().over(Window.partitionBy("pos").orderBy("plain", "venue", "date_start", "date_end", "town", "source_id", "p_size"))
    several = told.join(shared, meet, "left_semi").withColumn("first", first).where("first = 1")
    return told.join(shared, meet, "left_anti").drop("plain", "source_id", "p_size").unionByName(several.drop("plain", "source_id", "p_size", "first"))


def _norm(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({c}), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


def _words(c: str) -> str:
    return f"list_distinct(list_filter(string_split({_norm(c)}, ' '), lambda w: length(w) >= {CONFIG.token_length}))"


def _comparable(a: str, b: str) -> str:
    short = CONFIG.short_title_tokens
    return f"""(len({a}.t) > 0 AND len({b}.t) > 0 AND (list_has_all({a}.t, {b}.t) OR list_has_all({b}.t, {a}.t)) AND (least(len({a}.t), len({b}.t)) > {short} OR len({a}.v) = 0 OR len({b}.v) = 0 OR list_has_any({a}.v, {b}.v))
 AND ({a}.s = {b}.s OR ({a}.n = {b}.n AND {a}.s <= {b}.e AND {b}.s <= {a}.e)))"""


def _pass(p: str, source: str) -> str:
    """A pass over a table (bucket, pos, place, n, t, v, s, e, sp, rich): what is reachable over comparable records, then each component in order, a record a step.

    Gives <p>_final (pos, w) of losers and <p>_seat (pos, place) of winners.
    """
    return f"""{p}_rec AS MATERIALIZED (SELECT bucket, {{'pos': pos, 'place': place, 'n': n, 't': t, 'v': v, 's': s, 'e': e, 'sp': sp, 'rich': rich}} AS r FROM {source}),
{p}_pair AS MATERIALIZED (SELECT a.r.pos AS a, b.r.pos AS b FROM {p}_rec a JOIN {p}_rec b ON a.bucket = b.bucket AND a.r.s = b.r.s WHERE a.r.pos <> b.r.pos AND {_comparable('a.r', 'b.r')}
 UNION SELECT a.r.pos, b.r.pos FROM {p}_rec a JOIN {p}_rec b ON a.bucket = b.bucket AND a.r.n = b.r.n WHERE a.r.pos <> b.r.pos AND {_comparable('a.r', 'b.r')}),
{p}_reach AS (SELECT DISTINCT a AS pos, a AS c FROM {p}_pair UNION SELECT r.pos, p.b FROM {p}_reach r JOIN {p}_pair p ON p.a = r.c),
{p}_comp AS MATERIALIZED (SELECT pos, min(c) AS comp FROM {p}_reach GROUP BY pos),
{p}_row AS MATERIALIZED (SELECT comp, r, row_number() OVER (PARTITION BY comp ORDER BY r.place, r.pos) AS k FROM {p}_comp c JOIN {p}_rec x ON x.r.pos = c.pos),
{p}_step AS (SELECT comp, CAST(1 AS BIGINT) AS k, [r] AS seats, CAST([] AS STRUCT(l BIGINT, w BIGINT)[]) AS lost FROM {p}_row WHERE k = 1
 UNION ALL SELECT comp, k, CASE WHEN len(h) = 0 THEN list_append(seats, r) ELSE list_transform(list_filter(range(1, len(seats) + 1), lambda i: i = best OR NOT list_contains(h, i)), lambda i: CASE WHEN i = best THEN holder ELSE seats[i] END) END,
 CASE WHEN len(h) = 0 THEN [] ELSE list_append(list_transform(list_filter(h, lambda i: i <> best), lambda i: {{'l': seats[i].pos, 'w': holder.pos}}), CASE WHEN win THEN {{'l': seats[best].pos, 'w': r.pos}} ELSE {{'l': r.pos, 'w': seats[best].pos}} END) END
 FROM (SELECT *, CASE WHEN win THEN {{'pos': r.pos, 'place': seats[best].place, 'n': r.n, 't': r.t, 'v': r.v, 's': r.s, 'e': r.e, 'sp': r.sp, 'rich': r.rich}} ELSE seats[best] END AS holder
  FROM (SELECT *, CASE WHEN r.sp <> seats[best].sp THEN r.sp ELSE r.rich > seats[best].rich END AS win
   FROM (SELECT *, list_sort(list_transform(h, lambda i: {{'worth': -CAST(seats[i].sp AS BIGINT) * 1000000 - seats[i].rich, 'i': i}}))[1].i AS best
    FROM (SELECT t.comp, x.k, t.seats, x.r, list_filter(range(1, len(t.seats) + 1), lambda i: {_comparable('t.seats[i]', 'x.r')}) AS h FROM {p}_step t JOIN {p}_row x ON x.comp = t.comp AND x.k = t.k + 1))))),
{p}_edge AS MATERIALIZED (SELECT u.l, u.w FROM (SELECT unnest(lost) AS u FROM {p}_step)),
{p}_walk AS (SELECT l, w, 1 AS hop FROM {p}_edge UNION ALL SELECT k.l, e.w, hop + 1 FROM {p}_walk k JOIN {p}_edge e ON e.l = k.w WHERE hop < 1000),
{p}_final AS MATERIALIZED (SELECT l AS pos, arg_max(w, hop) AS w FROM {p}_walk GROUP BY l),
{p}_seat AS MATERIALIZED (SELECT u.pos, u.place FROM (SELECT unnest(arg_max(seats, k)) AS u FROM {p}_step GROUP BY comp))"""


_RECORD = f"pos, place, {_norm('title')} AS n, {_words('title')} AS t, {_words('venue')} AS v, date_start AS s, coalesce(date_end, date_start) AS e, date_end IS NOT NULL AS sp, richness AS rich"
_KEYED_SQL = f"""{LISTED_SQL}, keyed AS (SELECT *, substr(regexp_replace(lower(title), '[^a-zA-Z0-9_]+', '', 'g'), 1, {CONFIG.key_length}) || '|' || CAST(date_start AS VARCHAR) AS key FROM listed),
one AS MATERIALIZED (SELECT key, arg_max(pos, {{'r': richness, 'p': -pos}}) AS pos, min(pos) AS place FROM keyed GROUP BY key)"""


@query(f"""WITH RECURSIVE {_KEYED_SQL}, first AS MATERIALIZED (SELECT l.*, one.place FROM one JOIN listed l USING (pos)),
{_pass('o', f"(SELECT origin AS bucket, {_RECORD} FROM first WHERE origin IS NOT NULL)")},
second AS MATERIALIZED (SELECT f.* REPLACE (coalesce(s.place, f.place) AS place) FROM first f LEFT JOIN o_seat s USING (pos) WHERE f.pos NOT IN (SELECT pos FROM o_final)),
{_pass('t', f"(SELECT {_norm('town')} AS bucket, {_RECORD} FROM second)")},
c AS (SELECT k.pos AS own, one.pos AS w1, coalesce(o.w, one.pos) AS w2 FROM keyed k JOIN one USING (key) LEFT JOIN o_final o ON o.pos = one.pos)
SELECT own AS pos, coalesce(t.w, w2) AS winner_pos, CASE WHEN own <> w1 THEN 'key' WHEN w1 <> w2 THEN 'origin' WHEN t.w IS NOT NULL THEN 'containment' END AS why FROM c LEFT JOIN t_final t ON t.pos = w2""")
def dedupe_full(spark, sf_dir):
    """All passes: by key, by original, by containment of titles in a town. Each row's final winner, and the pass that it lost in."""
    return dedupe.every_pass(listed(spark, sf_dir))


@query(f"""WITH RECURSIVE {_KEYED_SQL}, r AS MATERIALIZED (SELECT l.pos, l.town, {_norm('title')} AS n, {_words('title')} AS t, {_words('venue')} AS v, date_start AS s, coalesce(date_end, date_start) AS e FROM one JOIN listed l USING (pos)),
p AS MATERIALIZED (SELECT a.pos AS a, b.pos AS b FROM r a JOIN r b ON a.town = b.town AND a.s = b.s AND a.pos <> b.pos AND {_comparable('a', 'b')}
 UNION SELECT a.pos, b.pos FROM r a JOIN r b ON a.town = b.town AND a.n = b.n AND a.pos <> b.pos AND {_comparable('a', 'b')}),
w AS (SELECT DISTINCT a AS id, a AS c FROM p UNION SELECT w.id, p.b FROM w JOIN p ON p.a = w.c)
SELECT component, count(*) AS n_rows FROM (SELECT id, min(c) AS component FROM w GROUP BY id) GROUP BY component""")
def title_components(spark, sf_dir):
    """The components that are folded one by one: records of a town tied by titles that hold each other, and the rows of each."""
    first = dedupe.by_key(listed(spark, sf_dir)).select(F.col("winner_pos").alias("pos"), "title", "venue", F.col("town").alias("bucket"), "date_start", F.coalesce("date_end", "date_start").alias("date_end"))
    words = lambda c: F.when(F.col(c).isNotNull(), F.concat_ws(" ", F.sort_array(tokens(F.col(c)))))
    # written once, and again in classes of rows alike: both are read several times
    named = settle(first.select("pos", "bucket", norm(F.col("title")).alias("n"), words("title").alias("t"), words("venue").alias("v"), "date_start", "date_end"))
    rows = dedupe.classes(named)
    release(named)
    told = rows.groupBy("class_id").agg(F.count("*").alias("rows")).join(graph.components(dedupe.title_links(rows)).withColumnRenamed("id", "class_id"), "class_id", "left")
    return told.groupBy(F.coalesce("component", "class_id").alias("component")).agg(F.sum("rows").alias("n_rows")).where("n_rows > 1")
