"""Queries of the registry: verdicts of probes, and what sources carry from probe to probe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.operators import normalise, registry
from gleanery.plans.registry import query
from gleanery.sources.tables import RUNS_SQL, runs, table

#: A source's probe of a day: what its runs of that day say. Runs without evidence are no probes of an address.
PROBES_SQL = f"""{RUNS_SQL}, d AS (SELECT source AS source_id, CAST(day - DATE '1970-01-01' AS BIGINT) AS day, bool_or(status IN ('ok', 'produced')) AS answered, bool_or(status = 'error') AS failed, max(coalesce(k, 0)) AS k, count(*) FILTER (WHERE status = 'produced') AS made FROM runs GROUP BY ALL),
probes AS (SELECT source_id, day, answered, k, 'http://' || source_id || '.pl/list' || CASE WHEN CAST(substr(source_id, 2) AS BIGINT) % 2 = 0 THEN '?page={{page}}' ELSE '' END AS url, CASE WHEN answered OR failed THEN 'plain' ELSE 'fb' END AS fetch,
CASE WHEN answered THEN 'ok' WHEN k % 5 = 0 THEN 'dns-dead' ELSE 'http-error' END AS reach, day % 3 = 0 AS can_search, k % 11 = 3 AS found, k % 4 = 1 AS moved, k % 6 = 2 AS elsewhere, k % 13 = 0 AND day % 2 = 0 AS is_new, CASE WHEN k % 7 = 5 THEN 2 ELSE 0 END AS harvested FROM d)"""


def probes(spark, sf_dir) -> DataFrame:
    """A probe of each source and day of the run log."""
    r = runs(spark, sf_dir).groupBy(F.col("source").alias("source_id"), F.datediff("day", F.lit("1970-01-01").cast("date")).cast("long").alias("day"))
    d = r.agg(F.bool_or(F.col("status").isin("ok", "produced")).alias("answered"), F.bool_or(F.col("status") == "error").alias("failed"), F.max(F.coalesce("k", F.lit(0))).alias("k"))
    even = F.substring("source_id", 2, 20).cast("long") % 2 == 0
    base = F.concat(F.lit("http://"), "source_id", F.lit(".pl/list"))
    url = F.concat(base, F.when(even, "?page={page}").otherwise(""))
    probed = F.concat(base, F.when(even, "?page=1").otherwise(""))
    k = F.col("k")
    return d.select(
        "source_id",
        "day",
        url.alias("url"),
        F.when(F.col("answered") | F.col("failed"), "plain").otherwise("fb").alias("fetch"),
        F.when(F.col("answered"), "ok").when(k % 5 == 0, "dns-dead").otherwise("http-error").alias("reach"),
        "answered",
        F.when(k % 6 == 2, F.concat(F.lit("https://"), "source_id", F.lit(".pl/calendar"))).when(k % 4 == 1, F.replace(probed, F.lit("http:"), F.lit("https:"))).otherwise(probed).alias("reached_url"),
        F.lit("plain").alias("reached_fetch"),
        (F.col("day") % 3 == 0).alias("can_search"),
        F.when(k % 11 == 3, F.concat(F.lit("https://new-"), "source_id", F.lit(".pl/"))).alias("candidate"),
        F.lit("ok").alias("candidate_reach"),
        F.lit(None).cast("string").alias("candidate_url"),
        F.when(k % 13 == 0, "none").alias("verdict"),
        (k % 2 == 1).alias("dated"),
        ((k % 13 == 0) & (F.col("day") % 2 == 0)).alias("is_new"),
        F.when(k % 7 == 5, 2).otherwise(0).alias("harvested"),
    )


JUDGED_SQL = f"""{PROBES_SQL}, j AS (SELECT *, can_search AND found AS replaced, CASE WHEN elsewhere THEN 'https://' || source_id || '.pl/calendar' WHEN moved THEN replace(url, 'http:', 'https:') ELSE url END AS there, is_new AND k % 2 = 0 AS barren FROM probes),
judged AS (SELECT source_id, day, url, CASE WHEN "fetch" = 'fb' THEN 'skipped' WHEN (answered OR replaced) AND barren THEN 'dead' WHEN answered AND there <> url THEN 'fixed' WHEN answered THEN 'ok' WHEN replaced THEN 'fixed' WHEN NOT can_search AND reach <> 'dns-dead' THEN 'error' WHEN harvested > 0 THEN 'error' ELSE 'dead' END AS outcome,
CASE WHEN "fetch" = 'fb' THEN 'not-probed' WHEN (answered OR replaced) AND barren THEN 'no-events' WHEN answered AND there <> url THEN 'moved' WHEN answered THEN 'answered' WHEN replaced THEN 'replaced' WHEN NOT can_search AND reach <> 'dns-dead' THEN 'no-search' WHEN harvested > 0 THEN 'harvested' ELSE 'unreachable' END AS why,
CASE WHEN "fetch" = 'fb' THEN NULL WHEN answered THEN nullif(there, url) WHEN replaced THEN 'https://new-' || source_id || '.pl/' END AS new_url FROM j)"""


@query(f"WITH {JUDGED_SQL} SELECT source_id, day, outcome, why, new_url FROM judged")
def probe_verdicts(spark, sf_dir):
    """What every probe says of its source's address."""
    return registry.verdicts(probes(spark, sf_dir)).select("source_id", "day", "outcome", "why", "new_url")


_LIMIT, _RECHECK, _KEEP = CONFIG.blocked_limit, CONFIG.blocked_recheck_days, CONFIG.registry_keep_days


@query(f"""WITH RECURSIVE {JUDGED_SQL}, o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY day, outcome) AS n FROM judged),
s AS (SELECT source_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS day, CAST(NULL AS VARCHAR) AS action, CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS VARCHAR) AS url, false AS dead, CAST(0 AS BIGINT) AS failures, CAST(NULL AS BIGINT) AS last_try, CAST(0 AS BIGINT) AS n_former FROM (SELECT DISTINCT source_id FROM o)
UNION ALL SELECT source_id, n, day, CASE WHEN rest THEN 'resting' ELSE 'tried' END, CASE WHEN NOT rest THEN outcome END, CASE WHEN good AND new_url IS NOT NULL THEN new_url ELSE here END, CASE WHEN good THEN false WHEN NOT rest AND outcome = 'dead' THEN true ELSE dead END,
 CASE WHEN good THEN 0 WHEN NOT rest AND outcome IN ('error', 'dead') THEN failures + 1 ELSE failures END, CASE WHEN good THEN NULL WHEN NOT rest AND outcome IN ('error', 'dead') THEN day ELSE last_try END, n_former + CASE WHEN good AND new_url IS NOT NULL AND new_url <> here THEN 1 ELSE 0 END
 FROM (SELECT *, NOT rest AND outcome IN ('ok', 'fixed') AS good FROM (SELECT o.source_id, o.n, o.day, o.outcome, o.new_url, coalesce(CASE WHEN NOT fresh THEN s.url END, o.url) AS here, NOT fresh AND dead AS dead, CASE WHEN fresh THEN 0 ELSE failures END AS failures, CASE WHEN NOT fresh THEN last_try END AS last_try, CASE WHEN fresh THEN 0 ELSE n_former END AS n_former,
  coalesce(NOT fresh AND failures >= {_LIMIT} AND o.day < last_try + {_RECHECK}, false) AS rest FROM (SELECT *, n AS at_n FROM s) s JOIN o ON o.source_id = s.source_id AND o.n = s.at_n + 1, LATERAL (SELECT coalesce(o.day - s.day > {_KEEP}, false) AS fresh))))
SELECT source_id, day, action, outcome, url, dead, failures, n_former FROM s WHERE n > 0""")
def registry_replay(spark, sf_dir):
    """Each source's standing after every probe: failures in a row, rests and rechecks, addresses. The batch twin of the stream with timers."""
    return registry.replay(registry.verdicts(probes(spark, sf_dir)))


def proposed(spark, sf_dir) -> DataFrame:
    """A model's proposal for each page, in one of seven shapes, some of them no good."""
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^[A-Za-z]+://([^/?#]*)", 1).alias("h"))
    k = F.col("page_id")
    j = lambda **f: F.to_json(F.struct(*[(v if not isinstance(v, str) else F.lit(v)).alias(n) for n, v in f.items()]))
    name = F.concat(F.lit(" Dom Kultury "), k)
    shapes = [
        j(url=F.concat(F.lit("https://"), "h", F.lit("/l?p={page}")), name=name, fetch="plain", type="library", confidence=(k % 30) / 10.0),
        j(url=F.col("h"), name=name, type="library"),
        j(url=F.concat(F.lit("http://facebook.com/groups/g"), k, F.lit("/posts/9/?ref=x")), name=name, fetch="magia", town="Mosina"),
        j(url=F.concat(F.lit("https://www.facebook.com/dk"), k), name=name, fetch="plain", type="venue", id=F.concat(F.lit("Id Łódź "), k)),
        j(url="zobacz w google", name=name),
        j(url=F.concat(F.lit("https://"), "h"), name="  ", confidence="wysoka"),
        F.when(k % 2 == 0, "[1, 2]").otherwise("{ nothing"),
    ]
    return p.select("page_id", F.lit("Luboń").alias("town"), F.get(F.array(*shapes), (k % 7).cast("int")).alias("body"))


PROPOSED_SQL = """p AS (SELECT page_id, page_id % 7 AS s, regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS h FROM pages),
n AS (SELECT page_id, CASE s WHEN 4 THEN 'not-an-address' WHEN 5 THEN 'no-name' WHEN 6 THEN 'not-object' END AS refused, CASE WHEN s IN (0, 1) THEN 'lubon-dom-kultury-' || page_id WHEN s = 2 THEN 'lubon-dom-kultury-' || page_id WHEN s = 3 THEN 'id-lodz-' || page_id END AS id,
CASE WHEN s < 4 THEN 'Dom Kultury ' || page_id END AS name, CASE s WHEN 0 THEN 'library' WHEN 1 THEN 'library' WHEN 2 THEN 'fb_group' WHEN 3 THEN 'venue' END AS type, CASE s WHEN 0 THEN 'https://' || h || '/l?p={page}' WHEN 1 THEN 'https://' || h WHEN 2 THEN 'https://www.facebook.com/groups/g' || page_id WHEN 3 THEN 'https://www.facebook.com/dk' || page_id END AS url,
CASE WHEN s IN (0, 1, 3) THEN 'Luboń' WHEN s = 2 THEN 'Mosina' END AS place, CASE s WHEN 0 THEN 'plain' WHEN 1 THEN 'plain' WHEN 2 THEN 'fb_group' WHEN 3 THEN 'fb' END AS fetch, CASE WHEN s = 0 THEN least(1.0, (page_id % 30) / 10.0) END AS confidence,
CASE s WHEN 0 THEN [] WHEN 1 THEN ['scheme', 'unknown-fetch'] WHEN 2 THEN ['group-root', 'group-fetch', 'group-type'] WHEN 3 THEN ['page-fetch'] END AS fixes FROM p)"""


@query(f"""WITH {PROPOSED_SQL} SELECT page_id, refused, id, name, type, url, place, "fetch", CAST(confidence AS DOUBLE) AS confidence, array_to_string(fixes, ',') AS fixes FROM n""")
def normalised_proposals(spark, sf_dir):
    """Proposals as registry rows, with the fixes that each one took, or why it was turned down."""
    return normalise.proposals(proposed(spark, sf_dir)).select("page_id", "refused", "id", "name", "type", "url", "place", "fetch", "confidence", F.array_join("fixes", ",").alias("fixes"))


@query(f"WITH {PROPOSED_SQL} SELECT fix, count(*) AS n FROM (SELECT unnest(fixes) AS fix FROM n UNION ALL SELECT 'refused: ' || refused FROM n WHERE refused IS NOT NULL) GROUP BY fix")
def proposal_fixes(spark, sf_dir):
    """How often each rule mended a proposal, and why others were turned down."""
    why = F.array(F.concat(F.lit("refused: "), "refused"))
    told = normalise.proposals(proposed(spark, sf_dir)).select(F.explode(F.coalesce("fixes", why)).alias("fix"))
    return told.groupBy("fix").agg(F.count("*").alias("n"))
