"""Queries of durable sinks: batches written, some of them twice, and what reading gives."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.durable import hadoop_path, release, settle, shared_folder
from gleanery.plans.registry import query
from gleanery.sources.tables import DUMPS_SQL, RUNS_SQL, dumps, runs
from gleanery.streaming import sinks

#: Batches that the tables of a query are dealt into.
BATCHES = 3


def fresh_folder(spark, name: str) -> str:
    """A folder of its own in the shared one; it goes when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    where, files = hadoop_path(spark, path)
    files.deleteOnExit(where)
    return path


def archived(spark, sf_dir) -> str:
    """An archive of all dumps, written in batches, the second of them twice. A source's day is seven dumps, so folders hold months."""
    path = fresh_folder(spark, "archive")
    captures = settle(dumps(spark, sf_dir).select(F.date_add(F.lit("2026-08-01").cast("date"), F.col("day")).alias("day"), F.regexp_replace("source", "[^A-Za-z0-9]", "_").alias("source_id"), F.col("text").alias("body"), F.col("doc_id").alias("seen")))
    for k in (0, 1, 1, 2):
        sinks.archive(captures.where(F.col("seen") % BATCHES == k), path, "month")
    release(captures)
    return path


ARCHIVE_SQL = f"{DUMPS_SQL}, a AS (SELECT DATE '2026-08-01' + day AS day, regexp_replace(source, '[^A-Za-z0-9]', '_', 'g') AS source_id, sha256(text) AS hash, min(doc_id) AS seen FROM dumps WHERE source IS NOT NULL GROUP BY ALL)"


@query(f"WITH {ARCHIVE_SQL} SELECT CAST(day AS DATE) AS day, source_id, hash, seen FROM a")
def archive_readback(spark, sf_dir):
    """The archive as it reads: one row for each day, source and distinct body."""
    return sinks.read_archive(spark, archived(spark, sf_dir)).select("day", "source_id", "hash", "seen")


@query(f"WITH {ARCHIVE_SQL}, d AS (SELECT DISTINCT day FROM a ORDER BY day DESC LIMIT 14) SELECT source_id, count(DISTINCT day) AS n_days, count(DISTINCT hash) AS n_bodies FROM a WHERE day IN (SELECT day FROM d) GROUP BY source_id")
def archived_sources(spark, sf_dir):
    """Which sources the archive's fourteen newest days hold."""
    path = archived(spark, sf_dir)
    days = sinks.archived_days(spark, path, 14).agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    return sinks.archived_sources(spark, path, F.lit(days.a), F.lit(days.b))


@query(f"WITH {ARCHIVE_SQL} SELECT source_id, CAST(day AS DATE) AS day, seen, hash FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY seen DESC, hash) AS r FROM a) WHERE r = 1")
def latest_captures(spark, sf_dir):
    """Each source's last capture, from the archive."""
    return sinks.latest_captures(spark, archived(spark, sf_dir))


def _standing(spark, sf_dir) -> tuple[sinks.BatchTable, DataFrame]:
    """A table of sources by day in batches of days, the last one written twice and all of them folded halfway."""
    r = runs(spark, sf_dir).groupBy("source", "day").agg(F.max_by("status", "event_id").alias("status"), F.count("*").alias("n"))
    rows = r.select("source", F.col("day").cast("date").alias("day"), "status", "n")
    table = sinks.BatchTable(spark, fresh_folder(spark, "standing"), rows.select("source", "day", "status", "n").schema, ["source"])
    part = F.pmod(F.datediff("day", F.lit("1970-01-01").cast("date")), F.lit(BATCHES))
    for k in (0, 1, 2, 2):
        table.write(rows.where(part == k).groupBy("source").agg(F.max(F.struct("day", "status", "n")).alias("r")).select("source", "r.*"), k)
        if k == 1:
            table.fold()
    return table, rows


_STANDING_SQL = f"""{RUNS_SQL}, r AS (SELECT source, day, arg_max(status, event_id) AS status, count(*) AS n, (day - DATE '1970-01-01') % {BATCHES} AS k FROM runs GROUP BY source, day)"""


@query(f"WITH {_STANDING_SQL} SELECT source, day, status, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k DESC, day DESC) AS p FROM r) WHERE p = 1")
def merged_batches(spark, sf_dir):
    """Sources by their last batch: batches merged on reading, a replayed one changes nothing."""
    return _standing(spark, sf_dir)[0].read()


@query(f"""WITH {_STANDING_SQL}, l AS (SELECT source, day, status, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k DESC, day DESC) AS p FROM r) WHERE p = 1),
t AS (SELECT source, max(day) AS day FROM r WHERE status = 'error' GROUP BY source)
SELECT coalesce(t.source, l.source) AS source, coalesce(t.day, l.day) AS day, CASE WHEN t.source IS NOT NULL THEN 'error' ELSE l.status END AS status, CASE WHEN t.source IS NOT NULL THEN 0 ELSE l.n END AS n FROM (SELECT * FROM l WHERE status <> 'produced') l FULL JOIN t ON t.source = l.source""")
def dry_run(spark, sf_dir):
    """A run on a copy of state: sources that last produced are forgotten first, then each source's last error is written; the table itself stays as it was."""
    table, rows = _standing(spark, sf_dir)
    draft = table.snapshot()
    draft.forget(F.col("status") == "produced")
    draft.write(rows.where("status = 'error'").groupBy("source").agg(F.max("day").alias("day")).select("source", "day", F.lit("error").alias("status"), F.lit(0).cast("long").alias("n")), 0)
    return draft.read()
