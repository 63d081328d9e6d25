"""Tables of a data folder, and the views of events, runs, pages, dumps and posts over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event for each line item: part and brand as title, nation as town, supplier as source and venue, months as days."""
    t = lambda n: table(spark, sf_dir, n)
    month = F.trunc("l_shipdate", "MM")
    return (
        t("lineitem")
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")).alias("pos"),
            F.concat(F.lit("s"), F.col("l_suppkey")).alias("source_id"),
            F.concat_ws(" ", "p_name", "p_brand").alias("title"),
            F.col("n_name").alias("town"),
            F.col("s_name").alias("venue"),
            month.alias("date_start"),
            F.when(F.col("l_linenumber") % 5 == 0, F.date_add(month, F.col("l_quantity").cast("int"))).alias("date_end"),
            (F.col("l_returnflag") == "R").alias("is_noise"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").cast("long").alias("quantity"),
            F.col("l_shipdate").cast("date").alias("ship_day"),
            "p_type",
            "p_size",
        )
    )


CATALOG_SQL = """catalog AS (
  SELECT (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS pos, 's' || l_suppkey AS source_id, p_name || ' ' || p_brand AS title, n_name AS town, s_name AS venue,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS date_start,
         CASE WHEN l_linenumber % 5 = 0 THEN CAST(CAST(date_trunc('month', l_shipdate) AS DATE) + CAST(l_quantity AS INTEGER) AS DATE) END AS date_end,
         l_returnflag = 'R' AS is_noise, l_extendedprice AS price, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_shipdate AS DATE) AS ship_day, p_type, p_size
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's run for each event of the stream: the user as source, the type as status, the value as cost, k and the day as key."""
    status = F.create_map(*[F.lit(x) for pair in (("click", "ok"), ("view", "unchanged"), ("error", "error"), ("signup", "empty"), ("purchase", "produced")) for x in pair])
    day = F.col("ts").cast("date")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("u"), F.col("user_id")).alias("source"),
        day.alias("day"),
        status[F.col("event_type")].alias("status"),
        F.col("value").alias("cost"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.concat_ws("|", F.get_json_object("props", "$.k"), day.cast("string")).alias("key"),
    )


RUNS_SQL = """runs AS (
  SELECT event_id, 'u' || user_id AS source, CAST(ts AS DATE) AS day,
         CASE event_type WHEN 'click' THEN 'ok' WHEN 'view' THEN 'unchanged' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'empty' WHEN 'purchase' THEN 'produced' END AS status,
         value AS cost, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') || '|' || CAST(CAST(ts AS DATE) AS VARCHAR) AS key
  FROM events)"""


def dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump of a source for each document: seven documents of a source in a row, by id, are its dumps of one day."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    return table(spark, sf_dir, "documents").select("doc_id", "source", ((n - 1) / 7).cast("int").alias("day"), F.coalesce("text", F.lit("")).alias("text"))


DUMPS_SQL = """dumps AS (
  SELECT doc_id, source, CAST(floor((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) / 7) AS INTEGER) AS day, coalesce(text, '') AS text FROM documents)"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, pos, href of every link of every page."""
    found = F.regexp_extract_all("html", F.lit("href=[\"']([^\"'#]+)[\"']"), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(found).alias("pos", "href"))


LINKS_SQL = """links AS (
  SELECT page_id, url, CAST(unnest(range(len(h))) AS INTEGER) AS pos, unnest(h) AS href
  FROM (SELECT page_id, url, regexp_extract_all(html, 'href=["'']([^"''#]+)["'']', 1) AS h FROM pages))"""


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group's post for each turn: the turn before is the original that it shares."""
    from pyspark.sql import Window

    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")).alias("original"))


POSTS_SQL = "posts AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS original FROM conversations)"
