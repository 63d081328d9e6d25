"""Queries over pages, dumps and posts: texts, addresses, blocks, furniture, reuse."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanery.functions import redact, text, urls
from gleanery.operators import blocks, filters
from gleanery.plans.registry import query
from gleanery.sources.tables import DUMPS_SQL, LINKS_SQL, POSTS_SQL, dumps, links, posts, table

#: Lines in a block where a text has no blank lines to cut at.
RUN = 5

NORM_SQL = f"trim(regexp_replace(regexp_replace(translate(lower(coalesce(text, '')), '{text.ACCENTED}', '{text.PLAIN}'), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


@query(f"SELECT doc_id, md5({NORM_SQL}) AS norm_md5, CAST(len(list_distinct(list_filter(string_split({NORM_SQL}, ' '), lambda w: length(w) >= 4))) AS INTEGER) AS n_tokens FROM documents")
def text_norm(spark, sf_dir):
    """The normal form of every text, as a hash, and its distinct words."""
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.norm(t)).alias("norm_md5"), F.size(text.tokens(t)).alias("n_tokens"))


@query(f"""SELECT doc_id, substr(regexp_replace(regexp_replace(translate(lower(coalesce(text, '')), '{text.POLISH}', '{text.POLISH_PLAIN}'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 48) AS slug, md5(translate(lower(coalesce(text, '')), '{text.ACCENTED}ł', '{text.PLAIN}l')) AS fold_md5 FROM documents""")
def slug(spark, sf_dir):
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", text.slug(t).alias("slug"), F.md5(text.fold(t)).alias("fold_md5"))


@query("SELECT source, sha256(regexp_replace(coalesce(text, ''), '/(?:19|20)\\d\\d-\\d\\d-\\d\\d(?:/)?(?:\\?[^\\s\\]]*)?', '/@@D@@', 'g')) AS hash, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1, 2")
def block_hashes(spark, sf_dir):
    """Content hashes of texts, with how often each occurs in a source."""
    d = table(spark, sf_dir, "documents").select("source", "doc_id", text.block_hash(F.coalesce("text", F.lit(""))).alias("hash"))
    return d.groupBy("source", "hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query("""SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS host,
regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') || lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '')) || CASE WHEN regexp_extract(url, '\\?([^#]*)', 1) <> '' THEN '?' || array_to_string(list_sort(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&')), '&') ELSE '' END AS url_key FROM pages""")
def url_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("host"), urls.url_key(F.col("url")).alias("url_key"))


@query()
def url_template_groups(spark, sf_dir):
    """Groups of link addresses of one shape on each host, with their score as a list of entries."""
    own = links(spark, sf_dir).withColumn("full", F.when(F.col("href").startswith("/"), F.concat(F.lit("http://"), urls.host(F.col("url")), F.col("href"))).otherwise(F.col("href")))
    grouped = own.where(urls.host(F.col("full")) != "").groupBy(urls.host(F.col("full")).alias("host"), urls.url_template(F.col("full")).alias("template")).agg(F.count_distinct("full").alias("n_urls"), F.avg((F.col("pos") >= 5).cast("double")).alias("ratio"))
    return grouped.withColumn("score", F.round(urls.template_score(F.col("n_urls"), F.col("ratio"), F.col("template")), 6)).select("host", "template", "n_urls", "score")


@query(f"WITH {LINKS_SQL} SELECT href, count(*) AS n, count(DISTINCT page_id) AS n_pages, min(page_id * 1000 + pos) AS first FROM links GROUP BY href")
def page_links(spark, sf_dir):
    """Addresses that pages link to."""
    return links(spark, sf_dir).groupBy("href").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("n_pages"), F.min(F.col("page_id") * 1000 + F.col("pos")).alias("first"))


@query("""WITH u AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)) AS p FROM pages) SELECT page_id, len(list_filter(string_split(p, '/'), lambda s: s IN ('fr', 'de', 'es'))) > 0 AS dropped FROM u""")
def repertoire_urls(spark, sf_dir):
    """Whether a segment of a page's path is on the list."""
    return table(spark, sf_dir, "pages").select("page_id", filters.repertoire_hit(urls.path(F.col("url")), ("fr", "de", "es")).alias("dropped"))


@query()
def chrome_blocks(spark, sf_dir):
    """Furniture and content of pages: blocks of five visible lines, which are sent and which aren't."""
    visible = F.regexp_replace(F.regexp_replace("html", "(?is)<(script|style)[^>]*>.*?</\\1>", " "), "(?i)</?(p|li|h[1-6]|div|br|nav|footer|article)[^>]*>", "\n")
    links_kept = F.regexp_replace(visible, "(?is)<a[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>", "$2 [$1]")
    lines = F.filter(F.transform(F.split(F.regexp_replace(links_kept, "<[^>]+>", ""), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    pages = table(spark, sf_dir, "pages").select("page_id", lines.alias("lines"))
    cut = pages.select("page_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size("lines") - 1) / 5)).cast("int")), lambda k: F.array_join(F.slice("lines", k * 5 + 1, 5), "\n"))).alias("pos", "text"))
    return blocks.partition_chrome(cut, "page_id", "text").select("page_id", "pos", F.length("text").alias("chars"), "chrome", "sent")


@query()
def segment(spark, sf_dir):
    """Content-hashed blocks of all texts; a line counts as a paragraph, as the texts have no blank lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", "\n", "\n\n").alias("text"))
    return blocks.segment(docs, "doc_id", "text").select(F.col("page").alias("doc_id"), "pos", "cut", "hash", "chars")


@query("SELECT doc_id, CAST(len(list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '\\n', '\n\n', 'g'), '\n\n'), lambda p: trim(p, ' \t')), lambda p: p <> '')) AS INTEGER) AS n FROM documents")
def paragraphs(spark, sf_dir):
    """How many paragraphs each text has, lines taken as such."""
    return table(spark, sf_dir, "documents").select("doc_id", F.size(text.paragraphs(F.regexp_replace(F.coalesce("text", F.lit("")), "\n", "\n\n"))).alias("n"))


@query(f"WITH {DUMPS_SQL} SELECT source, day, doc_id, length(text) AS chars FROM (SELECT *, row_number() OVER (PARTITION BY source, day ORDER BY length(text) DESC, doc_id) AS r FROM dumps WHERE trim(text) <> '') WHERE r = 1")
def longest_dump(spark, sf_dir):
    """The longest dump of each source and day."""
    d = dumps(spark, sf_dir).where(F.trim("text") != "")
    best = d.groupBy("source", "day").agg(F.max(F.struct(F.length("text").alias("chars"), (-F.col("doc_id")).alias("d"))).alias("b"))
    return best.select("source", "day", (-F.col("b.d")).alias("doc_id"), F.col("b.chars").cast("long").alias("chars"))


@query(f"WITH {DUMPS_SQL} SELECT source, max(day) AS day, arg_max(doc_id, CAST(day AS BIGINT) * 1000000000 + doc_id) AS doc_id FROM dumps WHERE day <= 4 AND trim(text) <> '' GROUP BY source")
def asof_dump(spark, sf_dir):
    """Each source's latest dump at or before a day."""
    d = dumps(spark, sf_dir).where((F.col("day") <= 4) & (F.trim("text") != ""))
    return d.groupBy("source").agg(F.max("day").alias("day"), F.max_by("doc_id", F.struct("day", "doc_id")).alias("doc_id"))


@query(f"""WITH {DUMPS_SQL}, l AS (SELECT source, day, unnest(string_split(text, '\n')) AS line FROM dumps), c AS (SELECT source, day, line, count(*) AS n FROM l GROUP BY ALL)
SELECT b.source, b.day, round(sum((length(b.line) + 1) * least(coalesce(a.n, 0), b.n)) / sum((length(b.line) + 1) * b.n), 6) AS ceiling FROM c b LEFT JOIN c a ON a.source = b.source AND a.line = b.line AND a.day = b.day - 1 WHERE b.day >= 1 GROUP BY b.source, b.day""")
def ceiling_reuse(spark, sf_dir):
    """Of each day's lines, weighted by length, the share that the day before had."""
    d = dumps(spark, sf_dir).select("source", "day", "text")
    shifted = d.withColumn("day", F.col("day") + 1).withColumn("key", F.struct("source", "day"))
    today = d.where("day >= 1").withColumn("key", F.struct("source", "day"))
    out = blocks.line_ceiling(shifted, today, "key", "text")
    return out.select("key.source", "key.day", F.round("ceiling", 6).alias("ceiling"))


@query(f"""WITH {DUMPS_SQL}, p AS (SELECT source, string_split(text, chr(10)) AS l, lag(text) OVER (PARTITION BY source ORDER BY doc_id) AS before FROM dumps),
b AS (SELECT source, before, array_to_string(l[k * {RUN} + 1:k * {RUN} + {RUN}], chr(10)) AS block FROM (SELECT *, unnest(range(0, CAST(ceil(len(l) / {RUN}.0) AS BIGINT))) AS k FROM p))
SELECT source, count(*) AS n, count(*) FILTER (WHERE contains(chr(10) || before || chr(10), chr(10) || block || chr(10))) AS n_seen, CAST(sum(length(block)) AS BIGINT) AS chars,
  CAST(coalesce(sum(length(block)) FILTER (WHERE contains(chr(10) || before || chr(10), chr(10) || block || chr(10))), 0) AS BIGINT) AS chars_seen FROM b GROUP BY source""")
def block_seen_before(spark, sf_dir):
    """How many blocks of each source's texts, runs of lines, stand whole in the source's text before."""
    p = dumps(spark, sf_dir).select("source", F.split("text", "\n").alias("l"), F.lag("text").over(Window.partitionBy("source").orderBy("doc_id")).alias("before"))
    cut = F.transform(F.sequence(F.lit(0), F.ceil(F.size("l") / RUN).cast("int") - 1), lambda k: F.array_join(F.slice("l", k * RUN + 1, RUN), "\n"))
    b = p.select("source", "before", F.explode(cut).alias("block")).withColumn("seen", F.coalesce(blocks.seen_in(F.col("block"), F.col("before")), F.lit(False)))
    chars = F.length("block")
    return b.groupBy("source").agg(F.count("*").alias("n"), F.count_if("seen").alias("n_seen"), F.sum(chars).cast("long").alias("chars"), F.sum(F.when(F.col("seen"), chars).otherwise(0)).cast("long").alias("chars_seen"))


@query("SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+(?:\\.[A-Za-z0-9_-]+)+')) AS INTEGER) AS n_emails FROM documents")
def email_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", redact.email_count(F.coalesce("text", F.lit(""))).alias("n_emails"))


REDACTION_SQL = f"""SELECT doc_id, CAST(list_sum(list_transform(parts, lambda p: len(regexp_extract_all(p, '{redact.EMAIL}')))) AS INTEGER) AS n_emails,
  CAST(len(list_filter(flatten(numbers), lambda x: PRIVATE)) AS INTEGER) AS n_phones,
  md5(array_to_string(list_transform(range(1, len(parts) + 1), lambda k: array_to_string(list_transform(range(1, len(rest[k]) + 1), lambda j: rest[k][j] || CASE WHEN numbers[k][j] IS NULL THEN '' WHEN NUMBER THEN '{redact.PHONE_MARK}' ELSE numbers[k][j] END), '') || coalesce(addresses[k], '')), '')) AS text_md5
FROM (SELECT *, list_transform(clean, lambda p: regexp_split_to_array(p, '{redact.PHONE}')) AS rest, list_transform(clean, lambda p: regexp_extract_all(p, '{redact.PHONE}')) AS numbers
  FROM (SELECT *, list_transform(parts, lambda p: regexp_replace(p, '{redact.EMAIL}', '{redact.EMAIL_MARK}', 'g')) AS clean
    FROM (SELECT doc_id, regexp_split_to_array(text, '{redact.ADDRESS}') AS parts, regexp_extract_all(text, '{redact.ADDRESS}') AS addresses FROM documents WHERE text IS NOT NULL)))
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL"""
PRIVATE_SQL = "regexp_matches(regexp_replace({0}, '[^0-9]', '', 'g'), '^(0048|48)?[0-9]{{9}}$') AND substr(right(regexp_replace({0}, '[^0-9]', '', 'g'), 9), 1, 2) NOT IN {1}"


@query(REDACTION_SQL.replace("PRIVATE", PRIVATE_SQL.format("x", redact.LANDLINE)).replace("NUMBER", PRIVATE_SQL.format("numbers[k][j]", redact.LANDLINE)))
def record_redaction(spark, sf_dir):
    """Texts with e-mail addresses and mobile numbers replaced, as a hash, and how many went."""
    out = redact.redact_events(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"])
    return out.select("doc_id", "n_emails", "n_phones", F.md5("text").alias("text_md5"))


@query(f"""WITH {POSTS_SQL} SELECT conv_id, count(*) AS n, count(*) FILTER (WHERE role = 'user') AS n_user, count(*) FILTER (WHERE text = '') AS n_empty, CAST(max(turn) - min(turn) AS BIGINT) AS span, count(*) >= 5 AS at_limit, CAST(sum(length(text)) AS BIGINT) AS chars FROM posts GROUP BY conv_id""")
def group_stats(spark, sf_dir):
    p = posts(spark, sf_dir)
    return p.groupBy("conv_id").agg(F.count("*").alias("n"), F.count_if(F.col("role") == "user").alias("n_user"), F.count_if(F.col("text") == "").alias("n_empty"), (F.max("turn") - F.min("turn")).cast("long").alias("span"), (F.count("*") >= 5).alias("at_limit"), F.sum(F.length("text")).alias("chars"))


@query(f"""WITH {POSTS_SQL}, c AS (SELECT regexp_replace(lower(coalesce(original, '')), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS a, regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS b FROM posts)
SELECT CASE WHEN contains(a, b) THEN 'original' WHEN contains(b, a) THEN 'caption' ELSE 'both' END AS shape, count(*) AS n, CAST(sum(length(b)) AS BIGINT) AS chars FROM c GROUP BY 1""")
def share_stats(spark, sf_dir):
    """Of shared posts and their originals, which of the two adds nothing."""
    p = posts(spark, sf_dir).select(text.share_shape(F.col("original"), F.col("text")).alias("shape"), F.length(text.canonical(F.col("text"))).alias("chars"))
    return p.groupBy("shape").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))


@query(f"WITH {POSTS_SQL} SELECT conv_id, md5(string_agg('POST' || chr(10) || role || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn)) AS text_md5, count(*) AS n FROM posts GROUP BY conv_id")
def posts_to_blocks(spark, sf_dir):
    """A group's posts as one text, in order, as a hash. A conversation is one record by nature."""
    p = posts(spark, sf_dir).select("conv_id", "turn", F.concat_ws("\n", F.lit("POST"), "role", "text").alias("block"))
    joined = p.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "block"))), lambda x: x["block"]), "\n\n---\n\n").alias("t"), F.count("*").alias("n"))
    return joined.select("conv_id", F.md5("t").alias("text_md5"), "n")


@query(f"""WITH RECURSIVE {POSTS_SQL}, o AS (SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS k, turn, length(text) + 12 AS size FROM posts),
f AS (SELECT conv_id, k, turn, CAST(size AS BIGINT) AS s, 0 AS chunk FROM o WHERE k = 1 UNION ALL SELECT o.conv_id, o.k, o.turn, CASE WHEN f.s + o.size > 900 THEN o.size ELSE f.s + o.size END, CASE WHEN f.s + o.size > 900 THEN f.chunk + 1 ELSE f.chunk END FROM f JOIN o ON o.conv_id = f.conv_id AND o.k = f.k + 1)
SELECT conv_id, turn, chunk FROM f""")
def batch_pack(spark, sf_dir):
    """Posts of a group into batches of bounded size, in order."""
    from gleanery.operators.budget import greedy_chunks

    arrays = posts(spark, sf_dir).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", (F.length("text") + 12).cast("long").alias("size")))).alias("items"))
    chunked = arrays.withColumn("chunks", greedy_chunks(F.transform("items", lambda x: x["size"]), 900))
    return chunked.withColumn("turn", F.transform("items", lambda x: x["turn"])).withColumnRenamed("chunks", "chunk").select("conv_id", F.inline(F.arrays_zip("turn", "chunk")))
