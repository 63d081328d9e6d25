"""Pages to text, and the links of a page, by column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tags whose whole content is no text of the page, and tags that end a line. Fixed values.
SILENT = ("script", "style", "noscript", "nav", "header", "footer", "aside")
BLOCKS = "p|div|li|ul|ol|h[1-6]|br|tr|table|article|section|main|title|head|body|html"
#: Replacements in order: comments and silent tags go, links get their address behind them, blocks become lines, other tags go.
STEPS = (
    ("(?s)<!--.*?-->", ""),
    *((f"(?is)<{tag}\\b.*?</{tag}>", "") for tag in SILENT),
    ("data:[a-z]+/[a-z+.-]+;base64,[A-Za-z0-9+/=]+", ""),
    ('(?is)<a\\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', "$2 [$1]"),
    (f"(?i)</?(?:{BLOCKS})\\b[^>]*>", "\n"),
    ("<[^>]*>", ""),
)
NAMED = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))
SQUEEZE = (("[ \\t\\r]+", " "), (" ?\\n[ \\n]*", "\n"))


def to_text(html: Column) -> Column:
    """The text of a page: a line for each block, links as text [address], without furniture tags."""
    out = html
    for pattern, to in STEPS:
        out = F.regexp_replace(out, pattern, to)
    for name, sign in NAMED:
        out = F.replace(out, F.lit(name), F.lit(sign))
    for pattern, to in SQUEEZE:
        out = F.regexp_replace(out, pattern, to)
    return F.btrim(out, F.lit(" \n"))


def site_links(pages: DataFrame) -> DataFrame:
    """page_id, href, in_nav: the distinct links of each page within its host. Columns: page_id, url, html."""
    links = lambda c: F.regexp_extract_all(c, F.lit('href="([^"#]+)"'), F.lit(1))
    menus = F.array_join(F.regexp_extract_all("html", F.lit("(?is)<nav\\b.*?</nav>"), F.lit(0)), " ")
    own = F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    each = pages.select("page_id", own.alias("own"), links(menus).alias("nav"), F.explode(F.array_distinct(links(F.col("html")))).alias("href"))
    return each.where(F.col("href").startswith("/") | F.col("href").contains(F.concat(F.lit("://"), F.col("own"), F.lit("/")))).select("page_id", "href", F.array_contains("nav", F.col("href")).alias("in_nav"))
