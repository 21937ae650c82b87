"""Operator 2, site-relative line dedup.

Native: DataFrame functions only. For each host, the share of its pages that
contain a line; lines of a share above ``ratio`` are boilerplate of that host
and leave all its pages, on hosts of any size. A line must be on ``min_pages``
pages at least: two by default, as a line on one page repeats nothing.

A page counts once for a line however often it repeats it. Lines are compared
trimmed, by their MD5. Counts are combined inside each task before the shuffle,
so a line on a third of all pages costs a row a task. A host has at most
(mean distinct lines a page) / ``ratio`` boilerplate lines; they travel as one
short array for each host, and pages never leave their task unless Spark
chooses to split a hot host's join.

Defined cases: null text stays null and counts as a page without lines; empty
lines are never boilerplate and stay; rows without a host keep all lines;
repeated rows are pages of their own; an empty table gives no rows. Dropped
lines go with their line break; a page of boilerplate alone becomes empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted, staged

RATIO = 0.1
REPEATED = 2

# Tags that end a line of text (fixed values of HTML).
BLOCK_TAGS = ("address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "footer",
              "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main", "nav",
              "ol", "option", "p", "pre", "section", "table", "td", "th", "title", "tr", "ul")
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
_HIDDEN = r"(?is)<(?:!--.*?--|script\b.*?</script\s*|style\b.*?</style\s*)>"
_BREAK = r"(?i)</?(?:" + "|".join(BLOCK_TAGS) + r")\b[^>]*>"
_GAP = r"[ \t\n\x0b\f\r]{2,}|[\t\n\x0b\f\r]"  # any white space but one blank
_TAG = r"<[!/a-zA-Z][^>]*>"
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; null where there is none."""
    host = F.lower(F.regexp_extract(url, _HOST, 1))
    return F.when(host != "", host)


def text_of_html(html: Column) -> Column:
    """Visible text, one block a line."""
    text = F.regexp_replace(F.regexp_replace(html, _HIDDEN, ""), _GAP, " ")
    text = F.regexp_replace(F.regexp_replace(text, _BREAK, "\n"), _TAG, "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.btrim(F.regexp_replace(text, r" *\n[ \n]*", "\n"), F.lit(" \n"))


def line_keys(lines: Column) -> Column:
    """Key of each line; null for an empty one."""
    return F.transform(lines, lambda x: F.when(F.trim(x) != "", F.unhex(F.md5(F.trim(x)))))


def boilerplate(pages: DataFrame, host_col: str, text_col: str, ratio: float = RATIO,
                min_pages: int = REPEATED) -> DataFrame:
    """For each ``host`` that has any: ``keys`` of its boilerplate lines."""
    rows = pages.select(quoted(host_col).alias("host"), quoted(text_col).alias("text")) \
        .filter(F.col("host").isNotNull())
    totals = rows.groupBy("host").agg(F.count("*").alias("pages"))
    found = (rows.select("host", F.explode(F.array_distinct(line_keys(F.split("text", "\n")))).alias("key"))
             .filter(F.col("key").isNotNull())
             .groupBy("host", "key").agg(F.count("*").alias("with_line"))
             .filter(F.col("with_line") >= min_pages))
    return (found.join(totals, "host")
            .filter(F.col("with_line") > F.lit(ratio) * F.col("pages"))
            .groupBy("host").agg(F.collect_list("key").alias("keys")))


def line_dedup(pages: DataFrame, host_col: str, text_col: str, ratio: float = RATIO,
               min_pages: int = REPEATED) -> tuple[DataFrame, str, str]:
    """``pages`` with ``text_col`` rewritten, and the names of two columns
    more: how many non-empty lines a page had and how many of them went."""
    drop = staged(boilerplate(pages, host_col, text_col, ratio, min_pages), "line-boilerplate")
    host, keys, lines, n_lines, n_dropped = (fresh(c, pages.columns) for c in
                                             ("_host", "_keys", "lines", "n_lines", "n_dropped"))
    drop = drop.select(F.col("host").alias(host), F.col("keys").alias(keys))
    marked = pages.join(drop, quoted(host_col) == F.col(host), "left")
    goes = lambda x: F.coalesce(F.array_contains(F.col(keys), F.unhex(F.md5(F.trim(x)))), F.lit(False))
    split = F.split(quoted(text_col), "\n")
    kept = F.filter(split, lambda x: (F.trim(x) == "") | ~goes(x))
    full = F.coalesce(F.size(F.filter(split, lambda x: F.trim(x) != "")).cast("long"), F.lit(0).cast("long"))
    count = F.when(quoted(text_col).isNull(), F.lit(0).cast("long")).otherwise(full)
    out = marked.select(
        *[quoted(c) for c in pages.columns if c != text_col],
        F.when(F.col(keys).isNull(), quoted(text_col)).otherwise(F.array_join(kept, "\n")).alias(text_col),
        count.alias(n_lines),
        F.when(F.col(keys).isNull() | quoted(text_col).isNull(), F.lit(0).cast("long"))
        .otherwise((F.size(split) - F.size(kept)).cast("long")).alias(n_dropped))
    return out, n_lines, n_dropped


def report(pages: DataFrame) -> DataFrame:
    """Per page of raw HTML: host, lines, dropped lines and the text left."""
    text = staged(pages.select("page_id", host_of(F.col("url")).alias("host"),
                               text_of_html(F.col("html")).alias("text")), "line-texts")
    out, n_lines, n_dropped = line_dedup(text, "host", "text")
    return out.select("page_id", "host", n_lines, n_dropped, "text")


SQL = rf"""
WITH t AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '{_HOST}', 1)), '') AS host,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(
           regexp_replace(html, '{_HIDDEN}', '', 'g'), '{_GAP}', ' ', 'g'),
           '{_BREAK}', chr(10), 'g'), '{_TAG}', '', 'g'), 'x^', '') AS raw
  FROM pages
), p AS (
  SELECT page_id, host, trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(raw, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
      '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
    ' *\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS text
  FROM t
), l AS (
  SELECT page_id, host, generate_subscripts(lines, 1) AS k, unnest(lines) AS line
  FROM (SELECT page_id, host, string_split(text, chr(10)) AS lines FROM p WHERE text IS NOT NULL)
), b AS (
  SELECT host, line FROM (
    SELECT host, trim(line) AS line, count(DISTINCT page_id) AS n FROM l
    WHERE host IS NOT NULL AND trim(line) <> '' GROUP BY ALL)
  JOIN (SELECT host, count(*) AS pages FROM p GROUP BY host) USING (host)
  WHERE n >= {REPEATED} AND n > CAST({RATIO} AS DOUBLE) * pages
), m AS (
  SELECT l.*, b.line IS NOT NULL AS goes FROM l LEFT JOIN b ON l.host = b.host AND trim(l.line) = b.line
), s AS (
  SELECT page_id, sum(CASE WHEN trim(line) <> '' THEN 1 ELSE 0 END) AS n_lines,
         sum(CASE WHEN goes THEN 1 ELSE 0 END) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT goes), '') AS text
  FROM m GROUP BY page_id
)
SELECT p.page_id, p.host, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, CASE WHEN p.text IS NOT NULL THEN s.text END AS text
FROM p LEFT JOIN s USING (page_id)
"""
