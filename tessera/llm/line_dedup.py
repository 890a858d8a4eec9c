"""Removes the boilerplate lines of a site.

A line is boilerplate where a large share of its site's pages has it: per site and line the pages are counted (a
page counts once, however often it repeats the line), and a line goes if at least ``min_pages`` pages and more than
``ratio`` of the site's pages have it. Lines are compared without the white space around them, by a 64-bit hash
inside their site. A site has at most ``average lines per page / ratio`` boilerplate lines, so they travel as one
short array per site; texts are never shuffled by line.

Defined cases: lines without a word are never counted nor dropped. A NULL text stays NULL and counts as a page
without lines. NULL sites form one site. Repeated rows are pages of their own. Text is cut at line feeds only, and
what stays is joined by line feeds again, so a text that loses nothing is unchanged and one that loses every line
is empty. Extra columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, same, written

RATIO = 0.1
MIN_PAGES = 2

_UNSEEN = r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>"
_BLOCK = r"(?i)</?(?:html|head|body|title|nav|header|footer|main|article|section|aside|div|p|ul|ol|li|h[1-6]|table|tr|td|th|br)(?:\s[^>]*)?/?>"
_TAG = r"<[^>]*>"


def html_text(html: Column) -> Column:
    """Text of a page, one line per block element; NULL stays NULL."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(html, _UNSEEN, ""), _BLOCK, "\n"), _TAG, "")


def _key(line: str) -> str:
    """SQL for the hash of a line; NULL for a line without a word."""
    return f"xxhash64(nullif(trim(BOTH ' \\t\\n\\u000B\\u000C\\r' FROM {line}), ''))"


def _lines(text: str) -> str:
    return f"split({text}, '\\n', -1)"


def boilerplate(pages: DataFrame, site: Column, text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``site`` and ``keys``, the hashes of its boilerplate lines; sites without any are left out."""
    own = pages.select(site.alias("site"), F.col(text).alias("text"))
    keys = f"array_distinct(filter(transform({_lines('text')}, l -> IF(trim(BOTH ' \\t\\n\\u000B\\u000C\\r' FROM l) = '', NULL, {_key('l')})), k -> k IS NOT NULL))"
    counts = own.select("site", F.expr(f"explode({keys}) AS key")).groupBy("site", "key").agg(F.count("*").alias("n"))
    totals = own.groupBy(F.col("site").alias("of")).agg(F.count("*").alias("total"))
    frequent = counts.filter(F.col("n") >= min_pages).join(totals, same(F.col("site"), F.col("of")))
    dropped = frequent.filter(F.col("n") > F.lit(float(ratio)) * F.col("total"))
    return dropped.groupBy("site").agg(F.sort_array(F.collect_list("key")).alias("keys"))


def drop_boilerplate(
    pages: DataFrame, site: Column, text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, dropped: str | None = None
) -> DataFrame:
    """The pages without the boilerplate lines of their site, with the columns they came with and, if a name is
    given, the number of lines that went as ``dropped``."""
    own, keys, lines, kept = (fresh(c, pages) for c in ("__site", "__keys", "__lines", "__kept"))
    found = written(boilerplate(pages, site, text, ratio, min_pages), "boilerplate").select(F.col("site").alias(own), F.col("keys").alias(keys))
    joined = pages.join(found, same(site, F.col(own)), "left")
    stays = F.expr(f"filter({lines}, _l -> NOT array_contains({keys}, {_key('_l')}))")
    cut = joined.withColumn(lines, F.when(F.col(keys).isNotNull(), F.split(F.col(text), "\n", -1))).withColumn(kept, stays)
    clean = F.when(F.col(kept).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    columns = [clean.alias(c) if c == text else F.col(f"`{c}`") for c in pages.columns]
    gone = [F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("bigint").alias(dropped)] if dropped else []
    return cut.select(*columns, *gone)
