"""Line dedup by site-relative frequency, in DataFrame operations only.

A line is boilerplate of a host when more than `ratio` of the host's pages hold it.
Counting moves (host, line digest) once a page, pre-aggregated before the shuffle.
What comes back is one list of digests a host: each page holds few lines that are on
over `ratio` of its host's pages, so such a list has at most (mean distinct lines a
page) / ratio entries. The texts themselves are not shuffled by line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged

RATIO, MIN_PAGES = 0.1, 5
#: Pages of a host that meet one copy of its list; a larger host has a copy for each so many.
HOST_PAGES = 1 << 18

#: What a page's source loses, in order: scripts, styles and comments, block tags, other tags.
PAGE_RULES = (
    (r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>|<!--.*?-->", ""),
    (r"(?i)</?(?:p|br|div|li|ul|ol|nav|article|h[1-6]|tr|table|title|head|body|header|footer|section)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
)
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
LINE_BREAK, OUTER_SPACE = r"[ \t\r\x0B\x0C]*\n[ \t\r\x0B\x0C\n]*", r"^[ \t\r\x0B\x0C\n]+|[ \t\r\x0B\x0C\n]+$"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def html_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags go, block tags end a line."""
    text = html
    for pattern, by in PAGE_RULES:
        text = F.regexp_replace(text, pattern, by)
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.regexp_replace(F.regexp_replace(text, LINE_BREAK, "\n"), OUTER_SPACE, "")


def url_host(url: Column) -> Column:
    """Lower-case host of a URL; '' where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def _digest(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.unhex(F.md5(F.encode(line, "UTF-8")))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate_lines(lines: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, boiler array<binary>, copies int) of lines(host, lines array<string>), a row a
    page; copies is how many times HOST_PAGES the host has, rounded up.

    A line counts once a page however often the page repeats it; blank lines never
    count. Lines on under min_pages pages of a host are never boilerplate.
    """
    totals = lines.groupBy("host").agg(F.count("*").alias("n_host_pages"))
    held = lines.select("host", F.explode(F.array_distinct(F.filter("lines", _has_word))).alias("line"))
    counted = held.groupBy("host", _digest(F.col("line")).alias("digest")).agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= min_pages)
    over = counted.join(totals, "host").where(F.col("n_pages") > ratio * F.col("n_host_pages"))
    copies = F.ceil(F.max("n_host_pages") / HOST_PAGES).cast("int")
    return over.groupBy("host").agg(F.collect_list("digest").alias("boiler"), copies.alias("copies"))


def drop_boilerplate(pages: DataFrame, text_col: str, host: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES, dropped_col: str | None = None, lines_col: str | None = None) -> DataFrame:
    """pages with the boilerplate lines of each host taken out of text_col.

    Lines are cut at \\n. Null texts stay null and empty ones empty; a page of
    boilerplate only becomes empty but stays. A null host is a host of its own, as is
    ''. Repeated rows are pages each. Every column of pages keeps its name and order;
    dropped_col and lines_col add the number of lines dropped and of lines with a word.
    """
    host = F.coalesce(host.cast("string"), F.lit("\0"))
    text = F.col(f"`{text_col}`")
    lines = F.split(text, "\n", -1)
    boiler = staged(boilerplate_lines(pages.select(host.alias("host"), F.coalesce(lines, F.array()).alias("lines")), ratio, min_pages), "boilerplate")
    salted = boiler.select(F.col("host").alias("host__"), F.col("boiler").alias("boiler__"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt__"))
    large = boiler.where("copies > 1").select(F.col("host").alias("host__"), F.col("copies").alias("copies__"))
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row__")
    # pages of a large host go round its copies by their number, so that equal pages do too
    named = pages.select(row, host.alias("host__"), F.monotonically_increasing_id().alias("number__"))
    if not large.isEmpty():
        named = named.join(large, "host__", "left")
    else:
        named = named.withColumn("copies__", F.lit(1))
    salt = F.pmod("number__", F.coalesce("copies__", F.lit(1))).cast("int")
    joined = named.withColumn("salt__", salt).join(salted, ["host__", "salt__"], "left").select("row__", "boiler__")
    text = F.col(f"row__.`{text_col}`")
    lines = F.split(text, "\n", -1)
    keep = F.filter(lines, lambda line: ~_has_word(line) | ~F.array_contains("boiler__", _digest(line)))
    joined = joined.select("row__", "boiler__", F.when(F.col("boiler__").isNotNull(), keep).alias("kept__"))
    none = F.col("boiler__").isNull()
    out = [(F.when(none, text).otherwise(F.array_join("kept__", "\n")) if c == text_col else F.col(f"row__.`{c}`")).alias(c) for c in pages.columns]
    if dropped_col:
        out.append(F.coalesce(F.when(none, 0).otherwise(F.size(lines) - F.size("kept__")), F.lit(0)).cast("long").alias(dropped_col))
    if lines_col:
        out.append(F.coalesce(F.size(F.filter(lines, _has_word)), F.lit(0)).cast("long").alias(lines_col))
    return joined.select(*out)
