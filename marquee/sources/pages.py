"""Collected HTML pages (S10-S12): tables, links and notice pages.

Each page is one row; parsing is a projection of built-in regex functions over
that row (``regexp_extract_all`` + ``posexplode``) on whatever partitioning the
page table has, without a Python worker. Cell texts asked for one by one
(``cell_text`` of a raw cell) are plain expressions; ``cells`` as a whole array of
texts goes through ``transform``, which Spark interprets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import evaluate_once

# Texts of the block / rate-limit notices a collector may save
# instead of the page it asked for.
NOTICE_TERMS = (
    "you have been temporarily rate limited",
    "your network has been banned",
)

# HTML entities decoded in cell text.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
            ("&#39;", "'"), ("&amp;", "&"))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The whitespace stripped from both ends of a cell's text.
CELL_SPACE = " \t\n\r\f\v\u00a0"


def cell_text(c) -> Column:
    """Visible text of an HTML fragment: tags dropped, entities decoded, trimmed.
    Plain cells (no '<', no '&') skip straight to the trim."""
    c = _c(c)
    t = F.regexp_replace(c, r"<[^>]*>", "")
    for ent, ch in ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    plain = ~(c.contains("<") | c.contains("&"))
    return F.btrim(F.when(plain, c).otherwise(t), F.lit(CELL_SPACE))


def _texts(arr: Column) -> Column:
    return F.transform(arr, lambda x: cell_text(x))


def drop_notice_pages(pages: DataFrame, html: str = "html", terms=NOTICE_TERMS) -> DataFrame:
    """Drop pages whose text is a block or rate-limit notice."""
    low = F.lower(F.col(html))
    hit = F.lit(False)
    for t in terms:
        hit = hit | low.contains(t)
    return pages.where(~hit)


def table_block(html, marker: str) -> Column:
    """The markup from ``marker`` (text inside the table's or a wrapper's opening
    tag, e.g. ``id="chart-month-table"``) to the first ``</table>`` after it."""
    h = _c(html)
    pos = F.locate(marker, h)
    after = F.when(pos > 0, h.substr(pos, F.length(h)))
    return F.regexp_extract(after, r"(?s)^(.*?)</table>", 1)


def extract_tables(pages: DataFrame, marker: str, key: str = "page_id",
                   html: str = "html", keep: tuple = (), raw: bool = False) -> DataFrame:
    """One row per body row of the marked table: (key, *keep, row_no,
    headers, cells). Header and cell text is trimmed; pages without the table
    give no rows; empty rows are kept here (filter with F8). With ``raw`` there are
    no headers and the cells are markup, for a caller that takes ``cell_text`` of the
    cells it needs."""
    # the marked table's markup, computed once per page and reused below
    pages = pages.select(F.col(key), *[F.col(c) for c in keep],
                         table_block(html, marker).alias("_block"))
    block = F.col("_block")
    body = F.coalesce(F.nullif(F.regexp_extract(block, r"(?s)<tbody[^>]*>(.*?)</tbody>", 1),
                               F.lit("")), block)
    headers = [] if raw else [_texts(F.regexp_extract_all(
        block, F.lit(r"(?s)<th[^>]*>(.*?)</th>"), 1)).alias("headers")]
    names = [] if raw else ["headers"]
    t = pages.select(
        F.col(key), *[F.col(c) for c in keep], *headers,
        F.regexp_extract_all(body, F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), 1).alias("_rows"),
    )
    # posexplode makes Catalyst infer ``size(_rows) > 0`` and push it down with the
    # whole extraction substituted in; the fence keeps that filter above it
    rows = evaluate_once(t).select(key, *keep, *names,
                                   F.posexplode("_rows").alias("row_no", "_row"))
    cells = F.regexp_extract_all(F.col("_row"), F.lit(r"(?s)<td[^>]*>(.*?)</td>"), 1)
    return rows.select(key, *keep, "row_no", *names, (cells if raw else _texts(cells)).alias("cells"))


def extract_links(pages: DataFrame, key: str = "page_id", html: str = "html",
                  css_class: str | None = None) -> DataFrame:
    """(key, pos, href, title) for every anchor, optionally only those with
    a CSS class (``a.item-title``)."""
    tags = F.regexp_extract_all(F.col(html), F.lit(r"(?s)(<a\s[^>]*>.*?</a>)"), 1)
    t = evaluate_once(pages.select(F.col(key), tags.alias("_tags"))).select(
        key, F.posexplode("_tags").alias("pos", "_tag"))
    out = t.select(
        key, "pos",
        F.regexp_extract("_tag", r'href="([^"]*)"', 1).alias("href"),
        cell_text(F.regexp_extract("_tag", r"(?s)^<a[^>]*>(.*)</a>$", 1)).alias("title"),
        F.regexp_extract("_tag", r'class="([^"]*)"', 1).alias("_class"),
    )
    if css_class:
        out = out.where(F.array_contains(F.split(F.col("_class"), r"\s+"), css_class))
    return out.drop("_class")
