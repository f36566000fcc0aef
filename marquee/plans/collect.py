"""Collected pages -> metric rows (M18) and players rows.

Pages are rows of a table (page_id / key, url, html); every step is a
DataFrame transformation, so millions of pages parse in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as X
from ..functions import dates as D
from ..operators.filters import min_arity
from ..session import evaluate_once
from ..sources.pages import cell_text, drop_notice_pages, extract_links, extract_tables
from .staging import METRIC_HEADERS

# Where the tables sit in the collected pages.
METRICS_TABLE_MARKER = "dataTables_scrollBody"
PLAYERS_TABLE_MARKER = 'id="chart-month-table"'
SEARCH_SECTION_MARKER = ">Categories</h3>"


def search_candidates(search_pages: DataFrame, key: str = "steam_id") -> DataFrame:
    """Result links (``a.item-title``) after the "Categories" heading of a
    search page collected for game ``key``: (key, pos, title, tracker_id)."""
    pages = drop_notice_pages(search_pages)
    pos = F.locate(SEARCH_SECTION_MARKER, F.col("html"))
    section = pages.where(pos > 0).withColumn(
        "html", F.col("html").substr(pos, F.length(F.col("html"))))
    links = extract_links(section, key=key, css_class="item-title")
    return links.select(key, "pos", "title",
                        X.link_id("href", r"/games/(\d+)").alias("tracker_id"))


def match_candidates(games: DataFrame, candidates: DataFrame, key: str = "steam_id",
                     name: str = "name") -> DataFrame:
    """Per game, the first candidate (lowest position) whose cleaned title
    equals the cleaned game name. Games without a name are skipped (F7)."""
    g = games.where(X.clean_name(name) != "").select(key, X.clean_name(name).alias("_nk"))
    c = candidates.where(F.col("tracker_id").isNotNull()).select(
        key, "pos", "tracker_id", X.clean_name("title").alias("_nk"))
    return (g.join(c, [key, "_nk"])
             .groupBy(key)
             .agg(F.min_by("tracker_id", "pos").alias("tracker_id")))


def metric_rows(game_pages: DataFrame, matches: DataFrame, key: str = "steam_id") -> DataFrame:
    """The monthly table of each matched game page as metric CSV rows:
    header renamed by position (P5), month floored and written dd/MM/yyyy (X6),
    '-' -> NULL, '1,234' / '+5' / '-3.2%' cleaned (X11), '1.2M' / '3.4K'
    expanded (X12), the game key added to each row (P6)."""
    pages = drop_notice_pages(game_pages).withColumnRenamed("page_id", "tracker_id")
    # Pages and matches are both one row per entity and grow with the catalogue:
    # join them before the rows are exploded, by sort-merge on the page id (a size
    # estimate after aggregates must not decide to hash or broadcast either side).
    pages = pages.join(matches.hint("merge"), "tracker_id")
    rows = evaluate_once(extract_tables(pages, METRICS_TABLE_MARKER, key="tracker_id",
                                        keep=(key,), raw=True))
    rows = rows.where(min_arity("cells", 1))
    cell = lambda i: cell_text(F.get(F.col("cells"), i))
    month = F.date_format(D.month_floor(D.parse_any_date(cell(0))), "dd/MM/yyyy")
    values = [X.cell_value(cell(i)) for i in range(1, len(METRIC_HEADERS) - 1)]
    out = rows.select(F.col(key).alias("steam_id"), month, *values)
    return out.toDF(*METRIC_HEADERS)


def player_rows(chart_pages: DataFrame, as_of: str, key: str = "appid") -> DataFrame:
    """The players-by-month table: rows with at least four cells (F8), the
    relative "Last 30 days" label resolved to ``as_of`` (X7), the month parsed
    with the format list (X5), thousands separators and signs removed (X13)."""
    pages = drop_notice_pages(chart_pages)
    rows = evaluate_once(extract_tables(pages, PLAYERS_TABLE_MARKER, key=key, raw=True)) \
        .where(min_arity("cells", 4))
    cell = lambda i: cell_text(F.get(F.col("cells"), i))
    month = F.date_format(D.parse_any_date(D.relative_month(cell(0), as_of)), "dd/MM/yyyy")
    return rows.select(
        key, "row_no",
        month.alias("Month"),
        F.replace(cell(1), F.lit(","), F.lit("")).alias("Peak"),
        X.gain(cell(2)).alias("Gain"),
        F.translate(cell(3), "%+", "").alias("Percent_Gain"),
    )
