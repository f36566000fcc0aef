"""Collected-page jobs (M18, M19) over HTML rendered from the driver tables.

The driver's own pages hold no tables, so pages are rendered here from table
aggregates -- monthly metric tables per part, search-result pages listing a
part's neighbours, players-by-month tables per customer -- and parsed back
with the library; the oracle SQL computes the same values directly. Each
rendered page gathers one row per calendar month (or three search results),
so page size is bounded by the calendar, not by the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as X
from ..session import read_table, scratch_path
from . import collect

Q, SQL = {}, {}

TRACKER_OFFSET = 100000


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _cells(*cells):
    return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells],
                    F.lit("</tr>"))


def _page_of_rows(df, key, order, row_html, name):
    """One string per ``key``: its rows' HTML in ``order`` (a bounded group)."""
    rows = F.sort_array(F.collect_list(F.struct(order.alias("o"), row_html.alias("h"))))
    return df.groupBy(key).agg(F.array_join(F.transform(rows, lambda x: x["h"]), "").alias(name))


_PREPARED: dict = {}


def prepared(spark, sf, build):
    """The rendered pages as a table, written once a session: rendering is test
    input, not part of the job under test."""
    key = (spark.sparkContext.applicationId, sf, build.__name__)
    if key not in _PREPARED:
        path = scratch_path(spark, build.__name__)
        build(spark, sf).write.parquet(path)
        _PREPARED[key] = path
    return spark.read.parquet(_PREPARED[key])


def metric_pages(spark, sf):
    """Monthly metric tables per part, cells in the collector's text styles."""
    li = read_table(spark, sf, "lineitem")
    m = li.groupBy(F.col("l_partkey").alias("k"),
                   F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("q"))
    n, q = F.col("n"), F.col("q")

    def dec1(c):
        return c.cast("decimal(10,1)").cast("string")

    row = _cells(
        F.date_format("month", "MMMM yyyy"),
        F.format_number(q * 1000, 0),
        F.concat(F.when(n >= 2, F.lit("+")).otherwise(F.lit("")), (n - 2).cast("string")),
        F.concat(dec1(n * 2.5), F.lit("%")),
        F.concat(dec1(q / 1000), F.lit("M")),
        F.concat(dec1(q / 10), F.lit("K")),
        F.when(n == 1, F.lit("-")).otherwise(n.cast("string")),
        F.concat(F.lit("-"), n.cast("string"), F.lit("%")),
        F.format_number(q, 0),
        (n * 100).cast("string"))
    head = ("<html><body><div class=\"dataTables_scrollBody\"><table><thead><tr>"
            + "".join(f"<th>{h}</th>" for h in ("Month", "Avg", "Gain", "%", "Peak", "Avg",
                                                 "Gain", "%", "Peak", "Hours"))
            + "</tr></thead><tbody>")
    pages = _page_of_rows(m, "k", F.col("month"), row, "rows")
    return pages.select((F.col("k") + TRACKER_OFFSET).alias("page_id"),
                        F.concat(F.lit(head), "rows", F.lit("</tbody></table></div></body></html>"))
                        .alias("html"))


def search_pages(spark, sf):
    """Per part, a search page whose results are the parts k-1, k, k+1 (those
    that exist), after a decoy link with the part's own name above the
    "Categories" heading."""
    p = read_table(spark, sf, "part").select("p_partkey", "p_name")
    k = F.col("p_partkey")
    cand = p.select(k.alias("k"), F.col("p_name").alias("name"),
                    F.posexplode(F.array(k - 1, k, k + 1)).alias("pos", "c"))
    cand = cand.join(p.select(F.col("p_partkey").alias("c"), F.col("p_name").alias("cname")), "c")
    link = F.concat(F.lit('<tr><td><a class="item-title" href="/games/'),
                    (F.col("c") + TRACKER_OFFSET).cast("string"), F.lit('">'), F.col("cname"),
                    F.lit("</a></td></tr>"))
    pages = _page_of_rows(cand, "k", F.col("pos"), link, "links")
    names = p.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))
    return pages.join(names, "k").select(
        F.col("k").alias("steam_id"),
        F.concat(F.lit('<html><h3>Channels</h3><a class="item-title" href="/games/1">'), F.col("name"),
                 F.lit("</a><h3>Categories</h3><table><tbody>"), F.col("links"),
                 F.lit("</tbody></table></html>")).alias("html"))


_CLEAN = (f"regexp_replace(regexp_replace(lower(coalesce(p_name, '')), '{X.NON_WORD}', '', 'g'), "
          f"'{X.SPACE_RUN}', '-', 'g')")


@register("page_metric_rows", f"""
WITH p AS (SELECT p_partkey, {_CLEAN} AS nk FROM part),
cand AS (
  SELECT g.p_partkey AS steam_id, 0 AS pos, c.p_partkey AS cand, c.nk AS cnk, g.nk AS gnk
  FROM p g JOIN p c ON c.p_partkey = g.p_partkey - 1
  UNION ALL
  SELECT g.p_partkey, 1, c.p_partkey, c.nk, g.nk FROM p g JOIN p c ON c.p_partkey = g.p_partkey
  UNION ALL
  SELECT g.p_partkey, 2, c.p_partkey, c.nk, g.nk FROM p g JOIN p c ON c.p_partkey = g.p_partkey + 1),
m AS (SELECT steam_id, arg_min(cand, pos) AS matched FROM cand
      WHERE cnk = gnk AND gnk <> '' GROUP BY steam_id),
a AS (SELECT l_partkey AS k, date_trunc('month', l_shipdate)::DATE AS month, count(*) AS n,
             sum(l_quantity)::BIGINT AS q FROM lineitem GROUP BY 1, 2)
SELECT m.steam_id, strftime(a.month, '%d/%m/%Y') AS "Month",
       (a.q * 1000)::DOUBLE AS "AvgViewers",
       (a.n - 2)::DOUBLE AS "AvgViewersGain",
       (a.n * 2.5)::DECIMAL(10,1)::DOUBLE AS "AvgViewers%Gain",
       trunc((a.q / 1000)::DECIMAL(10,1)::DOUBLE * 1000000.0)::DOUBLE AS "PeakViewers",
       trunc((a.q / 10)::DECIMAL(10,1)::DOUBLE * 1000.0)::DOUBLE AS "AvgStreams",
       CASE WHEN a.n = 1 THEN NULL ELSE a.n::DOUBLE END AS "AvgStreamsGain",
       (-a.n)::DOUBLE AS "AvgStreamsùGain",
       a.q::DOUBLE AS "PeakStreams",
       (a.n * 100)::DOUBLE AS "HoursWatched"
FROM m JOIN a ON a.k = m.matched""")
def page_metric_rows(spark, sf):
    """M18 + S10 + S11 + J4: search pages -> matched tracker ids -> the matched
    page's monthly table -> metric CSV rows with cleaned numbers."""
    games = read_table(spark, sf, "part").select(F.col("p_partkey").alias("steam_id"),
                                                 F.col("p_name").alias("name"))
    matches = collect.match_candidates(games, collect.search_candidates(
        prepared(spark, sf, search_pages)))
    return collect.metric_rows(prepared(spark, sf, metric_pages), matches)


NOTICE = "<html><h1>You have been temporarily rate limited</h1></html>"


def player_pages(spark, sf):
    """Players-by-month tables per customer (newest month first, labelled
    'Last 30 days', plus one short row); AUTOMOBILE customers get a rate-limit
    notice instead of their page."""
    o = read_table(spark, sf, "orders")
    m = o.groupBy(F.col("o_custkey").alias("appid"),
                  F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("bigint")).alias("peak"))
    n = F.col("n")
    label = F.when(F.col("month") == F.lit("2001-08-01").cast("date"), F.lit("Last 30 days")) \
        .otherwise(F.date_format("month", "MMMM yyyy"))
    row = _cells(label, F.format_number("peak", 0),
                 F.when(n == 1, F.lit("-")).otherwise(F.concat(F.lit("+"), (n - 1).cast("string"))),
                 F.concat(F.lit("+"), (n * 1.5).cast("decimal(10,1)").cast("string"), F.lit("%")))
    pages = _page_of_rows(m, "appid", -F.datediff("month", F.lit("1970-01-01").cast("date")), row,
                          "rows")
    seg = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("appid"), "c_mktsegment")
    html = F.concat(F.lit('<table id="chart-month-table"><thead><tr><th>Month</th><th>Peak</th>'
                          '<th>Gain</th><th>%</th></tr></thead><tbody>'), F.col("rows"),
                    F.lit("<tr><td>short</td><td>1</td></tr></tbody></table>"))
    return pages.join(seg, "appid", "left").select(
        "appid", F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(NOTICE)).otherwise(html)
        .alias("html"))


@register("page_player_rows", """
WITH o AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n,
                  sum(trunc(o_totalprice))::BIGINT AS peak FROM orders GROUP BY 1, 2)
SELECT o_custkey AS appid,
       (row_number() OVER (PARTITION BY o_custkey ORDER BY month DESC) - 1)::INT AS row_no,
       strftime(month, '%d/%m/%Y') AS "Month", peak::VARCHAR AS "Peak",
       CASE WHEN n = 1 THEN '-' ELSE (n - 1)::VARCHAR END AS "Gain",
       (n * 1.5)::DECIMAL(10,1)::VARCHAR AS "Percent_Gain"
FROM o
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""")
def page_player_rows(spark, sf):
    """M19 + S10 + S12 + F8 + X7 + X13: notice pages dropped, rows with fewer
    than four cells dropped, 'Last 30 days' resolved to August 2001."""
    return collect.player_rows(prepared(spark, sf, player_pages), as_of="August 2001")
