"""The warehouse run on the driver's tables.

Analogues: a game is a ``part`` row (p_partkey is the appid, the words of
p_name are its developers, p_brand its category, p_type its genre); monthly
audience metrics come from ``lineitem`` by ship month; months of ``orders``
form the date dimension. Each adapter below derives a bronze-shaped table from
the driver table with built-in expressions only, so every query's work grows
with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table
from . import marts, staging


def bronze_catalogue(part: DataFrame) -> DataFrame:
    """The catalogue JSON's shape (fixture §1), derived from ``part``."""
    size = F.col("p_size")
    key = F.col("p_partkey")
    released = F.make_date((F.lit(1990) + size % 30).cast("int"),
                           (F.lit(1) + key % 12).cast("int"),
                           (F.lit(1) + key % 28).cast("int"))
    return part.select(
        key.alias("appid"),
        F.col("p_name").alias("name"),
        F.date_format(released, "d/M/yyyy").alias("release_date"),
        F.col("p_type").alias("short_description"),
        F.split(F.col("p_name"), " ").alias("developers"),
        F.array(F.col("p_brand")).alias("categories"),
        F.split(F.col("p_type"), " ").alias("genre"),
        F.concat(F.lit("img/"), key.cast("string"), F.lit(".jpg")).alias("header_image"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price"),
        F.when(size % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("EUR")).alias("currency"),
        (size % 2 == 0).alias("windows"),
        (size % 3 == 0).alias("linux"),
        (size % 7 == 0).alias("mac"),
        F.when(size % 4 == 0, F.lit(None).cast("bigint")).otherwise(size.cast("bigint") * 2)
        .alias("metacritic"),
        (F.col("p_retailprice").cast("bigint") * 3).alias("recommendations"),
    )


BRONZE_CATALOGUE_SQL = """
SELECT p_partkey AS appid, p_name AS name,
       strftime(make_date(1990 + p_size % 30, 1 + p_partkey % 12, 1 + p_partkey % 28), '%-d/%-m/%Y')
         AS release_date,
       p_type AS short_description,
       string_split(p_name, ' ') AS developers,
       [p_brand] AS categories,
       string_split(p_type, ' ') AS genre,
       'img/' || p_partkey::VARCHAR || '.jpg' AS header_image,
       round(p_retailprice * 100)::BIGINT AS price,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'EUR' END AS currency,
       p_size % 2 = 0 AS windows, p_size % 3 = 0 AS linux, p_size % 7 = 0 AS mac,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size::BIGINT * 2 END AS metacritic,
       trunc(p_retailprice)::BIGINT * 3 AS recommendations
FROM part"""


def bronze_metrics(lineitem: DataFrame) -> DataFrame:
    """The monthly metrics CSV's shape (fixture §2), derived from ``lineitem``.
    Columns are produced positionally and named by the header rename (P5)."""
    q = F.col("l_quantity")
    price = F.col("l_extendedprice")
    positional = lineitem.select(
        F.col("l_partkey"),
        F.trunc(F.col("l_shipdate").cast("date"), "MM"),
        price / 10,
        q / 2 - 12,
        F.col("l_discount") * 100 + q / 4,
        price / 7,
        q / 4,
        F.lit(25.5) - q,
        F.col("l_tax") * 100 - q / 8,
        q * 2.5,
        price.cast("decimal(12,2)").cast("string"),
    )
    return staging.rename_by_position(positional)


BRONZE_METRICS_SQL = """
SELECT l_partkey AS steam_id,
       date_trunc('month', l_shipdate)::DATE AS "Month",
       l_extendedprice / 10 AS "AvgViewers",
       l_quantity / 2 - 12 AS "AvgViewersGain",
       l_discount * 100 + l_quantity / 4 AS "AvgViewers%Gain",
       l_extendedprice / 7 AS "PeakViewers",
       l_quantity / 4 AS "AvgStreams",
       25.5 - l_quantity AS "AvgStreamsGain",
       l_tax * 100 - l_quantity / 8 AS "AvgStreamsùGain",
       l_quantity * 2.5 AS "PeakStreams",
       l_extendedprice::DECIMAL(12,2)::VARCHAR AS "HoursWatched"
FROM lineitem"""

STG_CATALOGUE_SQL = f"""
SELECT appid::INT AS appid, name::VARCHAR AS name,
       strptime(release_date, '%d/%m/%Y') AS release_date,
       developers::VARCHAR[] AS developers, categories::VARCHAR[] AS categories,
       genre::VARCHAR[] AS genre, header_image::VARCHAR AS header_image,
       price / 100::DECIMAL(10, 2) AS price, currency::VARCHAR AS currency,
       windows::BOOLEAN AS windows, mac::BOOLEAN AS mac, linux::BOOLEAN AS linux,
       metacritic::INT AS metacritic, recommendations::INT AS recommendations
FROM ({BRONZE_CATALOGUE_SQL}) raw_steam"""

STG_METRICS_SQL = f"""
SELECT steam_id::INT AS appid, "Month"::DATE AS metric_month,
       "AvgViewers"::INT AS avg_viewers, "AvgViewersGain"::INT AS avg_viewers_gain,
       "AvgViewers%Gain"::DECIMAL(10, 1) AS avg_viewers_pct_gain,
       "PeakViewers"::INT AS peak_viewers, "AvgStreams"::INT AS avg_streams,
       "AvgStreamsGain"::INT AS avg_streams_gain,
       "AvgStreamsùGain"::DECIMAL(10, 1) AS avg_streams_u_gain,
       "PeakStreams"::INT AS peak_streams, "HoursWatched"::INT AS hours_watched
FROM ({BRONZE_METRICS_SQL}) raw_twitch"""

# The date dimension's months come from orders (see module docstring).
ORDER_MONTHS_SQL = "SELECT date_trunc('month', o_orderdate)::DATE AS metric_month FROM orders"

DIM_GAMES_SQL = f"""
SELECT row_number() OVER (ORDER BY appid) AS game_key, appid, name, release_date, price,
       currency, windows, mac, linux, metacritic, recommendations, header_image
FROM ({STG_CATALOGUE_SQL}) games"""

DIM_DATE_SQL = f"""
WITH months AS (SELECT DISTINCT metric_month FROM ({ORDER_MONTHS_SQL}) m
                WHERE metric_month IS NOT NULL)
SELECT (year(metric_month) * 100 + month(metric_month))::INT AS date_key,
       metric_month AS full_date, year(metric_month) AS year, month(metric_month) AS month,
       monthname(metric_month) AS month_name, quarter(metric_month) AS quarter
FROM months"""


def _dim_member_sql(array_col: str, name: str, key: str) -> str:
    return f"""
WITH u AS (SELECT DISTINCT unnest({array_col}) AS {name}
           FROM ({STG_CATALOGUE_SQL}) s WHERE {array_col} IS NOT NULL)
SELECT row_number() OVER (ORDER BY {name}) AS {key}, {name} FROM u"""


def _bridge_sql(array_col: str, name: str, key: str) -> str:
    return f"""
WITH gm AS (SELECT s.appid, unnest(s.{array_col}) AS {name}
            FROM ({STG_CATALOGUE_SQL}) s WHERE s.{array_col} IS NOT NULL)
SELECT g.game_key, d.{key}
FROM gm INNER JOIN ({DIM_GAMES_SQL}) g ON gm.appid = g.appid
        INNER JOIN ({_dim_member_sql(array_col, name, key)}) d ON gm.{name} = d.{name}"""


FACT_SQL = f"""
SELECT g.game_key, d.date_key, t.avg_viewers, t.avg_viewers_gain, t.avg_viewers_pct_gain,
       t.peak_viewers, t.avg_streams, t.avg_streams_gain, t.avg_streams_u_gain,
       t.peak_streams, t.hours_watched
FROM ({STG_METRICS_SQL}) t
  INNER JOIN ({DIM_GAMES_SQL}) g ON t.appid = g.appid
  INNER JOIN ({DIM_DATE_SQL}) d
    ON (year(t.metric_month) * 100 + month(t.metric_month))::INT = d.date_key"""


# ---------------------------------------------------------------- builders

def stg_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_catalogue(bronze_catalogue(read_table(spark, sf, "part")))


def stg_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_metrics(bronze_metrics(read_table(spark, sf, "lineitem")))


def order_months(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return o.select(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("metric_month"))


def q_stg_catalogue(spark, sf):
    return stg_catalogue(spark, sf)


def q_stg_metrics(spark, sf):
    return stg_metrics(spark, sf)


def q_dim_entity(spark, sf):
    return marts.dim_entity(stg_catalogue(spark, sf))


def q_dim_date_month(spark, sf):
    return marts.dim_date(order_months(spark, sf))


def q_dim_member(spark, sf):
    return marts.dim_member(stg_catalogue(spark, sf), "developers", "developer_name",
                            "developer_key")


def q_dim_brand(spark, sf):
    return marts.dim_member(stg_catalogue(spark, sf), "categories", "category_name",
                            "category_key")


def q_dim_genre(spark, sf):
    return marts.dim_member(stg_catalogue(spark, sf), "genre", "genre_name", "genre_key")


def q_bridge_entity_member(spark, sf):
    from ..operators.members import bridge
    stg = stg_catalogue(spark, sf)
    games = marts.dim_entity(stg)
    dev = marts.dim_member(stg, "developers", "developer_name", "developer_key")
    return bridge(stg, "appid", "developers", games, "game_key", dev, "developer_name",
                  "developer_key")


def q_bridge_entity_brand(spark, sf):
    from ..operators.members import bridge
    stg = stg_catalogue(spark, sf)
    games = marts.dim_entity(stg)
    cat = marts.dim_member(stg, "categories", "category_name", "category_key")
    return bridge(stg, "appid", "categories", games, "game_key", cat, "category_name",
                  "category_key")


def q_fct_metrics(spark, sf):
    stg = stg_catalogue(spark, sf)
    return marts.fact(stg_metrics(spark, sf), marts.dim_entity(stg),
                      marts.dim_date(order_months(spark, sf)))


QUERIES = {
    "stg_catalogue": q_stg_catalogue,
    "stg_metrics": q_stg_metrics,
    "dim_entity": q_dim_entity,
    "dim_date_month": q_dim_date_month,
    "dim_member": q_dim_member,
    "dim_brand": q_dim_brand,
    "dim_genre": q_dim_genre,
    "bridge_entity_member": q_bridge_entity_member,
    "bridge_entity_brand": q_bridge_entity_brand,
    "fct_metrics": q_fct_metrics,
}

ORACLE = {
    "stg_catalogue": STG_CATALOGUE_SQL,
    "stg_metrics": STG_METRICS_SQL,
    "dim_entity": DIM_GAMES_SQL,
    "dim_date_month": DIM_DATE_SQL,
    "dim_member": _dim_member_sql("developers", "developer_name", "developer_key"),
    "dim_brand": _dim_member_sql("categories", "category_name", "category_key"),
    "dim_genre": _dim_member_sql("genre", "genre_name", "genre_key"),
    "bridge_entity_member": _bridge_sql("developers", "developer_name", "developer_key"),
    "bridge_entity_brand": _bridge_sql("categories", "category_name", "category_key"),
    "fct_metrics": FACT_SQL,
}


# ---------------------------------------------------------------- quality gate

STG_MONTHS_DIM_SQL = f"""
WITH months AS (SELECT DISTINCT metric_month FROM ({STG_METRICS_SQL}) m
                WHERE metric_month IS NOT NULL)
SELECT (year(metric_month) * 100 + month(metric_month))::INT AS date_key,
       metric_month AS full_date, year(metric_month) AS year, month(metric_month) AS month,
       monthname(metric_month) AS month_name, quarter(metric_month) AS quarter
FROM months"""

STG_FACT_SQL = f"""
SELECT g.game_key, d.date_key, t.avg_viewers, t.avg_viewers_gain, t.avg_viewers_pct_gain,
       t.peak_viewers, t.avg_streams, t.avg_streams_gain, t.avg_streams_u_gain,
       t.peak_streams, t.hours_watched
FROM ({STG_METRICS_SQL}) t
  INNER JOIN ({DIM_GAMES_SQL}) g ON t.appid = g.appid
  INNER JOIN ({STG_MONTHS_DIM_SQL}) d
    ON (year(t.metric_month) * 100 + month(t.metric_month))::INT = d.date_key"""

# The warehouse as the pipeline builds it (months from the metrics themselves).
WAREHOUSE_SQL = {
    "stg_catalogue": STG_CATALOGUE_SQL,
    "stg_metrics": STG_METRICS_SQL,
    "dim_games": DIM_GAMES_SQL,
    "dim_date": STG_MONTHS_DIM_SQL,
    "dim_developer": _dim_member_sql("developers", "developer_name", "developer_key"),
    "dim_genre": _dim_member_sql("genre", "genre_name", "genre_key"),
    "dim_category": _dim_member_sql("categories", "category_name", "category_key"),
    "bridge_game_developer": _bridge_sql("developers", "developer_name", "developer_key"),
    "bridge_game_genre": _bridge_sql("genre", "genre_name", "genre_key"),
    "bridge_game_category": _bridge_sql("categories", "category_name", "category_key"),
    "fct": STG_FACT_SQL,
}


def _check_sql(label, table, kind, col, parent):
    src = WAREHOUSE_SQL[table]
    if kind == "not_null":
        failing = f"SELECT 1 FROM ({src}) m WHERE m.{col} IS NULL"
    elif kind == "unique":
        failing = (f"SELECT m.{col} FROM ({src}) m WHERE m.{col} IS NOT NULL "
                   f"GROUP BY m.{col} HAVING count(*) > 1")
    else:
        failing = (f"SELECT 1 FROM ({src}) c WHERE c.{col} IS NOT NULL AND c.{col} NOT IN "
                   f"(SELECT p.{col} FROM ({WAREHOUSE_SQL[parent]}) p WHERE p.{col} IS NOT NULL)")
    return (f"SELECT '{label}' AS model, '{kind}' AS kind, '{col}' AS column_name, "
            f"count(*) AS n_failing FROM ({failing}) f")


def q_qa_warehouse(spark, sf):
    """Q1-Q4: the 31 declared checks over a warehouse built from the driver
    tables, one row per check with its failing-row count."""
    from ..operators import quality
    from ..session import scratch_path
    from ..sources.sinks import table_writer
    # every model is written once, as Parquet, and read by all checks that use it
    w = marts.build_warehouse(stg_catalogue(spark, sf), stg_metrics(spark, sf),
                              write=table_writer(spark, scratch_path(spark, "qa-warehouse")))
    return quality.failure_counts(w)


def _qa_sql():
    from ..operators.quality import DECLARED_CHECKS
    return "\nUNION ALL\n".join(_check_sql(*c) for c in DECLARED_CHECKS)


QUERIES["qa_warehouse"] = q_qa_warehouse
ORACLE["qa_warehouse"] = _qa_sql()
