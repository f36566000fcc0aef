"""Sources, sinks, loads, pages, streaming and goal queries over the driver
tables. Queries that go through files write them under the session's shared
checkpoint folder (a fresh sub-folder per run) and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..operators.members import bridge
from ..schemas import CATALOGUE_SCHEMA, METRICS_TEXT_SCHEMA, PLAYERS_SCHEMA, PRICE_SCHEMA, USERS_SCHEMA
from ..session import read_table, scratch_path
from ..sources import files, pages, payload, sinks
from . import goals, legacy, marts
from .driver import (BRONZE_CATALOGUE_SQL, DIM_DATE_SQL, FACT_SQL, STG_CATALOGUE_SQL,
                     bronze_catalogue, order_months, stg_catalogue, stg_metrics)

Q, SQL = {}, {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ payloads, pages

def _payload_text(e):
    """A store-API payload per event: the event id is the dynamic top-level key."""
    b = lambda c: c.cast("string")  # noqa: E731  'true' / 'false'
    date_text = F.when((F.col("event_type") == "view") & (F.col("value") < 5), F.lit("Coming soon")) \
        .otherwise(F.date_format("ts", "d MMM, yyyy"))
    price = F.when(F.col("value") > 10, F.concat(
        F.lit('{"initial": '), F.round(F.col("value") * 100).cast("bigint").cast("string"),
        F.lit(', "currency": "EUR"}'))).otherwise(F.lit("null"))
    return F.concat(
        F.lit('{"'), F.col("event_id").cast("string"), F.lit('": {"success": '),
        b(F.col("event_type") != "error"),
        F.lit(', "data": {"name": "'), F.col("event_type"), F.lit(" "), F.col("user_id").cast("string"),
        F.lit('", "release_date": {"coming_soon": '), b(F.col("value") > 45),
        F.lit(', "date": "'), date_text,
        F.lit('"}, "developers": ["u'), F.col("user_id").cast("string"),
        F.lit('"], "categories": [{"id": 1, "description": "'), F.col("event_type"),
        F.lit('"}], "price_overview": '), price,
        F.lit(', "platforms": {"windows": true, "mac": '), b(F.col("user_id") % 2 == 0),
        F.lit('}, "metacritic": {"score": '), F.get_json_object("props", "$.k"),
        F.lit('}, "recommendations": {"total": '), F.col("user_id").cast("string"),
        F.lit("}}}}"))


_PAYLOAD_TEXT_SQL = """
'{"' || event_id::VARCHAR || '": {"success": ' || (event_type <> 'error')::VARCHAR
 || ', "data": {"name": "' || event_type || ' ' || user_id::VARCHAR
 || '", "release_date": {"coming_soon": ' || (value > 45)::VARCHAR
 || ', "date": "' || CASE WHEN event_type = 'view' AND value < 5 THEN 'Coming soon'
                          ELSE strftime(ts, '%-d %b, %Y') END
 || '"}, "developers": ["u' || user_id::VARCHAR
 || '"], "categories": [{"id": 1, "description": "' || event_type
 || '"}], "price_overview": ' || CASE WHEN value > 10 THEN '{"initial": '
        || round(value * 100)::BIGINT::VARCHAR || ', "currency": "EUR"}' ELSE 'null' END
 || ', "platforms": {"windows": true, "mac": ' || (user_id % 2 = 0)::VARCHAR
 || '}, "metacritic": {"score": ' || json_extract_string(props, '$.k')
 || '}, "recommendations": {"total": ' || user_id::VARCHAR || '}}}}'"""


@register("payload_fields", f"""
WITH p AS (SELECT event_id, json_extract({_PAYLOAD_TEXT_SQL}, '$."' || event_id::VARCHAR || '"') AS e
           FROM events),
d AS (SELECT event_id, e, json_extract_string(e, '$.data.release_date.date') AS dt FROM p
      WHERE coalesce(json_extract(e, '$.success')::BOOLEAN, false)
        AND json_extract(e, '$.data') IS NOT NULL
        AND NOT (dt IS NULL OR dt = '' OR contains(lower(dt), 'coming') OR contains(lower(dt), 'soon')
                 OR contains(lower(dt), 'tba') OR contains(lower(dt), 'to be announced')
                 OR contains(lower(dt), 'announced')
                 OR coalesce(json_extract(e, '$.data.release_date.coming_soon')::BOOLEAN, true) <> false))
SELECT event_id AS appid,
       coalesce(json_extract_string(e, '$.data.name'), '') AS name,
       strftime(strptime(dt, '%d %b, %Y'), '%d/%m/%Y') AS release_date,
       coalesce(json_extract_string(e, '$.data.short_description'), '') AS short_description,
       json_extract_string(e, '$.data.developers[*]') AS developers,
       json_extract_string(e, '$.data.categories[*].description') AS categories,
       []::VARCHAR[] AS genre,
       coalesce(json_extract_string(e, '$.data.header_image'), '') AS header_image,
       coalesce(json_extract(e, '$.data.price_overview.initial')::BIGINT, 0) AS price,
       json_extract_string(e, '$.data.price_overview.currency') AS currency,
       json_extract(e, '$.data.platforms.windows')::BOOLEAN AS windows,
       json_extract(e, '$.data.platforms.linux')::BOOLEAN AS linux,
       json_extract(e, '$.data.platforms.mac')::BOOLEAN AS mac,
       json_extract(e, '$.data.metacritic.score')::BIGINT AS metacritic,
       coalesce(json_extract(e, '$.data.recommendations.total')::BIGINT, 0) AS recommendations
FROM d""")
def payload_fields(spark, sf):
    """Raw payloads (one per event) -> released catalogue rows."""
    e = read_table(spark, sf, "events", spread=True)
    raw = e.select("event_id", _payload_text(e).alias("payload"))
    return payload.parse_payload(raw, "payload", "event_id")


_LINK_SQL = r"""
WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)(<a\s[^>]*>.*?</a>)', 1)) AS tag,
                  (generate_subscripts(regexp_extract_all(html, '(?s)(<a\s[^>]*>.*?</a>)', 1), 1) - 1)::INTEGER AS pos
           FROM pages)"""


@register("page_links", _LINK_SQL + r"""
SELECT page_id, pos, regexp_extract(tag, 'href="([^"]*)"', 1) AS href,
       regexp_replace(replace(replace(replace(replace(replace(replace(
           regexp_replace(regexp_extract(tag, '(?s)^<a[^>]*>(.*)</a>$', 1), '<[^>]*>', '', 'g'),
           '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
           '^[\s ]+|[\s ]+$', '', 'g') AS title
FROM t""")
def page_links(spark, sf):
    """S10/S11 link rows: every anchor of every page with its position."""
    return pages.extract_links(pages.drop_notice_pages(read_table(spark, sf, "pages")))


@register("page_state_filter", """
SELECT page_id, url FROM pages
WHERE NOT (contains(lower(html), 'you have been temporarily rate limited')
           OR contains(lower(html), 'your network has been banned'))""")
def page_state_filter(spark, sf):
    """Pages that are not block / rate-limit notices."""
    return pages.drop_notice_pages(read_table(spark, sf, "pages")).select("page_id", "url")


# ------------------------------------------------------------ files

@register("export_roundtrip", """
SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def export_roundtrip(spark, sf):
    """K3/K5 + K4 + S1/S2: nations exported as CSV, one folder per region (K5);
    regions as JSON in files of at most 2 records (K4); both read back with
    declared schemas and joined."""
    root = scratch_path(spark, "export")
    nation, region = read_table(spark, sf, "nation"), read_table(spark, sf, "region")
    sinks.export_csv(nation, f"{root}/nation", by=["n_regionkey"])
    sinks.export_json(region, f"{root}/region", per_file=2)
    n_schema = T.StructType([T.StructField("n_nationkey", T.IntegerType()),
                             T.StructField("n_name", T.StringType()),
                             T.StructField("n_regionkey", T.IntegerType())])
    r_schema = T.StructType([T.StructField("r_regionkey", T.IntegerType()),
                             T.StructField("r_name", T.StringType())])
    n = spark.read.schema(n_schema).option("header", True).csv(f"{root}/nation")
    r = spark.read.schema(r_schema).json(f"{root}/region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select("n_nationkey", "n_name", "n_regionkey", "r_name"))


_PRICE_FILE_SCHEMA = T.StructType([T.StructField("o_orderkey", T.StringType()),
                                   T.StructField("DateTime", T.StringType()),
                                   T.StructField("Final price", T.StringType()),
                                   T.StructField("2-year low", T.StringType())])


@register("keyed_file_load", """
SELECT o_custkey % 20 AS appid, o_orderkey::BIGINT AS o_orderkey, o_orderdate::DATE AS date,
       o_totalprice::DECIMAL(12,2)::DOUBLE AS final_price
FROM orders""")
def keyed_file_load(spark, sf):
    """S4-S7 + F11 + X5/X14: orders written as ';' CSV with decimal commas into
    two worker folders (instance_1, instance_2), one folder per key bucket; read
    back with one glob over the workers, the key taken from the path."""
    root = scratch_path(spark, "keyed")
    o = read_table(spark, sf, "orders")
    out = o.select(
        (F.col("o_custkey") % 20).alias("bucket"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.date_format("o_orderdate", "d/M/yyyy").alias("DateTime"),
        F.replace(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("."),
                  F.lit(",")).alias("Final price"),
        F.lit("").alias("2-year low"))
    sinks.export_csv(out.where(F.col("o_custkey") < 750), f"{root}/instance_1/price",
                     by=["bucket"], sep=";")
    sinks.export_csv(out.where(F.col("o_custkey") >= 750), f"{root}/instance_2/price",
                     by=["bucket"], sep=";")
    raw = files.read_keyed_csv(spark, f"{root}/instance_*/price/bucket=*/*.csv",
                               _PRICE_FILE_SCHEMA, sep=";", key_regex=r"bucket=(\d+)/")
    from ..functions import cleaning as X
    return raw.select("appid", F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                      D.parse_any_date("DateTime").alias("date"),
                      X.decimal_comma(F.col("`Final price`")).alias("final_price"))


def _history_files(spark, df, root: str, kind: str, sep: str = ","):
    """Write ``df`` as CSV files of a hundred customers each, rows in ``o_orderkey``
    order, split over two worker folders like the collectors' ``instance_*/<kind>/``
    layout; every file's line order is then known. The key is a column."""
    ordered = (df.withColumn("block", F.floor(F.col("appid") / 100).cast("int"))
                 .repartition("block").sortWithinPartitions("block", "o_orderkey")
                 .drop("o_orderkey"))
    for worker in (1, 2):
        sinks.export_csv(ordered.where(F.col("block") % 2 == worker - 1),
                         f"{root}/instance_{worker}/{kind}", by=["block"], sep=sep)


def _read_history(spark, root: str, kind: str, schema: T.StructType, **options):
    """The files back: every column as text, the appid last (as it was written)."""
    text = T.StructType([T.StructField("appid", T.StringType()), *schema.fields])
    raw = files.read_keyed_csv(spark, f"{root}/instance_*/{kind}/block=*/*.csv", text,
                               key_regex=r"block=(\d+)/", key_name="block", **options)
    return raw.withColumn("appid", F.col("appid").try_cast("bigint"))


_FR_MONTHS = ", ".join(f"'{fr}'" for fr, _ in D.FRENCH_MONTHS[:12])
_PLAYER_TEXT_SQL = f"""
SELECT o_custkey AS appid, o_orderkey,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-08-01' THEN 'Last 30 days'
            WHEN o_orderstatus = 'F'
              THEN list_extract([{_FR_MONTHS}], month(o_orderdate)::INT) || strftime(o_orderdate, ' %Y')
            ELSE strftime(o_orderdate, '%B %Y') END AS "Month",
       CASE WHEN o_orderstatus = 'P' THEN '-' ELSE trunc(o_totalprice)::BIGINT::VARCHAR END AS "Peak",
       CASE WHEN o_orderpriority = '5-LOW' THEN '-' ELSE '+' || (o_orderkey % 100)::VARCHAR END AS "Gain",
       replace((o_totalprice / 1000)::DECIMAL(10,1)::VARCHAR, '.', ',') AS "Percent_Gain"
FROM orders"""


def _player_text(o):
    d = F.col("o_orderdate")
    fr = F.element_at(F.array(*[F.lit(fr) for fr, _ in D.FRENCH_MONTHS[:12]]), F.month(d))
    month = (F.when(d >= F.lit("2001-08-01").cast("timestamp_ntz"), F.lit("Last 30 days"))
              .when(F.col("o_orderstatus") == "F", F.concat(fr, F.date_format(d, " yyyy")))
              .otherwise(F.date_format(d, "MMMM yyyy")))
    return o.select(
        F.col("o_custkey").alias("appid"), "o_orderkey", month.alias("Month"),
        F.when(F.col("o_orderstatus") == "P", F.lit("-"))
         .otherwise(F.col("o_totalprice").cast("bigint").cast("string")).alias("Peak"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("-"))
         .otherwise(F.concat(F.lit("+"), (F.col("o_orderkey") % 100).cast("string"))).alias("Gain"),
        F.replace((F.col("o_totalprice") / 1000).cast("decimal(10,1)").cast("string"),
                  F.lit("."), F.lit(",")).alias("Percent_Gain"))


@register("players_load", f"""
WITH t AS ({_PLAYER_TEXT_SQL}),
p AS (
  SELECT appid, o_orderkey,
         date_trunc('month', coalesce(
           try_strptime(CASE WHEN "Month" = 'Last 30 days' THEN 'August 2001' ELSE "Month" END, '%B %Y'),
           make_date(CAST(right("Month", 4) AS INT),
                     list_position([{_FR_MONTHS}], split_part("Month", ' ', 1)), 1)))::DATE AS month,
         nullif("Peak", '-')::INT AS peak,
         nullif(replace(replace(replace("Gain", ',', ''), '+', ''), '%', ''), '-')::INT AS gain,
         replace(replace(replace("Percent_Gain", ',', ''), '+', ''), '%', '')::DOUBLE AS percent_gain
  FROM t)
SELECT appid::BIGINT AS appid, month, peak, gain, percent_gain FROM p
WHERE appid IN (SELECT p_partkey FROM part WHERE p_size <= 40)
QUALIFY row_number() OVER (PARTITION BY appid, month ORDER BY o_orderkey) = 1""")
def players_load(spark, sf):
    """M14 + S7 + X5/X7/X13: players files of a hundred games each in two worker
    folders; 'Last 30 days' resolved to a given month, English and
    French month names, '-' -> NULL, first row per (game, month) wins, unknown
    games refused."""
    root = scratch_path(spark, "players")
    _history_files(spark, _player_text(read_table(spark, sf, "orders")), root, "players")
    raw = _read_history(spark, root, "players", PLAYERS_SCHEMA)
    games = read_table(spark, sf, "part").where(F.col("p_size") <= 40).select(
        F.col("p_partkey").alias("appid"))
    return legacy.players_load(raw, games, as_of="August 2001").rows


_PRICE_TEXT_SQL = """
SELECT o_custkey AS appid, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS "DateTime",
       CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE replace(o_totalprice::DECIMAL(12,2)::VARCHAR, '.', ',') END AS "Final price",
       replace((floor(o_totalprice * 50) / 100)::DECIMAL(12,2)::VARCHAR, '.', ',') AS "2-year low"
FROM orders"""


@register("price_load", f"""
WITH t AS ({_PRICE_TEXT_SQL}),
body AS (SELECT * FROM t QUALIFY o_orderkey < max(o_orderkey) OVER (PARTITION BY appid // 100))
SELECT appid::BIGINT AS appid, strptime("DateTime", '%Y-%m-%d')::DATE AS date,
       replace("Final price", ',', '.')::DOUBLE AS final_price,
       replace("2-year low", ',', '.')::DOUBLE AS two_year_low
FROM body
WHERE appid IN (SELECT p_partkey FROM part WHERE p_size <= 40)
QUALIFY row_number() OVER (PARTITION BY appid, "DateTime" ORDER BY o_orderkey) = 1""")
def price_load(spark, sf):
    """M15 + S5: ';' price files with decimal commas; the last line of
    every file is dropped; first row per (game, day) wins."""
    root = scratch_path(spark, "price")
    o = read_table(spark, sf, "orders")
    text = o.select(
        F.col("o_custkey").alias("appid"), "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("DateTime"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string")).otherwise(
            F.replace(F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit("."),
                      F.lit(","))).alias("Final price"),
        F.replace((F.floor(F.col("o_totalprice") * 50) / 100).cast("decimal(12,2)").cast("string"),
                  F.lit("."), F.lit(",")).alias("2-year low"))
    _history_files(spark, text, root, "price", sep=";")
    raw = _read_history(spark, root, "price", PRICE_SCHEMA, sep=";", drop_footer=True)
    games = read_table(spark, sf, "part").where(F.col("p_size") <= 40).select(
        F.col("p_partkey").alias("appid"))
    return legacy.price_load(raw, games).rows


@register("users_load", """
SELECT strptime(strftime(day, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS "DateTime",
       users AS "Users", trunc(avg_users)::BIGINT AS "AverageUsers",
       CASE WHEN in_game < 10 THEN NULL ELSE in_game END::BIGINT AS "InGame"
FROM (SELECT date_trunc('day', ts) AS day, count(*) AS users, avg(value) AS avg_users,
             count_if(event_type = 'view') AS in_game FROM events GROUP BY 1) t""")
def users_load(spark, sf):
    """M16 + S3: daily platform counts written as ';' CSV (blank when too few
    in-game samples) and loaded back typed."""
    root = scratch_path(spark, "users")
    e = read_table(spark, sf, "events")
    daily = (e.groupBy(F.date_trunc("day", "ts").alias("day"))
              .agg(F.count(F.lit(1)).cast("double").alias("Users"),
                   F.avg("value").alias("Average Users"),
                   F.count_if(F.col("event_type") == "view").alias("_ig")))
    out = daily.select(F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("DateTime"), "Users",
                       "Average Users",
                       F.when(F.col("_ig") < 10, F.lit(None).cast("double"))
                       .otherwise(F.col("_ig").cast("double")).alias("In-Game"))
    sinks.export_csv(out, root, sep=";")
    return legacy.users_load(files.with_file_order(
        files.read_semicolon_csv(spark, root, USERS_SCHEMA))).rows


def _metric_text(li):
    """lineitem rendered as the metrics CSV, text cells with blanks and dashes."""
    def dec(c, scale=1):
        return c.cast(f"decimal(14,{scale})").cast("string")
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.col("l_partkey").cast("string").alias("steam_id"),
        F.date_format(F.trunc(F.col("l_shipdate").cast("date"), "MM"), "dd/MM/yyyy").alias("Month"),
        F.when(F.col("l_linenumber") == 7, F.lit("")).otherwise(dec(F.floor(p) / 10)).alias("AvgViewers"),
        F.when(F.col("l_discount") == 0, F.lit("-")).otherwise(dec(q / 2 - 12)).alias("AvgViewersGain"),
        F.when(F.col("l_tax") == 0, F.lit("")).otherwise(dec(F.col("l_discount") * 100, 2)).alias("AvgViewers%Gain"),
        dec(F.floor(p / 7 * 10) / 10).alias("PeakViewers"),
        F.when(F.col("l_returnflag") == "R", F.lit("-")).otherwise(dec(q / 4, 2)).alias("AvgStreams"),
        dec(F.lit(25.5) - q).alias("AvgStreamsGain"),
        dec(F.col("l_tax") * 100, 2).alias("AvgStreamsùGain"),
        dec(q * 2.5).alias("PeakStreams"),
        F.when(F.col("l_linestatus") == "O", F.lit("-")).otherwise(dec(p, 2)).alias("HoursWatched"))


_METRIC_TEXT_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey::VARCHAR AS steam_id,
       strftime(date_trunc('month', l_shipdate), '%d/%m/%Y') AS "Month",
       CASE WHEN l_linenumber = 7 THEN '' ELSE (floor(l_extendedprice) / 10)::DECIMAL(14,1)::VARCHAR END AS "AvgViewers",
       CASE WHEN l_discount = 0 THEN '-' ELSE (l_quantity / 2 - 12)::DECIMAL(14,1)::VARCHAR END AS "AvgViewersGain",
       CASE WHEN l_tax = 0 THEN '' ELSE (l_discount * 100)::DECIMAL(14,2)::VARCHAR END AS "AvgViewers%Gain",
       (floor(l_extendedprice / 7 * 10) / 10)::DECIMAL(14,1)::VARCHAR AS "PeakViewers",
       CASE WHEN l_returnflag = 'R' THEN '-' ELSE (l_quantity / 4)::DECIMAL(14,2)::VARCHAR END AS "AvgStreams",
       (25.5 - l_quantity)::DECIMAL(14,1)::VARCHAR AS "AvgStreamsGain",
       (l_tax * 100)::DECIMAL(14,2)::VARCHAR AS "AvgStreamsùGain",
       (l_quantity * 2.5)::DECIMAL(14,1)::VARCHAR AS "PeakStreams",
       CASE WHEN l_linestatus = 'O' THEN '-' ELSE l_extendedprice::DECIMAL(14,2)::VARCHAR END AS "HoursWatched"
FROM lineitem"""


_METRICS_LOAD_SQL = f"""
WITH t AS ({_METRIC_TEXT_SQL}),
acc AS (
  SELECT l_orderkey, l_linenumber, steam_id::INT AS steam_id, strptime("Month", '%d/%m/%Y')::DATE AS date,
         CASE WHEN "AvgViewers" = '-' THEN NULL ELSE trunc("AvgViewers"::DOUBLE)::INT END AS "AvgViewers",
         CASE WHEN "AvgViewersGain" IN ('-', '') THEN NULL ELSE trunc("AvgViewersGain"::DOUBLE)::INT END AS "AvgViewersGain",
         CASE WHEN "AvgViewers%Gain" IN ('-', '') THEN NULL ELSE "AvgViewers%Gain"::DOUBLE END AS "AvgViewers%Gain",
         CASE WHEN "PeakViewers" = '-' THEN NULL ELSE trunc("PeakViewers"::DOUBLE)::INT END AS "PeakViewers",
         CASE WHEN "AvgStreams" = '-' THEN NULL ELSE trunc("AvgStreams"::DOUBLE)::INT END AS "AvgStreams",
         CASE WHEN "AvgStreamsGain" IN ('-', '') THEN NULL ELSE trunc("AvgStreamsGain"::DOUBLE)::INT END AS "AvgStreamsGain",
         CASE WHEN "AvgStreamsùGain" IN ('-', '') THEN NULL ELSE "AvgStreamsùGain"::DOUBLE END AS "AvgStreamsùGain",
         CASE WHEN "PeakStreams" = '-' THEN NULL ELSE trunc("PeakStreams"::DOUBLE)::INT END AS "PeakStreams",
         CASE WHEN "HoursWatched" = '-' THEN NULL ELSE "HoursWatched" END AS "HoursWatched"
  FROM t WHERE "AvgViewers" <> '')
SELECT steam_id, date, "AvgViewers", "AvgViewersGain", "AvgViewers%Gain", "PeakViewers", "AvgStreams",
       "AvgStreamsGain", "AvgStreamsùGain", "PeakStreams", "HoursWatched"
FROM acc
WHERE steam_id IN (SELECT p_partkey FROM part WHERE p_size <= 40)
QUALIFY row_number() OVER (PARTITION BY steam_id, date ORDER BY l_orderkey, l_linenumber) = 1"""


@register("metrics_load", _METRICS_LOAD_SQL)
def metrics_load(spark, sf):
    """Lineitem rendered as metric CSV files (in (l_orderkey, l_linenumber)
    order), loaded with the legacy rules: blank AvgViewers rejects, '-' gives
    NULL, unknown games (parts of size > 40) are refused, first row per
    (steam_id, month) in file order wins."""
    return _metrics_load_result(spark, sf).rows


def _metrics_load_result(spark, sf):
    root = scratch_path(spark, "metrics")
    li = read_table(spark, sf, "lineitem")
    text = _metric_text(li).orderBy("l_orderkey", "l_linenumber").drop("l_orderkey", "l_linenumber")
    sinks.export_csv(text, root)
    raw = files.read_metrics_csv(spark, root, METRICS_TEXT_SCHEMA, with_order=True)
    games = read_table(spark, sf, "part").where(F.col("p_size") <= 40).select(
        F.col("p_partkey").cast("int").alias("appid"))
    return legacy.metrics_load(raw, games)


@register("metrics_audit", f"""
WITH loaded AS ({_METRICS_LOAD_SQL})
SELECT (SELECT count(*) FROM lineitem) AS n_total, (SELECT count(*) FROM loaded) AS n_ok,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM loaded) AS n_rejected""")
def metrics_audit(spark, sf):
    """K9 + A5: the load audit's grand-total row for the metrics load (rows read,
    inserted, rejected -- parse failures, unknown games and duplicate keys)."""
    audit = _metrics_load_result(spark, sf).audit
    return audit.where(F.col("file_path").isNull()).select("n_total", "n_ok", "n_rejected")


@register("catalogue_load", f"""
WITH b AS ({BRONZE_CATALOGUE_SQL}),
dev AS (SELECT row_number() OVER (ORDER BY name) AS developer_id, name
        FROM (SELECT DISTINCT developers[1] AS name FROM b WHERE developers[1] IS NOT NULL) d)
SELECT b.appid, b.name, dev.developer_id, strptime(b.release_date, '%d/%m/%Y')::DATE AS release_date,
       coalesce(b.short_description, '') AS short_description, coalesce(b.price, 0) AS price,
       b.currency, coalesce(b.windows, false) AS windows, coalesce(b.linux, false) AS linux,
       coalesce(b.mac, false) AS mac, b.metacritic, coalesce(b.recommendations, 0) AS recommendations,
       coalesce(b.header_image, '') AS header_image
FROM b LEFT JOIN dev ON b.developers[1] = dev.name""")
def catalogue_load(spark, sf):
    """The catalogue exported as JSON batch files (K4) and loaded back:
    first developer only, developer ids created on the fly (W2)."""
    root = scratch_path(spark, "catalogue")
    sinks.export_json(bronze_catalogue(read_table(spark, sf, "part")), root, per_file=500)
    bronze = files.read_catalogue_json(spark, root, CATALOGUE_SCHEMA, with_order=True,
                                       multiLine=False)
    return legacy.catalogue_load(bronze).rows.select(*legacy.GAME_FIELDS)


@register("incremental_load", """
SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def incremental_load(spark, sf):
    """ST1: events arrive in two drops; each run of the availableNow stream picks
    up only the new files and appends first-wins rows by event_id."""
    from ..streaming.incremental import read_target, run_incremental
    root = scratch_path(spark, "stream")
    e = read_table(spark, sf, "events")
    cut = F.lit("2024-01-04").cast("timestamp_ntz")
    args = dict(schema=e.schema, target=f"{root}/target", checkpoint=f"{root}/_checkpoint",
                keys=["event_id"], order=["ts"])
    e.where(F.col("ts") < cut).write.parquet(f"{root}/src/drop=1")
    run_incremental(spark, f"{root}/src", **args)
    e.where(F.col("ts") >= cut).write.parquet(f"{root}/src/drop=2")
    run_incremental(spark, f"{root}/src", **args)
    return read_target(spark, f"{root}/target").select(*e.columns)


# ------------------------------------------------------------ goals

def _genre_marts(spark, sf):
    stg = stg_catalogue(spark, sf)
    games = marts.dim_entity(stg)
    genre = marts.dim_member(stg, "genre", "genre_name", "genre_key")
    b = bridge(stg, "appid", "genre", games, "game_key", genre, "genre_name", "genre_key")
    dates = marts.dim_date(order_months(spark, sf))
    f = marts.fact(stg_metrics(spark, sf), games, dates)
    return games, genre, b, dates, f


_GENRE_SQL = f"""
WITH g AS ({STG_CATALOGUE_SQL}),
games AS (SELECT row_number() OVER (ORDER BY appid) AS game_key, appid, price FROM g),
genre AS (SELECT row_number() OVER (ORDER BY genre_name) AS genre_key, genre_name
          FROM (SELECT DISTINCT unnest(genre) AS genre_name FROM g WHERE genre IS NOT NULL) u),
br AS (SELECT games.game_key, genre.genre_key
       FROM (SELECT appid, unnest(genre) AS genre_name FROM g WHERE genre IS NOT NULL) x
       JOIN games ON x.appid = games.appid JOIN genre ON x.genre_name = genre.genre_name),
f AS ({FACT_SQL}),
dd AS ({DIM_DATE_SQL})"""


@register("goal_member_month", _GENRE_SQL + """
SELECT genre.genre_name, f.date_key, dd.year, dd.month,
       sum(f.hours_watched)::BIGINT AS total_hours, max(f.peak_viewers) AS peak_viewers,
       count(*) AS n_rows
FROM f JOIN br ON f.game_key = br.game_key JOIN genre ON br.genre_key = genre.genre_key
       JOIN dd ON f.date_key = dd.date_key
GROUP BY genre.genre_name, f.date_key, dd.year, dd.month""")
def goal_member_month(spark, sf):
    """G1 (extension): hours watched and peak viewers per genre and month."""
    games, genre, b, dates, f = _genre_marts(spark, sf)
    return goals.member_month(f, b, genre, "genre_key", "genre_name", dates)


@register("goal_corr", _GENRE_SQL + """,
pg AS (SELECT game_key, avg(avg_viewers) AS mean_viewers FROM f GROUP BY game_key),
pr AS (SELECT pg.game_key, games.price, pg.mean_viewers FROM pg JOIN games ON pg.game_key = games.game_key
       WHERE games.price > 0)
SELECT NULL::VARCHAR AS genre_name, count(*) AS n_games, round(corr(price, mean_viewers), 6) AS corr FROM pr
UNION ALL
SELECT genre.genre_name, count(*) AS n_games, round(corr(price, mean_viewers), 6) AS corr
FROM pr JOIN br ON pr.game_key = br.game_key JOIN genre ON br.genre_key = genre.genre_key
GROUP BY genre.genre_name""")
def goal_corr(spark, sf):
    """G2 (extension): price vs mean average viewers, overall and per genre."""
    games, genre, b, dates, f = _genre_marts(spark, sf)
    return goals.price_viewer_corr(f, games, b, genre, "genre_key", "genre_name")
