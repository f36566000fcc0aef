"""Explicit nulls, declared tables, published versions and numbered batches over the
driver tables, each with its SQL. Constants are spelt out in the SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import declared, filters, loads
from ..operators.ledger import IdLedger
from ..schemas import CATALOGUE_SCHEMA
from ..session import materialize, read_table, scratch_path
from ..sources import files, pages, payload, publish, sinks
from . import legacy, marts
from .driver import STG_FACT_SQL, bronze_catalogue, stg_catalogue, stg_metrics

Q, SQL = {}, {}


def register(name, sql):
    def deco(fn):
        Q[name], SQL[name] = fn, sql
        return fn
    return deco


# ------------------------------------------------------------ absent and null fields

def _field(name, *cases, otherwise):
    """``"name": value`` by the event's id modulo ``n``; a case of None leaves it out."""
    out = None
    for n, r, value in cases:
        text = F.lit(None).cast("string") if value is None else F.lit(f'"{name}": {value}')
        hit = F.col("event_id") % n == r
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return out.otherwise(F.concat(F.lit(f'"{name}": '), otherwise))


def _object(*fields):
    return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))


def _quoted(c):
    return F.concat(F.lit('"'), c, F.lit('"'))


def _null_payloads(spark, sf):
    """A payload per event whose fields are absent, null, empty or set by the event's id."""
    e = read_table(spark, sf, "events")
    number = F.col("event_id").cast("string")
    data = _object(
        _field("name", (3, 0, None), (3, 1, "null"), otherwise=_quoted(F.col("event_type"))),
        _field("short_description", (5, 0, "null"), (5, 1, None), otherwise=_quoted(number)),
        _field("developers", (4, 0, None), (4, 1, "null"), (4, 2, "[]"),
               otherwise=F.concat(F.lit('["u'), number, F.lit('", null]'))),
        _field("categories", (7, 0, None), (7, 1, "null"), (7, 2, '[{"id": 1}]'), (7, 3, '[{"description": null}]'),
               (7, 4, "{}"),
               otherwise=F.concat(F.lit('[{"description": "'), F.col("event_type"), F.lit('"}]'))),
        _field("price_overview", (6, 0, None), (6, 1, "null"), (6, 2, "{}"), (6, 3, '{"currency": "EUR"}'),
               (6, 4, '{"initial": null, "currency": null}'),
               otherwise=F.concat(F.lit('{"initial": '), number, F.lit(', "currency": "USD"}'))),
        _field("platforms", (11, 0, "null"), (11, 1, None), (11, 2, '"all"'),
               otherwise=F.lit('{"windows": null, "mac": true}')),
        _field("metacritic", (13, 0, "null"), (13, 1, None), (13, 2, "{}"), (13, 3, "7"),
               otherwise=F.concat(F.lit('{"score": '), number, F.lit("}"))),
        _field("recommendations", (17, 0, "null"), (17, 1, None), (17, 2, "{}"), (17, 3, '{"total": null}'),
               (17, 4, "[]"),
               otherwise=F.concat(F.lit('{"total": '), number, F.lit("}"))),
        _field("release_date", (19, 0, "null"), (19, 1, '{"coming_soon": null, "date": "6 Mar, 2024"}'),
               (19, 2, '{"coming_soon": false}'), (19, 3, '{"date": "6 Mar, 2024"}'), (19, 4, None), (19, 5, '"2024"'),
               otherwise=F.lit('{"coming_soon": false, "date": "6 Mar, 2024"}')))
    entry = _object(
        _field("success", (23, 0, "false"), (23, 4, None), otherwise=F.lit("true")),
        _field("data", (23, 1, "null"), (23, 2, None), otherwise=data))
    text = F.when(F.col("event_id") % 23 == 3, F.lit("no json")) \
        .otherwise(F.concat(F.lit("{"), _quoted(number), F.lit(": "), entry, F.lit("}")))
    return e.select("event_id", text.alias("payload"))


_NULL_REASON = """
CASE WHEN e % 23 IN (0, 2, 3, 4) THEN 'no data' WHEN e % 23 = 1 THEN 'bad data'
     WHEN e % 19 = 5 THEN 'bad release_date' WHEN e % 19 < 5 THEN 'unreleased'
     WHEN e % 11 = 2 THEN 'bad platforms' WHEN e % 13 = 3 THEN 'bad metacritic'
     WHEN e % 17 = 4 THEN 'bad recommendations' WHEN e % 7 IN (2, 4) THEN 'bad categories' END"""


@register("payload_nulls", f"""
SELECT e AS appid, CASE e % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE event_type END AS name,
       '06/03/2024' AS release_date,
       CASE e % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE e::VARCHAR END AS short_description,
       CASE e % 4 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN NULL WHEN 2 THEN []::VARCHAR[]
                  ELSE ['u' || e, NULL] END AS developers,
       CASE e % 7 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN []::VARCHAR[] WHEN 3 THEN [NULL]::VARCHAR[] ELSE [event_type] END AS categories,
       []::VARCHAR[] AS genre, '' AS header_image,
       CASE e % 6 WHEN 4 THEN NULL WHEN 5 THEN e ELSE 0 END::BIGINT AS price,
       CASE e % 6 WHEN 3 THEN 'EUR' WHEN 5 THEN 'USD' END AS currency,
       NULL::BOOLEAN AS windows, NULL::BOOLEAN AS linux, CASE WHEN e % 11 > 1 THEN true END AS mac,
       CASE WHEN e % 13 > 2 THEN e END::BIGINT AS metacritic,
       CASE WHEN e % 17 < 3 THEN 0 WHEN e % 17 = 3 THEN NULL ELSE e END::BIGINT AS recommendations
FROM (SELECT event_id AS e, event_type FROM events) WHERE {_NULL_REASON} IS NULL""")
def payload_nulls(spark, sf):
    """S9 + P12: a default for an absent field, NULL for an explicit null."""
    return payload.parse_payload(_null_payloads(spark, sf), "payload", "event_id")


@register("payload_passed_by", f"""
SELECT e AS appid, {_NULL_REASON} AS reason FROM (SELECT event_id AS e FROM events)
WHERE {_NULL_REASON} IS NOT NULL""")
def payload_passed_by(spark, sf):
    """F4 + F5: every payload that is no game, with the reason."""
    return payload.payload_rejects(_null_payloads(spark, sf), "payload", "event_id")


def _null_catalogue(spark, sf):
    """Catalogue batches whose records lack fields, hold nulls or hold unfit values."""
    c = bronze_catalogue(read_table(spark, sf, "part"))
    key = F.col("appid")
    pick = {"price": 3, "windows": 5, "mac": 7, "short_description": 4, "recommendations": 6, "header_image": 8}

    def field(name):
        value = F.to_json(F.struct(F.col(name)), {"ignoreNullFields": "false"})
        inner = F.substring(value, F.lit(2), F.length(value) - 2)
        if name == "metacritic":
            inner = F.when(key % 29 == 0, F.lit('"metacritic": "high"')).otherwise(inner)
        if name == "name":
            return F.when(key % 31 != 0, inner)
        if name not in pick:
            return inner
        n = pick[name]
        return F.when(key % n == 1, F.lit(f'"{name}": null')).when(key % n != 2, inner)

    record = _object(*[field(f.name) for f in CATALOGUE_SCHEMA.fields])
    records = c.select(F.floor(key / 100).cast("int").alias("block"), record.alias("value"))
    root = scratch_path(spark, "catalogue-nulls")
    arrays = records.groupBy("block").agg(F.concat(
        F.lit("[\n"), F.concat_ws(",\n", F.array_sort(F.collect_list("value"))), F.lit("\n]")).alias("value"))
    arrays.write.partitionBy("block").text(root)
    return materialize(files.read_catalogue_variant(spark, f"{root}/block=*"))


@register("catalogue_nulls", """
SELECT p_partkey AS appid, CASE WHEN p_partkey % 3 = 2 THEN 0 END::BIGINT AS default_price,
       p_partkey % 3 = 1 AS null_price, CASE WHEN p_partkey % 5 = 2 THEN false END AS default_windows,
       p_partkey % 5 = 1 AS null_windows, p_partkey % 4 = 2 AS empty_description,
       p_partkey % 4 = 1 AS null_description,
       CASE WHEN p_partkey % 29 = 0 THEN 'bad metacritic' WHEN p_partkey % 31 = 0 THEN 'no name' END AS reason
FROM part""")
def catalogue_nulls(spark, sf):
    """S2 + P12 + M12: games loaded from batches with absent and null fields, and the
    records refused for an unfit value or without a name."""
    res = legacy.catalogue_load(_null_catalogue(spark, sf))
    key = F.col("appid")

    def shown(reason):
        return [key, F.when(key % 3 == 2, F.col("price")).alias("default_price"),
                F.col("price").isNull().alias("null_price"),
                F.when(key % 5 == 2, F.col("windows")).alias("default_windows"),
                F.col("windows").isNull().alias("null_windows"),
                (F.col("short_description") == "").eqNullSafe(True).alias("empty_description"),
                F.col("short_description").isNull().alias("null_description"), reason.alias("reason")]

    return res.rows.select(*shown(F.lit(None).cast("string"))).unionAll(
        res.rejected.select(*shown(F.col("reason"))))


# ------------------------------------------------------------ declared tables

def _untyped_metrics(spark, sf):
    """Metric rows as text, with values that no column of the declared table takes."""
    li = read_table(spark, sf, "lineitem")
    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    at = lambda n, value, good: F.when(line % n == 0, F.lit(value)).otherwise(good)
    return li.select(
        line.alias("line"),
        at(31, None, at(37, "12x", F.col("l_partkey").cast("string"))).alias("steam_id"),
        at(41, "2024-02-30", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date"),
        at(43, "3000000000", F.col("l_quantity").cast("int").cast("string")).alias("AvgViewers"),
        F.lit(None).cast("string").alias("AvgViewersGain"),
        at(47, "NaN", at(53, "1e39", F.lit("0.5"))).alias("AvgViewers%Gain"),
        at(59, "2.5", F.lit("7")).alias("PeakViewers"), F.lit(4).alias("AvgStreams"),
        F.col("l_quantity").alias("AvgStreamsGain"),
        at(61, F.lit(1.5), F.lit(2.0)).alias("PeakStreams"),
        at(67, "h" * 51, F.repeat(F.lit("h"), F.lit(50))).alias("HoursWatched"))


_UNTYPED_REASON = """
CASE WHEN line % 31 = 0 THEN 'null steam_id' WHEN line % 37 = 0 THEN 'bad steam_id'
     WHEN line % 41 = 0 THEN 'bad date' WHEN line % 43 = 0 THEN 'bad avg_viewers'
     WHEN line % 47 = 0 OR line % 53 = 0 THEN 'bad avg_viewers_gain_percent' WHEN line % 59 = 0 THEN 'bad peak_viewers'
     WHEN line % 61 = 0 THEN 'bad peak_streams' WHEN line % 67 = 0 THEN 'long hours_watched' END"""
_UNTYPED_SQL = "(SELECT *, l_orderkey * 10 + l_linenumber AS line FROM lineitem)"


def _declared(spark, sf):
    return declared.declared_write(_untyped_metrics(spark, sf), declared.LEGACY_TABLES["twitchgames"],
                                   scratch_path(spark, "declared"))


@register("declared_write", f"""
SELECT l_partkey::INT AS steam_id, l_shipdate::DATE AS date, trunc(l_quantity)::INT AS avg_viewers,
       NULL::INT AS avg_viewers_gain, 0.5::FLOAT AS avg_viewers_gain_percent, 7 AS peak_viewers, 4 AS avg_streams,
       l_quantity::INT AS avg_streams_gain, NULL::FLOAT AS avg_streams_gain_percent, 2 AS peak_streams,
       repeat('h', 50) AS hours_watched
FROM {_UNTYPED_SQL} WHERE {_UNTYPED_REASON} IS NULL AND l_quantity = trunc(l_quantity)""")
def declared_write(spark, sf):
    """K6: the rows that fit, read back with the declared names, types and order."""
    return _declared(spark, sf).rows


@register("declared_rejects", f"""
SELECT line, coalesce({_UNTYPED_REASON.replace("WHEN line % 61 = 0", "WHEN l_quantity <> trunc(l_quantity) THEN "
                                               "'bad avg_streams_gain' WHEN line % 61 = 0")}) AS reason
FROM {_UNTYPED_SQL} WHERE {_UNTYPED_REASON} IS NOT NULL OR l_quantity <> trunc(l_quantity)""")
def declared_rejects(spark, sf):
    """K6: every other row, with the first column it does not fit."""
    return _declared(spark, sf).rejected.select("line", F.col("reject_reason").alias("reason"))


@register("constraint_report", """
WITH g AS (SELECT p_partkey AS appid, p_size FROM part WHERE p_size <= 40),
t AS (SELECT CASE WHEN l_orderkey % 13 <> 0 THEN l_partkey END AS id,
             CASE WHEN l_orderkey % 17 <> 0 THEN date_trunc('month', l_shipdate)::DATE END AS d FROM lineitem),
m AS (SELECT DISTINCT p_brand AS b FROM part),
l AS (SELECT p_partkey AS appid, p_size AS id FROM part)
SELECT 'steamgames' AS table_name, 'not_null' AS kind, 'name' AS columns, 0::BIGINT AS n_failing
UNION ALL SELECT 'steamgames', 'not_null', 'appid', 0
UNION ALL SELECT 'steamgames', 'foreign_key', 'developer_id', (SELECT count(*) FROM g WHERE p_size > 10)
UNION ALL SELECT 'steamgames', 'primary_key', 'appid', 0
UNION ALL SELECT 'developers', 'not_null', 'id', 0
UNION ALL SELECT 'developers', 'primary_key', 'id', 0
UNION ALL SELECT 'developers', 'unique', 'name', 5
UNION ALL SELECT 'categories', 'not_null', 'id', 0
UNION ALL SELECT 'categories', 'primary_key', 'id', 0
UNION ALL SELECT 'categories', 'unique', 'description', (SELECT count(*) FROM m)
UNION ALL SELECT 'games_categories', 'not_null', 'game_appid', 0
UNION ALL SELECT 'games_categories', 'not_null', 'category_id', 0
UNION ALL SELECT 'games_categories', 'foreign_key', 'game_appid',
                 (SELECT count(*) FROM l WHERE appid NOT IN (SELECT appid FROM g))
UNION ALL SELECT 'games_categories', 'foreign_key', 'category_id',
                 (SELECT count(*) FROM l WHERE id > 2 * (SELECT count(*) FROM m))
UNION ALL SELECT 'games_categories', 'primary_key', 'game_appid,category_id', 0
UNION ALL SELECT 'twitchgames', 'not_null', 'steam_id', (SELECT count(*) FROM t WHERE id IS NULL)
UNION ALL SELECT 'twitchgames', 'not_null', 'date', (SELECT count(*) FROM t WHERE d IS NULL)
UNION ALL SELECT 'twitchgames', 'foreign_key', 'steam_id',
                 (SELECT count(*) FROM t WHERE id IS NOT NULL AND id NOT IN (SELECT appid FROM g))
UNION ALL SELECT 'twitchgames', 'primary_key', 'steam_id,date',
                 (SELECT count(*) - count(DISTINCT (id, d)) FROM t WHERE id IS NOT NULL AND d IS NOT NULL)""")
def constraint_report(spark, sf):
    """Q4: the declared constraints of five tables with nulls, repeated keys, names equal
    but for case, and children without parents."""
    part, li = read_table(spark, sf, "part"), read_table(spark, sf, "lineitem")
    games = part.where("p_size <= 40").select(F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"),
                                              F.col("p_size").alias("developer_id"))
    developers = spark.range(1, 11).select("id", F.when(F.col("id") > 5, F.concat(F.lit("Dév"), F.col("id") - 5))
                                           .otherwise(F.concat(F.lit("DEV"), F.col("id"))).alias("name"))
    brands = part.groupBy("p_brand").agg(F.min("p_partkey").alias("least"))
    from ..operators.keys import surrogate_key
    keyed = surrogate_key(brands.select(F.explode(F.array("p_brand", F.lower("p_brand"))).alias("description")),
                          "description", "id")
    links = part.select(F.col("p_partkey").alias("game_appid"), F.col("p_size").alias("category_id"))
    metrics = li.select(F.when(F.col("l_orderkey") % 13 != 0, F.col("l_partkey")).alias("steam_id"),
                        F.when(F.col("l_orderkey") % 17 != 0, F.trunc("l_shipdate", "MM")).alias("date"))
    return declared.constraint_report({"developers": developers, "steamgames": games, "categories": keyed,
                                       "games_categories": links, "twitchgames": metrics})


# ------------------------------------------------------------ published versions

class _Refused(Exception):
    pass


@register("publish_readback", f"""
SELECT 2::BIGINT AS version, f.* FROM ({STG_FACT_SQL}) f""")
def publish_readback(spark, sf):
    """K1 + K2: a first build of the star schema over a few games, a second over all of
    them, a third that fails half-way and a fourth that its check refuses; the fact table
    that readers then see is the second build's."""
    root = scratch_path(spark, "published")
    catalogue, metrics = stg_catalogue(spark, sf), stg_metrics(spark, sf)
    with publish.Publication(spark, root) as build:
        marts.build_warehouse(catalogue.where("appid <= 20"), metrics, write=build.write)
    with publish.Publication(spark, root) as build:
        marts.build_warehouse(catalogue, metrics, write=build.write)

    def broken(name, df):
        if name == "bridge_game_developer":
            raise _Refused(name)
        return failing.write(name, df)

    def refuse(tables):
        raise _Refused(f"{tables['dim_date'].count()} months")

    try:
        with publish.Publication(spark, root) as failing:
            marts.build_warehouse(catalogue.where("appid <= 10"), metrics, write=broken)
    except _Refused:
        pass
    try:
        with publish.Publication(spark, root) as build:
            build.write("dim_date", metrics.limit(0))
            build.check(refuse)
    except _Refused:
        pass
    now = publish.manifest(spark, root)["version"]
    return publish.published(spark, root, "fct_twitch_data").select(F.lit(now).cast("bigint").alias("version"), "*")


# ------------------------------------------------------------ numbered batches

@register("json_batches", """
WITH t AS (SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // 150 + 1 AS batch,
                  row_number() OVER (ORDER BY p_partkey) AS rn FROM part)
SELECT batch::INT AS batch, 1::BIGINT AS n_files, count(*) AS n_rows, min(p_partkey) AS first_key,
       max(p_partkey) AS last_key, true AS in_order,
       count(*) FILTER (p_partkey % 3 = 0) AS n_null_currency
FROM t GROUP BY batch""")
def json_batches(spark, sf):
    """K4 + S2: the catalogue in numbered JSON batches of 150 games, read back."""
    root = scratch_path(spark, "batches")
    games = bronze_catalogue(read_table(spark, sf, "part")).withColumn(
        "currency", F.when(F.col("appid") % 3 != 0, F.lit("EUR")))
    sinks.export_batches(games, root, "appid", per_file=150)
    back = files.read_catalogue_variant(spark, f"{root}/batch=*")
    number = F.regexp_extract("file_path", r"batch=(\d+)/", 1).cast("int")
    first = F.min(F.struct("line_no", "appid"))["appid"]
    last = F.max(F.struct("line_no", "appid"))["appid"]
    return back.groupBy(number.alias("batch")).agg(
        F.count_distinct("file_path").alias("n_files"), F.count(F.lit(1)).alias("n_rows"),
        F.min("appid").alias("first_key"), F.max("appid").alias("last_key"),
        ((first == F.min("appid")) & (last == F.max("appid"))).alias("in_order"),
        F.count_if(F.col("currency").isNull() & ~F.array_contains("absent", "currency")).alias("n_null_currency"))


# ------------------------------------------------------------ free-form dates

_DATE_SHAPES = (  # a format of Spark's and of DuckDB's
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ"), ("yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'", "%Y-%m-%dT%H:%M:%S.%g+02:00"),
    ("dd.MM.yyyy", "%d.%m.%Y"), ("MMM d, yyyy", "%b %-d, %Y"), ("EEEE, MMMM d, yyyy", "%A, %B %-d, %Y"),
    ("d-MMM-yy", "%-d-%b-%y"), ("yyyy/MM/dd HH:mm", "%Y/%m/%d %H:%M"), ("yyyyMMdd", "%Y%m%d"),
    ("MMM d yyyy h:mm a", "%b %-d %Y %-I:%M %p"), ("d/M/yy", "%-d/%-m/%y"), ("'the 'd'th of 'MMMM yyyy", "the %-dth of %B %Y"),
    ("MM/yyyy", "%m/%Y"), ("yyyy-MM", "%Y-%m"), ("yyyy", "%Y"), ("'Q1 'yyyy", "Q1 %Y"), ("'Coming 'MMMM", "Coming %B"),
)


@register("date_grammar", f"""
WITH t AS (SELECT o_orderkey, o_orderdate::DATE AS d,
                  CASE o_orderkey % {len(_DATE_SHAPES)} {" ".join(f"WHEN {i} THEN strftime(o_orderdate, '{f}')"
                                                               for i, (_, f) in enumerate(_DATE_SHAPES))} END AS text
           FROM orders)
SELECT o_orderkey, text, CASE WHEN o_orderkey % 16 IN (11, 12) THEN date_trunc('month', d)::DATE
                              WHEN o_orderkey % 16 < 11 THEN d END AS day
FROM t""")
def date_grammar(spark, sf):
    """Dates as ISO with a time, with dots, with weekdays, ordinals, short years and
    clocks, months without a day, and texts that are no date."""
    o = read_table(spark, sf, "orders")
    text = F.coalesce(*[F.when(F.col("o_orderkey") % len(_DATE_SHAPES) == i, F.date_format("o_orderdate", f))
                        for i, (f, _) in enumerate(_DATE_SHAPES)])
    return o.select("o_orderkey", text.alias("text"), D.parse_any_date(text).alias("day"))


# ------------------------------------------------------------ ids across loads

@register("id_ledger", """
WITH a AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS name FROM part WHERE p_size <= 25),
b AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS name FROM part WHERE p_size > 20),
c AS (SELECT DISTINCT p_brand AS name FROM part UNION SELECT name FROM a)
SELECT name, (name IN (SELECT name FROM a))::INT + (name IN (SELECT name FROM b))::INT
             + (name NOT IN (SELECT name FROM a UNION ALL SELECT name FROM b))::INT AS n_ids,
       true AS ids_are_its_own, true AS aliases_lead_to_it
FROM (SELECT name FROM a UNION SELECT name FROM b UNION SELECT name FROM c)""")
def id_ledger(spark, sf):
    """Two loads that begin before either commits, and a third after them: per name
    how many ids it got, whether no other name has one of them, and whether the
    dimension and the aliases lead to its smallest."""
    ledger = IdLedger(spark, scratch_path(spark, "ledger"), block=8)
    part = read_table(spark, sf, "part")
    words = part.select("p_size", F.explode(F.split("p_name", " ")).alias("name"))
    first = ledger.begin(words.where("p_size <= 25"), "name")
    second = ledger.begin(words.where("p_size > 20"), "name")
    second.commit()
    first.commit()
    ledger.begin(part.select(F.col("p_brand").alias("name")).union(
        words.where("p_size <= 25").select("name")), "name").commit()
    out = ledger.handed_out()
    owners = out.groupBy("id").agg(F.count_distinct("name").alias("names"))
    lead = out.join(ledger.aliases(), "id", "left").join(owners, "id").join(
        ledger.dimension().select("name", F.col("id").alias("canonical")), "name")
    return lead.groupBy("name").agg(
        F.count_distinct("id").cast("int").alias("n_ids"), (F.max("names") == 1).alias("ids_are_its_own"),
        F.bool_and(F.coalesce("name_id", "id") == F.col("canonical")).alias("aliases_lead_to_it"))


# ------------------------------------------------------------ late keys

@register("late_keys", """
WITH d AS (
  SELECT event_id AS k, value, 0 AS batch FROM events WHERE event_id % 3 <> 2
  UNION ALL SELECT event_id, value + 1, 1 FROM events WHERE event_id % 3 = 2 AND event_id % 2 = 0
  UNION ALL SELECT event_id, value + 2, 2 FROM events WHERE event_id % 97 = 0
  UNION ALL SELECT event_id, value + 3, 3 FROM events)
SELECT k, arg_min(value, batch) AS value FROM d GROUP BY k""")
def late_keys(spark, sf):
    """ST1 + K7: four drops; the later ones repeat keys of the earlier ones, which stay.
    Every batch opens only stored files whose index does not rule its keys out."""
    from ..streaming.incremental import read_target, run_incremental
    root = scratch_path(spark, "late")
    e = read_table(spark, sf, "events").select(F.col("event_id").alias("k"), "value")
    drops = (e.where("k % 3 <> 2"), e.where("k % 3 = 2 AND k % 2 = 0").select("k", (F.col("value") + 1).alias("value")),
             e.where("k % 97 = 0").select("k", (F.col("value") + 2).alias("value")),
             e.select("k", (F.col("value") + 3).alias("value")))
    for n, drop in enumerate(drops):
        drop.write.parquet(f"{root}/src/drop={n}")
        run_incremental(spark, f"{root}/src", schema=e.schema, target=f"{root}/target",
                        checkpoint=f"{root}/_checkpoint", keys=["k"], order=["value"])
    return read_target(spark, f"{root}/target").select("k", "value")


# ------------------------------------------------------------ rows that can fail

@register("names_given", """
SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN '  x ' ELSE text END AS name FROM documents
WHERE doc_id % 7 NOT IN (0, 1, 2)""")
def names_given(spark, sf):
    """documents whose name is missing, empty or blank go; any other stays."""
    d = read_table(spark, sf, "documents")
    key = F.col("doc_id") % 7
    name = F.when(key == 0, F.lit(None).cast("string")).when(key == 1, F.lit("")).when(key == 2, F.lit("   ")) \
        .when(key == 3, F.lit("  x ")).otherwise(F.col("text"))
    named = d.select("doc_id", name.alias("name"))
    return named.where(filters.name_present(F.trim("name")))


@register("notice_pages", """
SELECT page_id, url FROM pages WHERE page_id % 5 NOT IN (0, 1)""")
def notice_pages(spark, sf):
    """Pages that carry a rate-limit or ban notice, in any case of letters, go."""
    p = read_table(spark, sf, "pages")
    key = F.col("page_id") % 5
    notice = F.when(key == 0, F.lit("<p>You have been TEMPORARILY rate limited</p>")).when(
        key == 1, F.lit("<h1>Your Network has been banned</h1>")).otherwise(F.lit("<p>rate limited offers</p>"))
    return pages.drop_notice_pages(p.withColumn("html", F.concat("html", notice))).select("page_id", "url")


@register("status_times", """
SELECT o_orderkey, o_orderstatus = 'F' AS players_chart, true AS time_in_run FROM orders""")
def status_times(spark, sf):
    """K11 with its time: the log written and read back; every key's time lies between
    the start of the run and its end."""
    o = read_table(spark, sf, "orders")
    path = scratch_path(spark, "status")
    start = spark.range(1).select(F.current_timestamp().cast("timestamp_ntz")).first()[0]
    sinks.write_table(loads.status_log(o, "o_orderkey", {"players_chart": F.col("o_orderstatus") == "F"}), path)
    end = spark.range(1).select(F.current_timestamp().cast("timestamp_ntz")).first()[0]
    log = sinks.read_back(spark, path)
    return log.select("o_orderkey", "players_chart",
                      F.col("processed_time").between(F.lit(start), F.lit(end)).alias("time_in_run"))
