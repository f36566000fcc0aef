"""Loads over bad input: the driver tables rendered as raw files with overflowing,
non-numeric, missing and repeated cells and keys injected by arithmetic on the
keys, and the rows, rejects and audits of the loads compared with SQL.

Constants are spelt out in the SQL, so a wrong one in the library shows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import get_or_create_keys
from ..operators.members import member_links
from ..operators.paging import append_block
from ..schemas import CATALOGUE_SCHEMA, METRICS_TEXT_SCHEMA, PLAYERS_SCHEMA, PRICE_SCHEMA, USERS_SCHEMA
from ..session import read_table, scratch_path
from ..sources import files, sinks
from . import legacy
from .driver import BRONZE_CATALOGUE_SQL, bronze_catalogue
from .driver_io import _history_files, _read_history

Q, SQL = {}, {}


def register(name, sql):
    def deco(fn):
        Q[name], SQL[name] = fn, sql
        return fn
    return deco


def _every(key, *cases, otherwise):
    """``value`` where the key is a multiple of ``n``, first match first."""
    out = None
    for n, value in cases:
        hit = F.col(key) % n == 0
        value = F.lit(value)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(otherwise)


# ------------------------------------------------------------ monthly metrics

_METRICS_SQL = """
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS id,
         CASE WHEN l_orderkey % 41 = 0 THEN '-' WHEN l_orderkey % 43 = 0 THEN 'x1'
              ELSE l_partkey::VARCHAR END AS steam_id,
         CASE WHEN l_orderkey % 47 = 0 THEN 'June 2024'
              ELSE strftime(l_shipdate, '%-d/%-m/%Y') END AS month,
         CASE WHEN l_orderkey % 53 = 0 THEN '3000000000' WHEN l_orderkey % 59 = 0 THEN 'nan'
              WHEN l_orderkey % 61 = 0 THEN '' ELSE '1,234.9' END AS avg_viewers,
         CASE WHEN l_orderkey % 67 = 0 THEN '1e400' WHEN l_orderkey % 71 = 0 THEN '-'
              ELSE '-5.7' END AS gain,
         CASE WHEN l_orderkey % 73 = 0 THEN 'inf' WHEN l_orderkey % 79 = 0 THEN ''
              ELSE '1,000.5' END AS pct
  FROM lineitem),
p AS (
  SELECT *, try_cast(steam_id AS INT) AS sid, try_strptime(month, '%d/%m/%Y')::DATE AS date,
         CASE WHEN steam_id <> '-' AND try_cast(steam_id AS INT) IS NULL THEN 'bad steam_id'
              WHEN avg_viewers IN ('3000000000', 'nan', '') THEN 'bad AvgViewers'
              WHEN gain = '1e400' THEN 'bad AvgViewersGain'
              WHEN pct = 'inf' THEN 'bad AvgViewers%Gain'
              WHEN try_strptime(month, '%d/%m/%Y') IS NULL THEN 'bad Month' END AS bad FROM t),
f AS (
  SELECT *, coalesce(bad, CASE WHEN sid IS NULL OR sid NOT IN
                            (SELECT p_partkey FROM part WHERE p_size <= 40) THEN 'unknown game' END) AS r0 FROM p),
g AS (
  SELECT *, CASE WHEN r0 IS NOT NULL THEN r0
                 WHEN row_number() OVER (PARTITION BY r0 IS NULL, sid, date ORDER BY l_orderkey, l_linenumber) > 1
                 THEN 'duplicate key' END AS reason FROM f)"""


def _metrics(spark, sf):
    li = read_table(spark, sf, "lineitem")
    root = scratch_path(spark, "dirty-metrics")
    # the order moves the four numbers of a row, the texts are made of the ordered rows
    ordered = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").orderBy("l_orderkey", "l_linenumber")
    text = ordered.select(
        _every("l_orderkey", (41, "-"), (43, "x1"), otherwise=F.col("l_partkey").cast("string")).alias("steam_id"),
        _every("l_orderkey", (47, "June 2024"), otherwise=F.date_format("l_shipdate", "d/M/yyyy")).alias("Month"),
        _every("l_orderkey", (53, "3000000000"), (59, "nan"), (61, ""), otherwise=F.lit("1,234.9")).alias("AvgViewers"),
        _every("l_orderkey", (67, "1e400"), (71, "-"), otherwise=F.lit("-5.7")).alias("AvgViewersGain"),
        _every("l_orderkey", (73, "inf"), (79, ""), otherwise=F.lit("1,000.5")).alias("AvgViewers%Gain"),
        F.lit("10").alias("PeakViewers"), F.lit("-").alias("AvgStreams"), F.lit("").alias("AvgStreamsGain"),
        F.lit("0.5").alias("AvgStreamsùGain"), F.lit("7").alias("PeakStreams"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("HoursWatched"))
    # nested folders, found recursively by extension (S6); other files are ignored
    sinks.export_csv(text, f"{root}/a/output_1/deep")
    spark.range(3).select(F.lit("not,a,metrics,file").alias("value")).write.text(f"{root}/a/notes")
    raw = files.read_metrics_csv(spark, f"{root}/a", METRICS_TEXT_SCHEMA, with_order=True,
                                 recursiveFileLookup=True, pathGlobFilter="*.csv")
    games = read_table(spark, sf, "part").where(F.col("p_size") <= 40).select(
        F.col("p_partkey").cast("int").alias("appid"))
    return legacy.metrics_load(raw, games)


@register("metrics_rejects", _METRICS_SQL + """
SELECT id, reason FROM g WHERE reason IS NOT NULL""")
def metrics_rejects(spark, sf):
    """Every refused line with its reason: too large, NaN, blank
    and infinite cells, bad months, missing and unknown games, repeated keys."""
    return _metrics(spark, sf).rejected.select(F.col("HoursWatched").cast("bigint").alias("id"), "reason")


@register("metrics_dirty_load", _METRICS_SQL + """
SELECT id, sid AS steam_id, date, 1234 AS avg_viewers,
       CASE WHEN gain = '-' THEN NULL ELSE -5 END AS gain,
       CASE WHEN pct = '' THEN NULL ELSE 1000.5::DOUBLE END AS pct
FROM g WHERE reason IS NULL""")
def metrics_dirty_load(spark, sf):
    """S6 + M13: the rows that remain of the same files, read recursively."""
    return _metrics(spark, sf).rows.select(
        F.col("HoursWatched").cast("bigint").alias("id"), "steam_id", "date",
        F.col("AvgViewers").alias("avg_viewers"), F.col("AvgViewersGain").alias("gain"),
        F.col("`AvgViewers%Gain`").alias("pct"))


# ------------------------------------------------------------ players and price

_PLAYERS_SQL = """
WITH t AS (
  SELECT o_orderkey, o_custkey, o_custkey // 100 AS block,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_custkey END AS appid,
         CASE WHEN o_orderkey % 37 = 0 THEN 'some day' ELSE strftime(o_orderdate, '%B %Y') END AS month_text,
         CASE WHEN o_orderkey % 41 = 0 THEN '3000000000' WHEN o_orderkey % 43 = 0 THEN 'nan'
              ELSE o_orderkey::VARCHAR END AS peak,
         CASE WHEN o_orderkey % 47 = 0 THEN '1,234' ELSE '+5' END AS gain,
         CASE WHEN o_orderkey % 53 = 0 THEN 'abc' WHEN o_orderkey % 59 = 0 THEN 'nan'
              WHEN o_orderkey % 61 = 0 THEN '-' ELSE '1,000.5' END AS pct
  FROM orders),
p AS (
  SELECT *, try_strptime(month_text, '%B %Y')::DATE AS month,
         CASE WHEN month_text = 'some day' THEN 'bad Month' WHEN peak IN ('3000000000', 'nan') THEN 'bad Peak'
              WHEN gain = '1,234' THEN 'bad Gain' WHEN pct IN ('abc', 'nan') THEN 'bad Percent_Gain'
              WHEN appid IS NULL OR appid NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)
              THEN 'unknown game' END AS r0 FROM t),
g AS (
  SELECT *, CASE WHEN r0 IS NOT NULL THEN r0
                 WHEN row_number() OVER (PARTITION BY r0 IS NULL, appid, month ORDER BY o_orderkey) > 1
                 THEN 'duplicate key' END AS reason FROM p)"""


def _players(spark, sf):
    root = scratch_path(spark, "dirty-players")
    text = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("appid"), "o_orderkey",
        _every("o_orderkey", (37, "some day"), otherwise=F.date_format("o_orderdate", "MMMM yyyy")).alias("Month"),
        _every("o_orderkey", (41, "3000000000"), (43, "nan"),
               otherwise=F.col("o_orderkey").cast("string")).alias("Peak"),
        _every("o_orderkey", (47, "1,234"), otherwise=F.lit("+5")).alias("Gain"),
        _every("o_orderkey", (53, "abc"), (59, "nan"), (61, "-"), otherwise=F.lit("1,000.5")).alias("Percent_Gain"))
    keyless = F.when(F.col("o_orderkey") % 31 == 0, F.lit("")).otherwise(F.col("appid").cast("string"))
    _history_files(spark, text.withColumn("key", keyless), root, "players")
    schema = T.StructType([*PLAYERS_SCHEMA.fields, T.StructField("key", T.StringType())])
    raw = _read_history(spark, root, "players", schema).withColumn(
        "appid", F.col("key").try_cast("bigint")).drop("key")
    games = read_table(spark, sf, "part").where(F.col("p_size") <= 40).select(F.col("p_partkey").alias("appid"))
    return legacy.players_load(raw, games)


@register("players_rejects", _PLAYERS_SQL + """
SELECT appid::BIGINT AS appid, month_text, reason, count(*) AS n FROM g
WHERE reason IS NOT NULL GROUP BY ALL""")
def players_rejects(spark, sf):
    """M14 + K7-K9: refused player rows by game, month and reason: overflow, NaN,
    thousands separators in a count, bad percentages, missing and repeated keys."""
    return (_players(spark, sf).rejected.groupBy("appid", "month_text", "reason")
            .agg(F.count(F.lit(1)).alias("n")))


@register("players_audit", _PLAYERS_SQL + """
SELECT block::BIGINT AS block, count(*) AS n_total, count_if(reason IS NULL)::BIGINT AS n_ok,
       count_if(reason IS NOT NULL)::BIGINT AS n_rejected FROM g GROUP BY ROLLUP (block)""")
def players_audit(spark, sf):
    """K9 + A5: rows read, inserted and refused per file, and the grand total."""
    return _players(spark, sf).audit.select(
        F.regexp_extract("file_path", r"block=(\d+)/", 1).try_cast("bigint").alias("block"),
        "n_total", "n_ok", "n_rejected")


_PRICE_SQL = """
WITH t AS (
  SELECT o_orderkey, o_custkey AS appid, strftime(o_orderdate, '%Y-%m-%d') AS day,
         CASE WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN 'free'
              WHEN o_orderkey % 41 = 0 THEN 'nan' ELSE '19,99' END AS final,
         CASE WHEN o_orderkey % 43 = 0 THEN 'abc' WHEN o_orderkey % 47 = 0 THEN '' ELSE '9,5' END AS low
  FROM orders QUALIFY o_orderkey < max(o_orderkey) OVER (PARTITION BY o_custkey // 100)),
p AS (
  SELECT *, CASE WHEN final IN ('free', 'nan') THEN 'bad Final price' WHEN low = 'abc' THEN 'bad 2-year low'
                 WHEN appid NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)
                 THEN 'unknown game' END AS r0 FROM t),
g AS (
  SELECT *, CASE WHEN r0 IS NOT NULL THEN r0
                 WHEN row_number() OVER (PARTITION BY r0 IS NULL, appid, day ORDER BY o_orderkey) > 1
                 THEN 'duplicate key' END AS reason FROM p)"""


def _price(spark, sf):
    root = scratch_path(spark, "dirty-price")
    text = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("appid"), "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("DateTime"),
        _every("o_orderkey", (31, ""), (37, "free"), (41, "nan"), otherwise=F.lit("19,99")).alias("Final price"),
        _every("o_orderkey", (43, "abc"), (47, ""), otherwise=F.lit("9,5")).alias("2-year low"))
    _history_files(spark, text, root, "price", sep=";")
    raw = _read_history(spark, root, "price", PRICE_SCHEMA, sep=";", drop_footer=True)
    games = read_table(spark, sf, "part").where(F.col("p_size") <= 40).select(F.col("p_partkey").alias("appid"))
    return legacy.price_load(raw, games)


@register("price_rejects", _PRICE_SQL + """
SELECT appid::BIGINT AS appid, strptime(day, '%Y-%m-%d')::DATE AS date, reason, count(*) AS n
FROM g WHERE reason IS NOT NULL GROUP BY ALL""")
def price_rejects(spark, sf):
    """M15 + K7-K9: refused price rows: bad prices, bad lows, unknown games, repeats."""
    return (_price(spark, sf).rejected.groupBy("appid", "date", "reason")
            .agg(F.count(F.lit(1)).alias("n")))


@register("price_dirty_load", _PRICE_SQL + """
SELECT appid::BIGINT AS appid, strptime(day, '%Y-%m-%d')::DATE AS date,
       CASE WHEN final = '' THEN NULL ELSE 19.99::DOUBLE END AS final_price,
       CASE WHEN low = '' THEN NULL ELSE 9.5::DOUBLE END AS two_year_low
FROM g WHERE reason IS NULL""")
def price_dirty_load(spark, sf):
    """A bad first row of a day does not win over a good later one."""
    return _price(spark, sf).rows


# ------------------------------------------------------------ catalogue and users

_CATALOGUE_SQL = f"""
WITH b AS ({BRONZE_CATALOGUE_SQL}),
t AS (
  SELECT CASE WHEN appid % 50 = 0 THEN NULL ELSE appid END AS appid, 0 AS late,
         CASE WHEN appid % 61 = 0 THEN NULL WHEN appid % 67 = 0 THEN '' ELSE name END AS name FROM b
  UNION ALL SELECT appid, 1, 'again' FROM b WHERE appid % 70 = 0),
p AS (SELECT *, CASE WHEN name IS NULL THEN 'no name' WHEN appid IS NULL THEN 'null key' END AS r0 FROM t),
g AS (
  SELECT *, CASE WHEN r0 IS NOT NULL THEN r0
                 WHEN row_number() OVER (PARTITION BY r0 IS NULL, appid ORDER BY late) > 1
                 THEN 'duplicate key' END AS reason FROM p)"""


def _catalogue(spark, sf):
    """Games as pretty-printed JSON arrays of a hundred records a file; the games that
    come twice come again in a folder read later."""
    root = scratch_path(spark, "dirty-catalogue")
    b = bronze_catalogue(read_table(spark, sf, "part"))
    first = b.withColumns({
        "name": F.when(F.col("appid") % 61 == 0, F.lit(None).cast("string"))
        .when(F.col("appid") % 67 == 0, F.lit("")).otherwise(F.col("name")),
        "block": F.floor(F.col("appid") / 100).cast("int"),
        "appid": F.when(F.col("appid") % 50 != 0, F.col("appid"))})
    late = b.where(F.col("appid") % 70 == 0).withColumns({
        "name": F.lit("again"), "block": F.floor(F.col("appid") / 1000).cast("int")})
    for folder, rows in (("a", first), ("b", late)):
        record = F.to_json(F.struct(*[F.col(c) for c in rows.columns if c != "block"]), {"pretty": "true"})
        # a file holds at most a hundred records: the group is bounded by its key
        (rows.groupBy("block").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(record), ",\n"),
                                            F.lit("\n]")).alias("value"))
         .repartition("block").write.partitionBy("block").text(f"{root}/{folder}"))
    bronze = files.read_catalogue_json(spark, f"{root}/*/*/*.txt", CATALOGUE_SCHEMA, with_order=True)
    return legacy.catalogue_load(bronze)


@register("catalogue_audit", _CATALOGUE_SQL + """
SELECT coalesce(reason, 'ok') AS outcome, count(*) AS n FROM g GROUP BY 1
UNION ALL SELECT 'total', count(*) FROM g
UNION ALL SELECT 'audit ok', count_if(reason IS NULL)::BIGINT FROM g
UNION ALL SELECT 'audit rejected', count_if(reason IS NOT NULL)::BIGINT FROM g""")
def catalogue_audit(spark, sf):
    """S2 + M12 + K9 + Q4: multi-line JSON; games without an id, without a name and
    seen before are refused with a reason, and the audit adds up."""
    res = _catalogue(spark, sf)
    count = F.count(F.lit(1)).alias("n")
    total = res.audit.where("file_path is null")
    parts = [res.rejected.groupBy(F.col("reason").alias("outcome")).agg(count),
             res.rows.agg(count).select(F.lit("ok").alias("outcome"), "n"),
             *[total.select(F.lit(k).alias("outcome"), F.col(c).alias("n")) for k, c in (
                 ("total", "n_total"), ("audit ok", "n_ok"), ("audit rejected", "n_rejected"))]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("catalogue_dirty_load", _CATALOGUE_SQL + """
SELECT appid, name FROM g WHERE reason IS NULL""")
def catalogue_dirty_load(spark, sf):
    """The games inserted from the same files; an empty name is a name."""
    return _catalogue(spark, sf).rows.select("appid", "name")


_USERS_SQL = """
WITH t AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS day,
         CASE WHEN event_id % 31 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text,
         CASE WHEN event_id % 37 = 0 THEN 'abc' WHEN event_id % 41 = 0 THEN '3000000000'
              WHEN event_id % 43 = 0 THEN 'NaN' ELSE '12.9' END AS users,
         CASE WHEN event_id % 47 = 0 THEN '' ELSE event_id::VARCHAR END AS in_game FROM events),
g AS (
  SELECT *, CASE WHEN ts_text = 'soon' THEN 'bad DateTime' WHEN users IN ('abc', '3000000000')
                 THEN 'bad Users' END AS reason FROM t)"""


def _users(spark, sf):
    root = scratch_path(spark, "dirty-users")
    e = read_table(spark, sf, "events").select(
        _every("event_id", (31, "soon"), otherwise=F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("DateTime"),
        _every("event_id", (37, "abc"), (41, "3000000000"), (43, "NaN"), otherwise=F.lit("12.9")).alias("Users"),
        F.lit("1").alias("Average Users"),
        _every("event_id", (47, ""), otherwise=F.col("event_id").cast("string")).alias("In-Game"))
    sinks.export_csv(e, root, sep=";")
    return legacy.users_load(files.with_file_order(files.read_semicolon_csv(spark, root, USERS_SCHEMA)))


@register("users_audit", _USERS_SQL + """
SELECT coalesce(reason, 'ok') AS outcome, count(*) AS n, sum(in_game::BIGINT)::BIGINT AS in_game,
       count(CASE WHEN reason IS NULL AND users <> 'NaN' THEN 1 END) AS with_users
FROM (SELECT * REPLACE (nullif(in_game, '') AS in_game) FROM g) GROUP BY 1
UNION ALL SELECT 'total', count(*), count_if(reason IS NULL)::BIGINT, count_if(reason IS NOT NULL)::BIGINT FROM g""")
def users_audit(spark, sf):
    """S3 + M16 + K9: rows by outcome, and the audit's total line (rows read,
    inserted, refused)."""
    res = _users(spark, sf)
    n = F.count(F.lit(1)).alias("n")
    summary = lambda df, outcome, users: df.groupBy(outcome.alias("outcome")).agg(
        n, F.sum("InGame").alias("in_game"), F.count(users).alias("with_users"))
    return (summary(res.rows, F.lit("ok"), F.col("Users"))
            .unionByName(summary(res.rejected, F.col("reason"), F.lit(None).cast("int")))
            .unionByName(res.audit.where("file_path is null").select(
                F.lit("total").alias("outcome"), F.col("n_total").alias("n"),
                F.col("n_ok").alias("in_game"), F.col("n_rejected").alias("with_users"))))


# ------------------------------------------------------------ collation

def _variants(part):
    """Type words in three spellings that one collated name unites."""
    word = lambda w: F.when(F.col("p_partkey") % 3 == 0, F.lower(w)).when(
        F.col("p_partkey") % 3 == 1, F.replace(w, F.lit("E"), F.lit("É"))).otherwise(w)
    return part.select(F.col("p_partkey").alias("appid"),
                       F.transform(F.split("p_type", " "), word).alias("genre"))


_VARIANTS_SQL = """
WITH t AS (
  SELECT p_partkey AS appid, unnest(string_split(p_type, ' ')) AS w FROM part),
v AS (
  SELECT appid, CASE WHEN appid % 3 = 0 THEN lower(w) WHEN appid % 3 = 1 THEN replace(w, 'E', 'É')
                     ELSE w END AS name FROM t),
k AS (SELECT *, lower(strip_accents(name)) AS k FROM v),
dim AS (SELECT row_number() OVER (ORDER BY name) AS id, name, k
        FROM (SELECT k, min(name) AS name FROM k GROUP BY k))"""


@register("collated_members", _VARIANTS_SQL + "\nSELECT id, name FROM dim")
def collated_members(spark, sf):
    """One id for all spellings of a name."""
    v = _variants(read_table(spark, sf, "part"))
    dim = spark.createDataFrame([], "id bigint, name string")
    return get_or_create_keys(v.select(F.explode("genre").alias("name")), dim, "name", "id", "UNICODE_CI_AI")


@register("collated_links", _VARIANTS_SQL + "\nSELECT DISTINCT appid, id FROM k JOIN dim USING (k)")
def collated_links(spark, sf):
    """K10 + W2: every spelling finds the id of its collated name."""
    v = _variants(read_table(spark, sf, "part"))
    return member_links(v, "appid", "genre", collated_members(spark, sf), "name", "id",
                        collation="UNICODE_CI_AI")


@register("collated_developers", _VARIANTS_SQL + """,
f AS (SELECT p_partkey AS appid, string_split(p_type, ' ')[1] AS w FROM part),
d AS (SELECT appid, lower(strip_accents(w)) AS k,
             CASE WHEN appid % 3 = 0 THEN lower(w) WHEN appid % 3 = 1 THEN replace(w, 'E', 'É') ELSE w END AS name
      FROM f),
ids AS (SELECT row_number() OVER (ORDER BY name) AS developer_id, k
        FROM (SELECT k, min(name) AS name FROM d GROUP BY k))
SELECT appid, developer_id FROM d JOIN ids USING (k)""")
def collated_developers(spark, sf):
    """M12 + W2: each game gets its first developer's id, whatever the spelling."""
    part = read_table(spark, sf, "part")
    bronze = bronze_catalogue(part).drop("developers").join(
        _variants(part).withColumnRenamed("genre", "developers"), "appid")
    return legacy.catalogue_load(bronze, collation="UNICODE_CI_AI").rows.select("appid", "developer_id")


# ------------------------------------------------------------ blocks, drops

@register("block_readback", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus FROM orders""")
def block_readback(spark, sf):
    """S13 + U2: an earlier block without a column is read back and a new block with
    it appended."""
    root = scratch_path(spark, "blocks")
    o = read_table(spark, sf, "orders")
    append_block(spark, root, o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_totalprice"), 1)
    return append_block(spark, root, o.where("o_orderkey % 2 = 0").select(
        "o_orderkey", "o_totalprice", "o_orderstatus"), 2).select("o_orderkey", "o_totalprice", "o_orderstatus")


@register("incremental_dirty", """
WITH d AS (
  SELECT 1 AS batch, CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id END AS k, ts, value FROM events
  WHERE event_id % 2 = 0 OR event_id % 5 = 0
  UNION ALL SELECT 1, event_id, ts + INTERVAL 1 DAY, -1 FROM events WHERE event_id % 10 = 0
  UNION ALL SELECT 2, CASE WHEN event_id % 89 = 0 THEN NULL ELSE event_id END, ts, value + 1 FROM events
  WHERE event_id % 2 = 1)
SELECT k, ts, value FROM d WHERE k IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY k ORDER BY batch, ts) = 1
UNION ALL SELECT -1, NULL, count(*) FROM d WHERE k IS NULL""")
def incremental_dirty(spark, sf):
    """ST1 + K7: two drops that repeat keys within and across files and miss some; the
    first row of a key stays, rows without a key are counted in the rejects."""
    from ..streaming.incremental import read_target, run_incremental
    root = scratch_path(spark, "dirty-stream")
    e = read_table(spark, sf, "events")
    key = lambda n: F.when(F.col("event_id") % n != 0, F.col("event_id")).alias("k")
    one = e.where("event_id % 2 = 0 OR event_id % 5 = 0").select(key(97), "ts", "value").unionByName(
        e.where("event_id % 10 = 0").select(F.col("event_id").alias("k"), (F.col("ts") + F.expr(
            "INTERVAL 1 DAY")).alias("ts"), F.lit(-1.0).alias("value")))
    two = e.where("event_id % 2 = 1").select(key(89), "ts", (F.col("value") + 1).alias("value"))
    args = dict(schema=one.schema, target=f"{root}/target", checkpoint=f"{root}/_checkpoint",
                keys=["k"], order=["ts"])
    for n, drop in enumerate((one, two)):
        drop.write.parquet(f"{root}/src/drop={n}")
        run_incremental(spark, f"{root}/src", **args)
    refused = read_target(spark, f"{root}/target_rejects").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return read_target(spark, f"{root}/target").select("k", "ts", "value").unionByName(
        refused.select(F.lit(-1).cast("bigint").alias("k"), F.lit(None).cast("timestamp_ntz").alias("ts"), "value"))
