"""Single operators run over the driver tables, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as X
from ..functions import dates as D
from ..operators import filters, loads, paging, quality
from ..operators.keys import get_or_create_keys, surrogate_key
from ..operators.members import member_links
from ..session import read_table
from .driver import BRONZE_CATALOGUE_SQL, STG_CATALOGUE_SQL, bronze_catalogue, stg_catalogue

Q, SQL = {}, {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ scans, counts

@register("table_counts", """
SELECT count(*) AS n_rows, count_if(o_orderstatus = 'F')::BIGINT AS n_filtered FROM orders""")
def table_counts(spark, sf):
    """A1 + A2: total and filtered counts in one pass."""
    o = read_table(spark, sf, "orders")
    return o.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("o_orderstatus") == "F").alias("n_filtered"))


@register("table_scan", """
SELECT p_partkey AS appid, p_name AS name FROM part WHERE p_retailprice > 950""")
def table_scan(spark, sf):
    """Projection + optional predicate; both reach the Parquet scan."""
    from ..sources.tables import scan_table
    return scan_table(read_table(spark, sf, "part"), {"p_partkey": "appid", "p_name": "name"},
                      where=F.col("p_retailprice") > 950)


# ------------------------------------------------------------ filters

@register("threshold_filter", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000""")
def threshold_filter(spark, sf):
    """F3."""
    o = read_table(spark, sf, "orders")
    return o.where(F.col("o_totalprice") > 100000).select("o_orderkey", "o_custkey")


def _unreleased_sql(t, flag):
    terms = " OR ".join(f"contains(lower({t}), '{w}')" for w in filters.UNRELEASED_TERMS)
    return f"({t} IS NULL OR {t} = '' OR {terms} OR coalesce({flag}, true) <> false)"


@register("term_filter", f"""
SELECT doc_id FROM documents
WHERE NOT {_unreleased_sql('text', "(CASE WHEN lang = 'en' THEN false "
                                    "WHEN lang = 'fr' THEN NULL ELSE n_chars < 500 END)")}""")
def term_filter(spark, sf):
    """F4 over whole document texts; the release flag is derived from ``lang``
    (absent for 'fr', so those rows count as unreleased)."""
    d = read_table(spark, sf, "documents")
    flag = (F.when(F.col("lang") == "en", F.lit(False))
             .when(F.col("lang") == "fr", F.lit(None).cast("boolean"))
             .otherwise(F.col("n_chars") < 500))
    return d.where(~filters.unreleased(F.col("text"), flag)).select("doc_id")


@register("value_filter", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def value_filter(spark, sf):
    """F6."""
    o = read_table(spark, sf, "orders")
    return o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@register("name_present", """
SELECT doc_id, lang FROM documents WHERE trim(text) IS NOT NULL AND trim(text) <> ''""")
def name_present(spark, sf):
    """F7 on trimmed texts."""
    d = read_table(spark, sf, "documents")
    return d.where(filters.name_present(F.trim("text"))).select("doc_id", "lang")


# ------------------------------------------------------------ cleaners

def _clean_sql(expr):
    return (f"regexp_replace(regexp_replace(lower(coalesce({expr}, '')), '{X.NON_WORD}', '', 'g'), "
            f"'{X.SPACE_RUN}', '-', 'g')")


@register("clean_name", f"""
SELECT doc_id, {_clean_sql('text')} AS clean FROM documents""")
def clean_name_q(spark, sf):
    """X2 over whole texts."""
    d = read_table(spark, sf, "documents", spread=True)
    return d.select("doc_id", X.clean_name("text").alias("clean"))


@register("name_match", f"""
WITH c AS (SELECT {_clean_sql('p_name')} AS nk, min(p_partkey) AS matched_id
           FROM part WHERE p_name IS NOT NULL AND p_name <> '' GROUP BY 1)
SELECT p.p_partkey AS appid, p.p_name AS name, c.matched_id
FROM part p JOIN c ON {_clean_sql('p.p_name')} = c.nk
WHERE p.p_name IS NOT NULL AND p.p_name <> ''""")
def name_match(spark, sf):
    """Each part matched to the first (lowest key) part of the same cleaned name."""
    p = read_table(spark, sf, "part")
    left = p.select(F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"))
    return filters.match_by_name(left, "name", p, "p_name", "p_partkey", "p_partkey")


_THOUSANDS_SQL = ("CASE WHEN l_discount = 0 THEN '-' ELSE '+' || (trunc(l_extendedprice)::BIGINT // 1000)::VARCHAR "
                  "|| ',' || lpad((trunc(l_extendedprice)::BIGINT % 1000)::VARCHAR, 3, '0') || '%' END")


def _thousands(li):
    v = F.col("l_extendedprice").cast("bigint")
    return F.when(F.col("l_discount") == 0, F.lit("-")).otherwise(
        F.concat(F.lit("+"), F.floor(v / 1000).cast("bigint").cast("string"), F.lit(","),
                 F.lpad((v % 1000).cast("string"), 3, "0"), F.lit("%")))


@register("numeric_clean", f"""
SELECT l_orderkey, l_linenumber, raw,
       CASE WHEN raw = '-' THEN NULL ELSE TRY_CAST(replace(replace(replace(raw, '+', ''), '%', ''), ',', '') AS DOUBLE) END AS value
FROM (SELECT l_orderkey, l_linenumber, {_THOUSANDS_SQL} AS raw FROM lineitem) t""")
def numeric_clean(spark, sf):
    """X11: '+12,345%' -> 12345.0; '-' -> NULL."""
    li = read_table(spark, sf, "lineitem")
    t = li.select("l_orderkey", "l_linenumber", _thousands(li).alias("raw"))
    return t.withColumn("value", X.clean_number("raw"))


@register("suffix_number", """
SELECT l_orderkey, l_linenumber, raw,
       trunc(TRY_CAST(left(raw, length(raw) - 1) AS DOUBLE) *
             CASE WHEN raw LIKE '%M' THEN 1000000.0 WHEN raw LIKE '%K' THEN 1000.0 END)::BIGINT AS value
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_quantity > 25
                  THEN (l_extendedprice / 1000)::DECIMAL(10,1)::VARCHAR || 'K'
                  ELSE (l_extendedprice * 100 / 1000000)::DECIMAL(10,1)::VARCHAR || 'M' END AS raw
      FROM lineitem) t""")
def suffix_number(spark, sf):
    """X12: '8.2M' -> 8199999 (IEEE product, truncated), '3.4K' -> 3400."""
    li = read_table(spark, sf, "lineitem")
    p = F.col("l_extendedprice")
    raw = F.when(F.col("l_quantity") > 25,
                 F.concat((p / 1000).cast("decimal(10,1)").cast("string"), F.lit("K"))).otherwise(
        F.concat((p * 100 / 1000000).cast("decimal(10,1)").cast("string"), F.lit("M")))
    t = li.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return t.withColumn("value", X.suffix_number("raw"))


@register("decimal_comma", """
SELECT l_orderkey, l_linenumber, raw,
       TRY_CAST(replace(nullif(raw, ''), ',', '.') AS DOUBLE) AS value
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_discount = 0 THEN '' ELSE replace(l_extendedprice::DECIMAL(12,2)::VARCHAR, '.', ',') END AS raw
      FROM lineitem) t""")
def decimal_comma(spark, sf):
    """X14: '19,99' -> 19.99, blank -> NULL."""
    li = read_table(spark, sf, "lineitem")
    raw = F.when(F.col("l_discount") == 0, F.lit("")).otherwise(
        F.replace(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")))
    t = li.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return t.withColumn("value", X.decimal_comma("raw"))


@register("trunc_int", """
SELECT l_orderkey, l_linenumber, raw, trunc(replace(raw, ',', '')::DOUBLE)::INT AS value
FROM (SELECT l_orderkey, l_linenumber,
             ((25 - l_quantity) * 1.5 + l_discount)::DECIMAL(12,3)::VARCHAR AS raw FROM lineitem) t""")
def trunc_int(spark, sf):
    """``int(float(x))`` truncates toward zero, also for negatives."""
    li = read_table(spark, sf, "lineitem")
    raw = ((F.lit(25) - F.col("l_quantity")) * 1.5 + F.col("l_discount")).cast("decimal(12,3)").cast("string")
    t = li.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return t.withColumn("value", X.int_trunc("raw"))


@register("blank_to_null", """
SELECT l_orderkey, l_linenumber, nullif(trim(flag), '') AS flag,
       CASE WHEN isnan(v) THEN NULL ELSE v END AS v
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_discount = 0 THEN '  ' ELSE l_returnflag END AS flag,
             CASE WHEN l_tax = 0 THEN 'nan'::DOUBLE ELSE l_tax END AS v FROM lineitem) t""")
def blank_to_null(spark, sf):
    """Blank text -> NULL, NaN -> NULL."""
    li = read_table(spark, sf, "lineitem")
    t = li.select("l_orderkey", "l_linenumber",
                  F.when(F.col("l_discount") == 0, F.lit("  ")).otherwise(F.col("l_returnflag")).alias("flag"),
                  F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("v"))
    return t.select("l_orderkey", "l_linenumber", X.blank_to_null("flag").alias("flag"),
                    X.nan_to_null("v").alias("v"))


@register("percent_of_total", """
SELECT l_returnflag, count(*) AS n,
       round(count(*)::DOUBLE / (SELECT count(*) FROM lineitem)::DOUBLE * 100.0, 2) AS pct
FROM lineitem GROUP BY l_returnflag""")
def percent_of_total(spark, sf):
    """Share of the whole table per flag; the total is one scalar."""
    li = read_table(spark, sf, "lineitem")
    total = li.count()
    g = li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", X.percent(F.col("n"), F.lit(total)))


# ------------------------------------------------------------ dates

_FR = ", ".join(f"'{fr}'" for fr, _ in D.FRENCH_MONTHS[:12])


def _fr_to_en_sql(expr):
    out = f"lower(trim({expr}))"
    for fr, en in D.FRENCH_MONTHS:
        out = f"replace({out}, '{fr}', '{en.lower()}')"
    return out


@register("date_parse", f"""
WITH t AS (
  SELECT o_orderkey, o_orderdate,
         strftime(o_orderdate, '%-d/%-m/%Y') AS day_text,
         CASE o_orderkey % 4
           WHEN 0 THEN strftime(o_orderdate, '%-d/%-m/%Y')
           WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 2 THEN strftime(o_orderdate, '%B %-d, %Y')
           ELSE strftime(o_orderdate, '%-d ') || list_extract([{_FR}], month(o_orderdate)::INT)
                || strftime(o_orderdate, ' %Y') END AS any_text
  FROM orders)
SELECT o_orderkey, day_text, any_text,
       strptime(day_text, '%d/%m/%Y') AS ts,
       strptime(day_text, '%d/%m/%Y')::DATE AS day,
       coalesce(try_strptime({_fr_to_en_sql('any_text')}, '%d/%m/%Y'),
                try_strptime({_fr_to_en_sql('any_text')}, '%Y-%m-%d'),
                try_strptime({_fr_to_en_sql('any_text')}, '%B %d, %Y'),
                try_strptime({_fr_to_en_sql('any_text')}, '%d %B %Y'))::DATE AS any_day
FROM t""")
def date_parse(spark, sf):
    """X3 (timestamp), X4 (date) and X5 (format list, French month names)."""
    o = read_table(spark, sf, "orders")
    d = F.col("o_orderdate")
    fr = F.element_at(F.array(*[F.lit(fr) for fr, _ in D.FRENCH_MONTHS[:12]]), F.month(d))
    any_text = (F.when(F.col("o_orderkey") % 4 == 0, F.date_format(d, "d/M/yyyy"))
                 .when(F.col("o_orderkey") % 4 == 1, F.date_format(d, "yyyy-MM-dd"))
                 .when(F.col("o_orderkey") % 4 == 2, F.date_format(d, "MMMM d, yyyy"))
                 .otherwise(F.concat(F.date_format(d, "d "), fr, F.date_format(d, " yyyy"))))
    t = o.select("o_orderkey", F.date_format(d, "d/M/yyyy").alias("day_text"),
                 any_text.alias("any_text"))
    return t.select("o_orderkey", "day_text", "any_text",
                    D.parse_timestamp("day_text").alias("ts"),
                    D.parse_day("day_text").alias("day"),
                    D.parse_any_date("any_text").alias("any_day"))


@register("month_floor", """
SELECT event_id, date_trunc('month', ts)::DATE AS month FROM events""")
def month_floor(spark, sf):
    """X6."""
    e = read_table(spark, sf, "events")
    return e.select("event_id", D.month_floor("ts").alias("month"))


@register("timestamp_parse", """
SELECT event_id, strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ts FROM events""")
def timestamp_parse(spark, sf):
    """Text -> TIMESTAMP_NTZ."""
    e = read_table(spark, sf, "events")
    t = e.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"))
    return t.select("event_id", D.parse_timestamp("t", "yyyy-MM-dd HH:mm:ss").alias("ts"))


# ------------------------------------------------------------ text pieces

@register("path_parts", """
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
       string_split(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/')[-1] AS last_piece,
       starts_with(url, 'https') AS secure, contains(url, '?') AS has_query,
       ends_with(url, '#top') AS to_top
FROM pages""")
def path_parts(spark, sf):
    """X20 + X21: split / last piece, starts/ends with, contains."""
    p = read_table(spark, sf, "pages")
    path = F.regexp_extract("url", r"^[a-z]+://[^/?#]+([^?#]*)", 1)
    return p.select("page_id", F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("host"),
                    X.name_part(path, "/", -1).alias("last_piece"),
                    F.col("url").startswith("https").alias("secure"),
                    F.col("url").contains("?").alias("has_query"),
                    F.col("url").endswith("#top").alias("to_top"))


@register("page_id_from_url", r"""
SELECT page_id, CAST(nullif(regexp_extract(url, '/[a-z]{2}/(\d+)', 1), '') AS BIGINT) AS linked_id FROM pages""")
def page_id_from_url(spark, sf):
    """Numeric id captured from a link."""
    p = read_table(spark, sf, "pages")
    return p.select("page_id", X.link_id("url", r"/[a-z]{2}/(\d+)").alias("linked_id"))


# ------------------------------------------------------------ keyed loads

_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@register("insert_ignore", f"""
WITH firsts AS (
  SELECT * FROM lineitem WHERE l_returnflag <> 'R'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY {', '.join(_LI_ORDER)}) = 1)
SELECT * FROM firsts f
WHERE NOT EXISTS (SELECT 1 FROM lineitem s WHERE s.l_returnflag = 'R'
                  AND s.l_orderkey = f.l_orderkey AND s.l_linenumber = f.l_linenumber)""")
def insert_ignore(spark, sf):
    """K7 + J6: stored rows are the 'R' lines; the rest is appended first-wins
    on (l_orderkey, l_linenumber), skipping keys already stored."""
    li = read_table(spark, sf, "lineitem")
    stored = li.where(F.col("l_returnflag") == "R")
    new = li.where(F.col("l_returnflag") != "R")
    return loads.insert_ignore(new, stored, ["l_orderkey", "l_linenumber"], _LI_ORDER)


@register("fk_accept", """
SELECT * FROM lineitem l WHERE EXISTS (SELECT 1 FROM part p WHERE p.p_size <= 40 AND p.p_partkey = l.l_partkey)""")
def fk_accept(spark, sf):
    """K8 + J5: lines whose part exists among parts of size <= 40."""
    li, p = read_table(spark, sf, "lineitem"), read_table(spark, sf, "part")
    return loads.fk_split(li, p.where(F.col("p_size") <= 40), "l_partkey", "p_partkey")[0]


@register("fk_reject", """
SELECT * FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_size <= 40 AND p.p_partkey = l.l_partkey)""")
def fk_reject(spark, sf):
    li, p = read_table(spark, sf, "lineitem"), read_table(spark, sf, "part")
    return loads.fk_split(li, p.where(F.col("p_size") <= 40), "l_partkey", "p_partkey")[1]


@register("get_or_create_key", f"""
WITH seed AS (
  SELECT row_number() OVER (ORDER BY developer_name) AS developer_key, developer_name
  FROM (SELECT DISTINCT unnest(developers) AS developer_name FROM ({STG_CATALOGUE_SQL}) s
        WHERE developers IS NOT NULL AND windows) u WHERE developer_name IS NOT NULL),
fresh AS (
  SELECT DISTINCT unnest(developers) AS developer_name FROM ({STG_CATALOGUE_SQL}) s
  WHERE developers IS NOT NULL)
SELECT developer_key, developer_name FROM seed
UNION ALL
SELECT (SELECT coalesce(max(developer_key), 0) FROM seed)
       + row_number() OVER (ORDER BY developer_name) AS developer_key, developer_name
FROM fresh WHERE developer_name IS NOT NULL
  AND developer_name NOT IN (SELECT developer_name FROM seed)""")
def get_or_create_key(spark, sf):
    """The seed dimension holds the developers of Windows games;
    all developers are then looked up, and new names get keys after the max."""
    stg = stg_catalogue(spark, sf)
    seed_names = (stg.where(F.col("windows")).where(F.col("developers").isNotNull())
                  .select(F.explode("developers").alias("developer_name"))
                  .where(F.col("developer_name").isNotNull()).distinct())
    seed = surrogate_key(seed_names, "developer_name", "developer_key")
    names = stg.where(F.col("developers").isNotNull()).select(
        F.explode("developers").alias("developer_name"))
    return get_or_create_keys(names, seed, "developer_name", "developer_key")


@register("load_audit", """
SELECT source, count(*) AS n_total,
       count_if(length(trim(text)) > 0 AND n_chars >= 200)::BIGINT AS n_ok,
       count_if(NOT (length(trim(text)) > 0 AND n_chars >= 200))::BIGINT AS n_rejected
FROM documents GROUP BY ROLLUP (source)""")
def load_audit(spark, sf):
    """K9 + A5: accepted / rejected per source, with the grand total row."""
    d = read_table(spark, sf, "documents")
    ok = (F.length(F.trim("text")) > 0) & (F.col("n_chars") >= 200)
    return loads.load_audit(d, "source", ok)


@register("member_links", f"""
WITH dim AS (
  SELECT row_number() OVER (ORDER BY developer_name) AS developer_key, developer_name
  FROM (SELECT DISTINCT unnest(developers) AS developer_name FROM ({STG_CATALOGUE_SQL}) s
        WHERE developers IS NOT NULL) u),
links AS (
  SELECT DISTINCT s.appid, d.developer_key, s.windows
  FROM (SELECT appid, windows, unnest(developers) AS developer_name FROM ({STG_CATALOGUE_SQL}) x
        WHERE developers IS NOT NULL) s
  JOIN dim d ON s.developer_name = d.developer_name),
stored AS (SELECT appid, developer_key FROM links WHERE windows)
SELECT appid, developer_key FROM links l
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.appid = l.appid AND s.developer_key = l.developer_key)""")
def member_links_q(spark, sf):
    """Deduplicated (game, developer) links; the links of Windows games are
    already stored and skipped."""
    from . import marts
    stg = stg_catalogue(spark, sf)
    dim = marts.dim_member(stg, "developers", "developer_name", "developer_key")
    stored = member_links(stg.where(F.col("windows")), "appid", "developers", dim,
                          "developer_name", "developer_key")
    return member_links(stg, "appid", "developers", dim, "developer_name", "developer_key",
                        existing=stored)


@register("status_log", """
SELECT o_orderkey, o_orderstatus = 'F' AS players_chart, o_totalprice > 100000 AS price_chart,
       false AS reviews_chart
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def status_log_q(spark, sf):
    """Per processed key, its success flags (time column left out so the
    result can be compared)."""
    o = read_table(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return loads.status_log(o, "o_orderkey", {
        "players_chart": F.col("o_orderstatus") == "F",
        "price_chart": F.col("o_totalprice") > 100000,
        "reviews_chart": F.lit(False)}, with_time=False)


@register("pending_keys", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))""")
def pending_keys(spark, sf):
    """L4: resume -- keys not in the status log."""
    o = read_table(spark, sf, "orders")
    log = status_log_q(spark, sf)
    return paging.pending(o.select("o_orderkey", "o_custkey"), log, "o_orderkey")


# ------------------------------------------------------------ paging, sharding

@register("page_offset", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000
ORDER BY o_orderkey LIMIT 1000 OFFSET 500""")
def page_offset(spark, sf):
    """L2: a page of the threshold-filtered keys (the page size is the feature)."""
    o = read_table(spark, sf, "orders").where(F.col("o_totalprice") > 100000)
    return paging.page(o.select("o_orderkey", "o_custkey"), "o_orderkey", 1000, 500)


@register("keyset_page", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 1000""")
def keyset_page(spark, sf):
    """L3: the page after cursor 5000."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return paging.keyset_page(o, "o_orderkey", 5000, 1000)


@register("shard_rows", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn,
                  count(*) OVER () AS total FROM orders)
SELECT o_orderkey, least(floor((rn - 1) / greatest(total // 6, 1)), 5)::INT AS shard FROM r""")
def shard_rows(spark, sf):
    """Six contiguous shards, remainder to the last."""
    o = read_table(spark, sf, "orders").select("o_orderkey")
    return paging.shard(o, "o_orderkey", 6)


_STARTS = [0, 2500, 5000, 7500, 10000, 12500]


@register("range_shard", f"""
SELECT o_orderkey, (CASE {' '.join(f'WHEN o_orderkey >= {s} THEN {i}' for i, s in reversed(list(enumerate(_STARTS))))}
                    END)::INT AS shard FROM orders""")
def range_shard(spark, sf):
    """Shards by fixed start ids."""
    o = read_table(spark, sf, "orders").select("o_orderkey")
    return paging.range_shard(o, "o_orderkey", _STARTS)


@register("last_block", """
SELECT o_custkey, arg_max(name, n) AS last_block, max(n) AS last_processed
FROM (SELECT o_custkey, 'block_games_1_' || o_orderkey::VARCHAR || '.csv' AS name, o_orderkey AS n
      FROM orders) t GROUP BY o_custkey""")
def last_block(spark, sf):
    """Per customer, the block file with the highest number (numeric order)."""
    o = read_table(spark, sf, "orders")
    names = o.select("o_custkey", F.concat(F.lit("block_games_1_"), F.col("o_orderkey").cast("string"),
                                           F.lit(".csv")).alias("name"))
    return paging.last_block(names, "name", ["o_custkey"])


@register("union_blocks", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders""")
def union_blocks(spark, sf):
    """Old and new blocks (orders before / from 1998) unioned by name."""
    o = read_table(spark, sf, "orders")
    old = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    new = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderdate", "o_totalprice", "o_custkey", "o_orderkey")
    return paging.union_blocks(old, new)


@register("footer_drop", """
SELECT c.* FROM conversations c
JOIN (SELECT conv_id, max(turn) AS last_turn FROM conversations GROUP BY conv_id) m USING (conv_id)
WHERE c.turn < m.last_turn""")
def footer_drop(spark, sf):
    """drop the last row (highest turn) of every conversation."""
    from ..sources.files import drop_last_per_group
    c = read_table(spark, sf, "conversations")
    return drop_last_per_group(c, "conv_id", "turn")


# ------------------------------------------------------------ quality

@register("qa_not_null", f"""
SELECT * FROM ({BRONZE_CATALOGUE_SQL}) b WHERE currency IS NULL""")
def qa_not_null(spark, sf):
    """Q1: catalogue rows without a currency."""
    return quality.check_not_null(bronze_catalogue(read_table(spark, sf, "part")), "currency")


@register("qa_unique", """
SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders
WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1""")
def qa_unique(spark, sf):
    """Q2: customers appearing on more than one order."""
    return quality.check_unique(read_table(spark, sf, "orders"), "o_custkey")


@register("qa_relationships", """
SELECT l_partkey AS from_field FROM lineitem l
WHERE l_partkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_size <= 40 AND p.p_partkey = l.l_partkey)""")
def qa_relationships(spark, sf):
    """Q3: line parts without a parent among parts of size <= 40."""
    li, p = read_table(spark, sf, "lineitem"), read_table(spark, sf, "part")
    return quality.check_relationship(li, "l_partkey", p.where(F.col("p_size") <= 40), "p_partkey")
