"""Legacy-track loads M12-M16 as set-based Spark jobs: one plan per load
instead of one statement per row, with the row effects of the relational
constraints (first-wins keys, parent checks, rejects and per-file audits)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as X
from ..functions import dates as D
from ..operators import declared, loads
from ..operators.keys import collated, get_or_create_keys
from ..operators.loads import LoadResult
from ..operators.members import member_links
from ..session import checked_broadcast, evaluate_once, materialize

ORDER = ["file_path", "line_no"]


def _identified(bronze: DataFrame) -> DataFrame:
    """Rows with their file and line; rows that come without are numbered once (a
    checkpoint keeps the numbers the same for every reader)."""
    if all(c in bronze.columns for c in ORDER):
        return bronze
    return materialize(bronze.drop(*ORDER).withColumns({
        "file_path": F.lit("-"), "line_no": F.monotonically_increasing_id()}))


@dataclass
class CatalogueLoad(LoadResult):
    developers: DataFrame  # the developer dimension after the load


GAME_FIELDS = ["appid", "name", "developer_id", "release_date", "short_description", "price",
               "currency", "windows", "linux", "mac", "metacritic", "recommendations",
               "header_image"]


def catalogue_load(bronze: DataFrame, developers: DataFrame | None = None,
                   target: DataFrame | None = None, collation: str | None = None) -> CatalogueLoad:
    """Games with their *first* developer's id (get-or-create, W2), the
    load-time defaults (P12) and a day-precision release date (X4).

    A game without an id or a name is refused; so is a second game of one id. Under
    a collation the developer's id is found by the collated name, as the unique
    index finds it.

    Rows of ``read_catalogue_variant`` say which fields their record lacks: those take
    the defaults, an explicit null stays NULL, and a record with a value that does not
    fit its column is refused. Without that column a NULL counts as absent."""
    spark = bronze.sparkSession
    bronze = _identified(bronze)
    told = "absent" in bronze.columns

    def default(c, value):
        lacks = F.array_contains("absent", c) if told else F.col(c).isNull()
        return F.when(lacks, value).otherwise(F.col(c)).alias(c)

    dev_dim = developers if developers is not None else spark.createDataFrame(
        [], "developer_id bigint, name string")
    first_dev = bronze.select(F.get(F.col("developers"), 0).alias("name"))
    dev_dim = get_or_create_keys(first_dev, dev_dim, "name", "developer_id", collation)
    games = bronze.select(
        "appid", "name", F.get(F.col("developers"), 0).alias("_dev"),
        D.try_parse_day("release_date").alias("release_date"),
        default("short_description", F.lit("")),
        default("price", F.lit(0).cast("bigint")),
        "currency",
        default("windows", F.lit(False)),
        default("linux", F.lit(False)),
        default("mac", F.lit(False)),
        "metacritic",
        default("recommendations", F.lit(0).cast("bigint")),
        default("header_image", F.lit("")),
        (F.col("unfit") if told else F.lit(None).cast("string")).alias("_unfit"),
        *ORDER)
    ids = dev_dim.select(collated("name", collation).alias("_name"), "developer_id")
    games = games.join(checked_broadcast(ids), collated("_dev", collation) == F.col("_name"),
                       "left").drop("_dev", "_name")
    games = games.withColumn("reason", F.coalesce(
        F.when(F.col("_unfit").isNotNull(), F.concat(F.lit("bad "), "_unfit")),
        F.when(F.col("name").isNull(), F.lit("no name")))).drop("_unfit")
    res = loads.keyed_load(games, ["appid"], ORDER, [*GAME_FIELDS, *ORDER], target)
    return CatalogueLoad(res.rows, res.rejected, res.audit, dev_dim)


def catalogue_links(bronze: DataFrame, dim: DataFrame, array_col: str,
                    existing: DataFrame | None = None, collation: str | None = None) -> DataFrame:
    """K10 for categories / genres: (game, member id), duplicates ignored."""
    if existing is not None:
        existing = existing.select(F.col("game_appid").alias("appid"), F.col("member_id").alias("id"))
    return member_links(bronze, "appid", array_col, dim, "name", "id", existing, collation) \
        .withColumnRenamed("appid", "game_appid").withColumnRenamed("id", "member_id")


def metrics_load(raw_text: DataFrame, games: DataFrame, target: DataFrame | None = None,
                 game_key: str = "appid") -> LoadResult:
    """Monthly metrics CSV read as text (with file order). F10 parses and
    rejects, K8 rejects unknown games, K7 keeps the first row per
    (steam_id, date) and skips stored keys, K9 audits per file."""
    parsed = evaluate_once(loads.accept_metrics(raw_text)).drop("accepted")
    parsed = loads.with_parent(parsed, games, "steam_id", game_key, ORDER)
    cols = ["steam_id", "date", "AvgViewers", "AvgViewersGain", "AvgViewers%Gain",
            "PeakViewers", "AvgStreams", "AvgStreamsGain", "AvgStreamsùGain",
            "PeakStreams", "HoursWatched"]
    return loads.keyed_load(parsed, ["steam_id", "date"], ORDER, cols, target)


def _cell(c: str):
    """A history cell: blank or '-' holds no value."""
    return F.nullif(F.nullif(F.trim(F.col(c)), F.lit("-")), F.lit(""))


def _first_reason(*tests):
    """The first test that holds, as the reason to reject a row."""
    return F.coalesce(*[F.when(test, F.lit(reason)) for reason, test in tests])


def players_load(raw: DataFrame, games: DataFrame, as_of: str | None = None,
                 target: DataFrame | None = None) -> LoadResult:
    """Per-game players CSV (key from the file name): month parsed once with
    the declared format list (X5/X7), counts as integers, the percentage with its
    thousands separators removed; a cell that does not parse rejects the row; first
    (appid, month) wins."""
    month_text = D.relative_month("Month", as_of) if as_of else F.col("Month")
    p = evaluate_once(raw.select(
        "appid", *ORDER, F.col("Month").alias("month_text"),
        D.month_floor(D.parse_any_date(month_text)).alias("month"),
        _cell("Peak").alias("_peak"), _cell("Gain").alias("_gain"), _cell("Percent_Gain").alias("_pct"),
        _cell("Peak").try_cast("int").alias("peak"), _cell("Gain").try_cast("int").alias("gain"),
        X.finite(F.replace(_cell("Percent_Gain"), F.lit(","), F.lit("")).try_cast("double"))
        .alias("percent_gain")))
    lost = lambda text, value: F.col(text).isNotNull() & F.col(value).isNull()
    p = p.withColumn("reason", _first_reason(
        ("bad Month", F.col("month").isNull()), ("bad Peak", lost("_peak", "peak")),
        ("bad Gain", lost("_gain", "gain")), ("bad Percent_Gain", lost("_pct", "percent_gain"))))
    return _keyed_history(p, games, ["appid", "month"],
                          ["appid", "month", "peak", "gain", "percent_gain"], target)


def price_load(raw: DataFrame, games: DataFrame, target: DataFrame | None = None) -> LoadResult:
    """Per-game price CSV (';', decimal comma, footer already dropped by the
    reader); date parsed with the format list; a cell that does not parse rejects
    the row; first (appid, date) wins."""
    final, low = F.col("`Final price`"), F.col("`2-year low`")
    p = evaluate_once(raw.select(
        "appid", *ORDER, F.nullif(final, F.lit("")).alias("_final"), F.nullif(low, F.lit("")).alias("_low"),
        D.parse_any_date("DateTime").alias("date"),
        X.finite(X.decimal_comma(final)).alias("final_price"),
        X.finite(X.decimal_comma(low)).alias("two_year_low")))
    lost = lambda text, value: F.col(text).isNotNull() & F.col(value).isNull()
    p = p.withColumn("reason", _first_reason(
        ("bad DateTime", F.col("date").isNull()), ("bad Final price", lost("_final", "final_price")),
        ("bad 2-year low", lost("_low", "two_year_low"))))
    return _keyed_history(p, games, ["appid", "date"],
                          ["appid", "date", "final_price", "two_year_low"], target)


def _keyed_history(p: DataFrame, games: DataFrame, keys, cols, target) -> LoadResult:
    return loads.keyed_load(loads.with_parent(p, games, "appid", "appid", ORDER), keys, ORDER,
                            cols, target)


def users_load(raw: DataFrame) -> LoadResult:
    """Platform users (';' CSV): timestamp parsed, counts truncated to
    integers, blanks/NaN -> NULL; a row without a timestamp, or with a count that is
    no number an integer column holds, is refused. Rows have no natural key: equal
    times are all kept."""
    raw = _identified(raw)
    counts = {"Users": "Users", "Average Users": "AverageUsers", "In-Game": "InGame"}
    text = lambda c: F.trim(F.col(f"`{c}`").cast("string"))
    absent = lambda c: F.coalesce(F.lower(text(c)).isin("", "nan", "na", "null", "none", "n/a"), F.lit(True))
    p = evaluate_once(raw.select(
        F.try_to_timestamp("DateTime", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
        .alias("DateTime"),
        *[F.when(~absent(c), text(c).try_cast("double").try_cast("int")).cast("bigint").alias(n)
          for c, n in counts.items()],
        _first_reason(*[(f"bad {c}", ~absent(c) & text(c).try_cast("double").try_cast("int").isNull())
                        for c in counts]).alias("_bad"), *ORDER))
    p = p.withColumn("reason", F.coalesce(F.when(F.col("DateTime").isNull(), F.lit("bad DateTime")),
                                          F.col("_bad"))).drop("_bad")
    ok = F.col("reason").isNull()
    return LoadResult(p.where(ok).select("DateTime", *counts.values()), p.where(~ok),
                      loads.load_audit(p, "file_path", ok))


def member_dim(bronze: DataFrame, array_col: str, existing: DataFrame | None = None,
               collation: str | None = None) -> DataFrame:
    """Categories / genres: every member name gets an id (get-or-create, W2)."""
    spark = bronze.sparkSession
    dim = existing if existing is not None else spark.createDataFrame([], "id bigint, name string")
    names = (bronze.where(F.col(array_col).isNotNull())
                   .select(F.explode(array_col).alias("name")))
    return get_or_create_keys(names, dim.select(F.col("id"), F.col("name")), "name", "id", collation)


def run(spark, out: str, catalogue_glob: str, metrics_glob: str | None = None,
        history_root: str | None = None, users_path: str | None = None,
        players_as_of: str | None = None, collation: str | None = None, declare: bool = False) -> dict:
    """The whole legacy load as Spark jobs. Each table is written once under
    ``out`` and read back by the loads that reference it (parent checks). With
    ``declare`` the tables are written again with the legacy database's names, types
    and order (``out/declared``), and its declared constraints are enforced on them."""
    from ..schemas import CATALOGUE_SCHEMA, METRICS_TEXT_SCHEMA, PLAYERS_SCHEMA, PRICE_SCHEMA, USERS_SCHEMA
    from ..sources import files, sinks

    def keep(name, df):
        sinks.write_table(df, f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    t = {}

    def load(name, res):
        """Rows, rejects and audit of one load."""
        t[name] = keep(name, res.rows.drop(*[c for c in ORDER if c in res.rows.columns]))
        t[f"{name}_rejects"] = keep(f"{name}_rejects", res.rejected)
        t[f"{name}_audit"] = keep(f"{name}_audit", res.audit)

    # raw files are parsed once, into typed bronze tables; all else reads those
    bronze = keep("_bronze_catalogue", files.read_catalogue_variant(
        spark, catalogue_glob, CATALOGUE_SCHEMA))
    res = catalogue_load(bronze, collation=collation)
    games = keep("_games", res.rows)
    t["developers"] = keep("developers", res.developers)
    load("steamgames", LoadResult(games, res.rejected, res.audit))
    ids = t["steamgames"].select("appid")
    # members are linked only from the rows that were inserted: a later row of
    # an appid already stored is refused whole, its members included
    known = keep("_bronze_inserted", bronze.join(games.select(*ORDER), ORDER, "left_semi"))
    for table, link, col in (("categories", "games_categories", "categories"),
                             ("genres", "games_genres", "genre")):
        t[table] = keep(table, member_dim(known, col, collation=collation))
        t[link] = keep(link, catalogue_links(known, t[table], col, collation=collation))
    if metrics_glob:
        raw = keep("_bronze_metrics", files.read_metrics_csv(
            spark, metrics_glob, METRICS_TEXT_SCHEMA, with_order=True))
        load("twitchgames", metrics_load(raw, t["steamgames"].select(F.col("appid").try_cast("int"))))
    if history_root:
        players = keep("_bronze_players", files.read_keyed_csv(
            spark, f"{history_root}/instance_*/players/*_players.csv", PLAYERS_SCHEMA))
        load("players_history", players_load(players, ids, as_of=players_as_of))
        price = keep("_bronze_price", files.read_keyed_csv(
            spark, f"{history_root}/instance_*/price/*_price.csv", PRICE_SCHEMA, sep=";",
            drop_footer=True))
        load("price_history", price_load(price, ids))
    if users_path:
        users = keep("_bronze_users", files.with_file_order(
            files.read_semicolon_csv(spark, users_path, USERS_SCHEMA)))
        load("global_steam_users", users_load(users))
    if declare:
        _declare(t, out, keep)
    return t


def _declare(t: dict, out: str, keep) -> None:
    """The declared tables, their rejects and the report of their constraints."""
    tables = {}
    for name, spec in declared.LEGACY_TABLES.items():
        if name in t:
            res = declared.declared_write(t[name], spec, f"{out}/declared/{name}")
            tables[name], t[f"declared_{name}_rejects"] = res.rows, res.rejected
            t[f"declared_{name}"] = res.rows
    t["constraint_report"] = keep("constraint_report", declared.constraint_report(tables))
    bad = t["constraint_report"].where("n_failing > 0").collect()  # one row a constraint
    if bad:
        raise declared.ConstraintError(f"constraints violated: {[tuple(r) for r in bad]}")
