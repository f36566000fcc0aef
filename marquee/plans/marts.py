"""Star schema M3-M11: entity, date and member dimensions, bridges, fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators.keys import surrogate_key
from ..operators.members import bridge, distinct_members
from ..session import checked_broadcast, materialize

GAME_COLUMNS = (
    "game_key", "appid", "name", "release_date", "price", "currency", "windows",
    "mac", "linux", "metacritic", "recommendations", "header_image",
)

FACT_MEASURES = (
    "avg_viewers", "avg_viewers_gain", "avg_viewers_pct_gain", "peak_viewers",
    "avg_streams", "avg_streams_gain", "avg_streams_u_gain", "peak_streams",
    "hours_watched",
)

# A month dimension holds one row per calendar month: 12 a year, so a thousand
# years of history stay far below this bound.
MAX_DATE_ROWS = 12_000


def dim_entity(stg_catalogue: DataFrame, key: str = "appid", name: str = "game_key",
               columns=GAME_COLUMNS) -> DataFrame:
    """M3: surrogate key in natural-key order over the whole staged catalogue."""
    keyed = surrogate_key(stg_catalogue.select(*[c for c in columns if c != name]), key, name)
    return keyed.select(*columns)


def dim_date(stg_metrics: DataFrame, month_col: str = "metric_month") -> DataFrame:
    """M4: distinct non-NULL months with their calendar attributes.

    Checkpointed where it is built: the table is calendar-sized, and consumers
    (a size check, then a broadcast) would otherwise each re-scan the metrics."""
    months = (stg_metrics.where(F.col(month_col).isNotNull())
              .select(F.col(month_col).alias("full_date")).distinct())
    return materialize(months.select(
        D.date_key("full_date").alias("date_key"),
        F.col("full_date"),
        D.year("full_date").alias("year"),
        D.month("full_date").alias("month"),
        D.month_name("full_date").alias("month_name"),
        D.quarter("full_date").alias("quarter"),
    ))


def dim_member(stg_catalogue: DataFrame, array_col: str, name: str, key: str) -> DataFrame:
    """M5-M7."""
    return distinct_members(stg_catalogue, array_col, name, key)


def fact(stg_metrics: DataFrame, entity_dim: DataFrame, date_dim: DataFrame,
         key: str = "appid", entity_key: str = "game_key",
         month_col: str = "metric_month", measures=FACT_MEASURES) -> DataFrame:
    """Metrics joined to the entity key (J1) and the computed month key
    (J2). Both dimensions are broadcast only behind a row-count check: the
    month dimension is calendar-bounded; the entity keys grow with the
    catalogue and beyond the bound are joined by sort-merge (AQE splits a hot
    key's partitions)."""
    dates = checked_broadcast(date_dim.select("date_key"), MAX_DATE_ROWS)
    entities = checked_broadcast(entity_dim.select(key, entity_key))
    m = stg_metrics.select(key, D.date_key(month_col).alias("date_key"), *measures)
    return (m.join(entities, key)
             .join(dates, "date_key")
             .select(entity_key, "date_key", *measures))


@dataclass
class Warehouse:
    stg_catalogue: DataFrame
    stg_metrics: DataFrame
    dim_games: DataFrame
    dim_date: DataFrame
    dim_developer: DataFrame
    dim_genre: DataFrame
    dim_category: DataFrame
    bridge_game_developer: DataFrame
    bridge_game_genre: DataFrame
    bridge_game_category: DataFrame
    fct: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def build_warehouse(stg_catalogue: DataFrame, stg_metrics: DataFrame,
                    write=None) -> Warehouse:
    """Build every model in dependency order. ``write(name, df) -> DataFrame``
    materialises a model and returns it read back, so shared inputs are not
    recomputed (K2); without it the models stay lazy."""
    w = write or (lambda name, df: df)
    stg_c = w("stg_steam", stg_catalogue)
    stg_m = w("stg_twitch", stg_metrics)
    games = w("dim_games", dim_entity(stg_c))
    dates = w("dim_date", dim_date(stg_m))
    dev = w("dim_developer", dim_member(stg_c, "developers", "developer_name", "developer_key"))
    gen = w("dim_genre", dim_member(stg_c, "genre", "genre_name", "genre_key"))
    cat = w("dim_category", dim_member(stg_c, "categories", "category_name", "category_key"))
    b_dev = w("bridge_game_developer", bridge(stg_c, "appid", "developers", games, "game_key",
                                               dev, "developer_name", "developer_key"))
    b_gen = w("bridge_game_genre", bridge(stg_c, "appid", "genre", games, "game_key",
                                           gen, "genre_name", "genre_key"))
    b_cat = w("bridge_game_category", bridge(stg_c, "appid", "categories", games, "game_key",
                                              cat, "category_name", "category_key"))
    fct = w("fct_twitch_data", fact(stg_m, games, dates))
    return Warehouse(stg_c, stg_m, games, dates, dev, gen, cat, b_dev, b_gen, b_cat, fct)
