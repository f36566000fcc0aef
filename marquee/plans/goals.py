"""Goal queries G1-G2 (the stated aim of relating price and genre to
viewership; the reference stops at the star schema, so these are extensions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast


def member_month(fact: DataFrame, bridge: DataFrame, member_dim: DataFrame, member_key: str,
                 member_name: str, date_dim: DataFrame) -> DataFrame:
    """G1: viewership per member (genre) and month. ``sum``/``max`` combine
    map-side, so a genre holding a third of all facts is pre-aggregated in every
    task before the shuffle."""
    return (fact.join(bridge, "game_key")
                .join(checked_broadcast(member_dim.select(member_key, member_name)), member_key)
                .join(checked_broadcast(date_dim.select("date_key", "year", "month"), 12_000),
                      "date_key")
                .groupBy(member_name, "date_key", "year", "month")
                .agg(F.sum("hours_watched").cast("bigint").alias("total_hours"),
                     F.max("peak_viewers").alias("peak_viewers"),
                     F.count(F.lit(1)).alias("n_rows")))


def price_viewer_corr(fact: DataFrame, games: DataFrame, bridge: DataFrame,
                      member_dim: DataFrame, member_key: str, member_name: str,
                      digits: int = 6) -> DataFrame:
    """Pearson correlation between price and a game's mean average viewers,
    over priced games (price > 0): one overall row (member NULL) plus one per
    member. Per-game means are a grouped aggregate; ``corr`` is algebraic."""
    per_game = fact.groupBy("game_key").agg(F.avg("avg_viewers").alias("mean_viewers"))
    # both branches below read ``priced``; the planner reuses its exchanges
    # (ReusedExchange), so the fact is aggregated once without a checkpoint
    priced = per_game.join(games.where(F.col("price") > 0).select("game_key", "price"), "game_key")
    overall = priced.agg(F.lit(None).cast("string").alias(member_name),
                         F.count(F.lit(1)).alias("n_games"),
                         F.round(F.corr("price", "mean_viewers"), digits).alias("corr"))
    by_member = (priced.join(bridge, "game_key")
                       .join(checked_broadcast(member_dim.select(member_key, member_name)),
                             member_key)
                       .groupBy(member_name)
                       .agg(F.count(F.lit(1)).alias("n_games"),
                            F.round(F.corr("price", "mean_viewers"), digits).alias("corr")))
    return overall.unionByName(by_member)
