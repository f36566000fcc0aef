"""Staging models M1 (catalogue) and M2 (monthly metrics): typed projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as X
from ..functions import dates as D

# The metric file header, in file order, after the collector's
# positional renames of the two gain and two percent-gain columns.
METRIC_HEADERS = (
    "steam_id", "Month", "AvgViewers", "AvgViewersGain", "AvgViewers%Gain",
    "PeakViewers", "AvgStreams", "AvgStreamsGain", "AvgStreamsùGain",
    "PeakStreams", "HoursWatched",
)

# Staged metric names, in model order, with the source column each
# comes from.
METRIC_COLUMNS = (
    ("appid", "steam_id"), ("metric_month", "Month"),
    ("avg_viewers", "AvgViewers"), ("avg_viewers_gain", "AvgViewersGain"),
    ("avg_viewers_pct_gain", "AvgViewers%Gain"), ("peak_viewers", "PeakViewers"),
    ("avg_streams", "AvgStreams"), ("avg_streams_gain", "AvgStreamsGain"),
    ("avg_streams_u_gain", "AvgStreamsùGain"), ("peak_streams", "PeakStreams"),
    ("hours_watched", "HoursWatched"),
)

CATALOGUE_COLUMNS = (
    "appid", "name", "release_date", "developers", "categories", "genre",
    "header_image", "price", "currency", "windows", "mac", "linux",
    "metacritic", "recommendations",
)


def stage_catalogue(bronze: DataFrame) -> DataFrame:
    """M1: typed catalogue; ``short_description`` is pruned (and so never read
    from a columnar source)."""
    t = dict((f.name, f.dataType) for f in bronze.schema.fields)
    return bronze.select(
        F.col("appid").cast("int").alias("appid"),
        F.col("name").cast("string").alias("name"),
        D.parse_timestamp("release_date").alias("release_date"),
        F.col("developers").cast("array<string>").alias("developers"),
        F.col("categories").cast("array<string>").alias("categories"),
        F.col("genre").cast("array<string>").alias("genre"),
        F.col("header_image").cast("string").alias("header_image"),
        # integer cents / decimal literal is DOUBLE in the reference's dialect
        (F.col("price").cast("double") / F.lit(100.0)).alias("price"),
        F.col("currency").cast("string").alias("currency"),
        F.col("windows").cast("boolean").alias("windows"),
        F.col("mac").cast("boolean").alias("mac"),
        F.col("linux").cast("boolean").alias("linux"),
        X.to_int("metacritic", t["metacritic"]).alias("metacritic"),
        X.to_int("recommendations", t["recommendations"]).alias("recommendations"),
    )


def stage_metrics(bronze: DataFrame) -> DataFrame:
    """M2: renamed, typed metrics. Column names with symbols are quoted; INT
    casts round half-to-even from DOUBLE and half-away from text/decimal."""
    t = dict((f.name, f.dataType) for f in bronze.schema.fields)
    out = []
    for target, src in METRIC_COLUMNS:
        c = F.col(f"`{src}`")
        if target == "metric_month":
            out.append(c.cast("date").alias(target))
        elif target.endswith("pct_gain") or target.endswith("u_gain"):
            out.append(X.to_decimal_1(c).alias(target))
        else:
            out.append(X.to_int(c, t[src]).alias(target))
    return bronze.select(*out)


def rename_by_position(df: DataFrame, names=METRIC_HEADERS) -> DataFrame:
    """P5: header rename by position."""
    return df.toDF(*names)
