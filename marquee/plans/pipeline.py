"""The warehouse pipeline end to end (E1): raw files -> bronze tables -> staging
-> dimensions, bridges, fact -> quality gate. Each model is written once and
read back by the models that depend on it (K2); the checks run after the build
and fail it on any violation."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..schemas import CATALOGUE_SCHEMA, METRICS_SCHEMA
from ..sources import files, sinks
from ..sources.publish import Publication
from . import marts, staging


def load_bronze(spark: SparkSession, metrics_glob: str, catalogue_glob: str, out: str,
                month_format: str = "d/M/yyyy") -> dict:
    """S1 + S2 + K1: typed bronze tables from the metric CSVs and catalogue JSON
    batches. Lines whose values do not fit the declared types (raw text kept) and
    metric rows whose month does not parse go to ``*_rejects`` tables instead of
    loading as NULLs or failing the build."""
    tables = {}
    for name, df in (
            ("bronze_twitch", files.read_metrics_csv(spark, metrics_glob, METRICS_SCHEMA,
                                                      rejects=True)),
            ("bronze_steam", files.read_catalogue_json(spark, catalogue_glob, CATALOGUE_SCHEMA,
                                                        rejects=True))):
        # the raw read is materialised once, then split into rows and rejects
        sinks.write_table(df, f"{out}/_raw_{name}")
        raw = spark.read.parquet(f"{out}/_raw_{name}")
        good, bad = files.split_rejects(raw)
        if "Month" in good.columns:
            dated = F.col("Month").isNull() | F.try_to_date("Month", month_format).isNotNull()
            bad = bad.unionByName(good.where(~dated), allowMissingColumns=True)
            good = good.where(dated)
        sinks.write_table(good, f"{out}/{name}")
        sinks.write_table(bad, f"{out}/{name}_rejects")
        tables[name] = spark.read.parquet(f"{out}/{name}")
        tables[f"{name}_rejects"] = spark.read.parquet(f"{out}/{name}_rejects")
    return tables


# Models joined on the game key downstream (fact <-> bridges in the goal
# queries): written bucketed on it, all with the same bucket count.
GAME_KEY_BUCKETED = {
    "fct_twitch_data": "game_key",
    "bridge_game_developer": "game_key",
    "bridge_game_genre": "game_key",
    "bridge_game_category": "game_key",
}


def _staged(bronze: dict, month_format: str):
    raw_m = bronze["bronze_twitch"].withColumn("Month", F.try_to_date("Month", month_format))
    return staging.stage_catalogue(bronze["bronze_steam"]), staging.stage_metrics(raw_m)


def run(spark: SparkSession, metrics_glob: str, catalogue_glob: str, out: str,
        month_format: str = "d/M/yyyy", check: bool = True, buckets: int | None = None,
        table_prefix: str = "", partition_fact_by_month: bool = False, publish: bool = False):
    """Build every model under ``out``; returns (warehouse, check summary).
    With ``publish`` the models become a new version of ``out`` all at once, after the
    checks have passed (``sources.publish``); a build that fails leaves the version
    before in place. With ``buckets`` the fact and bridges are bucketed on ``game_key``; with
    ``partition_fact_by_month`` the fact is also partitioned by ``date_key``, so
    month-filtered reads prune whole folders."""
    parts = {"fct_twitch_data": "date_key"} if partition_fact_by_month else None
    if publish:
        if buckets:
            raise ValueError("bucketed tables live in the catalog, not in a published version")
        with Publication(spark, out) as build:
            bronze = load_bronze(spark, metrics_glob, catalogue_glob, f"{out}/v{build.version}/_bronze", month_format)
            w = marts.build_warehouse(*_staged(bronze, month_format), write=lambda name, df: build.write(
                name, df, [parts[name]] if name in (parts or {}) else None))
            return w, quality.gate(w, check)
    bronze = load_bronze(spark, metrics_glob, catalogue_glob, out, month_format)
    stg_c, stg_m = _staged(bronze, month_format)
    write = (sinks.bucketed_writer(spark, out, GAME_KEY_BUCKETED, buckets, table_prefix, parts)
             if buckets else sinks.table_writer(spark, out, parts))
    w = marts.build_warehouse(stg_c, stg_m, write=write)
    return w, quality.gate(w, check)
