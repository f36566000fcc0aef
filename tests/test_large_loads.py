"""Steps that grow with the large tables: what a load reads and refuses, what a gate moves."""

import re

import pytest
from pyspark.sql import functions as F

from marquee.operators import declared, loads, quality
from marquee.plans import driver, legacy
from marquee.schemas import METRICS_TEXT_SCHEMA
from marquee.sources import files, sinks
from tests.conftest import SF_SMALL


@pytest.fixture()
def metrics(spark, tmp):
    """The load of five lines in two files."""
    row = {f.name: "7" for f in METRICS_TEXT_SCHEMA.fields}
    for i, months in enumerate((("1/1/2024", "1/1/2024", "June"), ("1/1/2024", "1/2/2024"))):
        df = spark.createDataFrame([{**row, "Month": m, "HoursWatched": f"{i}{j}"} for j, m in enumerate(months)],
                                   METRICS_TEXT_SCHEMA)
        sinks.export_csv(df.coalesce(1), f"{tmp}/f{i}")
    raw = files.read_metrics_csv(spark, tmp, METRICS_TEXT_SCHEMA, with_order=True, recursiveFileLookup=True,
                                 pathGlobFilter="*.csv")
    return legacy.metrics_load(raw, spark.createDataFrame([(7,)], "appid int"))


@pytest.fixture()
def fixed_plan(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_parsing_a_metrics_line_is_code_the_jvm_compiles(metrics, fixed_plan, capsys):
    """HotSpot leaves methods of more than 8,000 bytes of code to its interpreter."""
    metrics.rejected.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_refused_lines_are_found_in_one_reading(metrics, fixed_plan, capsys):
    assert sorted(tuple(r) for r in metrics.rejected.select("HoursWatched", "reason").collect()) == [
        ("01", "duplicate key"), ("02", "bad Month"), ("10", "duplicate key")]
    metrics.rejected.explain("simple")
    assert len(re.findall(r"FileScan csv|Scan csv", capsys.readouterr().out)) == 1


@pytest.mark.parametrize("with_target", (False, True))
def test_inserted_and_refused_rows_are_all_rows(spark, with_target):
    """A key with most of the rows, null keys, rows with a reason, keys stored twice."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
        .cast("int").alias("k"), (F.col("id") % 2).cast("string").alias("m"),
        F.concat(F.lit("f"), (F.lit(1999) - F.col("id")).cast("string").substr(1, 1)).alias("file_path"),
        (F.lit(1999) - F.col("id")).alias("line_no"),
        F.when(F.col("id") % 7 == 0, "bad").alias("reason")).repartition(5)
    stored = spark.createDataFrame([(0, "1"), (0, "1"), (5, "1"), (None, "0"), (1 << 40, "0")], "k long, m string")
    got = loads.keyed_load(df, ["k", "m"], ["file_path", "line_no"], ["k", "m", "file_path", "line_no"],
                           stored if with_target else None)
    seen, rows, refused = {(0, "1"), (5, "1")} if with_target else set(), set(), set()
    for r in sorted(df.collect(), key=lambda r: (r.file_path, r.line_no)):
        reason = r.reason or ("null key" if r.k is None else "duplicate key" if (r.k, r.m) in seen else None)
        if reason:
            refused.add((r.line_no, reason))
        else:
            seen.add((r.k, r.m))
            rows.add(r.line_no)
    assert {r.line_no for r in got.rows.collect()} == rows
    assert got.rejected.columns == df.columns and got.rejected.schema["k"].dataType == df.schema["k"].dataType
    found = [(r.line_no, r.reason) for r in got.rejected.collect()]
    assert len(found) == len(set(found)) == 2000 - len(rows) and set(found) == refused


def test_rows_of_one_place_are_inserted_or_refused_as_before(spark):
    """Rows that share their file and line are not told apart; one without a place is refused."""
    df = spark.createDataFrame([(1, "f", 1), (1, "f", 1), (1, "f", 2), (2, None, 1), (2, "f", 9)],
                               "k int, file_path string, line_no long").withColumn("reason", F.lit(None).cast("string"))
    got = loads.keyed_load(df, ["k"], ["file_path", "line_no"], ["k", "file_path", "line_no"])
    assert sorted(r.line_no for r in got.rows.collect()) == [1, 1]
    assert sorted((r.k, r.line_no) for r in got.rejected.collect()) == [(1, 2), (2, 1), (2, 9)]


def test_a_large_parent_meets_counts_only(spark, monkeypatch, capsys):
    child = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 77).when(F.col("id") % 100 == 1, None)
                                     .otherwise(F.col("id") % 60).alias("game_key"))
    t = {"fct": child, "dim_games": spark.range(50).union(spark.range(9)).withColumnRenamed("id", "game_key")}
    some = [c for c in quality.DECLARED_CHECKS if c[1] == "fct" and c[3] == "game_key"]
    small = sorted(tuple(r) for r in quality.failure_counts(t, some).collect())
    assert [r[3] for r in small] == [child.where("game_key is null").count(),
                                     child.where("game_key >= 50").count()]
    monkeypatch.setattr(quality, "checked_broadcast", lambda df, otherwise: None)
    counted = quality.failure_counts(t, some)
    assert sorted(tuple(r) for r in counted.collect()) == small
    counted.explain("extended")
    assert "_salt" not in capsys.readouterr().out


def test_the_gate_reads_models_from_columns(spark, capsys):
    """Every model is a Parquet table, none a checkpoint of rows."""
    driver.q_qa_warehouse(spark, SF_SMALL).explain()
    plan = capsys.readouterr().out
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan


def test_foreign_keys_of_a_large_parent_are_counted_by_key(spark, monkeypatch, capsys):
    specs = {n: declared.LEGACY_TABLES[n] for n in ("steamgames", "games_genres", "genres")}
    t = {"steamgames": spark.createDataFrame([(i, "a", None) for i in range(20)], "appid int, name string, developer_id int"),
         "genres": spark.createDataFrame([(1, "x")], "id int, description string"),
         "games_genres": spark.range(300).select(F.when(F.col("id") % 9 == 0, None).otherwise(F.col("id") % 30)
                                                 .cast("int").alias("game_appid"), F.lit(1).alias("genre_id"))}
    t["developers"] = spark.createDataFrame([], "id int, name string")
    specs["developers"] = declared.LEGACY_TABLES["developers"]
    small = sorted(tuple(r) for r in declared.constraint_report(t, specs).collect())
    lost = t["games_genres"].where("game_appid >= 20").count()
    assert lost and ("games_genres", "foreign_key", "game_appid", lost) in small
    monkeypatch.setattr(declared, "checked_broadcast", lambda df, otherwise: None)
    report = declared.constraint_report(t, specs)
    assert sorted(tuple(r) for r in report.collect()) == small
    report.explain("extended")
    assert "_salt" not in capsys.readouterr().out
