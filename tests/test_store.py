"""Explicit nulls, declared tables, published versions, numbered batches: edge cases."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import declared
from marquee.plans import legacy, pipeline
from marquee.schemas import CATALOGUE_SCHEMA
from marquee.sources import files, payload, publish, sinks


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


# ------------------------------------------------------------ absent and null fields

RELEASED = {"coming_soon": False, "date": "6 Mar, 2024"}


def _payloads(spark, *datas):
    rows = [(i, json.dumps({str(i): {"success": True, "data": d}})) for i, d in enumerate(datas)]
    return spark.createDataFrame(rows, "id long, payload string")


def test_absent_fields_take_defaults_and_nulls_stay(spark):
    df = _payloads(spark, {"release_date": RELEASED},
                   {"release_date": RELEASED, "name": None, "short_description": None, "developers": None,
                    "header_image": None, "recommendations": {"total": None},
                    "price_overview": {"initial": None, "currency": None}})
    absent, null = sorted(payload.parse_payload(df, "payload", "id").collect(), key=lambda r: r.appid)
    assert (absent.name, absent.short_description, absent.developers, absent.categories, absent.genre,
            absent.header_image, absent.price, absent.recommendations) == ("", "", [], [], [], "", 0, 0)
    assert (null.name, null.short_description, null.developers, null.header_image, null.price, null.currency,
            null.recommendations) == (None,) * 7
    assert null.categories == []


def test_payloads_passed_by_say_why(spark):
    df = _payloads(spark, None, {"release_date": None}, {"release_date": RELEASED, "platforms": "all"},
                   {"release_date": RELEASED, "genres": [{"id": "1"}]}, {"release_date": RELEASED, "categories": {}},
                   {"release_date": {"date": "6 Mar, 2024"}}, {}, {"release_date": "6 Mar, 2024"},
                   {"release_date": RELEASED, "categories": None, "platforms": None})
    got = {r.appid: r.reason for r in payload.payload_rejects(df, "payload", "id").collect()}
    assert got == {0: "bad data", 1: "unreleased", 2: "bad platforms", 3: "bad genres", 4: "bad categories",
                   5: "unreleased", 6: "unreleased", 7: "bad release_date"}
    odd = spark.createDataFrame([(1, None), (2, "no json"), (3, "{}"), (4, '{"4": null}'), (None, "{}")],
                                "id long, payload string")
    assert {r.reason for r in payload.payload_rejects(odd, "payload", "id").collect()} == {"no data"}
    assert payload.payload_rejects(odd, "payload", "id").count() == 5


def test_catalogue_records_say_what_they_lack(spark, tmp):
    _write(f"{tmp}/a/1.json", json.dumps([{"appid": 1, "name": "a"}, {"appid": 2, "name": "b", "price": None,
                                                                      "windows": None, "developers": ["d", None]},
                                          {"appid": "x3", "name": "c"}, 7, {"appid": 4}], indent=2))
    _write(f"{tmp}/a/2.json", "[]")
    _write(f"{tmp}/a/3.json", "[{")
    _write(f"{tmp}/a/4.json", '{"appid": 5, "name": "alone"}')
    bronze = files.read_catalogue_variant(spark, f"{tmp}/a/*.json")
    rows = {(r.file_path[-6:], r.line_no): r for r in bronze.collect()}
    assert set(rows) == {("1.json", i) for i in range(5)} | {("3.json", 0), ("4.json", 0)}
    assert "price" in rows["1.json", 0].absent and "price" not in rows["1.json", 1].absent
    assert [rows["1.json", i].unfit for i in range(5)] == [None, None, "appid", "record", None]
    assert rows["3.json", 0].unfit == "record" and rows["4.json", 0].name == "alone"
    res = legacy.catalogue_load(bronze)
    games = {r.appid: r for r in res.rows.collect()}
    assert (games[1].price, games[1].windows) == (0, False) and (games[2].price, games[2].windows) == (None, None)
    assert sorted(r.reason for r in res.rejected.collect()) == ["bad appid", "bad record", "bad record", "no name"]
    assert set(games) == {1, 2, 5}


# ------------------------------------------------------------ declared tables

SPEC = declared.TableSpec("t", (
    declared.Field("id", "int"), declared.Field("name", "varchar(3)", True), declared.Field("score", "float"),
    declared.Field("day", "date", source="on")), ("id",), (("name",),), ((("score",), "p", ("s",)),))


def test_declared_write_enforces_type_order_and_nulls(spark, tmp):
    rows = [("1", "abc", 1.5, "2024-01-02", "kept"), ("x", "abc", 1.0, None, "id"), ("2", None, 1.0, None, "name"),
            (None, "a", 1.0, None, "id"), ("3", "abcd", 1.0, None, "long"), ("4", "a", float("nan"), None, "nan"),
            ("5", "é😀x", None, "2024-02-30", "day"), ("6", "é😀x", None, None, "kept")]
    df = spark.createDataFrame(rows, "id string, name string, score double, on string, note string")
    res = declared.declared_write(df.select("note", "on", "score", "name", "id"), SPEC, f"{tmp}/t")
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in SPEC.schema] == [
        ("id", "int", False), ("name", "string", False), ("score", "float", True), ("day", "date", True)]
    assert sorted((r.id, r.name) for r in res.rows.collect()) == [(1, "abc"), (6, "é😀x")]
    assert spark.read.parquet(f"{tmp}/t").schema.simpleString() == SPEC.schema.simpleString()
    assert sorted((r.note, r.reject_reason) for r in res.rejected.collect()) == [
        ("day", "bad day"), ("id", "bad id"), ("id", "null id"), ("long", "long name"), ("name", "null name"),
        ("nan", "bad score")]
    assert tuple(res.audit.first()) == (8, 2, 6)


def test_a_column_that_is_missing_is_null(spark, tmp):
    df = spark.createDataFrame([(1,)], "id int")
    assert declared.declared_write(df, SPEC, f"{tmp}/t").rejected.first().reject_reason == "null name"
    empty = declared.declared_write(df.limit(0), SPEC, f"{tmp}/e")
    assert empty.rows.count() == 0 and empty.rows.columns == SPEC.schema.names


def test_files_of_another_schema_are_refused(spark, tmp):
    spark.range(3).write.parquet(f"{tmp}/other")
    with pytest.raises(declared.SchemaError):
        declared.read_declared(spark, SPEC, f"{tmp}/other")


def test_declared_load_and_report_agree(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0, "2024-01-02", "f", 0), (1, "b", 1.0, None, "f", 1), (2, "c", 9.0, None, "f", 2),
         (3, "d", None, None, "g", 0), (None, "e", 1.0, None, "g", 1), (4, "f", 2.0, "never", "g", 2)],
        "id int, name string, score double, on string, file_path string, line_no long")
    parents = {"p": spark.createDataFrame([(1.0,), (2.0,), (None,)], "s double")}
    res = declared.declared_load(df, SPEC, parents, ["file_path", "line_no"])
    assert sorted(r.id for r in res.rows.collect()) == [1, 3]
    assert sorted(r.reason for r in res.rejected.collect()) == ["bad day", "duplicate key", "null id", "unknown p"]
    audit = {r.file_path: (r.n_total, r.n_ok, r.n_rejected) for r in res.audit.collect()}
    assert audit == {"f": (3, 1, 2), "g": (3, 1, 2), None: (6, 2, 4)}
    specs = {"t": SPEC, "p": declared.TableSpec("p", (declared.Field("s", "float"),))}
    assert {r[3] for r in declared.enforce({"t": res.rows, **parents}, specs)} == {0}
    raw = declared.fit(df, SPEC).drop("reason")
    report = {(r.kind, r.columns): r.n_failing for r in declared.constraint_report({"t": raw, **parents}, specs).collect()}
    assert report == {("not_null", "id"): 1, ("not_null", "name"): 0, ("foreign_key", "score"): 1,
                      ("primary_key", "id"): 1, ("unique", "name"): 0}
    with pytest.raises(declared.ConstraintError, match="primary_key"):
        declared.enforce({"t": raw, **parents}, specs)


def _legacy_files(tmp, **game):
    base = {"appid": 10, "name": "Alpha", "release_date": "06/03/2024", "developers": ["Ève"], "price": None,
            "categories": ["Solo", "solo"], "genre": ["Action"], "currency": "EUR"}
    _write(f"{tmp}/steam/1/a.json", json.dumps([base, {**base, "appid": 20, "name": "Beta", "developers": ["eve"]},
                                                {**base, "appid": 30, **game}]))
    head = "steam_id,Month,AvgViewers,AvgViewersGain,AvgViewers%Gain,PeakViewers,AvgStreams,AvgStreamsGain," \
           "AvgStreamsùGain,PeakStreams,HoursWatched\n"
    _write(f"{tmp}/twitch/a.csv", head + "10,01/02/2024,5,-,0.5,9,1,,0.1,2,77\n20,1/3/2024,5,1,,9,1,,0.1,2,78\n")


def test_legacy_run_declares_its_tables(spark, tmp):
    _legacy_files(tmp)
    t = legacy.run(spark, f"{tmp}/out", f"{tmp}/steam/*/*.json", f"{tmp}/twitch/*.csv", collation="UNICODE_CI_AI",
                   declare=True)
    assert t["constraint_report"].where("n_failing > 0").count() == 0
    games = declared.read_declared(spark, declared.LEGACY_TABLES["steamgames"], f"{tmp}/out/declared/steamgames")
    assert {(r.appid, r.price, r.developer_id) for r in games.collect()} == {(10, None, 1), (20, None, 1), (30, None, 1)}
    metrics = spark.read.parquet(f"{tmp}/out/declared/twitchgames")
    assert metrics.columns == [f.name for f in declared.LEGACY_TABLES["twitchgames"].fields]
    assert dict(metrics.dtypes)["avg_viewers"] == "int" and dict(metrics.dtypes)["avg_viewers_gain_percent"] == "float"


def test_legacy_run_reports_a_violated_constraint(spark, tmp):
    """A name no column holds is refused by the declared table; its links have no parent then."""
    _legacy_files(tmp, name="n" * 300)
    with pytest.raises(declared.ConstraintError, match="game_appid"):
        legacy.run(spark, f"{tmp}/out", f"{tmp}/steam/*/*.json", collation="UNICODE_CI_AI", declare=True)


# ------------------------------------------------------------ published versions

def test_readers_see_whole_versions(spark, tmp):
    root = f"{tmp}/pub"
    with pytest.raises(LookupError):
        publish.published(spark, root, "a")
    with publish.Publication(spark, root) as build:
        build.write("a", spark.range(3))
        build.write("b", spark.range(3).withColumn("p", F.col("id") % 2), partition_by=["p"])
        with pytest.raises(LookupError):
            publish.manifest(spark, root)  # nothing is visible yet
    seen = publish.published(spark, root, "a")
    with publish.Publication(spark, root) as build:
        build.write("a", spark.range(5))
        assert publish.published(spark, root, "a").count() == 3
    assert publish.versions(spark, root) == [1, 2] and seen.count() == 3
    assert publish.published(spark, root, "a").count() == 5
    assert publish.published(spark, root, "b").where("p = 1").count() == 1  # taken over
    assert publish.published(spark, root, "a", 1).count() == 3
    entry = publish.manifest(spark, root)["tables"]
    assert (entry["a"]["path"], entry["a"]["rows"], entry["b"]["path"]) == ("v2/a", 5, "v1/b")


def test_a_failed_build_leaves_the_old_version(spark, tmp):
    root = f"{tmp}/pub"
    with publish.Publication(spark, root) as build:
        build.write("a", spark.range(3))
    with pytest.raises(ZeroDivisionError):
        with publish.Publication(spark, root) as build:
            build.write("a", spark.range(9))
            1 / 0
    with pytest.raises(AssertionError):
        with publish.Publication(spark, root) as build:
            build.write("a", spark.range(0))
            build.check(lambda tables: (_ for _ in ()).throw(AssertionError()) if not tables["a"].count() else None)
    assert publish.versions(spark, root) == [1] and publish.published(spark, root, "a").count() == 3
    with publish.Publication(spark, root) as build:  # failed builds keep their numbers
        build.write("a", spark.range(4))
    assert publish.versions(spark, root) == [1, 4]


def test_two_builds_at_once_do_not_meet(spark, tmp):
    root = f"{tmp}/pub"
    one, two = publish.Publication(spark, root), publish.Publication(spark, root)
    assert (one.version, two.version) == (1, 2)
    two.write("a", spark.range(2))
    two.commit()
    one.write("b", spark.range(1))
    one.commit()
    assert publish.manifest(spark, root)["version"] == 2


def test_expire_keeps_what_a_manifest_names(spark, tmp):
    root = f"{tmp}/pub"
    for n in (1, 2, 3):
        with publish.Publication(spark, root) as build:
            build.write("a", spark.range(n))
            if n == 1:
                build.write("b", spark.range(7))
    assert publish.expire(spark, root, keep=1) == [1, 2] and publish.versions(spark, root) == [3]
    assert publish.published(spark, root, "a").count() == 3 and publish.published(spark, root, "b").count() == 7
    assert not os.path.exists(f"{root}/v1/a") and not os.path.exists(f"{root}/v2/a")


def test_the_pipeline_publishes_after_its_checks(spark, tmp):
    _legacy_files(tmp)
    args = (spark, f"{tmp}/twitch/*.csv", f"{tmp}/steam/*/*.json", f"{tmp}/wh")
    pipeline.run(*args, publish=True, partition_fact_by_month=True)
    fact = publish.published(spark, f"{tmp}/wh", "fct_twitch_data")
    # the row whose gain is no number went to the rejects
    assert [r.date_key for r in fact.collect()] == [202403] and fact.where("date_key = 202402").count() == 0
    _write(f"{tmp}/steam/2/b.json", json.dumps([{"appid": 10, "name": "again", "developers": []}]))
    with pytest.raises(AssertionError):  # a repeated appid fails the gate
        pipeline.run(*args, publish=True)
    assert publish.versions(spark, f"{tmp}/wh") == [1]


# ------------------------------------------------------------ numbered batches

def test_batches_are_numbered_over_the_whole_table(spark, tmp):
    names = {3: None, 5: 'quote " and \\ é', 6: "line\nbreak"}
    df = spark.range(1, 24).repartition(5).select(
        F.col("id").alias("appid"), F.coalesce(*[F.when(F.col("id") == k, F.lit(v)) for k, v in names.items()],
                                               F.when(F.col("id") != 3, F.concat(F.lit("g"), "id"))).alias("name"))
    sinks.export_batches(df, f"{tmp}/out", "appid", per_file=5)
    found = {}
    for number in range(1, 6):
        [name] = [f for f in os.listdir(f"{tmp}/out/batch={number}") if f.startswith("part-")]
        with open(f"{tmp}/out/batch={number}/{name}", encoding="utf-8") as f:
            found[number] = json.load(f)
    assert [[g["appid"] for g in found[b]] for b in found] == [
        list(range(i, min(i + 5, 24))) for i in range(1, 24, 5)]
    by_id = {g["appid"]: g["name"] for games in found.values() for g in games}
    assert all(by_id[k] == v for k, v in names.items()) and by_id[9] == "g9"
    back = files.read_catalogue_variant(spark, f"{tmp}/out/batch=*", T.StructType(CATALOGUE_SCHEMA.fields[:2]))
    assert {(r.appid, r.name) for r in back.collect()} == set(by_id.items())


def test_no_rows_give_no_batch(spark, tmp):
    sinks.export_batches(spark.range(0), f"{tmp}/none", "id", per_file=5)
    assert not [f for f in os.listdir(f"{tmp}/none") if f.startswith("batch=")]
