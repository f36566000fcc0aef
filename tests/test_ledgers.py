"""Ids across loads, key index of the incremental load, block manifests, hot files, dates."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.functions import dates as D
from marquee.operators import paging
from marquee.operators.ledger import IdLedger
from marquee.sources import files
from marquee.streaming import key_index
from marquee.streaming.incremental import read_target, run_incremental


# ------------------------------------------------------------ free-form dates

DATES = {
    "2024-03-06T10:11:12Z": (2024, 3, 6), "2024-03-06T10:11:12.123456+02:00": (2024, 3, 6), "06.03.2024": (2024, 3, 6),
    "Mar 6, 2024": (2024, 3, 6), "6 Mar, 2024": (2024, 3, 6), "March 2024": (2024, 3, 1), "6 mars 2024": (2024, 3, 6),
    "1er janvier 2024": (2024, 1, 1), "mercredi 14 févr. 2024 à 10:30": (2024, 2, 14), "mercredi 14 févr. 2024 10:30": (2024, 2, 14),
    "Wednesday, the 6th of March 2024": (2024, 3, 6), "14-déc-24": (2024, 12, 14), "20240306": (2024, 3, 6),
    "2024/3/6": (2024, 3, 6), "3/2024": (2024, 3, 1), "2024-03": (2024, 3, 1), "6/3/24": (2024, 3, 6),
    "31/12/69": (1969, 12, 31), "31/12/68": (2068, 12, 31), "2024-02-29": (2024, 2, 29),
    "03/04/2024": (2024, 4, 3),   # ambiguous: day first
    "03/14/2024": (2024, 3, 14),  # only possible month first
    "Dec 25 2023 at 5:30 PM": (2023, 12, 25), "  SEPT 9 2021  ": (2021, 9, 9), "30 août 2020": (2020, 8, 30),
    # no date
    "2024": None, "Q1 2024": None, "Coming soon": None, "TBA": None, "": None, None: None, "30/02/2024": None,
    "2023-02-29": None, "Mar 32, 2024": None, "Mar Apr 2024": None, "1 2 3 4": None, "99999999999": None,
    "10:30": None, "13/13/2024": None, "0/1/2024": None, "March 6": None,
}


def test_free_form_dates(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(DATES)], "i long, t string")
    got = {r.t: r.d for r in df.select("t", D.parse_free_date("t").alias("d")).collect()}
    want = {t: d and dt.date(*d) for t, d in DATES.items()}
    assert got == want
    listed = {r.t: r.d for r in df.select("t", D.parse_any_date("t").alias("d")).collect()}
    assert listed == want


def test_every_day_in_every_order(spark):
    days = spark.range(0, 40000, 13).select(F.date_add(F.lit("1969-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    for f in ("d/M/yyyy", "yyyy-M-d", "d MMMM yyyy", "MMM dd, yyyy", "EEE d MMM yyyy HH:mm:ss", "yyyyMMdd", "d.M.yy"):
        if f == "d.M.yy":
            days = days.where("d < '2069-01-01'")
        assert days.where(~D.parse_free_date(F.date_format("d", f)).eqNullSafe(F.col("d"))).count() == 0, f


# ------------------------------------------------------------ ids across loads

def test_two_loads_of_one_day(spark, tmp):
    ledger = IdLedger(spark, f"{tmp}/ids", block=4, collation="UNICODE_CI_AI")
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    one = ledger.begin(names("Zeta", "zéta", "a", "b", "c", "d", None), "name")
    two = ledger.begin(names("A", "e"), "name")
    assert {r.name for r in one.ids().collect()} == {"Zeta", "a", "b", "c", "d"}
    assert not {r.id for r in one.ids().collect()} & {r.id for r in two.ids().collect()}
    assert ledger.dimension().count() == 0  # nothing before a commit
    two.commit()
    one.commit()
    dim = {r.name: r.id for r in ledger.dimension().collect()}
    assert len(dim) == len(set(dim.values())) == 6
    [alias] = ledger.aliases().collect()  # a name both loads met keeps its smaller id
    assert {alias.id, alias.name_id} == {[r.id for r in load.ids().collect() if r.name in "aA"][0] for load in (one, two)}
    three = ledger.begin(names("É", "e", "ZETA", "new"), "name")
    three.commit()
    ids = {r.name.lower(): r.id for r in three.ids().collect()}
    assert ids["zeta"] == dim["Zeta"] and len(ids) == 3 and ids["new"] > max(dim.values())
    assert ledger.begin(names(), "name").commit() == 3


def test_a_load_that_never_commits_leaves_a_gap(spark, tmp):
    ledger = IdLedger(spark, f"{tmp}/ids", block=10)
    ledger.begin(spark.createDataFrame([("x",)], "name string"), "name")
    ledger.begin(spark.createDataFrame([("x",)], "name string"), "name").commit()
    assert [tuple(r) for r in ledger.dimension().collect()] == [(11, "x")]


# ------------------------------------------------------------ key index

def test_filters_hold_their_keys():
    rng = np.random.default_rng(3)
    held, other = rng.integers(-2 ** 62, 2 ** 62, 5000), rng.integers(-2 ** 62, 2 ** 62, 5000)
    bloom = key_index._filter(held)
    assert all(key_index._any_in(bloom, held[i:i + 1]) for i in range(0, 5000, 50))
    assert sum(key_index._any_in(bloom, other[i:i + 1]) for i in range(5000)) < 50
    assert not key_index._any_in(key_index._filter(held[:0]), other[:3])


def _drop(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_a_batch_opens_only_files_that_may_hold_its_keys(spark, tmp, monkeypatch):
    schema = spark.createDataFrame([], "k bigint, s string, v long").schema
    src, target = f"{tmp}/src", f"{tmp}/target"
    opened = []
    monkeypatch.setattr(key_index, "ROWS_A_FILE", 300)
    plain = key_index.files_to_open
    monkeypatch.setattr(key_index, "files_to_open", lambda *a: opened.append(plain(*a)) or opened[-1])
    args = dict(schema=schema, target=target, checkpoint=f"{tmp}/ckpt", keys=["k", "s"], order=["v"])
    for n in range(4):  # key ranges side by side, then late keys of the second
        _drop(spark, src, [(n * 1000 + i, f"s{i}", n) for i in range(1000)], schema)
        run_incremental(spark, src, **args)
    assert [len(o) for o in opened] == [0] * 4  # the ranges do not meet
    n_files = len([f for f in os.listdir(f"{target}/_batch=1") if f.endswith(".parquet")])
    assert n_files > 1
    _drop(spark, src, [(1500, "s500", 9), (1501, "other", 9), (9000, "s", 9)], schema)
    run_incremental(spark, src, **args)
    late = opened[-1]
    assert 1 <= len(late) < n_files and all("_batch=1" in f for f in late)
    # what the batch reads are those files and no other
    names = lambda paths: sorted(os.path.basename(p) for p in paths)
    assert names(spark.read.schema(schema).parquet(*late).inputFiles()) == names(late)
    rows = {(r.k, r.s): r.v for r in read_target(spark, target).collect()}
    assert rows[1500, "s500"] == 1 and rows[1501, "other"] == 9 and rows[9000, "s"] == 9 and len(rows) == 4002


def test_batches_without_an_index_are_opened_whole(spark, tmp):
    schema = spark.createDataFrame([], "k string, v long").schema
    src, target = f"{tmp}/src", f"{tmp}/target"
    spark.createDataFrame([("a", 1), ("é", 1)], schema).write.parquet(f"{target}/_batch=0")
    rows = spark.createDataFrame([("é", 2), ("z", 2)], schema)
    assert key_index.files_to_open(spark, target, rows, ["k"], 5) == [f"{target}/_batch=0"]
    key_index.build(spark, target, schema, ["k"], 0)
    assert key_index.files_to_open(spark, target, rows.where("k = 'z'"), ["k"], 5) == []
    found = key_index.files_to_open(spark, target, rows, ["k"], 5)
    assert len(found) == 1 and key_index.files_to_open(spark, target, rows, ["k"], 0) == []
    assert key_index.files_to_open(spark, target, rows.limit(0), ["k"], 5) == []


def test_more_keys_than_a_broadcast_holds(spark, tmp, monkeypatch):
    schema = spark.createDataFrame([], "k long").schema
    spark.range(10).toDF("k").coalesce(1).write.parquet(f"{tmp}/t/_batch=0")
    key_index.build(spark, f"{tmp}/t", schema, ["k"], 0)
    monkeypatch.setattr(key_index, "MAX_BROADCAST_KEYS", 3)
    assert len(key_index.files_to_open(spark, f"{tmp}/t", spark.range(5, 20).toDF("k"), ["k"], 1)) == 1
    assert key_index.files_to_open(spark, f"{tmp}/t", spark.range(50, 60).toDF("k"), ["k"], 1) == []


# ------------------------------------------------------------ blocks

def test_reading_blocks_opens_one_manifest(spark, tmp, monkeypatch):
    root = f"{tmp}/blocks"
    with pytest.raises(LookupError):
        paging.read_blocks(spark, root)
    paging.append_block(spark, root, spark.createDataFrame([(1, "a")], "k long, s string"), 30)
    paging.append_block(spark, root, spark.createDataFrame([(2.5, 2)], "x double, k long"), 60)
    out = paging.append_block(spark, root, spark.createDataFrame([("c",)], "s string"), 90)
    assert out.columns == ["k", "s", "x"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "a", None), (2, None, 2.5), (None, "c", None)]
    listed = paging.block_manifest(spark, root)
    assert [(b["number"], b["rows"]) for b in listed["blocks"]] == [(30, 1), (60, 1), (90, 1)]
    read = []
    text = spark.read.text
    monkeypatch.setattr(type(spark.read), "text", lambda self, path, **k: read.append(path) or text(path, **k))
    assert paging.read_blocks(spark, root).count() == 3 and read == [f"{root}/_blocks/90.json"]
    with pytest.raises(ValueError, match="after the last"):
        paging.append_block(spark, root, spark.range(1), 90)
    with pytest.raises(ValueError, match="column k"):
        paging.append_block(spark, root, spark.createDataFrame([("x",)], "k string"), 91)


# ------------------------------------------------------------ hot files

@pytest.mark.parametrize("small", [True, False])
def test_the_last_line_of_a_hot_file(spark, monkeypatch, small):
    """A third of all lines in one file: its lines are never gathered in one task."""
    if not small:
        monkeypatch.setattr(files, "checked_broadcast", lambda df, **k: None)
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("f"), F.col("id") % 100)).alias("f"),
        F.col("id").alias("line"), F.lit(1).alias("_salt_"))
    out = files.drop_last_per_group(rows, "f", "line")
    assert out.count() == 30_000 - 101 and out.columns == ["f", "line", "_salt_"]
    last = {r.f: r.m for r in rows.groupBy("f").agg(F.max("line").alias("m")).collect()}
    assert out.where(F.col("f") == "hot").agg(F.max("line")).first()[0] == 29_994 < last["hot"] == 29_997
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in files.drop_last_per_group(rows, "f", "line").groupBy(
            F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 2 * 30_000 / len(sizes) and len(sizes) > 1
