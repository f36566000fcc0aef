"""Paging, resume and sharding helpers."""

import datetime as dt

from pyspark.sql import functions as F

from marquee.operators import loads, paging


def test_keyset_pages_cover_the_table_once(spark):
    df = spark.range(0, 95).withColumnRenamed("id", "k")
    seen, cursor = [], None
    while True:
        page = paging.keyset_page(df, "k", cursor, 20)
        rows = [r.k for r in page.collect()]
        if not rows:
            break
        seen += rows
        cursor = paging.next_cursor(page, "k")
    assert seen == list(range(95))


def test_offset_page_is_ordered(spark):
    df = spark.range(0, 50).select((F.col("id") * 7 % 50).alias("k"))
    assert [r.k for r in paging.page(df, "k", 5, 10).collect()] == list(range(10, 15))


def test_status_log_and_pending(spark):
    games = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "appid bigint, name string")
    done = loads.status_log(games.where("appid < 3"), "appid",
                            {"players_chart": F.col("appid") == 1, "price_chart": F.lit(True)})
    row = done.where("appid = 1").first()
    assert row.players_chart and row.price_chart
    assert isinstance(row.processed_time, dt.datetime)
    assert [r.appid for r in paging.pending(games, done, "appid").collect()] == [3]


def test_range_shard_and_last_block(spark):
    df = spark.range(0, 10).withColumnRenamed("id", "k")
    shards = {r.k: r.shard for r in paging.range_shard(df, "k", [0, 3, 7]).collect()}
    assert [shards[k] for k in range(10)] == [0, 0, 0, 1, 1, 1, 1, 2, 2, 2]
    names = spark.createDataFrame([("block_games_1_30.csv",), ("block_games_1_120.csv",),
                                   ("block_games_1_90.csv",)], "name string")
    last = paging.last_block(names, "name").first()
    assert (last.last_block, last.last_processed) == ("block_games_1_120.csv", 120)


def test_union_blocks_by_name_with_missing_columns(spark):
    old = spark.createDataFrame([(1, "x")], "steam_id bigint, Month string")
    new = spark.createDataFrame([("y", 2, 5.0)], "Month string, steam_id bigint, AvgViewers double")
    rows = sorted(paging.union_blocks(old, new).collect(), key=lambda r: r.steam_id)
    assert [(r.steam_id, r.Month, r.AvgViewers) for r in rows] == [(1, "x", None), (2, "y", 5.0)]
