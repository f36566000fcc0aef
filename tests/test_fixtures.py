"""Golden edge cases (FIXTURES.md): small invented files written to a temp dir,
loaded through the real readers and models, checked row for row."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from marquee.operators import quality
from marquee.plans import collect, legacy, marts, staging
from marquee.schemas import CATALOGUE_SCHEMA, METRICS_SCHEMA, METRICS_TEXT_SCHEMA, PLAYERS_SCHEMA, PRICE_SCHEMA, USERS_SCHEMA
from marquee.sources import files, payload


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def _game(appid, name, **kw):
    g = {"appid": appid, "name": name, "release_date": "01/02/2020", "short_description": "x",
         "developers": ["Dev A"], "categories": ["Single-player"], "genre": ["Action"],
         "header_image": "h", "price": 999, "currency": "EUR", "windows": True,
         "linux": False, "mac": None, "metacritic": 80, "recommendations": 1500}
    g.update(kw)
    return g


@pytest.fixture()
def catalogue_dir(tmp):
    root = os.path.join(tmp, "steam")
    a = [
        _game(10, "Alpha", release_date="6/3/2024", developers=["Zeta", "Ève", "Zeta"]),
        _game(20, "Beta", developers=[], categories=None, genre=["Action", None]),
        _game(30, "Gamma", price=0, currency=None, developers=["eve"]),
    ]
    b = [_game(30, "Gamma again", release_date=None), _game(40, "Delta", genre=["RPG"])]
    _write(os.path.join(root, "output_1", "steam_data_001.json"), json.dumps(a, indent=2, ensure_ascii=False))
    _write(os.path.join(root, "output_2", "steam_data_001.json"), json.dumps(b, indent=2, ensure_ascii=False))
    _write(os.path.join(root, "output_2", "steam_data_002.json"), "[]")
    return root


def test_catalogue_json_and_star_schema(spark, catalogue_dir):
    bronze = files.read_catalogue_json(spark, f"{catalogue_dir}/*/*.json")
    assert bronze.count() == 5  # the empty-array file adds nothing
    stg = staging.stage_catalogue(bronze)
    rows = {r.appid: r for r in stg.collect() if r.name != "Gamma again"}
    assert rows[10].release_date == dt.datetime(2024, 3, 6)  # one-digit day and month
    assert rows[30].price == 0.0 and rows[30].currency is None
    assert rows[20].categories is None and rows[20].developers == []

    games = marts.dim_entity(stg)
    keys = sorted((r.appid, r.game_key) for r in games.collect())
    assert [k for _, k in keys] == [1, 2, 3, 4, 5]  # duplicate appid keeps both rows

    genre = marts.dim_member(stg, "genre", "genre_name", "genre_key")
    g = [(r.genre_key, r.genre_name) for r in genre.orderBy("genre_key").collect()]
    assert g == [(1, "Action"), (2, "RPG"), (3, None)]  # NULL member gets the last key

    dev = marts.dim_member(stg, "developers", "developer_name", "developer_key")
    assert [r.developer_name for r in dev.orderBy("developer_key").collect()] == \
        ["Dev A", "Zeta", "eve", "Ève"]  # binary order, exact names

    from marquee.operators.members import bridge
    b = bridge(stg, "appid", "developers", games, "game_key", dev, "developer_name", "developer_key")
    alpha = [r for r in b.collect() if r.game_key == 1]
    assert len(alpha) == 3  # duplicate member kept
    bg = bridge(stg, "appid", "genre", games, "game_key", genre, "genre_name", "genre_key")
    assert all(r.genre_key != 3 for r in bg.collect())  # NULL member drops out of the join

    # the duplicate appid fails the declared uniqueness check
    assert quality.check_unique(stg, "appid").count() == 1


@pytest.fixture()
def metrics_dir(tmp):
    header = ",".join(["steam_id", "Month", "AvgViewers", "AvgViewersGain", "AvgViewers%Gain",
                       "PeakViewers", "AvgStreams", "AvgStreamsGain", "AvgStreamsùGain",
                       "PeakStreams", "HoursWatched"])
    lines = [
        "10,01/03/2024,2.5,1,2.25,10,3.5,,0.15,4,1000",
        "10,01/03/2024,9.5,1,2.25,10,3.5,,0.15,4,1000",   # same key: first wins in legacy
        "20,01/04/2024,,1,2,10,3,1,1,4,10",               # blank AvgViewers: rejected
        "99,01/04/2024,1,1,1,1,1,1,1,1,1",                # unknown game
        "10,01/05/2024,7,-,-,8,9,-,-,10,3000000000",
    ]
    root = os.path.join(tmp, "twitch")
    _write(os.path.join(root, "block_games_1_30.csv"), header + "\n" + "\n".join(lines) + "\n")
    return root


def test_metrics_warehouse_staging_rounds_half_even(spark, metrics_dir):
    raw = files.read_metrics_csv(spark, f"{metrics_dir}/*.csv", METRICS_SCHEMA)
    first = raw.limit(2)
    stg = staging.stage_metrics(first.withColumn("Month", F.to_date("Month", "dd/MM/yyyy")))
    r = sorted(stg.collect(), key=lambda x: x.avg_viewers)
    assert (r[0].avg_viewers, r[0].avg_streams) == (2, 4)   # 2.5 -> 2, 3.5 -> 4
    assert r[1].avg_viewers == 10                            # 9.5 -> 10
    assert r[0].avg_viewers_gain == 1 and r[0].avg_streams_gain is None
    assert float(r[0].avg_streams_u_gain) == 0.2             # 0.15 -> 0.2


def test_metrics_legacy_load(spark, metrics_dir):
    raw = files.read_metrics_csv(spark, f"{metrics_dir}/*.csv", METRICS_TEXT_SCHEMA, with_order=True)
    games = spark.createDataFrame([(10,), (20,)], "appid int")
    res = legacy.metrics_load(raw, games)
    rows = sorted(res.rows.collect(), key=lambda r: r.date)
    assert len(rows) == 2
    assert rows[0].AvgViewers == 2 and rows[0].AvgStreams == 3   # truncated, first row won
    assert rows[1].AvgViewersGain is None and rows[1]["AvgViewers%Gain"] is None
    assert rows[1].HoursWatched == "3000000000"                   # kept as text
    reasons = sorted(r.reason for r in res.rejected.collect())
    assert reasons == ["bad AvgViewers", "duplicate key", "unknown game"]
    audit = {r.file_path: (r.n_total, r.n_ok, r.n_rejected) for r in res.audit.collect()}
    assert audit[None] == (5, 2, 3)  # the duplicate key is not inserted


@pytest.fixture()
def history_dir(tmp):
    root = os.path.join(tmp, "history")
    _write(os.path.join(root, "instance_1", "players", "10_players.csv"),
           "﻿Month,Peak,Gain,Percent_Gain\n"
           "March 2024,\"1,234\",+5,\"1,5\"\n"
           "mars 2024,999,-,\n"
           "February 2024,abc,1,2\n")
    _write(os.path.join(root, "instance_2", "players", "20_players.csv"),
           "Month,Peak,Gain,Percent_Gain\nJanuary 2024,50,-3,-2.5\n")
    # instance_3 has no players folder at all
    _write(os.path.join(root, "instance_3", "price", "10_price.csv"),
           "DateTime;Final price;2-year low\n2024-01-01;19,99;9,99\n2024-01-01;5,00;1\n"
           "2024-01-02;;\n2024-01-03;1,00;1,00\n")
    _write(os.path.join(root, "instance_3", "price", "20_price.csv"), "DateTime;Final price;2-year low\n")
    return root


def test_players_load_key_from_file_name(spark, history_dir):
    raw = files.read_keyed_csv(spark, f"{history_dir}/instance_*/players/*_players.csv", PLAYERS_SCHEMA)
    games = spark.createDataFrame([(10,), (20,)], "appid bigint")
    res = legacy.players_load(raw, games)
    rows = sorted((r.appid, str(r.month), r.peak, r.gain, r.percent_gain) for r in res.rows.collect())
    # '1,234' is not an integer (rejected, as int() would); 'mars' is March
    assert rows == [(10, "2024-03-01", 999, None, None), (20, "2024-01-01", 50, -3, -2.5)]
    assert sorted(r.reason for r in res.rejected.collect()) == ["bad Peak", "bad Peak"]
    audit = {r.file_path: (r.n_total, r.n_ok, r.n_rejected) for r in res.audit.collect()}
    assert audit[None] == (4, 2, 2) and all(a == b + c for a, b, c in audit.values())


def test_price_load_drops_footer(spark, history_dir):
    raw = files.read_keyed_csv(spark, f"{history_dir}/instance_*/price/*_price.csv", PRICE_SCHEMA,
                               sep=";", drop_footer=True)
    games = spark.createDataFrame([(10,), (20,)], "appid bigint")
    res = legacy.price_load(raw, games)
    rows = sorted((str(r.date), r.final_price, r.two_year_low) for r in res.rows.collect())
    # the last line (2024-01-03) is dropped; the first 2024-01-01 row wins
    assert rows == [("2024-01-01", 19.99, 9.99), ("2024-01-02", None, None)]


def test_users_load(spark, tmp):
    p = os.path.join(tmp, "users.csv")
    _write(p, "DateTime;Users;Average Users;In-Game\n2024-01-01 00:00:00;10.7;3.2;\n"
              "2024-01-02 00:00:00;NaN;4.9;7\n")
    rows = legacy.users_load(files.read_semicolon_csv(spark, p, USERS_SCHEMA)).rows.orderBy("DateTime").collect()
    assert [(r.Users, r.AverageUsers, r.InGame) for r in rows] == [(10, 3, None), (None, 4, 7)]


def test_users_load_refuses_bad_cells(spark, tmp):
    p = os.path.join(tmp, "users.csv")
    _write(p, "DateTime;Users;Average Users;In-Game\n2024-01-01 00:00:00;abc;3.2;\nsoon;1;1;1\n"
              "2024-01-02 00:00:00;3000000000;1;1\n2024-01-03 00:00:00;inf;1;1\n2024-01-04 00:00:00;1;1;1\n"
              "2024-01-04 00:00:00;1;1;1\n")
    res = legacy.users_load(files.with_file_order(files.read_semicolon_csv(spark, p, USERS_SCHEMA)))
    assert res.rows.count() == 2  # equal times are no repeated key
    assert sorted(r.reason for r in res.rejected.collect()) == ["bad DateTime", "bad Users", "bad Users", "bad Users"]
    audit = {r.file_path: (r.n_total, r.n_ok, r.n_rejected) for r in res.audit.collect()}
    assert len(audit) == 2 and set(audit.values()) == {(6, 2, 4)}


def test_metrics_load_refuses_what_no_column_holds(spark, tmp):
    header = ("steam_id,Month,AvgViewers,AvgViewersGain,AvgViewers%Gain,PeakViewers,AvgStreams,"
              "AvgStreamsGain,AvgStreamsùGain,PeakStreams,HoursWatched\n")
    cells = ["10,1/3/2024,3000000000,1,1,1,1,1,1,1,1", "10,1/4/2024,nan,1,1,1,1,1,1,1,1",
             "10,1/5/2024,1,1e400,1,1,1,1,1,1,1", "10,1/6/2024,1,1,inf,1,1,1,1,1,1", "-,1/6/2024,1,1,1,1,1,1,1,1,1",
             "10,June 2024,1,1,1,1,1,1,1,1,1", "10,6/3/2024,7,,,1,-,,,1,1", "10,06/03/2024,8,,,1,-,,,1,1"]
    _write(os.path.join(tmp, "m.csv"), header + "\n".join(cells) + "\n")
    raw = files.read_metrics_csv(spark, os.path.join(tmp, "m.csv"), METRICS_TEXT_SCHEMA, with_order=True)
    res = legacy.metrics_load(raw, spark.createDataFrame([(10,), (None,)], "appid int"))
    assert [(r.AvgViewers, str(r.date)) for r in res.rows.collect()] == [(7, "2024-03-06")]
    assert sorted(r.reason for r in res.rejected.collect()) == [
        "bad AvgViewers", "bad AvgViewers", "bad AvgViewers%Gain", "bad AvgViewersGain", "bad Month",
        "duplicate key", "unknown game"]


def test_stored_keys_are_rejects(spark, history_dir):
    raw = files.read_keyed_csv(spark, f"{history_dir}/instance_*/players/*_players.csv", PLAYERS_SCHEMA)
    games = spark.createDataFrame([(10,), (20,)], "appid bigint")
    stored = spark.createDataFrame([(20, "2024-01-01")], "appid bigint, month string").selectExpr(
        "appid", "cast(month as date) month")
    res = legacy.players_load(raw, games, target=stored)
    assert [r.appid for r in res.rows.collect()] == [10]
    assert sorted(r.reason for r in res.rejected.collect()) == ["bad Peak", "bad Peak", "duplicate key"]


def test_no_worker_folder_at_all(spark, tmp):
    raw = files.read_keyed_csv(spark, f"{tmp}/none/instance_*/players/*_players.csv", PLAYERS_SCHEMA)
    assert raw.count() == 0 and {"appid", "file_path", "line_no"} <= set(raw.columns)
    raw = files.read_keyed_csv(spark, f"{tmp}/none/*/price/*.csv", PRICE_SCHEMA, sep=";", drop_footer=True)
    assert legacy.price_load(raw, spark.createDataFrame([(1,)], "appid bigint")).audit.count() <= 1


def test_catalogue_refuses_games_without_id_or_name(spark):
    rows = [(None, "No id", ["A"]), (1, None, ["A"]), (2, "Two", ["A"]), (2, "Again", ["B"]), (3, "", None)]
    bronze = spark.createDataFrame([(a, n, None, "", d, None, ["g"], "", 1, "EUR", True, True, True, 1, 1)
                                    for a, n, d in rows], CATALOGUE_SCHEMA).coalesce(1)
    res = legacy.catalogue_load(bronze)
    assert {(r.appid, r.name) for r in res.rows.collect()} == {(2, "Two"), (3, "")}
    assert sorted(r.reason for r in res.rejected.collect()) == ["duplicate key", "no name", "null key"]
    total = res.audit.where("file_path is null").first()
    assert (total.n_total, total.n_ok, total.n_rejected) == (5, 2, 3)
    dim = legacy.member_dim(bronze, "genre")
    assert sorted(r.game_appid for r in legacy.catalogue_links(bronze, dim, "genre").collect()) == [1, 2, 3]


def test_collated_names_keep_their_ids(spark):
    rows = [(1, "One", ["Éa"], ["Rpg"]), (2, "Two", ["ea"], ["RPG", "rpg"]), (3, "Three", ["Other"], ["rpġ"])]
    bronze = spark.createDataFrame([(a, n, None, "", d, None, g, "", 1, "EUR", True, True, True, 1, 1)
                                    for a, n, d, g in rows], CATALOGUE_SCHEMA)
    res = legacy.catalogue_load(bronze, collation="UNICODE_CI_AI")
    devs = {r.appid: r.developer_id for r in res.rows.collect()}
    assert devs[1] == devs[2] and devs[3] not in (None, devs[1]) and res.developers.count() == 2
    dim = legacy.member_dim(bronze, "genre", collation="UNICODE_CI_AI")
    links = legacy.catalogue_links(bronze, dim, "genre", collation="UNICODE_CI_AI").collect()
    assert dim.count() == 1 and sorted(r.game_appid for r in links) == [1, 2, 3]


def test_link_ids_and_suffixes_out_of_range_are_null(spark):
    from marquee.functions import cleaning as X
    row = spark.createDataFrame([("/games/99999999999999999999", "1e30M", "7.9K")], "a string, b string, c string") \
        .select(X.link_id("a").alias("a"), X.suffix_number("b").alias("b"), X.suffix_number("c").alias("c")).first()
    assert tuple(row) == (None, None, 7900)


def _payload(appid, success=True, data=True, **data_kw):
    d = {"name": "G", "release_date": {"coming_soon": False, "date": "6 mars 2024"},
         "developers": ["D"], "categories": [{"id": 1, "description": "Solo"}],
         "genres": [{"id": "1", "description": "Action"}], "price_overview": {"initial": 1999, "currency": "EUR"},
         "platforms": {"windows": True, "linux": False, "mac": False},
         "metacritic": {"score": 71}, "recommendations": {"total": 12}}
    d.update(data_kw)
    body = {"success": success}
    if data:
        body["data"] = d
    return json.dumps({str(appid): body})


def test_payload_parse(spark):
    rows = [
        (1, _payload(1)),
        (2, _payload(2, success=False)),
        (3, _payload(3, data=False)),
        (4, _payload(4, price_overview=None, metacritic=None, recommendations=None)),
        (5, _payload(5, release_date={"coming_soon": True, "date": "Coming soon"})),
        (6, _payload(6, release_date={"coming_soon": False, "date": "TBA"})),
        (7, _payload(7, release_date={"date": "1 Jan, 2024"})),  # coming_soon absent
    ]
    df = spark.createDataFrame(rows, "id bigint, payload string")
    out = {r.appid: r for r in payload.parse_payload(df, "payload", "id").collect()}
    assert sorted(out) == [1, 4]
    assert out[1].release_date == "06/03/2024" and out[1].categories == ["Solo"] and out[1].price == 1999
    assert out[4].price == 0 and out[4].currency is None and out[4].metacritic is None
    assert out[4].recommendations == 0


METRICS_PAGE = """<html><body><div class="dataTables_scrollBody"><table>
<thead><tr><th>Month</th><th>Avg viewers</th><th>Gain</th><th>%</th><th>Peak</th>
<th>Avg streams</th><th>Gain</th><th>%</th><th>Peak</th><th>Hours</th></tr></thead>
<tbody>
<tr><td>March 2024</td><td>1,234</td><td>+5</td><td>-3.2%</td><td>1.2M</td><td>3.4K</td><td>-</td><td>-</td><td>8.2M</td><td>12</td></tr>
<tr><td>Feb 2024</td><td>10</td></tr>
<tr></tr>
</tbody></table></div></body></html>"""

SEARCH_PAGE = """<html><h3>Channels</h3><a class="item-title" href="/games/1">Half Life</a>
<h3>Categories</h3><table><tbody>
<tr><td><a class="item-title" href="/games/77">Half-Life 2!</a></td></tr>
<tr><td><a class="item-title" href="/games/78">Half Life</a></td></tr>
<tr><td><a href="/games/79" class="x item-title">half   life</a></td></tr>
</tbody></table></html>"""

PLAYERS_PAGE = """<table id="chart-month-table"><thead><tr><th>Month</th><th>Peak</th><th>Gain</th><th>%</th></tr></thead>
<tbody><tr><td>Last 30 days</td><td>1,500</td><td>+20</td><td>+1.3%</td></tr>
<tr><td>February 2025</td><td>1,480</td><td>-</td><td>-</td></tr>
<tr><td>short</td><td>1</td></tr></tbody></table>"""


def test_pages_to_metric_rows(spark):
    games = spark.createDataFrame([(10, "Half Life"), (11, "")], "steam_id bigint, name string")
    search = spark.createDataFrame([(10, SEARCH_PAGE), (11, SEARCH_PAGE)], "steam_id bigint, html string")
    cands = collect.search_candidates(search)
    assert sorted(r.tracker_id for r in cands.where("steam_id = 10").collect()) == [77, 78, 79]
    match = collect.match_candidates(games, cands)
    assert [(r.steam_id, r.tracker_id) for r in match.collect()] == [(10, 78)]
    pages = spark.createDataFrame([(78, METRICS_PAGE), (90, "<html>none</html>")], "page_id bigint, html string")
    rows = collect.metric_rows(pages, match).orderBy("Month").collect()
    assert len(rows) == 2  # the empty <tr> gives no row; the page without a table none
    r = [x for x in rows if x.Month == "01/03/2024"][0]
    assert (r.AvgViewers, r.AvgViewersGain, r["AvgViewers%Gain"]) == (1234.0, 5.0, -3.2)
    assert (r.PeakViewers, r.AvgStreams, r.AvgStreamsGain) == (1200000.0, 3400.0, None)
    assert r.PeakStreams == 8199999.0  # IEEE product truncated, as in the collector


def test_pages_to_player_rows(spark):
    pages = spark.createDataFrame([(5, PLAYERS_PAGE), (6, "You have been temporarily rate limited")],
                                  "appid bigint, html string")
    rows = collect.player_rows(pages, as_of="March 2025").orderBy("row_no").collect()
    assert [(r.Month, r.Peak, r.Gain, r.Percent_Gain) for r in rows] == [
        ("01/03/2025", "1500", "20", "1.3"), ("01/02/2025", "1480", "-", "-")]


def test_pipeline_end_to_end(spark, tmp):
    from marquee.plans import pipeline
    root = os.path.join(tmp, "raw")
    games = [_game(10, "Alpha", genre=["Action", "RPG"]), _game(20, "Beta")]
    _write(os.path.join(root, "steam", "o1", "steam_data_001.json"), json.dumps(games, indent=2))
    _write(os.path.join(root, "twitch", "block.csv"),
           "steam_id,Month,AvgViewers,AvgViewersGain,AvgViewers%Gain,PeakViewers,AvgStreams,"
           "AvgStreamsGain,AvgStreamsùGain,PeakStreams,HoursWatched\n"
           "10,01/03/2024,2.5,1,2.25,10,3.5,,0.15,4,1000\n"
           "20,01/04/2024,3,1,2,10,3,1,1,4,10\n"
           "99,01/04/2024,1,1,1,1,1,1,1,1,1\n")
    w, summary = pipeline.run(spark, f"{root}/twitch/*.csv", f"{root}/steam/*/*.json",
                              os.path.join(tmp, "wh"))
    assert len(summary) == 31 and all(n == 0 for *_, n in summary)
    assert w.fct.count() == 2            # the unknown game drops out of the join
    assert w.bridge_game_genre.count() == 3
    assert sorted(r.date_key for r in w.dim_date.collect()) == [202403, 202404]


def test_legacy_run(spark, tmp, catalogue_dir, metrics_dir, history_dir):
    users = os.path.join(tmp, "users.csv")
    _write(users, "DateTime;Users;Average Users;In-Game\n2024-01-01 00:00:00;10.7;3.2;\n")
    t = legacy.run(spark, os.path.join(tmp, "legacy"), f"{catalogue_dir}/*/*.json",
                   f"{metrics_dir}/*.csv", history_dir, users, collation="UNICODE_CI_AI")
    games = {r.appid: r for r in t["steamgames"].collect()}
    assert sorted(games) == [10, 20, 30, 40]        # appid 30 twice: first file wins
    assert games[30].name == "Gamma" and games[20].developer_id is None
    devs = {r.name: r.developer_id for r in t["developers"].collect()}
    # first developers only; 'eve' and 'Ève' would be one name, but only 'Zeta',
    # 'eve' and 'Dev A' are first developers
    assert set(devs) == {"Dev A", "Zeta", "eve"}
    assert games[10].developer_id == devs["Zeta"]
    gen = {r.name for r in t["genres"].collect()}
    assert gen == {"Action", "RPG"}                 # NULL member is no genre
    cats = {r.name for r in t["categories"].collect()}
    assert cats == {"Single-player"}
    links = t["games_genres"].collect()
    assert len(links) == len({(r.game_appid, r.member_id) for r in links})
    assert t["twitchgames"].count() == 2 and t["players_history"].count() == 2
    assert t["price_history"].count() == 2 and t["global_steam_users"].count() == 1
    audit = {r.file_path: r.n_ok for r in t["twitchgames_audit"].collect()}
    assert audit[None] == 2                         # steam_id 20 has only a rejected row
    for name in ("steamgames", "twitchgames", "players_history", "price_history", "global_steam_users"):
        total = t[f"{name}_audit"].where("file_path is null").first()
        assert t[name].count() == total.n_ok and t[f"{name}_rejects"].count() == total.n_rejected
        assert total.n_ok + total.n_rejected == total.n_total


def test_pipeline_bucketed_fact_and_bridge_join_without_shuffle(spark, tmp):
    from marquee.plans import goals, pipeline
    root = os.path.join(tmp, "raw")
    games = [_game(i, f"G{i}", genre=["Action", "RPG"][: 1 + i % 2]) for i in range(1, 30)]
    _write(os.path.join(root, "steam", "o1", "steam_data_001.json"), json.dumps(games, indent=2))
    lines = [f"{i},01/0{1 + i % 9}/2024,{i}.5,1,2.25,10,3.5,,0.15,4,{i * 10}" for i in range(1, 30)]
    _write(os.path.join(root, "twitch", "block.csv"),
           "steam_id,Month,AvgViewers,AvgViewersGain,AvgViewers%Gain,PeakViewers,AvgStreams,"
           "AvgStreamsGain,AvgStreamsùGain,PeakStreams,HoursWatched\n" + "\n".join(lines) + "\n")
    w, summary = pipeline.run(spark, f"{root}/twitch/*.csv", f"{root}/steam/*/*.json",
                              os.path.join(tmp, "whb"), buckets=4, table_prefix="t_bucket_")
    assert all(n == 0 for *_, n in summary)
    joined = w.fct.join(w.bridge_game_genre, "game_key")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = w.fct.join(w.bridge_game_genre, "game_key")._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan  # co-located buckets: no shuffle on either side
    g1 = goals.member_month(w.fct, w.bridge_game_genre, w.dim_genre, "genre_key", "genre_name",
                            w.dim_date)
    assert g1.agg(F.sum("n_rows")).first()[0] == joined.count()


def test_recursive_discovery_by_extension(spark, tmp):
    header = ("steam_id,Month,AvgViewers,AvgViewersGain,AvgViewers%Gain,PeakViewers,AvgStreams,"
              "AvgStreamsGain,AvgStreamsùGain,PeakStreams,HoursWatched\n")
    _write(os.path.join(tmp, "out", "output_1", "block_games_1_30.csv"), header + "1,01/03/2024,1,,,1,1,,,1,1\n")
    _write(os.path.join(tmp, "out", "output_2", "deep", "block_games_2_30.csv"), header + "2,01/03/2024,1,,,1,1,,,1,1\n")
    _write(os.path.join(tmp, "out", "output_2", "notes.txt"), "not a metrics file\n")
    df = files.read_metrics_csv(spark, os.path.join(tmp, "out"), METRICS_TEXT_SCHEMA, with_order=True,
                                recursiveFileLookup=True, pathGlobFilter="*.csv")
    assert sorted(r.steam_id for r in df.collect()) == ["1", "2"]


def test_get_or_create_keys_collation(spark):
    from marquee.operators.keys import get_or_create_keys
    dim = spark.createDataFrame([(1, "Ève"), (2, "Zeta")], "id bigint, name string")
    names = spark.createDataFrame([("eve",), ("EVE",), ("New",), ("zeta",), ("new",)], "name string")
    exact = {r.name: r.id for r in get_or_create_keys(names, dim, "name", "id").collect()}
    assert exact["Ève"] == 1 and exact["Zeta"] == 2 and len(exact) == 2 + 5
    folded = {r.name: r.id for r in get_or_create_keys(names, dim, "name", "id", "UNICODE_CI_AI").collect()}
    # 'eve'/'EVE' are 'Ève', 'zeta' is 'Zeta'; 'New'/'new' are one new name with id 3
    assert folded == {"Ève": 1, "Zeta": 2, "New": 3}


def test_member_links_skip_stored_pairs(spark):
    bronze = spark.createDataFrame([(1, ["A", "B", "A"]), (2, ["B"]), (3, None)],
                                   "appid bigint, genre array<string>")
    dim = legacy.member_dim(bronze, "genre")
    ids = {r.name: r.id for r in dim.collect()}
    stored = spark.createDataFrame([(1, ids["A"])], "game_appid bigint, member_id bigint")
    links = legacy.catalogue_links(bronze, dim, "genre", existing=stored)
    assert sorted((r.game_appid, r.member_id) for r in links.collect()) == \
        [(1, ids["B"]), (2, ids["B"])]


def test_pipeline_rejects_values_that_do_not_fit(spark, tmp):
    from marquee.plans import pipeline
    root = os.path.join(tmp, "raw")
    _write(os.path.join(root, "steam", "o1", "a.json"), json.dumps([_game(1, "A"), _game(2, "B")], indent=2))
    _write(os.path.join(root, "twitch", "b.csv"),
           "steam_id,Month,AvgViewers,AvgViewersGain,AvgViewers%Gain,PeakViewers,AvgStreams,"
           "AvgStreamsGain,AvgStreamsùGain,PeakStreams,HoursWatched\n"
           "1,6/3/2024,2.5,1,2,10,3,1,1,4,100\n"
           "1,June 2024,2.5,1,2,10,3,1,1,4,100\n"
           "2,01/03/2024,\"1,234\",1,2,10,3,1,1,4,100\n")
    t = pipeline.load_bronze(spark, f"{root}/twitch/*.csv", f"{root}/steam/*/*.json",
                             os.path.join(tmp, "wh"))
    assert t["bronze_twitch"].count() == 1
    rej = t["bronze_twitch_rejects"].collect()
    assert len(rej) == 2 and any("1,234" in (r["_corrupt_record"] or "") for r in rej)
    assert any(r.Month == "June 2024" for r in rej)
    assert t["bronze_steam"].count() == 2 and t["bronze_steam_rejects"].count() == 0


def test_legacy_refused_duplicate_links_no_members(spark, tmp):
    root = os.path.join(tmp, "cat")
    _write(os.path.join(root, "o1", "a.json"), json.dumps([_game(7, "First", genre=["Action"])], indent=2))
    _write(os.path.join(root, "o2", "b.json"), json.dumps([_game(7, "Again", genre=["Indie"])], indent=2))
    t = legacy.run(spark, os.path.join(tmp, "out"), f"{root}/*/*.json")
    assert [r.name for r in t["steamgames"].collect()] == ["First"]
    assert {r.name for r in t["genres"].collect()} == {"Action"}  # 'Indie' came with the refused row


def test_cli_warehouse_and_legacy(spark, tmp, capsys):
    from marquee.__main__ import main
    root = os.path.join(tmp, "raw")
    _write(os.path.join(root, "steam", "o1", "a.json"), json.dumps([_game(1, "A"), _game(2, "B")], indent=2))
    _write(os.path.join(root, "twitch", "b.csv"),
           "steam_id,Month,AvgViewers,AvgViewersGain,AvgViewers%Gain,PeakViewers,AvgStreams,"
           "AvgStreamsGain,AvgStreamsùGain,PeakStreams,HoursWatched\n1,01/03/2024,2.5,1,2,10,3,1,1,4,100\n")
    assert main(["warehouse", "--metrics", f"{root}/twitch/*.csv", "--catalogue",
                 f"{root}/steam/*/*.json", "--out", os.path.join(tmp, "wh")]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert len(out) == 31 and all(line.endswith("\t0") for line in out)
    assert main(["legacy", "--catalogue", f"{root}/steam/*/*.json", "--out", os.path.join(tmp, "lg"),
                 "--metrics", f"{root}/twitch/*.csv"]) == 0
    assert spark.read.parquet(os.path.join(tmp, "lg", "steamgames")).count() == 2


def test_fact_partitioned_by_month_prunes(spark, tmp):
    from marquee.plans import pipeline
    root = os.path.join(tmp, "raw")
    _write(os.path.join(root, "steam", "o1", "a.json"), json.dumps([_game(1, "A"), _game(2, "B")], indent=2))
    _write(os.path.join(root, "twitch", "b.csv"),
           "steam_id,Month,AvgViewers,AvgViewersGain,AvgViewers%Gain,PeakViewers,AvgStreams,"
           "AvgStreamsGain,AvgStreamsùGain,PeakStreams,HoursWatched\n"
           "1,01/03/2024,2.5,1,2,10,3,1,1,4,100\n2,01/04/2024,3,1,2,10,3,1,1,4,10\n")
    w, _ = pipeline.run(spark, f"{root}/twitch/*.csv", f"{root}/steam/*/*.json",
                        os.path.join(tmp, "wh"), partition_fact_by_month=True)
    march = w.fct.where(F.col("date_key") == 202403)
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan and "= 202403" in plan
    assert march.count() == 1 and w.fct.count() == 2
