import zlib

from pyspark.sql import functions as F

from marquee.llm import queries, sharding
from tests.conftest import SF_SMALL
from tests.llm.util import docs, long_text

ROWS = [(i, f"text {i % 9} " * (i % 5)) for i in range(500)] + [
    (None, None), (None, "x"), (7, "text"), (7, "text"), (900, ""), (901, long_text())]


def check(rows, n, **options):
    def run(spark):
        return sharding.external_shuffle(docs(spark, rows), n_shards=n, **options).collect()
    return run


def test_slots_are_gapless_and_values_right(spark):
    for options in ({}, {"bucket_rows": 3}, {"bucket_bytes": 500}):
        got = check(ROWS, 6, **options)(spark)
        assert len(got) == len(ROWS)
        by_shard = {}
        for r in got:
            by_shard.setdefault(r.shard, []).append(r.slot)
        assert set(by_shard) <= set(range(6))
        assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
        assert sorted((r.doc_id or -1, r["size"], r.text_crc32, r.law) for r in got) == sorted(
            (i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "key")
            for i, t in ROWS)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    six = {(r.doc_id, r.text_crc32): r for r in check(ROWS, 6)(spark)}
    seven = {(r.doc_id, r.text_crc32): r for r in check(ROWS, 7)(spark)}
    for k, r in six.items():
        assert r.grown_shard == seven[k].shard
        assert r.grown_shard in (r.shard, 6)


def test_shares_are_even(spark):
    ids = spark.range(40_000).select(sharding.shard_of(F.col("id"), 40, 17).alias("s"))
    sizes = [r["count"] for r in ids.groupBy("s").count().collect()]
    assert len(sizes) == 40 and 850 < min(sizes) and max(sizes) < 1150


def test_the_order_is_shuffled(spark):
    got = sorted(check([(i, "same") for i in range(1000)], 1)(spark), key=lambda r: r.slot)
    ids = [r.doc_id for r in got]
    assert ids != sorted(ids)
    # ranks of neighbours are as far apart as in a random order (a third of n)
    assert 280 < sum(abs(a - b) for a, b in zip(ids, ids[1:])) / 999 < 390


def test_written_shards_hold_the_whole_records(spark, tmp):
    table = docs(spark, ROWS)
    sharding.write_shards(table, f"{tmp}/shards", n_shards=4, bucket_rows=50)
    back = spark.read.parquet(f"{tmp}/shards")
    assert back.count() == len(ROWS) and back.select("shard").distinct().count() == 4
    assert back.select("record.*").columns == table.columns


def test_written_shards_say_where_their_records_are(spark, tmp):
    """Places, sizes and CRCs read back from the files; slots are gapless, files in slot order."""
    table = docs(spark, ROWS)
    sharding.write_shards(table, f"{tmp}/back", n_shards=6, bucket_rows=50)
    got = sharding.read_shards(table, f"{tmp}/back", n_shards=6).collect()
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in got) == sorted(
        (i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ROWS)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 6)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    files = spark.read.parquet(f"{tmp}/back").select(
        F.input_file_name().alias("f"), "slot", F.col("record.text").alias("text")).collect()
    assert sorted(r.text or "" for r in files) == sorted(t or "" for _, t in ROWS)
    per_file = {}
    for r in files:
        per_file.setdefault(r.f, []).append(r.slot)
    assert all(s == list(range(s[0], s[0] + len(s))) for s in per_file.values())


def test_the_query_writes_the_shards(spark, monkeypatch):
    paths = []
    write = sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda d, path, **k: (paths.append(path), write(d, path, **k)))
    queries.op6_sharding(spark, SF_SMALL)
    docs_ = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    back = spark.read.parquet(*paths)
    places = docs_.select("doc_id", sharding.shard_of(F.col("doc_id"), 40, 17).alias("shard"))
    assert sorted(map(tuple, back.select("record.doc_id", "shard").collect())) == sorted(map(tuple, places.collect()))
    assert back.select("record.*").exceptAll(docs_).count() == docs_.exceptAll(back.select("record.*")).count() == 0


def test_buckets_stay_bounded_on_skew(spark):
    """Equal rows, and a hot id's rows, are spread over buckets by their shard's own counts."""
    rows = [(i, f"text {i}") for i in range(600)] + [(None, None)] * 400 + [(7, f"hot {i}") for i in range(400)]
    for carry in ((), ("doc_id", "text")):
        out, n = sharding.scattered(docs(spark, rows), n_shards=4, bucket_rows=50, carry=carry)
        sizes = [r["count"] for r in out.groupBy("bucket").count().collect()]
        assert sum(sizes) == len(rows) and n <= len(rows) // 50 + 4 and max(sizes) <= 100
    got = check(rows, 4, bucket_rows=50)(spark)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_empty_table(spark):
    assert check([], 40)(spark) == []


def test_empty_shards(spark, tmp):
    table = docs(spark, [])
    sharding.write_shards(table, f"{tmp}/none", n_shards=40)
    assert sharding.read_shards(table, f"{tmp}/none").collect() == []


def test_records_that_have_no_order(spark, tmp):
    """Maps and variants are carried like any column."""
    table = docs(spark, ROWS).withColumn("m", F.create_map(F.lit("k"), F.col("text"))).withColumn(
        "v", F.parse_json(F.lit('{"a": 1}')))
    sharding.write_shards(table, f"{tmp}/maps", n_shards=4, bucket_rows=50)
    got = sharding.read_shards(table, f"{tmp}/maps", n_shards=4).collect()
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == len(ROWS) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    back = spark.read.parquet(f"{tmp}/maps")
    assert back.where("record.m['k'] <=> record.text").count() == len(ROWS)
