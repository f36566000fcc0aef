import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from marquee.llm import warc
from tests.llm.util import long_text, table

FORGED = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\n"
          "Content-Length: 5\r\n\r\nhello\r\n\r\n")
BIG = "<p>" + "same payload " * 20 + "</p>"
ROWS = [(i, f"http://x/{i}", f"<html>{i}</html>" * (i % 4)) for i in range(60)] + [
    (100, None, None), (101, "u", ""), (102, "a\r\nb: c", "x" * 99), (103, "u", "x" * 99),
    (104, "u", BIG), (105, "u", BIG), (106, "v", BIG), (107, "u", FORGED * 5), (108, "u", FORGED),
    (109, "u", "a" * 200 + "WARC/1.0\r\n"), (110, "u", "WARC/1.0\r\n\r\n\r\nContent-Length: 3\r\n\r\n" * 9),
    (111, "u", "WARC/1.0\r\nContent-Length: 99999999999999999999999\r\n\r\n" + "y" * 120),
    (112, "u", "ünï 💥\x00" * 40), (113, "u", long_text(20_000)), (114, "u", "WARC/1.0"), (115, "u", "\r\n\r\n"),
    (116, "u", "HTTP/1.1 200 OK\r\nContent-Length: 7\r\n\r\n" * 4), (104, "u", BIG), (None, "n", "no id " * 30)]
SCHEMA = "page_id long, url string, html string"


def brute(rows):
    least = {}
    for i, _, h in rows:
        h = h or ""
        if len(h.encode()) >= 100 and i is not None:
            least[h] = min(least.get(h, i), i)
    out = Counter()
    for i, _, h in rows:
        h = h or ""
        first = least.get(h, i)
        out[i, len(h.encode()), hashlib.sha256(h.encode()).hexdigest(),
            "response" if first == i else "revisit", None if first == i else first] += 1
    return out


def test_round_trip(spark, tmp):
    pages = table(spark, ROWS, SCHEMA)
    warc.write_archives(pages, f"{tmp}/a", records_per_file=9)
    got = warc.read_archives(spark, f"{tmp}/a").collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got) == brute(ROWS)
    payloads = defaultdict(set)
    for i, _, h in ROWS:
        payloads[i].add(h or "")
    assert all(bytes(r.payload).decode() in payloads[r.page_id] for r in got if r.record_type == "response")
    assert {r.url for r in got if r.page_id == 102} == {"a%0D%0Ab: c"}
    assert warc.broken_files(spark, f"{tmp}/a").count() == 0


def test_round_trip_of_long_ids(spark):
    """The least and greatest long, ids of 19 digits and nulls among them come back exactly."""
    least, most = -1 << 63, (1 << 63) - 1
    rows = [(i, "u", f"<html>{i}</html>") for i in (least, least + 1, most, most - 1, 10 ** 18, 10 ** 18 + 1,
                                                    (1 << 53) + 1, None, 3)]
    rows += [(most, "u", BIG), (most - 2, "u", BIG), (None, "u", BIG), (10 ** 18 + 3, "v", FORGED * 5),
             (10 ** 18 + 5, "v", FORGED * 5)]
    got = warc.round_trip(table(spark, rows, SCHEMA)).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got) == brute(rows)
    head = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\n\r\n"
    for i, read in ((most, most), (most + 1, None), (least, least), (least - 1, None)):
        assert warc._record(head.format(i).encode())[0] == read


def test_splits_inside_a_file_change_nothing(spark, tmp):
    """Files read in many small splits give the same candidates and records."""
    warc.write_archives(table(spark, ROWS, SCHEMA).coalesce(1), f"{tmp}/b", compression="none")
    digests = lambda: sorted(str((r.page_id, r.payload_digest)) for r in
                             warc.read_archives(spark, f"{tmp}/b").collect())
    offsets = lambda: sorted((r.off, r.succ or 0) for r in
                             warc.candidates(spark, f"{tmp}/b").collect())
    whole, chain = digests(), offsets()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert spark.read.text(f"{tmp}/b").rdd.getNumPartitions() > 10
        split, again = digests(), offsets()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert split == whole and again == chain and len(whole) == len(ROWS)


def test_a_cut_file_is_reported(spark, tmp):
    warc.write_archives(table(spark, ROWS[:30], SCHEMA).coalesce(1), f"{tmp}/c")
    text = "".join(r.value for r in spark.read.text(f"{tmp}/c", wholetext=True).collect())
    (spark.createDataFrame([(text[:-30],)], "value string").coalesce(1).write.option("lineSep", " ")
     .text(f"{tmp}/d"))
    broken = warc.broken_files(spark, f"{tmp}/d").collect()
    assert len(broken) == 1 and broken[0].chain_end != broken[0].bytes


def test_pointer_jumping_keeps_the_chain_only(spark):
    chain = [(f, k * 10, k * 10 + 10) for f in "ab" for k in range(37)]
    false = [("a", 15, 20), ("a", 16, 700), ("b", 3, 17), ("c", 5, 15)]
    nodes = spark.createDataFrame([(ord(f), o, s) for f, o, s in chain + false],
                                  "fid long, off long, succ long")
    got = {(chr(r.fid), r.off) for r in warc.reachable(nodes).collect()}
    assert got == {(f, o) for f, o, _ in chain}


def test_empty_table(spark):
    assert warc.round_trip(table(spark, [], SCHEMA)).count() == 0


def test_spread_groups(spark):
    pages = table(spark, [(i, "u", BIG) for i in range(300)], SCHEMA)
    kinds = warc.classify(pages).groupBy(F.col("first").isNull().alias("r")).count().collect()
    assert {r.r: r["count"] for r in kinds} == {True: 1, False: 299}
