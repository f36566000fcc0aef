"""WARC archives: writing pages, and reading them back by boundary-chain verification.

Writing: one record per page. Of pages with equal payloads of at least
``MIN_REVISIT`` bytes the one with the smallest id is a ``response``, the others
are ``revisit`` records that refer to it and carry the HTTP header only. Only pages
whose digest a fixed-size Bloom filter of repeated digests may hold are shuffled to
find that out. Spark's text writer writes the files (gzip by default), so they may
lie in any store Spark can write to.

Reading, two scans that shuffle no payload:

1. The files are split at the magic line, so a payload that holds it yields false
   candidates. Every candidate at byte offset ``o`` emits the offset at which its
   successor would start (by its Content-Length). A real record is one that the
   chain from the start of the file reaches; pointer jumping finds these: each round
   every reached candidate marks its pointer's target and every pointer is replaced
   by its target's pointer, so r rounds cover chains of 2 ** r records, over all
   files at once and on (file, offset, pointer) numbers only.
2. A candidate that is a whole record is parsed where it is read. The pieces of
   records that hold the magic (found by a Bloom filter, then exactly) are brought
   together by record.

Defined cases: a null html is an empty payload and a null url an empty target;
line ends in a url are escaped; an empty payload is a response; rows repeated
with the same id and payload are all responses; a page id that is null is written
as an empty id and read back as null (and is never referred to); an empty table
writes an archive without records; other columns are ignored. A file whose chain
does not end at its last byte is reported by ``broken_files``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.session import scratch_path

from .common import bloom_bitmap, in_bloom, look_up, written

MAGIC = "WARC/1.0\r\n"
BLANK = "\r\n\r\n"
MIN_REVISIT = 100
RECORDS_PER_FILE = 20_000


def classify(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
             payload_col: str = "html") -> DataFrame:
    """page id, url, payload, its size and digest, and ``first``: the id of the
    response that the page revisits (null for a response)."""
    payload = F.coalesce(pages[payload_col], F.lit(""))
    base = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"),
                        payload.alias("payload"), F.octet_length(payload).alias("n"),
                        F.sha2(payload, 256).alias("digest"))
    groups = written(
        base.where(F.col("n") >= MIN_REVISIT).groupBy("digest")
        .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1").select("digest", "least"), "warc-repeated")
    held = bloom_bitmap(groups.select(F.xxhash64("digest")), groups.count())

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(in_bloom(held.value, h.to_numpy().view(np.uint64)))

    marked = base.withColumn("maybe", maybe(F.xxhash64("digest")))
    columns = ["id", "url", "payload", "n", "digest"]
    once = marked.where(~F.col("maybe")).select(*columns, F.lit(None).cast("long").alias("first"))
    found = look_up(marked.where("maybe").select(*columns), groups, ["digest"],
                    F.struct("id", "url"))
    return once.unionByName(found.select(
        *columns, F.when(~F.col("least").eqNullSafe(F.col("id")), F.col("least")).alias("first")))


def _urn(i: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("")), F.lit(">"))


def record_text(date: str = "2024-01-01T00:00:00Z") -> Column:
    """The record of a row of ``classify``, without the two line ends that close it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    F.lit("Content-Length: "), F.col("n").cast("string"), F.lit(BLANK))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _urn(F.col("id"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", _urn(F.col("first"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/"
                                       "identical-payload-digest")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(BLANK), block)


def write_archives(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE,
                   compression: str = "gzip", **columns) -> None:
    (classify(pages, **columns).select(record_text().alias("value")).write
     .option("lineSep", BLANK).option("maxRecordsPerFile", records_per_file)
     .option("compression", compression).text(path))


_FIELD = re.compile(rb"(?:^|\r\n)([^:\r\n]+):[ \t]*([^\r\n]*)")
_PAGE = re.compile(rb"^<urn:page:(-?\d{1,19})>$")
_DIGEST = re.compile(rb"^sha256:([0-9a-f]{64})$")
_SIZE = re.compile(rb"^\d{1,15}$")


def _fields(head: bytes) -> dict[bytes, bytes]:
    out: dict[bytes, bytes] = {}
    for name, value in _FIELD.findall(head):
        out.setdefault(name.lower(), value)
    return out


def _extent(body: bytes) -> int | None:
    """Bytes from a candidate's magic to where its successor would start."""
    head, blank, _ = body.partition(b"\r\n\r\n")
    size = _fields(head).get(b"content-length", b"") if blank else b""
    return len(MAGIC) + len(head) + 4 + int(size) + 4 if _SIZE.match(size) else None


def _record(body: bytes) -> tuple:
    """page id, payload size, digest, type, refers_to, url, payload of a whole record."""
    head, _, rest = body.partition(b"\r\n\r\n")
    fields, block = _fields(head), rest[:-4]
    http, _, payload = block.partition(b"\r\n\r\n")

    def page(name: bytes) -> int | None:
        found = _PAGE.match(fields.get(name, b""))
        i = int(found[1]) if found else None
        return i if found and -1 << 63 <= i < 1 << 63 else None

    kind = fields.get(b"warc-type", b"").decode("utf-8", "replace")
    if kind == "response":
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    else:  # what the record states of the payload it leaves out
        stated = _fields(http).get(b"content-length", b"")
        size = int(stated) if _SIZE.match(stated) else None
        found = _DIGEST.match(fields.get(b"warc-payload-digest", b""))
        digest, payload = found[1].decode() if found else None, None
    return (page(b"warc-record-id"), size, digest, kind, page(b"warc-refers-to"),
            fields.get(b"warc-target-uri", b"").decode("utf-8", "replace"), payload)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """fid (hash of the file's path), block (start of the split) and body, in file order
    inside a split: what precedes the first magic of a file, then what follows each."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.xxhash64("_metadata.file_path").alias("fid"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("body"))


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[int]]]:
    """The batches with each line's distance from its split's first line."""
    now, at = None, 0
    for b in batches:
        rel = []
        for fid, block, body in zip(b["fid"], b["block"], b["body"]):
            if (fid, block) != now:
                now, at = (fid, block), 0
            rel.append(at)
            at += len(body) + len(MAGIC)
        yield b, rel


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """fid, block, rel, ``off`` (null-free; -10 for what precedes the first magic),
    ``size`` and ``succ`` of every line: numbers only."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, rel in _numbered(batches):
            yield pd.DataFrame({
                "fid": b["fid"], "block": b["block"], "rel": rel,
                "size": [len(x) for x in b["body"]],
                "extent": pd.array([_extent(x) for x in b["body"]], dtype="Int64")})

    found = written(_lines(spark, path).mapInPandas(
        run, "fid long, block long, rel long, size long, extent long"), "warc-lines")
    before = Window.partitionBy("fid").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = found.groupBy("fid", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    bases = bases.select("fid", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0))
                         .alias("base"))
    off = F.col("base") + F.col("rel") - len(MAGIC)
    return written(found.join(bases, ["fid", "block"]).select(
        "fid", "block", "rel", off.alias("off"), "size",
        F.when(off >= 0, off + F.col("extent")).alias("succ")), "warc-candidates")


def reachable(nodes: DataFrame) -> DataFrame:
    """(fid, off) of the candidates that the chain from offset 0 reaches."""
    state = written(nodes.select("fid", "off", F.col("succ").alias("jump"),
                                 (F.col("off") == 0).alias("reached")), "warc-jump")
    count = state.where("reached").count()
    while True:
        target = state.select("fid", F.col("off").alias("jump"), F.col("jump").alias("far"))
        jumped = state.join(target, ["fid", "jump"], "left").select(
            "fid", "off", F.col("far").alias("jump"), "reached", F.lit(True).alias("own"))
        marks = state.where(F.col("reached") & F.col("jump").isNotNull()).select(
            "fid", F.col("jump").alias("off"), F.lit(None).cast("long").alias("jump"),
            F.lit(True).alias("reached"), F.lit(False).alias("own"))
        state = written(
            jumped.unionByName(marks).groupBy("fid", "off")
            .agg(F.max("jump").alias("jump"), F.max("reached").alias("reached"),
                 F.max("own").alias("own")).where("own").drop("own"), "warc-jump")
        now = state.where("reached").count()
        if now == count:
            return state.where("reached").select("fid", "off")
        count = now


_OUT = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, url string, payload binary")
_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    # no float on the way: it would round ids beyond 2 ** 53
    out = pd.DataFrame(rows, columns=_NAMES, dtype=object)
    for c in ("page_id", "payload_bytes", "refers_to"):
        out[c] = pd.array(out[c].to_list(), dtype="Int64")
    return out


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record: page id, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``, ``url``, ``payload`` (bytes; null for a revisit,
    or if not asked for)."""
    found = candidates(spark, path)
    real = reachable(found.where("off >= 0")).withColumn("real", F.lit(True))
    upto = Window.partitionBy("fid").orderBy("off")
    start = F.last(F.when(F.col("real"), F.col("off")), ignorenulls=True).over(upto)
    owned = found.join(real, ["fid", "off"], "left").select(
        "fid", "block", "rel", "off", "real", start.alias("start"))
    # pieces that no record owns, or of records in several pieces
    pieces = F.count(F.lit(1)).over(Window.partitionBy("fid", "start"))
    odd = written(owned.withColumn("pieces", pieces).where("start is null or pieces > 1")
                  .select("fid", "block", "rel", "off", "start"), "warc-odd")
    held = bloom_bitmap(odd.select(F.xxhash64("fid", "block", "rel")), odd.count())
    key = F.xxhash64("fid", "block", "rel").alias("key")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, rel in _numbered(batches):
            yield b.assign(rel=rel)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            maybe = in_bloom(held.value, b["key"].to_numpy().view(np.uint64))
            rows = [(None,) * 7 if odd_one else _record(body)
                    for odd_one, body in zip(maybe, b["body"])]
            out = _frame([r if with_payload else (*r[:6], None) for r in rows])
            out["fid"], out["block"], out["rel"] = b["fid"], b["block"], b["rel"]
            out["piece"] = b["body"].where(maybe, None)
            yield out

    lines = _lines(spark, path).mapInPandas(number, "fid long, block long, body binary, rel long")
    read = written(lines.select("fid", "block", "rel", "body", key).mapInPandas(
        parse, f"{_OUT}, fid long, block long, rel long, piece binary"), "warc-records")
    whole = read.where("piece is null").select(*_NAMES)
    # a piece that the filter holds by mistake is a whole record of its own
    parts = read.where("piece is not null").select("fid", "block", "rel", "piece").join(
        odd.withColumn("known", F.lit(True)), ["fid", "block", "rel"], "left")
    alone = F.col("known").isNull()
    parts = parts.where(alone | F.col("start").isNotNull()).select(
        "fid", F.when(alone, F.struct("block", "rel")).alias("own"), "start", "off", "piece")

    def assemble(pdf: pd.DataFrame) -> pd.DataFrame:
        body = MAGIC.encode().join(pdf.sort_values("off")["piece"])
        row = _record(body)
        return _frame([row if with_payload else (*row[:6], None)])

    return whole.unionByName(parts.groupBy("fid", "own", "start").applyInPandas(assemble, _OUT))


def broken_files(spark: SparkSession, path: str) -> DataFrame:
    """Files whose chain does not end at their last byte: file, ``bytes`` (of the
    uncompressed file) and ``chain_end``."""
    found = candidates(spark, path)
    names = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file")).distinct()
    ends = found.join(reachable(found.where("off >= 0")), ["fid", "off"]).groupBy("fid").agg(
        F.max("succ").alias("chain_end"))
    sizes = found.groupBy("fid").agg((F.sum(F.col("size") + len(MAGIC)) - len(MAGIC)).alias("bytes"))
    return (names.withColumn("fid", F.xxhash64("file")).join(sizes, "fid")
            .join(ends, "fid", "left").where(~F.col("bytes").eqNullSafe(F.col("chain_end")))
            .select("file", "bytes", "chain_end"))


def round_trip(pages: DataFrame, with_payload: bool = True, **columns) -> DataFrame:
    """Write the pages to a fresh archive in the shared folder and read it back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, **columns)
    return read_archives(spark, path, with_payload)
