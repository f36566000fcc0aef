"""Sharding by a two-pass external shuffle.

Pass one scatters the records into memory-sized buckets by seeded hashes; pass
two loads one bucket at a time, Fisher-Yates shuffles it (Spark's ``shuffle``)
and writes it. A shard is a fixed set of buckets, as many as its own bytes and
rows need. ``write_shards`` writes the whole records, a folder a shard, and
``read_shards`` reads places, sizes and CRCs back from what was written.

Law ``key``: the shard depends on the id and the shard count only. Shard number
``j`` takes an id from the shards below with probability 1/(j + 1) by the hash
of (seed, id, j), and the last shard that takes it has it; so one more shard
moves rows only into itself, and all shards expect the same share. Inside a
shard, a record's bucket comes from a hash of id, size and CRC, so neither a hot
id nor equal texts meet in one bucket. If rows equal in all three could fill a
bucket, the rows are numbered first and the hash takes in the number.

Defined cases: a null text has size 16 and the CRC of no bytes; a null id is a
value like any other; repeated rows get slots of their own, which of them gets
which is open; an empty table gives an empty table; other columns are ignored
unless named in ``carry``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marquee.session import checked_broadcast

from .common import written

ROW_OVERHEAD = 16
LUMP = 4             # equal rows that could fill 1 / LUMP of a bucket are spread
TASKS = 10_000       # buckets are written by at most this many tasks
SORTED_LISTS = "spark.sql.execution.useObjectHashAggregateExec"


def shard_of(key: Column, n_shards: int, seed: int = 0) -> Column:
    """The shard (0 .. n_shards - 1) of a key; see the module's law."""
    takes = [F.when(F.pmod(F.xxhash64(F.lit(seed), key, F.lit(j)), F.lit(j + 1)) == 0, F.lit(j))
             .otherwise(F.lit(0)) for j in range(1, n_shards)]
    return F.greatest(F.lit(0), F.lit(0), *takes).cast("int")


def _size(data: Column) -> Column:
    return (F.length(data) + ROW_OVERHEAD).cast("long")


def _bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def scattered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              n_shards: int = 40, seed: int = 17, bucket_bytes: int = 64 << 20,
              bucket_rows: int = 50_000, carry: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """Pass one: every row's ``shard``, its ``bucket`` (numbered over all shards) and
    ``r``, the row itself; and the number of buckets."""
    data = _bytes(docs[text_col])
    record = [F.struct(*[docs[c] for c in carry]).alias("record")] if carry else []
    rows = docs.select(docs[id_col].alias("id"), _size(data).alias("size"),
                       F.crc32(data).alias("crc"), *record)
    shard = shard_of(F.col("id"), n_shards, seed).alias("shard")
    equal = rows.groupBy("id", "size", "crc").agg(F.count(F.lit(1)).alias("n"))
    many = F.when(F.col("n") > 1, F.col("n"))
    totals = {r.shard: r for r in equal.select(shard, "size", "n", many.alias("many")).groupBy("shard").agg(
        F.sum(F.col("n") * F.col("size")).alias("b"), F.sum("n").alias("n"),
        F.max(F.col("many") * F.col("size")).alias("lump_b"), F.max("many").alias("lump_n")).collect()}
    counts, starts, n_buckets = [], [], 0
    for k in range(n_shards):
        t = totals.get(k)
        counts.append(max(1, -(-t.b // bucket_bytes), -(-t.n // bucket_rows)) if t else 1)
        starts.append(n_buckets)
        n_buckets += counts[-1]
    number = F.lit(0).cast("long")
    if any(counts[k] > 1 and (LUMP * (t.lump_b or 0) > bucket_bytes
                              or LUMP * (t.lump_n or 0) > bucket_rows) for k, t in totals.items()):
        # written, so that a task that runs again sees the same numbers
        rows = written(rows.withColumn("number", F.monotonically_increasing_id()), "shuffle-numbered")
        number = F.col("number")
    mix = F.xxhash64(F.lit(seed), "crc", "size", "id")
    place = F.when(number > 0, F.xxhash64(number, mix)).otherwise(mix)
    of_shard = lambda values: F.get(F.lit(values), F.col("shard"))
    out = rows.select(shard, place.alias("place"), F.struct(
        place.alias("mix"), *[F.col(c) for c in ("id", "size", "crc")],
        *([F.col("record")] if carry else [])).alias("r"))
    return out.select("shard", (of_shard(starts) + F.pmod("place", of_shard(counts))).cast("int")
                      .alias("bucket"), "r"), n_buckets


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _in_order(rows: str, kind: T.DataType) -> Column:
    """A bucket's rows in an order that only its contents decide. Records that hold maps
    or variants have no order of their own and go by the hash that placed them; rows of
    one hash are equal in id, size and CRC."""
    if _orderable(kind):
        return F.array_sort(rows)
    return F.array_sort(rows, lambda a, b: F.when(a["mix"] < b["mix"], -1).when(a["mix"] > b["mix"], 1).otherwise(0))


def shuffled(rows: DataFrame, n_buckets: int, seed: int = 17) -> DataFrame:
    """Pass two: ``shard``, ``slot`` and ``r``. A task loads bucket after bucket."""
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = written(rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "shuffle-offsets")
    tasks = min(n_buckets, TASKS)
    loaded = rows.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)))
    # each bucket: an order that only its contents decide, then Fisher-Yates
    lists = (loaded.groupBy(F.pmod("bucket", F.lit(tasks)).alias("task"), "shard", "bucket")
             .agg(F.collect_list("r").alias("rs"))
             .select("shard", "bucket", F.shuffle(_in_order("rs", rows.schema["r"].dataType), seed).alias("rs")))
    return lists.join(checked_broadcast(offsets), "bucket").select(
        "shard", "offset", F.posexplode("rs").alias("pos", "r")).select(
        "shard", (F.col("offset") + F.col("pos")).cast("long").alias("slot"), "r")


@contextmanager
def _one_bucket_at_a_time(spark: SparkSession):
    """Lists are gathered by sorting: hashing would hold all buckets of a task."""
    before = spark.conf.get(SORTED_LISTS)
    spark.conf.set(SORTED_LISTS, "false")
    try:
        yield
    finally:
        spark.conf.set(SORTED_LISTS, before)


def _described(out: DataFrame, id_col: str, n_shards: int, seed: int) -> list[Column]:
    """The result's columns, from those of a placed row (id, size, crc, shard, slot)."""
    grown = F.when(F.pmod(F.xxhash64(F.lit(seed), F.col("id"), F.lit(n_shards)),
                          F.lit(n_shards + 1)) == 0, F.lit(n_shards)).otherwise(F.col("shard"))
    return [F.col("id").alias(id_col), F.col("size"), F.col("crc").alias("text_crc32"),
            F.lit("key").alias("law"), F.col("shard"), F.col("slot"),
            grown.cast("int").alias("grown_shard")]


def external_shuffle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     n_shards: int = 40, seed: int = 17, bucket_bytes: int = 64 << 20,
                     bucket_rows: int = 50_000, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``
    and the ``carry`` columns (in a struct ``record``) of every row.

    ``bucket_bytes`` and ``bucket_rows`` bound what one bucket is expected to
    hold; each shard's number of buckets follows from its own totals."""
    rows, n_buckets = scattered(docs, id_col, text_col, n_shards, seed, bucket_bytes,
                                bucket_rows, carry)
    with _one_bucket_at_a_time(docs.sparkSession):
        placed = written(shuffled(rows, n_buckets, seed), "shuffle-buckets")
    out = placed.select("shard", "slot", "r.*")
    return out.select(*_described(out, id_col, n_shards, seed), *(["record"] if carry else []))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 n_shards: int = 40, seed: int = 17, **options) -> None:
    """Write the whole records (``record``, with their ``slot``), one folder a shard, a
    file a bucket, in slot order: the buckets of a shard follow one another."""
    rows, n_buckets = scattered(docs, id_col, text_col, n_shards, seed,
                                carry=tuple(docs.columns), **options)
    with _one_bucket_at_a_time(docs.sparkSession):
        (shuffled(rows, n_buckets, seed).select("shard", "slot", "r.record")
         .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))


def read_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                n_shards: int = 40, seed: int = 17) -> DataFrame:
    """The columns of ``external_shuffle`` as the shards written from ``docs`` hold them:
    sizes and CRCs are those of the records' texts, shards those of their folders."""
    schema = docs.select(F.lit(0).cast("long").alias("slot"),
                         F.struct(*[docs[c] for c in docs.columns]).alias("record"),
                         F.lit(0).alias("shard")).schema
    back = docs.sparkSession.read.schema(schema).parquet(path)
    data = _bytes(back["record"][text_col])
    out = back.select(back["record"][id_col].alias("id"), _size(data).alias("size"),
                      F.crc32(data).alias("crc"), "shard", "slot")
    return out.select(*_described(out, id_col, n_shards, seed))


__all__ = ["external_shuffle", "read_shards", "shard_of", "write_shards"]
