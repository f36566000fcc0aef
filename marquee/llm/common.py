"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.lookup import look_up  # noqa: F401
from marquee.session import scratch_path

# The word alphabet of every operator: runs of anything but ASCII white space.
WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\f\r"


ARROW_ROWS = "1000"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers import the operators' functions from where the driver has them
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    # documents are long: small Arrow batches keep what a Python worker holds small
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def words(text: Column) -> Column:
    """The words of a text; null has none. Only the ends of a split can be empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder, read back.

    Cuts the lineage: what a task committed is what every later reader sees,
    whichever executors are lost afterwards."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give what a finished task of a Python worker has freed back to the system: idle
    workers otherwise keep what their longest texts took."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not this allocator: nothing to give back


def crc32_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


BLOOM_CHUNK_BITS = 18  # a bitmap is built in pieces of 2 ** 18 bits
BLOOM_MAX_BITS = 28    # and never exceeds 2 ** 28 bits (32 MB)


def bloom_bitmap(keys: DataFrame, n: int):
    """A Bloom filter (two probes) over a long column of uniform hashes, as packed
    bytes: 16 bits a key, bounded at 2 ** BLOOM_MAX_BITS bits whatever ``n`` is.

    It only spares work: what it lets through by mistake, a join behind it drops."""
    import numpy as np
    import pandas as pd

    bits = min(BLOOM_MAX_BITS, max(BLOOM_CHUNK_BITS, (16 * max(1, n)).bit_length()))
    k = F.col(keys.columns[0])
    places = F.explode(F.array(F.shiftrightunsigned(k, 64 - bits),
                               k.bitwiseAND(F.lit((1 << bits) - 1))))
    spots = keys.select(places.alias("at")).select(
        F.shiftright("at", BLOOM_CHUNK_BITS).alias("chunk"),
        F.col("at").bitwiseAND(F.lit((1 << BLOOM_CHUNK_BITS) - 1)).cast("int").alias("bit"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        field = np.zeros(1 << BLOOM_CHUNK_BITS, dtype=np.uint8)
        field[pdf["bit"].to_numpy()] = 1
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "field": [np.packbits(field).tobytes()]})

    step = 1 << (BLOOM_CHUNK_BITS - 3)
    bitmap = np.zeros(1 << (bits - 3), dtype=np.uint8)
    # distinct spots: a chunk receives at most 2 ** BLOOM_CHUNK_BITS of them
    for r in spots.distinct().groupBy("chunk").applyInPandas(
            pack, "chunk long, field binary").toLocalIterator():
        bitmap[r.chunk * step:(r.chunk + 1) * step] = np.frombuffer(r.field, dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def in_bloom(bitmap, keys):
    """Which of the hashes (a numpy array of 64-bit integers) the filter may hold."""
    import numpy as np

    k = keys.astype(np.uint64, copy=False)
    bits = len(bitmap).bit_length() + 2
    hit = np.ones(len(k), dtype=bool)
    for at in (k >> np.uint64(64 - bits), k & np.uint64((1 << bits) - 1)):
        hit &= (bitmap[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return hit


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) of every node of the edges (long columns ``x``, ``y``): the
    smallest node of its connected component.

    Alternating large-star and small-star steps over the whole edge set until it
    no longer changes; hot centres are looked up by salted keys, never gathered."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("x", "y").union(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
        near = both if large else both.where("y < x")
        least = near.groupBy("x").agg(F.min("y").alias("m")).select(
            "x", F.least("x", "m").alias("m"))
        own = look_up(near, least, ["x"], F.col("y"))
        if large:
            out = own.where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        else:
            out = own.select(F.col("y").alias("x"), F.col("m").alias("y")).union(
                least.select("x", F.col("m").alias("y")))
        return out.where("x <> y").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()

    state = written(edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
                    .where("x <> y").distinct(), name)
    before = mark(state)
    while before[0]:
        state = written(star(star(state, True), False), name)
        after = mark(state)
        if after == before:
            break
        before = after
    return state.select(F.col("x").alias("node"), F.col("y").alias("comp")).union(
        state.select(F.col("y").alias("node"), F.col("y").alias("comp")).distinct())
