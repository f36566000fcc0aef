"""Which stored files may hold a batch's keys: one index row a file (K7, ST1).

Every batch folder of a target is written range-partitioned by key, and its index says of
each file how many keys it holds, the least and greatest first key, and a Bloom filter
over the whole keys (16 bits and 4 probes a key). A later batch tests its keys against
the index, in tasks that read index rows only, and opens the files that remain. A filter
never misses a key that is there; one it lets through by mistake costs a file read, no
wrong row."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import MAX_BROADCAST_KEYS
from ..small_files import Folder

BITS_A_KEY, PROBES = 16, 4
ROWS_A_FILE = 1_000_000  # what a task gathers to build one filter


def _hashes(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys]).alias("h")


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    """The filter's bits of each key: double hashing on the two halves of its hash."""
    h = h.astype(np.int64).view(np.uint64)
    a, b = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return (a[:, None] + np.arange(PROBES, dtype=np.uint64) * b[:, None]) % np.uint64(bits)


def _filter(h: np.ndarray) -> bytes:
    bits = max(64, BITS_A_KEY * len(h) + 7 & ~7)
    field = np.zeros(bits, dtype=np.uint8)
    field[_places(h, bits).ravel().astype(np.int64)] = 1
    return np.packbits(field).tobytes()


def _any_in(bloom: bytes, h: np.ndarray) -> bool:
    field = np.frombuffer(bloom, dtype=np.uint8)
    at = _places(h, 8 * len(field)).astype(np.int64)
    return bool(((field[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1).any())


def index_path(target: str) -> str:
    return f"{target.rstrip('/')}_index"


def build(spark: SparkSession, target: str, schema: T.StructType, keys: list[str], batch: int) -> None:
    """The index of a batch's files; the folder is overwritten if the batch runs again."""
    stored = spark.read.schema(schema).parquet(f"{target}/_batch={batch}")
    rows = stored.select(F.col("_metadata.file_path").alias("file"), F.col(keys[0]).alias("key"), _hashes(keys))
    kind = T.StructType([T.StructField("file", T.StringType()), T.StructField("n", T.LongType()),
                         T.StructField("lo", rows.schema["key"].dataType),
                         T.StructField("hi", rows.schema["key"].dataType),
                         T.StructField("bloom", T.BinaryType())])

    def one(table: pa.Table) -> pa.Table:
        ends = pc.min_max(table["key"])
        bloom = _filter(table["h"].to_numpy())
        return pa.table({"file": table["file"].slice(0, 1), "n": pa.array([len(table)], pa.int64()),
                         "lo": pa.array([ends["min"].as_py()], table["key"].type),
                         "hi": pa.array([ends["max"].as_py()], table["key"].type),
                         "bloom": pa.array([bloom], pa.binary())})

    # a file's keys are gathered to build its filter: files hold ROWS_A_FILE rows at most
    rows.groupBy("file").applyInArrow(one, kind).write.mode("overwrite").parquet(
        f"{index_path(target)}/_batch={batch}")


def files_to_open(spark: SparkSession, target: str, rows: DataFrame, keys: list[str], batch: int) -> list[str]:
    """The stored files, of other batches than ``batch``, that may hold a key of ``rows``.

    Batches without an index are opened whole. More keys than a broadcast may hold are
    compared by their least and greatest key only."""
    stored = [n for n in Folder(spark, target).names() if n.startswith("_batch=") and n not in (
        "_batch=-1", f"_batch={batch}")]
    indexed = set(Folder(spark, index_path(target)).names())
    out = [f"{target}/{n}" for n in stored if n not in indexed]
    n, low, high = rows.agg(F.count(F.lit(1)), F.min(keys[0]), F.max(keys[0])).first()
    folders = [f"{index_path(target)}/{n}" for n in stored if n in indexed]
    if not folders or not n:
        return out if n else []
    index = spark.read.option("basePath", index_path(target)).parquet(*folders)
    near = index.where((F.col("lo") <= F.lit(high)) & (F.col("hi") >= F.lit(low)))
    if n > MAX_BROADCAST_KEYS:
        return out + [unquote(r.file) for r in near.select("file").toLocalIterator()]
    table = rows.select(F.col(keys[0]).alias("key"), _hashes(keys)).toArrow().sort_by("key")  # n is checked
    shared = spark.sparkContext.broadcast((table["key"].to_pylist(), table["h"].to_numpy()))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_left, bisect_right

        asked, h = shared.value
        for b in batches:
            hit = []
            for lo, hi, bloom in zip(*(b.column(c).to_pylist() for c in ("lo", "hi", "bloom"))):
                i, j = bisect_left(asked, lo), bisect_right(asked, hi)
                hit.append(j > i and _any_in(bloom, h[i:j]))
            yield pa.RecordBatch.from_arrays([b.column("file").filter(pa.array(hit, pa.bool_()))], names=["file"])

    found = near.select("file", "lo", "hi", "bloom").mapInArrow(test, "file string")
    out += [unquote(r.file) for r in found.toLocalIterator()]  # the scan gives paths as URLs
    shared.unpersist()
    return out
