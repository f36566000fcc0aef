"""Paging, resume and sharding."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import small_files
from ..functions.cleaning import name_part
from .keys import surrogate_key


def page(df: DataFrame, key: str, n: int, offset: int = 0) -> DataFrame:
    """L2: ``LIMIT n OFFSET m``, with the ORDER BY the reference left out added
    so pages are reproducible. A first page is a top-k (``TakeOrderedAndProject``:
    ``n`` rows a task); an offset is a range of the distributed dense key, so no task
    holds the rows that are skipped."""
    if not offset:
        return df.orderBy(F.col(key).asc_nulls_last()).limit(n)
    ranked = surrogate_key(df, key, "_rn")
    return ranked.where((F.col("_rn") > offset) & (F.col("_rn") <= offset + n)).drop("_rn")


def keyset_page(df: DataFrame, key: str, cursor, n: int) -> DataFrame:
    """L3: the next ``n`` rows after ``cursor`` in key order; the new cursor is
    the page's ``max(key)``. The predicate reaches the scan."""
    rows = df.where(F.col(key) > F.lit(cursor)) if cursor is not None else df
    return rows.orderBy(F.col(key)).limit(n)


def next_cursor(page_df: DataFrame, key: str):
    return page_df.agg(F.max(key)).first()[0]


def pending(df: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """L4: keys not yet in the status log (resume after a stop)."""
    return df.join(log.select(key), key, "left_anti")


def shard(df: DataFrame, key: str, n: int, name: str = "shard") -> DataFrame:
    """Contiguous shards in key order, ``total // n`` rows each, the
    remainder to the last shard. Positions come from the distributed dense key
    (no single-partition window), and so does the total."""
    ranked = surrogate_key(df, key, "_rn")
    total = ranked.agg(F.max("_rn")).first()[0] or 0
    size = max(total // n, 1)
    s = F.least(F.floor((F.col("_rn") - 1) / F.lit(size)), F.lit(n - 1)).cast("int")
    return ranked.select(*df.columns, s.alias(name))


def range_shard(df: DataFrame, key: str, starts: list[int], name: str = "shard") -> DataFrame:
    """Shard by fixed start ids: shard i holds keys in [starts[i], starts[i+1])."""
    expr = F.lit(None).cast("int")
    for i, s in enumerate(starts):
        expr = F.when(F.col(key) >= F.lit(s), F.lit(i)).otherwise(expr)
    return df.withColumn(name, expr)


def block_number(c, sep: str = "_") -> F.Column:
    """The number at the end of a block file name, e.g. ``block_games_1_30.csv`` -> 30."""
    last = name_part(c, sep, -1)
    return F.split(last, r"\.").getItem(0).try_cast("bigint")


def last_block(df: DataFrame, name_col: str, by: list[str] | None = None) -> DataFrame:
    """Numeric (not text) order on the number inside a name; take the last.
    ``max_by`` is an aggregate, so it combines map-side per group."""
    agg = [F.max_by(F.col(name_col), block_number(F.col(name_col))).alias("last_block"),
           F.max(block_number(F.col(name_col))).alias("last_processed")]
    return df.groupBy(*(by or [])).agg(*agg)


def union_blocks(*dfs: DataFrame) -> DataFrame:
    """Union by column name of old and new blocks; columns missing in
    a block come out NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """The fields of both by name, those of ``old`` first."""
    known = {f.name: f for f in old}
    for f in new:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()} in earlier blocks, "
                             f"{f.dataType.simpleString()} in this one")
    return T.StructType([T.StructField(f.name, f.dataType) for f in
                         [*old, *(f for f in new if f.name not in known)]])


def block_manifest(spark, folder: str) -> dict | None:
    """The newest manifest of a folder of blocks: one small file that lists them all."""
    numbers = small_files.numbers(small_files.Folder(spark, folder).names("_blocks"), ".json")
    if not numbers:
        return None
    return json.loads(spark.read.text(f"{folder}/_blocks/{numbers[-1]}.json", wholetext=True).first()[0])


def read_blocks(spark, folder: str) -> DataFrame:
    """Every block, with one schema (columns that a block lacks come out NULL).
    The manifest names the blocks and the schema, so no footer is read to find either."""
    listed = block_manifest(spark, folder)
    if listed is None:
        raise LookupError(f"{folder} has no block")
    paths = [f"{folder}/block_{b['number']}" for b in listed["blocks"]]
    return spark.read.schema(T.StructType.fromJson(listed["schema"])).parquet(*paths)


def append_block(spark, folder: str, new: DataFrame, number: int, per_file: int | None = None) -> DataFrame:
    """Write the next block file and read every block back, old and new, with
    one schema (columns that older blocks lack come out NULL).

    A block counts from the moment the manifest names it; the manifest after it lists
    the blocks before and this one (number, rows) and their common schema."""
    before = block_manifest(spark, folder) or {"blocks": [], "schema": T.StructType([]).jsonValue()}
    if number <= max((b["number"] for b in before["blocks"]), default=-1):
        raise ValueError(f"block {number} is not after the last one")
    schema = _merged(T.StructType.fromJson(before["schema"]), new.schema)
    path = f"{folder}/block_{number}"
    new.write.option("maxRecordsPerFile", per_file or 0).mode("errorifexists").parquet(path)
    rows = spark.read.schema(new.schema).parquet(path).count()
    files = small_files.Folder(spark, folder)
    files.publish(f"_blocks/{number}.json", json.dumps({
        "blocks": [*before["blocks"], {"number": number, "rows": rows}], "schema": schema.jsonValue()}))
    return read_blocks(spark, folder)
