"""Sinks K1-K6: tables and exports. Every write is a distributed write by the
executors; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import surrogate_key


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> None:
    """K1 / K2 / K6: create-or-replace a model as Parquet with its declared
    schema. ``sort_by`` gives a storage order (L1) -- not a contract."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_csv(df: DataFrame, path: str, by: list[str] | None = None, sep: str = ",",
               mode: str = "overwrite") -> None:
    """K3 / K5: CSV with a header; with ``by`` one folder per entity value."""
    w = df.write.mode(mode).option("header", True).option("sep", sep)
    if by:
        w = w.partitionBy(*by)
    w.csv(path)


def export_json(df: DataFrame, path: str, per_file: int | None = None,
                mode: str = "overwrite") -> None:
    """K4: JSON in numbered files of at most ``per_file`` records, UTF-8 text
    written as is (no ASCII escaping)."""
    w = df.write.mode(mode)
    if per_file:
        w = w.option("maxRecordsPerFile", per_file)
    w.json(path)


def export_batches(df: DataFrame, path: str, by: str, per_file: int, number: str = "batch",
                   mode: str = "overwrite") -> None:
    """K4: numbered JSON batches. Rows in ``by`` order are numbered 1..n over the whole
    table, and batch b holds the rows (b - 1) * per_file + 1 .. b * per_file: one file a
    batch, in the folder ``<number>=b``, and only the last one may hold fewer rows.

    A file is one JSON array with a record a line, null fields written out, text as is
    (no ASCII escaping). ``per_file`` bounds what a task holds for a batch."""
    ranked = surrogate_key(df, by, "_rn")
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    batch = F.floor((F.col("_rn") - 1) / F.lit(per_file)) + 1
    lines = ranked.select(batch.cast("int").alias(number), F.struct("_rn", record.alias("record")).alias("line"))
    arrays = lines.groupBy(number).agg(F.concat_ws(",\n", F.transform(
        F.array_sort(F.collect_list("line")), lambda x: x["record"])).alias("records"))
    arrays.select(number, F.concat(F.lit("[\n"), "records", F.lit("\n]")).alias("value")) \
        .write.mode(mode).partitionBy(number).text(path)


def table_writer(spark: SparkSession, root: str, partitions: dict[str, str] | None = None):
    """``write(name, df) -> df`` for ``build_warehouse``: write a model, hand
    back its read-back table so later models reuse it instead of recomputing.
    Models named in ``partitions`` are written partitioned by that column."""
    def write(name: str, df: DataFrame) -> DataFrame:
        path = f"{root}/{name}"
        by = (partitions or {}).get(name)
        write_table(df, path, partition_by=[by] if by else None)
        return read_back(spark, path)
    return write


def write_bucketed(df: DataFrame, name: str, path: str, by: str, buckets: int,
                   mode: str = "overwrite", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted on ``by`` (files at ``path``,
    registered in the session catalog) and return it read back. Tables bucketed
    on the same key with the same bucket count join without a shuffle."""
    w = df.write.mode(mode).option("path", path)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.bucketBy(buckets, by).sortBy(by).saveAsTable(name)
    return df.sparkSession.table(name)


def bucketed_writer(spark: SparkSession, root: str, buckets: dict[str, str], n: int,
                    prefix: str = "", partitions: dict[str, str] | None = None):
    """Like ``table_writer``; models named in ``buckets`` are written bucketed on
    their key, all with the same bucket count ``n``."""
    plain = table_writer(spark, root, partitions)

    def write(name: str, df: DataFrame) -> DataFrame:
        if name in buckets:
            return write_bucketed(df, f"{prefix}{name}", f"{root}/{name}", buckets[name], n,
                                  partition_by=(partitions or {}).get(name))
        return plain(name, df)
    return write
