"""File sources S1-S7 and S13.

Every reader declares its schema (no inference in production) and can attach
the file path and a within-file order key. Spark's CSV/JSON scans expose no row
index, so the order key is ``(file path, split start, position in split)``:
within one file, splits are ordered by their start offset and rows inside a split
are read in line order, which is all first-wins loads (K7) and footer drops
(S5) need -- and files stay splittable.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookup import look_up
from ..schemas import CATALOGUE_SCHEMA, METRICS_TEXT_SCHEMA
from ..session import checked_broadcast, evaluate_once, materialize
from .variant import is_object, typed_row


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``file_path`` and ``line_no`` (increasing in file order within each file)."""
    mid = F.monotonically_increasing_id()
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        (F.col("_metadata.file_block_start") * F.lit(1 << 20)
         + mid.bitwiseAND(F.lit((1 << 33) - 1))).alias("line_no"),
    )


CORRUPT = "_corrupt_record"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """``schema`` plus a text column that receives lines the reader cannot parse."""
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, rejected raw lines) of a read made with ``with_corrupt_column``."""
    return (df.where(F.col(CORRUPT).isNull()).drop(CORRUPT),
            df.where(F.col(CORRUPT).isNotNull()))


def read_metrics_csv(spark: SparkSession, path: str, schema: T.StructType = METRICS_TEXT_SCHEMA,
                     with_order: bool = False, rejects: bool = False, **options) -> DataFrame:
    """Comma CSV files with a header, declared schema, globbed or
    discovered recursively (``recursiveFileLookup`` + ``pathGlobFilter``). With
    ``rejects`` a line whose values do not fit the schema keeps its raw text in
    ``_corrupt_record`` instead of silently becoming NULLs."""
    if rejects:
        schema = with_corrupt_column(schema)
        options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE", **options}
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(path)
    return with_file_order(df) if with_order else df


def read_catalogue_json(spark: SparkSession, path: str,
                        schema: T.StructType = CATALOGUE_SCHEMA, with_order: bool = False,
                        rejects: bool = False, **options) -> DataFrame:
    """Pretty-printed JSON arrays of objects (``multiLine``), any depth of
    glob. An empty array file contributes no rows. With ``rejects`` an
    unparsable file or record lands in ``_corrupt_record``."""
    if rejects:
        schema = with_corrupt_column(schema)
        options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE", **options}
    reader = spark.read.schema(schema).option("multiLine", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.json(path)
    return with_file_order(df) if with_order else df


def read_catalogue_variant(spark: SparkSession, path: str,
                           schema: T.StructType = CATALOGUE_SCHEMA, **options) -> DataFrame:
    """S2 with absent fields kept apart from explicit nulls: the declared columns, then
    ``absent`` (names of the fields a record lacks), ``unfit`` (its first field whose
    value does not convert), ``file_path`` and ``line_no`` (the record's place in its
    file). A file that is no JSON, or an item that is no object, is one row whose
    ``unfit`` is ``record``; an empty array gives none."""
    reader = spark.read.option("multiLine", True).option("singleVariantColumn", "v")
    for k, v in options.items():
        reader = reader.option(k, v)
    whole = reader.json(path).select("v", F.col("_metadata.file_path").alias("file_path"))
    items = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    rows = whole.select("file_path", F.posexplode(items).alias("line_no", "v"))
    *columns, lacking, wrong = typed_row(F.col("v"), schema)
    no_record = ~is_object(F.col("v"))
    # converted once per record, whatever reads the columns afterwards
    return evaluate_once(rows.select(
        *columns, lacking, F.when(no_record, F.lit("record")).otherwise(wrong).alias("unfit"),
        "file_path", F.col("line_no").cast("bigint").alias("line_no")))


def read_keyed_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   key_regex: str = r"(\d+)_[^/]*$", key_name: str = "appid",
                   drop_footer: bool = False, **options) -> DataFrame:
    """Per-entity CSV files whose key is taken from the file path.

    ``path`` may hold globs over worker directories (``instance_*/players``);
    directories that do not exist contribute nothing, also if none of them does.
    With ``drop_footer`` the last data line of every file is dropped (S5)."""
    reader = (spark.read.schema(schema).option("header", True).option("sep", sep)
              .option("ignoreMissingFiles", True))
    for k, v in options.items():
        reader = reader.option(k, v)
    try:
        df = with_file_order(reader.csv(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        columns = T.StructType([*schema.fields, T.StructField("file_path", T.StringType()),
                                T.StructField("line_no", T.LongType())])
        df = spark.createDataFrame([], columns)
    df = df.withColumn(key_name, F.regexp_extract("file_path", key_regex, 1).try_cast("bigint"))
    if drop_footer:
        df = drop_last_per_group(df, "file_path", "line_no")
    return df


def drop_last_per_group(df: DataFrame, group: str, order: str) -> DataFrame:
    """drop the last row of each group in ``order``.

    Last rows are found split by split: every task keeps the largest ``order`` of each
    group it meets, and the few rows that leaves (one a group and split) are reduced to
    one a group and checkpointed. That table is broadcast behind a size check, else
    looked up by salted keys, so the lines of a file that holds a third of them all stay
    spread over its splits."""
    last = materialize(df.groupBy(group).agg(F.max(order).alias("_last")).where(F.col(group).isNotNull()))
    small = checked_broadcast(last, otherwise=None)
    flagged = (df.join(small, group) if small is not None
               else look_up(df, last, [group], F.col(order)))
    return flagged.where(F.col(order) < F.col("_last")).select(*[F.col(f"`{c}`") for c in df.columns])


def read_semicolon_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: ';'-separated CSV with a header."""
    return spark.read.schema(schema).option("header", True).option("sep", ";").csv(path)
