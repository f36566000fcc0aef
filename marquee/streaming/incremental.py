"""ST1: incremental bronze load on Structured Streaming.

New files dropped into the source folder are picked up once (the file source
remembers what it has read in its checkpoint), each micro-batch is appended to
the target with insert-ignore semantics (K7: first row per key wins, keys
already stored are skipped, rows without a key go to the rejects). The stored
keys are read between the batch's least and greatest key only and filtered by a
broadcast of the batch's keys (behind a size check), never shuffled whole.
``availableNow`` processes whatever has arrived and stops, so a scheduled job
resumes exactly where the last run ended, and a lost executor only re-runs the
failed micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.loads import first_per_key, has_key
from ..session import checked_broadcast
from . import key_index


def run_incremental(spark: SparkSession, source: str, schema: T.StructType, target: str,
                    checkpoint: str, keys: list[str], order: list[str],
                    fmt: str = "parquet", options: dict | None = None,
                    rejects: str | None = None) -> None:
    """Process every file not yet seen under ``source`` into ``target``; rows without
    a key are written to ``rejects`` (default: ``target`` + ``_rejects``)."""
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source)
    rejects = rejects or f"{target.rstrip('/')}_rejects"
    # the target exists from the start, so that any failure to read it is an error
    nothing = spark.createDataFrame([], schema)
    for folder in (target, rejects):
        nothing.write.mode("ignore").parquet(f"{folder}/_batch=-1")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        rows = first_per_key(batch.where(has_key(keys)), keys, order).persist()
        # keys of earlier batches only: a re-run of this batch must not see its own
        # partial output
        may_hold = key_index.files_to_open(spark, target, rows, keys, batch_id)
        stored = spark.read.schema(schema).parquet(*may_hold) if may_hold else nothing
        hits = stored.select(*keys).join(checked_broadcast(rows.select(*keys)), keys, "left_semi")
        # one folder per batch id, overwritten on a re-run: idempotent
        # files of disjoint key ranges, so that the index rules most of them out later
        (rows.join(hits, keys, "left_anti").repartitionByRange(*keys).write.mode("overwrite")
         .option("maxRecordsPerFile", key_index.ROWS_A_FILE).parquet(f"{target}/_batch={batch_id}"))
        key_index.build(spark, target, schema, keys, batch_id)
        batch.where(~has_key(keys)).write.mode("overwrite").parquet(f"{rejects}/_batch={batch_id}")
        rows.unpersist()
        batch.unpersist()

    q = (stream.writeStream.foreachBatch(upsert)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()


def read_target(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("_batch")
