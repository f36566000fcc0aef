"""Exact dedup by content sort.

Sampled splitters range-partition the rows by their (normalised) text, an
external sort inside each range places equal texts next to each other, and a
window compares every row with its neighbours on the full text and keeps one
row of each run.

The range key is (first 32 characters, hash of the whole text, salt): short, so
that the sampled splitters stay small however long the texts are, and equal for
equal texts, so that a run never crosses a range. A text that holds more than
1/512 of all rows -- at most 512 texts can -- is cut into 64 salted runs by id
hash; the runs of such a text, one row each, are then merged by its SHA-256. Where one
id has that many rows of such a text (a null id, a repeated row), the rows are numbered
in a written table first and salted by their number.

Defined cases: a null text counts as empty; rows equal in id and text are one
group like any other and exactly one of them is kept; a null id loses against
any other id, and a group with null ids only has a null ``keep_id`` and one
kept row; an empty table gives an empty table; other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

HEAVY_TEXTS = 512   # a text is hot when it holds more than 1/HEAVY_TEXTS of the rows
HEAVY_SALTS = 64    # runs that a hot text is cut into
PREFIX = 32         # characters of the text in the range key


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       keep: str = "min",
                       normalise: Callable[[Column], Column] | None = None,
                       carry: bool = False) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``
    and, with ``carry``, the input row as the struct ``record``.

    ``keep`` is ``"min"`` or ``"max"``: which id of a group of equal texts stays.
    ``normalise`` maps the text before it is compared (default: no change)."""
    text = F.coalesce(docs[text_col], F.lit(""))
    record = [F.struct(*[docs[c] for c in docs.columns]).alias("record")] if carry else []
    rows = docs.select(docs[id_col].alias("_id"),
                       (normalise(text) if normalise else text).alias("_t"), *record)
    rows = rows.withColumn("_fp", F.xxhash64("_t"))

    limit = max(1, docs.count() // HEAVY_TEXTS)
    hot = [r._fp for r in rows.groupBy("_fp").agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > limit).select("_fp").collect()]  # at most HEAVY_TEXTS
    is_hot = F.col("_fp").isin(hot) if hot else F.lit(False)
    spread = F.col("_id")
    if hot and rows.where(is_hot).groupBy("_fp", "_id").agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") > limit).count():
        rows = written(rows.withColumn("_no", F.monotonically_increasing_id()), "content-sort-rows")
        spread = F.col("_no")

    best = F.min if keep == "min" else F.max
    order = F.col("_id").asc_nulls_last() if keep == "min" else F.col("_id").desc_nulls_last()
    run = Window.partitionBy("_prefix", "_fp", "_salt", "_t")
    whole = run.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = (rows
            .withColumn("_prefix", F.substring("_t", 1, PREFIX))
            .withColumn("_hot", is_hot)
            .withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread, "_fp"),
                                                              F.lit(HEAVY_SALTS)))
                        .otherwise(F.lit(0)))
            .repartitionByRange("_prefix", "_fp", "_salt")
            .select("_id", "_hot", "_salt", F.sha2("_t", 256).alias("_sha"),
                    F.row_number().over(run.orderBy(order)).alias("_rank"),
                    best("_id").over(whole).alias("_run_keep"),
                    F.count(F.lit(1)).over(whole).alias("_run_size"),
                    *(["record"] if carry else [])))
    runs = written(runs, "content-sort-runs")

    # of the runs of a hot text, the one with the best id (then the least salt) keeps it
    known, first = (F.col("_run_keep").isNotNull(), -F.col("_salt"))
    if keep == "min":
        known, first = ~known, F.col("_salt")
    merged = (runs.where(F.col("_hot") & (F.col("_rank") == 1)).groupBy("_sha")
              .agg(best(F.struct(known.alias("k"), F.col("_run_keep").alias("id"),
                                 first.alias("salt"))).alias("_best"),
                   F.sum("_run_size").alias("_size"))
              .select("_sha", F.col("_best.id").alias("_keep"), "_size",
                      F.abs("_best.salt").alias("_keep_salt")))
    keep_id = F.when(F.col("_hot"), F.col("_keep")).otherwise(F.col("_run_keep"))
    return (runs.join(F.broadcast(merged), "_sha", "left")  # one row per hot text
            .select(F.col("_id").alias(id_col), keep_id.alias("keep_id"),
                    F.coalesce("_size", "_run_size").alias("group_size"),
                    (F.col("_id").eqNullSafe(keep_id) & (F.col("_rank") == 1)
                     & (~F.col("_hot") | (F.col("_salt") == F.col("_keep_salt")))).alias("kept"),
                    F.col("_sha").alias("text_sha256"), *(["record"] if carry else [])))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep: str = "min") -> DataFrame:
    """The documents that stay, one of each group of equal texts, with all their
    columns."""
    return content_sort_dedup(docs, id_col, text_col, keep, carry=True).where("kept").select(
        "record.*")
