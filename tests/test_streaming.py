"""ST1: the incremental load picks up each new file once, survives restarts and
keeps first-wins semantics across micro-batches."""

import os

from pyspark.sql import functions as F

from marquee.streaming.incremental import read_target, run_incremental


def test_incremental_restart_and_first_wins(spark, tmp):
    schema = "k bigint, ts timestamp_ntz, v string"
    src, target, ckpt = (os.path.join(tmp, d) for d in ("src", "target", "ckpt"))

    def drop(name, rows):  # new files land directly in the source folder
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    import datetime as dt
    t = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    args = dict(schema=spark.createDataFrame([], schema).schema, target=target,
                checkpoint=ckpt, keys=["k"], order=["ts"])
    drop("d1", [(1, t[1], "a-late"), (1, t[0], "a-first"), (2, t[0], "b")])
    run_incremental(spark, src, **args)
    run_incremental(spark, src, **args)          # nothing new: no change
    assert read_target(spark, target).count() == 2
    drop("d2", [(1, t[0], "a-again"), (3, t[2], "c"), (3, t[3], "c-late")])
    run_incremental(spark, src, **args)
    rows = {r.k: r.v for r in read_target(spark, target).collect()}
    assert rows == {1: "a-first", 2: "b", 3: "c"}  # stored keys are never replaced
    assert read_target(spark, target).groupBy("k").count().where(F.col("count") > 1).count() == 0


def test_incremental_refuses_null_keys_and_reports_a_failing_target(spark, tmp):
    import datetime as dt

    import pytest
    schema = "k bigint, ts timestamp_ntz, v string"
    src, target, ckpt = (os.path.join(tmp, d) for d in ("src", "target", "ckpt"))
    t = dt.datetime(2024, 1, 1)
    args = dict(schema=spark.createDataFrame([], schema).schema, target=target,
                checkpoint=ckpt, keys=["k"], order=["ts"])
    for n in range(2):
        spark.createDataFrame([(None, t, f"none {n}"), (7, t, f"seven {n}"), (8 + n, t, "x")], schema) \
            .coalesce(1).write.mode("append").parquet(src)
        run_incremental(spark, src, **args)
    assert sorted((r.k, r.v) for r in read_target(spark, target).collect()) == [
        (7, "seven 0"), (8, "x"), (9, "x")]
    assert sorted(r.v for r in read_target(spark, f"{target}_rejects").collect()) == ["none 0", "none 1"]
    # a stored file that cannot be read fails the batch instead of passing for "no target"
    stored = next(p for p in __import__("pathlib").Path(target, "_batch=0").glob("*.parquet"))
    good = stored.read_bytes()
    stored.write_bytes(b"broken")
    crc = stored.with_name(f".{stored.name}.crc")
    if crc.exists():
        crc.unlink()
    spark.createDataFrame([(7, t, "again")], schema).coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception):
        run_incremental(spark, src, **args)
    stored.write_bytes(good)
    run_incremental(spark, src, **args)
    assert read_target(spark, target).where("k = 7").count() == 1
