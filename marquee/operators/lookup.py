"""Looking up one row per key without gathering a hot key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def look_up(left: DataFrame, right: DataFrame, keys: list[str], spread_by: Column,
            salts: int = 64) -> DataFrame:
    """``left`` with the columns of ``right`` (one row a key, or none: nulls).

    A plain join would send all left rows of a hot key to one task. Here the
    distinct (key, salt) pairs of the left side -- at most ``salts`` a key,
    combined in the map tasks -- fetch the right row, and the left rows join on
    (key, salt). Exact, and no decision depends on sizes."""
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    need = salted.select(*keys, "_salt").distinct().join(right, keys)
    return salted.join(need, [*keys, "_salt"], "left").drop("_salt")
