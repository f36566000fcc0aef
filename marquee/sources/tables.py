"""Table scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scan_table(df: DataFrame, columns: dict[str, str] | list[str],
               where: Column | None = None) -> DataFrame:
    """Projection (optionally renamed) with an optional predicate. Both are
    declared on the scan, so Parquet reads only these columns and receives the
    predicate as a pushed filter."""
    rows = df.where(where) if where is not None else df
    if isinstance(columns, dict):
        return rows.select(*[F.col(c).alias(a) for c, a in columns.items()])
    return rows.select(*columns)
