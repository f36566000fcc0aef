"""Row predicates (F3-F8) and name matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import clean_name

# Release-date words that mark an unreleased title.
UNRELEASED_TERMS = ("coming", "soon", "tba", "to be announced", "announced")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unreleased(date_text, coming_soon=None) -> Column:
    """date text empty/NULL, or containing an unreleased term (any case), or
    a ``coming_soon`` flag that is not false (absent counts as true)."""
    t = F.lower(_c(date_text))
    hit = F.lit(False)
    for term in UNRELEASED_TERMS:
        hit = hit | t.contains(term)
    cond = _c(date_text).isNull() | (_c(date_text) == "") | hit
    if coming_soon is not None:
        cond = cond | (F.coalesce(_c(coming_soon), F.lit(True)) != F.lit(False))
    return cond


def name_present(c) -> Column:
    """skip rows without a name."""
    return _c(c).isNotNull() & (_c(c) != "")


def min_arity(cells, n: int) -> Column:
    """F8: keep rows with at least ``n`` cells."""
    return F.size(_c(cells)) >= n


def match_by_name(left: DataFrame, left_name: str, right: DataFrame, right_name: str,
                  right_id: str, position: str, out: str = "matched_id") -> DataFrame:
    """Match each left row to the first candidate (lowest ``position``) whose
    normalised name (X2) equals its own.

    Candidates are first reduced to one per normalised name with ``min_by`` (a
    map-side-combining aggregate), then joined many-to-one: no pair explosion
    inside a popular name, and a hot name costs one row per task."""
    best = (right.where(name_present(right_name))
                 .groupBy(clean_name(right_name).alias("_nk"))
                 .agg(F.min_by(F.col(right_id), F.struct(F.col(position), F.col(right_id)))
                      .alias(out)))
    return (left.where(name_present(left_name))
                .withColumn("_nk", clean_name(left_name))
                .join(best, "_nk")
                .drop("_nk"))
