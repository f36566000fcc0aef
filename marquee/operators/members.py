"""Array members: distinct vocabularies (A3), bridges (J3) and member links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast
from .keys import collated, surrogate_key
from .lookup import look_up


def exploded(df: DataFrame, key: str, array_col: str, name: str) -> DataFrame:
    """F1 + X1: one row per member; NULL/empty arrays give no row, NULL members
    and duplicates are kept. Catalyst pushes ``IsNotNull`` into the scan and adds
    ``size > 0`` before the generator."""
    return (df.where(F.col(array_col).isNotNull())
              .select(F.col(key), F.explode(F.col(array_col)).alias(name)))


def distinct_members(df: DataFrame, array_col: str, name: str, key_name: str) -> DataFrame:
    """M5-M7: ``SELECT DISTINCT unnest(arr)`` keyed by name order (NULL last).

    ``distinct`` is a hash aggregate with a map-side partial step, so a hot
    member is reduced before the shuffle."""
    names = (df.where(F.col(array_col).isNotNull())
               .select(F.explode(F.col(array_col)).alias(name))
               .distinct())
    return surrogate_key(names, name, key_name)


def bridge(df: DataFrame, key: str, array_col: str, entity_dim: DataFrame,
           entity_key: str, member_dim: DataFrame, member_name: str,
           member_key: str) -> DataFrame:
    """Exploded members joined to both dimensions by natural key.
    Duplicates are kept; NULL members drop out of the equi-join."""
    pairs = exploded(df, key, array_col, member_name)
    entities = checked_broadcast(entity_dim.select(key, entity_key))
    members = checked_broadcast(member_dim.select(member_name, member_key))
    return (pairs.join(entities, key)
                 .join(members, member_name)
                 .select(entity_key, member_key))


def member_links(df: DataFrame, key: str, array_col: str, dim: DataFrame,
                 name_col: str, id_col: str, existing: DataFrame | None = None,
                 collation: str | None = None) -> DataFrame:
    """(entity, member id) links with a composite key: duplicates within the
    input are collapsed, pairs already stored and rows without a key are skipped.
    With ``collation`` a name finds its id under the dimension's collation, as the
    unique index would.

    Ids are broadcast behind a size check, else looked up by salted keys, so a member
    with a third of all links is never gathered in one task."""
    ids = dim.select(collated(name_col, collation).alias("_k"), id_col)
    names = exploded(df.where(F.col(key).isNotNull()), key, array_col, name_col).withColumn(
        "_k", collated(name_col, collation))
    small = checked_broadcast(ids, otherwise=None)
    found = (names.join(small, "_k") if small is not None
             else look_up(names.where("_k IS NOT NULL"), ids, ["_k"], F.col(key)).where(F.col(id_col).isNotNull()))
    links = found.select(key, id_col).dropDuplicates([key, id_col])
    if existing is not None:
        links = links.join(existing.select(key, id_col), [key, id_col], "left_anti")
    return links
