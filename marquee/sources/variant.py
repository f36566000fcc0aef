"""Fields of VARIANT values, with an absent field kept apart from an explicit null.

A typed JSON read gives NULL for both; the collectors' loads do not: a default stands
in for a field that is absent, and a null that is written out stays a null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field(v: Column, path: str) -> Column:
    """The field as VARIANT: NULL if absent, a variant null if written as null."""
    return F.variant_get(v, path, "variant")


def absent(v: Column, path: str) -> Column:
    return field(v, path).isNull()


def explicit_null(v: Column, path: str) -> Column:
    return F.coalesce(F.is_variant_null(field(v, path)), F.lit(False))


def value(v: Column, path: str, kind: str, default: Column | None = None) -> Column:
    """The field as ``kind``; ``default`` only where it is absent. A value that does
    not convert is NULL (``unfit`` tells it from a null)."""
    typed = F.try_variant_get(v, path, kind)
    return typed if default is None else F.when(absent(v, path), default).otherwise(typed)


def unfit(v: Column, path: str, kind: str) -> Column:
    """The field holds a value that does not convert to ``kind``."""
    return ~absent(v, path) & ~explicit_null(v, path) & F.try_variant_get(v, path, kind).isNull()


def is_object(v: Column) -> Column:
    """``v`` is a JSON object (an absent value is not)."""
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))


def typed_row(v: Column, schema: T.StructType) -> list[Column]:
    """The fields of an object by a declared schema, then ``absent`` (names of the
    fields it lacks) and ``unfit`` (the first field whose value does not convert)."""
    names = [(f.name, f"$['{f.name}']", f.dataType.simpleString()) for f in schema.fields]
    lacking = F.filter(F.array(*[F.when(absent(v, p), F.lit(n)) for n, p, _ in names]), lambda n: n.isNotNull())
    wrong = F.coalesce(*[F.when(unfit(v, p, k), F.lit(n)) for n, p, k in names], F.lit(None).cast("string"))
    return [*[F.try_variant_get(v, p, k).alias(n) for n, p, k in names], lacking.alias("absent"), wrong.alias("unfit")]
