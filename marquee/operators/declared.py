"""Declared tables (K6, Q4): one constraint table drives the typed writer, the loads and
the report of violations."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checked_broadcast, materialize
from .loads import LoadResult, keyed_load
from .lookup import look_up
from .quality import orphans


@dataclass(frozen=True)
class Field:
    name: str
    kind: str                    # a type as DDL writes it; varchar(n) bounds the length
    not_null: bool = False
    source: str | None = None    # the incoming column, if it has another name

    @property
    def length(self) -> int | None:
        return int(self.kind[8:-1]) if self.kind.startswith("varchar(") else None

    @property
    def type(self) -> T.DataType:
        return T.StringType() if self.length else T._parse_datatype_string(self.kind)


@dataclass(frozen=True)
class TableSpec:
    """A table's columns in order, its keys, and the parents its rows must have."""

    name: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    collation: str | None = None  # names that differ in case or accent only are one name

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, f.name not in self.required) for f in self.fields])

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields if f.not_null or f.name in self.primary_key)


_CI = "UNICODE_CI_AI"


def _member_table(name: str, column: str) -> TableSpec:
    return TableSpec(name, (Field("id", "int"), Field(column, "varchar(255)", source="name")), ("id",),
                     ((column,),), collation=_CI)


def _link_table(name: str, member: str, parent: str) -> TableSpec:
    return TableSpec(name, (Field("game_appid", "int"), Field(member, "int", source="member_id")),
                     ("game_appid", member), (),
                     ((("game_appid",), "steamgames", ("appid",)), ((member,), parent, ("id",))))


_GAME = (("appid",), "steamgames", ("appid",))
# The tables of the legacy database, in creation order.
LEGACY_TABLES = {t.name: t for t in (
    TableSpec("developers", (Field("id", "int", source="developer_id"), Field("name", "varchar(255)")), ("id",),
              (("name",),), collation=_CI),
    TableSpec("steamgames", (
        Field("appid", "int"), Field("name", "varchar(255)", True), Field("developer_id", "int"),
        Field("release_date", "date"), Field("short_description", "string"), Field("price", "int"),
        Field("header_image", "string"), Field("currency", "varchar(10)"), Field("windows", "boolean"),
        Field("linux", "boolean"), Field("mac", "boolean"), Field("metacritic", "int"),
        Field("recommendations", "int")), ("appid",), (), ((("developer_id",), "developers", ("id",)),)),
    _member_table("categories", "description"), _member_table("genres", "description"),
    _link_table("games_categories", "category_id", "categories"), _link_table("games_genres", "genre_id", "genres"),
    TableSpec("twitchgames", (
        Field("steam_id", "int"), Field("date", "date"), Field("avg_viewers", "int", source="AvgViewers"),
        Field("avg_viewers_gain", "int", source="AvgViewersGain"),
        Field("avg_viewers_gain_percent", "float", source="AvgViewers%Gain"),
        Field("peak_viewers", "int", source="PeakViewers"), Field("avg_streams", "int", source="AvgStreams"),
        Field("avg_streams_gain", "int", source="AvgStreamsGain"),
        Field("avg_streams_gain_percent", "float", source="AvgStreamsùGain"),
        Field("peak_streams", "int", source="PeakStreams"),
        Field("hours_watched", "varchar(50)", source="HoursWatched")),
        ("steam_id", "date"), (), ((("steam_id",), "steamgames", ("appid",)),)),
    TableSpec("players_history", (
        Field("appid", "int"), Field("month", "date"), Field("peak", "int"), Field("gain", "int"),
        Field("percent_gain", "float")), ("appid", "month"), (), (_GAME,)),
    TableSpec("price_history", (
        Field("appid", "int"), Field("date", "date"), Field("final_price", "float"),
        Field("two_year_low", "float")), ("appid", "date"), (), (_GAME,)),
    TableSpec("global_steam_users", (
        Field("DateTime", "timestamp_ntz", True), Field("Users", "int"), Field("AverageUsers", "int"),
        Field("InGame", "int"))),
)}


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _typed(f: Field, source: T.DataType) -> tuple[Column, Column]:
    """The value as declared, and whether a value that is there does not fit."""
    c = _q(f.source or f.name)
    v = c.try_cast(f.type)
    lost = c.isNotNull() & v.isNull()
    if isinstance(source, T.FractionalType) and isinstance(f.type, T.IntegralType):
        lost = lost | (v.cast("double") != c.cast("double"))  # a fraction would go
    if isinstance(f.type, T.FractionalType):
        lost = lost | F.isnan(v) | (F.abs(v.cast("double")) == float("inf"))
    return v, F.coalesce(lost, F.lit(False))


def fit(df: DataFrame, spec: TableSpec, carry: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns in order, typed, then ``carry`` and ``reason`` (NULL: the row
    fits): the first column whose value does not convert, is too long or is missing.
    A column that ``df`` lacks is NULL in every row."""
    have = {f.name: f.dataType for f in df.schema.fields}
    df = df.withColumns({f.source or f.name: F.lit(None).cast(f.type)
                         for f in spec.fields if (f.source or f.name) not in have})
    values, faults = [], []
    for f in spec.fields:
        v, lost = _typed(f, have.get(f.source or f.name, f.type))
        faults.append(F.when(lost, F.lit(f"bad {f.name}")))
        if f.length:
            faults.append(F.when(F.char_length(v) > f.length, F.lit(f"long {f.name}")))
        if f.name in spec.required:
            faults.append(F.when(v.isNull(), F.lit(f"null {f.name}")))
        values.append(v.alias(f.name))
    kept = [c for c in carry if c not in {f.name for f in spec.fields}]
    return df.select(*values, *[_q(c) for c in kept], F.coalesce(*faults).alias("reason"))


def declared_write(df: DataFrame, spec: TableSpec, path: str, carry: tuple[str, ...] = ()) -> LoadResult:
    """K6: rows that fit are written to ``path`` with the declared names, types and order,
    the others to ``path_rejects`` with their incoming columns as they were and a
    ``reason``. The incoming rows are read once, into a checkpoint both writes read."""
    spark = df.sparkSession
    raw = F.struct(*[_q(c) for c in df.columns]).alias("_raw")
    checked = materialize(fit(df.select("*", raw), spec, ("_raw", *carry)))
    good = checked.where("reason IS NULL").select(*spec.schema.names)
    good.write.mode("overwrite").parquet(path)
    bad = checked.where("reason IS NOT NULL").select("_raw.*", F.col("reason").alias("reject_reason"))
    bad.write.mode("overwrite").parquet(f"{path}_rejects")
    audit = checked.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("reason").isNull()).alias("n_ok"))
    return LoadResult(read_declared(spark, spec, path), spark.read.schema(bad.schema).parquet(f"{path}_rejects"),
                      audit.withColumn("n_rejected", F.col("n_total") - F.col("n_ok")))


class SchemaError(ValueError):
    pass


def read_declared(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The table with its declared schema; refuses files written with another one."""
    stored = spark.read.parquet(path)
    if [(f.name, f.dataType) for f in stored.schema] != [(f.name, f.dataType) for f in spec.schema]:
        raise SchemaError(f"{path}: {stored.schema.simpleString()} is not {spec.schema.simpleString()}")
    return spark.read.schema(spec.schema).parquet(path)


def _parent_keys(df: DataFrame, keys: tuple[str, ...], parent: DataFrame, parent_keys: tuple[str, ...]) -> DataFrame:
    parents = parent.select(*[_q(p).cast(df.schema[k].dataType).alias(k) for k, p in zip(keys, parent_keys)])
    return parents.dropna().distinct()


def _known(df: DataFrame, keys: tuple[str, ...], parent: DataFrame, parent_keys: tuple[str, ...],
           flag: str) -> DataFrame:
    """``df`` with ``flag`` true where a parent row exists. Parents are broadcast behind a
    size check, else looked up by salted keys."""
    parents = _parent_keys(df, keys, parent, parent_keys).withColumn(flag, F.lit(True))
    small = checked_broadcast(parents, otherwise=None)
    return (df.join(small, list(keys), "left") if small is not None
            else look_up(df, parents, list(keys), F.monotonically_increasing_id()))


def _some_null(keys: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [_q(k).isNull() for k in keys])


def declared_load(df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame], order: list[str],
                  target: DataFrame | None = None, by: str = "file_path") -> LoadResult:
    """A keyed load (K6-K9) that the constraint table alone describes: values that do not
    fit, keys that are missing, parents that do not exist and keys that came before are
    rejects with their reason. A foreign key with a NULL part is not checked."""
    rows = fit(df, spec, tuple(dict.fromkeys([*order, by])))
    for i, (keys, table, parent_keys) in enumerate(spec.foreign_keys):
        flag = f"_parent{i}"
        rows = _known(rows, keys, parents[table], parent_keys, flag)
        missing = ~_some_null(keys) & F.col(flag).isNull()
        rows = rows.withColumn("reason", F.coalesce("reason", F.when(missing, F.lit(f"unknown {table}")))).drop(flag)
    return keyed_load(rows, list(spec.primary_key), order, [*spec.schema.names], target, by)


def constraint_report(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = LEGACY_TABLES) -> DataFrame:
    """Q4: one row per declared constraint of the tables given: ``table_name``, ``kind``
    (not_null, primary_key, unique, foreign_key), ``columns``, ``n_failing`` (rows).

    A table's not-null and foreign-key constraints are conditional counts of one pass,
    but of parents too many for a broadcast, whose children are counted by key first; a
    key is one grouped count (each row after the first of its key fails; keys with a
    NULL are left to not-null)."""
    parts = []
    for name, df in tables.items():
        spec = specs[name]
        tests = [("not_null", (c,), _q(c).isNull()) for c in spec.required]
        flagged = df
        for i, (keys, table, parent_keys) in enumerate(spec.foreign_keys):
            parents = _parent_keys(df, keys, tables[table], parent_keys)
            small = checked_broadcast(parents, otherwise=None)
            if small is None:
                parts.append(orphans(df, list(keys), parents).select(
                    F.lit(name).alias("table_name"), F.lit("foreign_key").alias("kind"),
                    F.lit(",".join(keys)).alias("columns"), "n_failing"))
                continue
            flagged = flagged.join(small.withColumn(f"_parent{i}", F.lit(True)), list(keys), "left")
            tests.append(("foreign_key", keys, ~_some_null(keys) & F.col(f"_parent{i}").isNull()))
        if tests:
            one = flagged.agg(*[F.count_if(t).alias(f"n{i}") for i, (_, _, t) in enumerate(tests)])
            parts.append(one.select(F.inline(F.array(*[F.struct(
                F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), F.lit(",".join(keys)).alias("columns"),
                F.col(f"n{i}").alias("n_failing")) for i, (kind, keys, _) in enumerate(tests)]))))
        for kind, keys in [("primary_key", spec.primary_key), *[("unique", u) for u in spec.unique]]:
            if keys:
                parts.append(_repeats(df, spec, keys).select(
                    F.lit(name).alias("table_name"), F.lit(kind).alias("kind"),
                    F.lit(",".join(keys)).alias("columns"), "n_failing"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _repeats(df: DataFrame, spec: TableSpec, keys: tuple[str, ...]) -> DataFrame:
    """Rows after the first of their key: combined map-side, so a hot key costs one row a
    task."""
    folded = [F.collate(_q(k), spec.collation) if spec.collation and isinstance(df.schema[k].dataType, T.StringType)
              else _q(k) for k in keys]
    return (df.where(~_some_null(keys)).groupBy(*[c.alias(f"k{i}") for i, c in enumerate(folded)])
            .agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_failing")))


class ConstraintError(AssertionError):
    pass


def enforce(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = LEGACY_TABLES) -> list[tuple]:
    """The report's rows; raises if any constraint fails."""
    rows = [tuple(r) for r in constraint_report(tables, specs).collect()]  # one row a constraint
    bad = [r for r in rows if r[3]]
    if bad:
        raise ConstraintError(f"constraints violated: {bad}")
    return rows
