"""Data-quality checks Q1-Q3: each returns the failing rows (empty = pass), as
the declared YAML tests do; ``run_checks`` runs a list and fails on violations."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast
from .loads import has_key


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Q1: rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Q2: non-NULL values seen more than once, with their counts. A grouped
    count combines map-side, so a hot value costs one row per task."""
    return (df.where(F.col(col).isNotNull())
              .groupBy(F.col(col).alias("unique_field"))
              .agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def check_relationship(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Q3: non-NULL child values with no parent row (anti-join)."""
    parents = parent.select(F.col(parent_col).alias("_p"))
    return (df.where(F.col(col).isNotNull())
              .join(parents, F.col(col) == F.col("_p"), "left_anti")
              .select(F.col(col).alias("from_field")))


@dataclass
class Check:
    model: str
    kind: str
    column: str
    failing: DataFrame


class QualityError(AssertionError):
    pass


def summary(checks: list[Check]) -> list[tuple[str, str, str, int]]:
    return [(c.model, c.kind, c.column, c.failing.count()) for c in checks]


def run_checks(checks: list[Check]) -> list[tuple[str, str, str, int]]:
    """Count failures of every check; raise if any check fails."""
    rows = summary(checks)
    bad = [r for r in rows if r[3]]
    if bad:
        raise QualityError(f"quality checks failed: {bad}")
    return rows


# The declared checks of the staging and mart models: (model, table
# in the built warehouse, check, column, parent table for relationships).
DECLARED_CHECKS = (
    ("stg_steam", "stg_catalogue", "not_null", "appid", None),
    ("stg_steam", "stg_catalogue", "unique", "appid", None),
    ("stg_twitch", "stg_metrics", "not_null", "appid", None),
    ("dim_games", "dim_games", "not_null", "game_key", None),
    ("dim_games", "dim_games", "unique", "game_key", None),
    ("dim_games", "dim_games", "not_null", "appid", None),
    ("dim_games", "dim_games", "unique", "appid", None),
    ("dim_date", "dim_date", "not_null", "date_key", None),
    ("dim_date", "dim_date", "unique", "date_key", None),
    ("dim_developer", "dim_developer", "not_null", "developer_key", None),
    ("dim_developer", "dim_developer", "unique", "developer_key", None),
    ("dim_genre", "dim_genre", "not_null", "genre_key", None),
    ("dim_genre", "dim_genre", "unique", "genre_key", None),
    ("dim_category", "dim_category", "not_null", "category_key", None),
    ("dim_category", "dim_category", "unique", "category_key", None),
    ("fct_twitch_data", "fct", "not_null", "game_key", None),
    ("fct_twitch_data", "fct", "relationships", "game_key", "dim_games"),
    ("fct_twitch_data", "fct", "not_null", "date_key", None),
    ("fct_twitch_data", "fct", "relationships", "date_key", "dim_date"),
    ("bridge_game_developer", "bridge_game_developer", "not_null", "game_key", None),
    ("bridge_game_developer", "bridge_game_developer", "relationships", "game_key", "dim_games"),
    ("bridge_game_developer", "bridge_game_developer", "not_null", "developer_key", None),
    ("bridge_game_developer", "bridge_game_developer", "relationships", "developer_key", "dim_developer"),
    ("bridge_game_genre", "bridge_game_genre", "not_null", "game_key", None),
    ("bridge_game_genre", "bridge_game_genre", "relationships", "game_key", "dim_games"),
    ("bridge_game_genre", "bridge_game_genre", "not_null", "genre_key", None),
    ("bridge_game_genre", "bridge_game_genre", "relationships", "genre_key", "dim_genre"),
    ("bridge_game_category", "bridge_game_category", "not_null", "game_key", None),
    ("bridge_game_category", "bridge_game_category", "relationships", "game_key", "dim_games"),
    ("bridge_game_category", "bridge_game_category", "not_null", "category_key", None),
    ("bridge_game_category", "bridge_game_category", "relationships", "category_key", "dim_category"),
)


def warehouse_checks(w) -> list[Check]:
    """The 31 declared checks of the staging and mart models."""
    t = w.tables()
    out = []
    for label, table, kind, col, parent in DECLARED_CHECKS:
        if kind == "not_null":
            failing = check_not_null(t[table], col)
        elif kind == "unique":
            failing = check_unique(t[table], col)
        else:
            failing = check_relationship(t[table], col, t[parent], col)
        out.append(Check(label, kind, col, failing))
    return out


def orphans(df: DataFrame, cols: list[str], parent: DataFrame) -> DataFrame:
    """How many rows without a NULL in ``cols`` have no parent row, as ``n_failing``: a
    value is one row per task however often it comes, and only the counts are joined."""
    values = df.where(has_key(cols)).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return values.join(parent.select(*cols), cols, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_failing"))


def _named(check: tuple, counted: DataFrame) -> DataFrame:
    model, _, kind, col, _ = check
    return counted.select(F.lit(model).alias("model"), F.lit(kind).alias("kind"),
                          F.lit(col).alias("column_name"), "n_failing")


def failure_counts(w, declared=DECLARED_CHECKS) -> DataFrame:
    """One row per declared check with its failing-row count.

    One pass per table: its not-null and relationship checks are conditional counts
    of a single aggregation, parent keys joined as broadcasts behind a size check. Of
    a larger parent the child's values are counted first and only the counts meet it.
    Each uniqueness check is one grouped count."""
    t = w.tables() if hasattr(w, "tables") else w
    parts, parents = [], {}
    for table in dict.fromkeys(c[1] for c in declared):
        own = [c for c in declared if c[1] == table]
        df, counts = t[table].select(*dict.fromkeys(c[3] for c in own)), []
        for i, (_, _, kind, col, parent) in enumerate(own):
            if kind == "not_null":
                counts.append((i, F.col(col).isNull()))
            elif kind == "relationships":
                if (parent, col) not in parents:
                    parents[parent, col] = checked_broadcast(
                        t[parent].select(col).where(F.col(col).isNotNull()).distinct(), otherwise=None)
                small = parents[parent, col]
                if small is None:
                    parts.append(_named(own[i], orphans(t[table], [col], t[parent])))
                    continue
                df = df.join(small.withColumn(f"_p{i}", F.lit(True)), col, "left")
                counts.append((i, F.col(col).isNotNull() & F.col(f"_p{i}").isNull()))
        if counts:
            one = df.agg(*[F.count_if(test).alias(f"n{i}") for i, test in counts])
            parts.append(one.select(F.inline(F.array(*[F.struct(
                F.lit(own[i][0]).alias("model"), F.lit(own[i][2]).alias("kind"),
                F.lit(own[i][3]).alias("column_name"), F.col(f"n{i}").alias("n_failing"))
                for i, _ in counts]))))
        parts += [_named(c, check_unique(t[table], c[3]).agg(F.count(F.lit(1)).alias("n_failing")))
                  for c in own if c[2] == "unique"]
    return reduce(lambda a, b: a.unionByName(b), parts)


def gate(w, check: bool = True) -> list[tuple[str, str, str, int]]:
    """The declared checks of a warehouse (a row each); raises if any fails."""
    rows = [tuple(r) for r in failure_counts(w).collect()]
    bad = [r for r in rows if r[3]]
    if check and bad:
        raise QualityError(f"quality checks failed: {bad}")
    return rows
