"""Keyed, audited loads: insert-ignore (K7, J6), parent check (K8, J5),
per-file audit (K9, A5), scrape status log (K11), metric acceptance (F10)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cleaning as X
from ..session import checked_broadcast
from .lookup import look_up


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in ``order`` (then all remaining columns as the
    tie-break, so the result is deterministic).

    Written as ``min(struct(order..., rest...))`` per key rather than a
    ``row_number`` window: the aggregate combines map-side, so a key holding a
    third of all rows is reduced in every input task before the shuffle instead
    of landing whole in one task."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    firsts = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return firsts.select(
        *keys,
        *[F.col(f"_first._o{i}").alias(c) for i, c in enumerate(order)],
        *[F.col(f"_first.{c}").alias(c) for c in rest],
    ).select(*df.columns)


def has_key(keys: list[str]) -> Column:
    """No part of the primary key is NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def insert_ignore(new: DataFrame, target: DataFrame | None, keys: list[str],
                  order: list[str]) -> DataFrame:
    """K7: rows to append -- first row per key wins, keys already stored are
    skipped, rows without a key are refused (an insert-ignore into a table with a
    primary key)."""
    firsts = first_per_key(new.where(has_key(keys)), keys, order)
    if target is None:
        return firsts
    return firsts.join(target.select(*keys), keys, "left_anti")


def fk_split(df: DataFrame, parent: DataFrame, on: str | list[str],
             parent_on: str | list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """K8: rows whose parent exists (semi-join) and the rejected rest (anti-join).
    NULL keys never match, so they are rejected, as a NOT NULL FK would."""
    on = [on] if isinstance(on, str) else on
    p_on = parent_on or on
    p_on = [p_on] if isinstance(p_on, str) else p_on
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(p_on, on)])
    return df.join(parents, on, "left_semi"), df.join(parents, on, "left_anti")


def load_audit(df: DataFrame, by: str, accepted: Column | str) -> DataFrame:
    """K9 + A5: rows total / accepted / rejected per file, plus the grand total
    (``by`` is NULL on that row). ``rollup`` aggregates partially per task."""
    acc = F.col(accepted) if isinstance(accepted, str) else accepted
    return df.rollup(by).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(acc).alias("n_ok"),
        F.count_if(~acc).alias("n_rejected"),
    )


def insert_audit(all_rows: DataFrame, inserted: DataFrame, by: str) -> DataFrame:
    """K9 + A5 for keyed loads: per file, rows read, rows actually inserted
    (after parse checks, parent checks and first-wins), and the rest rejected,
    plus the grand total (``by`` NULL). Two grouped counts, joined on the file
    with NULL-safe equality so the total rows meet."""
    tot = all_rows.rollup(by).agg(F.count(F.lit(1)).alias("n_total"))
    ok = inserted.rollup(by).agg(F.count(F.lit(1)).alias("n_ok")).withColumnRenamed(by, "_by")
    return (tot.join(ok, tot[by].eqNullSafe(ok["_by"]), "left")
               .select(by, "n_total", F.coalesce("n_ok", F.lit(0)).alias("n_ok"))
               .withColumn("n_rejected", F.col("n_total") - F.col("n_ok")))


@dataclass
class LoadResult:
    """One keyed load: rows + rejects = rows read, per file."""

    rows: DataFrame        # rows to append to the target
    rejected: DataFrame    # every row refused, with its ``reason``
    audit: DataFrame       # per file: n_total, n_ok, n_rejected (+ grand total)


def with_parent(df: DataFrame, parent: DataFrame, key: str, parent_key: str,
                order: list[str]) -> DataFrame:
    """K8: reason ``unknown game`` on rows whose parent does not exist.

    The parent keys are broadcast behind a size check; beyond it they are looked
    up by salted keys, so a parent with a third of the rows is never gathered."""
    parents = parent.select(F.col(parent_key).alias(key)).where(F.col(key).isNotNull()).distinct()
    known = parents.withColumn("_known", F.lit(True))
    small = checked_broadcast(known, otherwise=None)
    flagged = (df.join(small, key, "left") if small is not None
               else look_up(df, known, [key], F.struct(*order)))
    return flagged.withColumn("reason", F.coalesce(
        "reason", F.when(F.col("_known").isNull(), F.lit("unknown game")))).drop("_known")


def keyed_load(parsed: DataFrame, keys: list[str], order: list[str], cols: list[str],
               target: DataFrame | None = None, by: str = "file_path") -> LoadResult:
    """K7 + K9 over parsed rows with a ``reason`` (NULL: acceptable so far).

    ``order`` identifies a row (file and line). Rows without a key are refused; of
    the rest the first of each key is inserted unless the key is stored already,
    and every other row is a reject: ``duplicate key``."""
    parsed = parsed.withColumn("reason", F.coalesce(
        "reason", F.when(~has_key(keys), F.lit("null key"))))
    rows = insert_ignore(parsed.where(F.col("reason").isNull()), target, keys, order)
    return LoadResult(rows.select(*cols), refused(parsed, target, keys, order),
                      insert_audit(parsed, rows, by))


def refused(parsed: DataFrame, target: DataFrame | None, keys: list[str], order: list[str],
            salts: int = 64) -> DataFrame:
    """Every row of ``parsed`` that is not inserted, in one reading: those with a
    ``reason``, and as ``duplicate key`` those after the first of their key.

    The rows of a key are ranked by salt, then the first of its salts among
    themselves, so a key with a third of the rows is spread over ``salts`` groups and
    none of its rows meets more than ``salts`` others. A stored key is a row before
    all lines."""
    lines = parsed.withColumn("_line", F.lit(1))
    if target is not None:
        stored = target.select(*[F.col(k).try_cast(parsed.schema[k].dataType).alias(k) for k in keys])
        lines = lines.unionByName(stored.where(has_key(keys)).withColumn("_line", F.lit(0)),
                                  allowMissingColumns=True)
    place = F.xxhash64(*order)
    good, sorting = F.col("reason").isNull(), ["_line", *order]
    lines = lines.withColumn("_good", good).withColumn(
        "_salt", F.when(good, F.pmod(place, F.lit(salts))).otherwise(place))
    ranked = lines.withColumn("_r", F.rank().over(
        Window.partitionBy("_good", *keys, "_salt").orderBy(*sorting)))
    ranked = ranked.withColumn("_group", F.when(F.col("_good") & (F.col("_r") == 1), F.lit(-1))
                               .otherwise(F.col("_salt")))
    ranked = ranked.withColumn("_first", F.rank().over(
        Window.partitionBy("_good", *keys, "_group").orderBy(*sorting)) == 1)
    first = (F.col("_group") == -1) & F.col("_first") & has_key(order)
    return (ranked.withColumn("reason", F.coalesce("reason", F.when(~first, F.lit("duplicate key"))))
            .where((F.col("_line") == 1) & F.col("reason").isNotNull())
            .select(*[F.col(f"`{c}`") for c in parsed.columns]))


def status_log(df: DataFrame, key: str, flags: dict[str, Column],
               with_time: bool = True) -> DataFrame:
    """One status row per processed key with success flags and the time."""
    cols = [F.col(key)] + [c.alias(n) for n, c in flags.items()]
    if with_time:
        cols.append(F.current_timestamp().cast("timestamp_ntz").alias("processed_time"))
    return df.select(*cols)


# Metric columns whose blank value rejects the row, and those where
# blank or '-' simply becomes NULL (the legacy load's asymmetry).
REQUIRED_METRICS = ("AvgViewers", "PeakViewers", "AvgStreams", "PeakStreams")
OPTIONAL_INT_METRICS = ("AvgViewersGain", "AvgStreamsGain")
OPTIONAL_PCT_METRICS = ("AvgViewers%Gain", "AvgStreamsùGain")


def accept_metrics(raw: DataFrame) -> DataFrame:
    """F10 + X15: parse the metric CSV's text columns as the legacy load does.

    Required counts: '-' -> NULL, otherwise ``int(float(x))`` after removing
    commas; a blank, unparsable or too large value rejects the row. Gains: blank
    or '-' -> NULL, anything else that is no number rejects the row. Adds ``date`` (the day-first month), ``accepted`` and
    ``reason``."""
    def q(c):
        return F.col(f"`{c}`")

    # Each text is parsed once, in a projection of its own, and the values and reasons
    # read what it found: with the parses written out wherever they are read, a row's
    # generated code is too long for the JVM to compile and runs interpreted.
    held = {c: q(c) != "-" for c in REQUIRED_METRICS}
    held |= {c: ~q(c).isin("-", "") for c in (*OPTIONAL_INT_METRICS, *OPTIONAL_PCT_METRICS)}
    found = {c: F.col(f"_v{i}") for i, c in enumerate(held)}
    parses = [F.when(held[c], F.replace(q(c), F.lit(","), F.lit("")).try_cast("double")
                     if c in OPTIONAL_PCT_METRICS else X.int_trunc(q(c))).alias(f"_v{i}")
              for i, c in enumerate(held)]
    parsed = raw.select("*", F.when(q("steam_id") != "-", q("steam_id").try_cast("int")).alias("_steam"),
                        F.try_to_date(q("Month"), "d/M/yyyy").alias("_date"), *parses)
    out = [F.col("_steam").alias("steam_id"), q("Month").alias("Month")]
    bad = [F.when((q("steam_id") != "-") & F.col("_steam").isNull(), F.lit("bad steam_id"))]
    for c, there in held.items():
        v = X.finite(found[c]) if c in OPTIONAL_PCT_METRICS else found[c]
        lost = there & v.isNull()
        # a CSV reader may hand a blank cell over as NULL: both reject the row
        bad.append(F.when(q(c).isNull() | lost if c in REQUIRED_METRICS else lost, F.lit(f"bad {c}")))
        out.append(v.alias(c))
    out.append(F.when(q("HoursWatched") == "-", F.lit(None).cast("string"))
               .otherwise(q("HoursWatched")).alias("HoursWatched"))
    month_bad = F.when(F.col("_date").isNull(), F.lit("bad Month"))
    reason = F.coalesce(*bad, month_bad)
    extra = [c for c in raw.columns if c not in
             ("steam_id", "Month", *REQUIRED_METRICS, *OPTIONAL_INT_METRICS,
              *OPTIONAL_PCT_METRICS, "HoursWatched")]
    return parsed.select(*out, *[q(c) for c in extra], F.col("_date").alias("date"),
                         reason.alias("reason")).withColumn("accepted", F.col("reason").isNull())
