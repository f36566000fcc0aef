"""Raw store API payloads -> typed catalogue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_any_date
from ..operators.filters import unreleased
from ..session import evaluate_once
from .variant import absent, explicit_null, field, is_object, value

# Nested objects and lists the collector reads into; a value of another
# kind there makes it give the game up.
NESTED_OBJECTS = ("release_date", "platforms", "metacritic", "recommendations")
DESCRIBED_LISTS = ("categories", "genres")


def _no_block(d: Column, name: str) -> Column:
    """The object or list is absent or null: as if it were empty."""
    return absent(d, f"$.{name}") | explicit_null(d, f"$.{name}")


def _descriptions(d: Column, name: str) -> Column:
    """The list's descriptions; a list that is not there has none."""
    items = F.transform(F.try_variant_get(d, f"$.{name}", "array<variant>"),
                        lambda x: F.try_variant_get(x, "$.description", "string"))
    return F.when(_no_block(d, name), F.array().cast("array<string>")).otherwise(items)


def _undescribed(d: Column, name: str) -> Column:
    """A list that is no list, or one of whose items has no description."""
    items = F.try_variant_get(d, f"$.{name}", "array<variant>")
    lacking = F.exists(items, lambda x: x.isNull() | field(x, "$.description").isNull())
    return ~_no_block(d, name) & (items.isNull() | lacking)


def classified(df: DataFrame, payload: str, id_col: str) -> DataFrame:
    """``appid``, ``_d`` (the entry's data) and ``reason``: why the collector passes the
    game by (NULL: it takes it).

    One JSON text per game, keyed by the game's own id (a dynamic key). A text that is
    no JSON, an entry without success or data (F5), an unreleased game (F4), or a
    nested field of the wrong kind is passed by."""
    path = F.concat(F.lit("$['"), F.col(id_col).cast("string"), F.lit("']"))
    entry = F.variant_get(F.from_json(F.col(payload), "variant"), path, "variant")
    # parsed once per row, then filtered (see ``evaluate_once``)
    t = evaluate_once(df.select(F.col(id_col).alias("appid"), entry.alias("_e")))
    success = F.coalesce(F.try_variant_get("_e", "$.success", "boolean"), F.lit(False))
    t = t.select("appid", success.alias("_ok"), field(F.col("_e"), "$.data").alias("_d"))
    d = F.col("_d")
    unlike = [F.when(~_no_block(d, n) & ~is_object(field(d, f"$.{n}")), F.lit(f"bad {n}"))
              for n in NESTED_OBJECTS]
    reason = F.coalesce(
        F.when(~F.col("_ok") | d.isNull(), F.lit("no data")),
        F.when(~is_object(d), F.lit("bad data")),
        unlike[0],
        F.when(unreleased(F.try_variant_get(d, "$.release_date.date", "string"),
                          value(d, "$.release_date.coming_soon", "boolean", F.lit(True))), F.lit("unreleased")),
        *unlike[1:],
        *[F.when(_undescribed(d, n), F.lit(f"bad {n}")) for n in DESCRIBED_LISTS])
    return t.select("appid", "_d", reason.alias("reason"))


def parse_payload(df: DataFrame, payload: str, id_col: str) -> DataFrame:
    """The games the collector takes, as catalogue rows.

    An absent field takes the collector's default and an explicit null stays NULL
    (P9-P12). That holds for values: a nested object or list that is null as a whole is
    taken as empty (the collector loses such a game to an error). A price block that is
    missing, null or empty means price 0 without a currency. The release date is
    re-written as ``dd/MM/yyyy`` text (X5)."""
    t = classified(df, payload, id_col).where("reason IS NULL")
    d = F.col("_d")
    price = field(d, "$.price_overview")
    priced = is_object(price) & (F.schema_of_variant(price) != F.lit("OBJECT<>"))
    text, none = F.lit(""), F.array().cast("array<string>")
    zero = F.lit(0).cast("bigint")
    return t.select(
        "appid",
        value(d, "$.name", "string", text).alias("name"),
        F.date_format(parse_any_date(F.try_variant_get(d, "$.release_date.date", "string")), "dd/MM/yyyy")
        .alias("release_date"),
        value(d, "$.short_description", "string", text).alias("short_description"),
        value(d, "$.developers", "array<string>", none).alias("developers"),
        _descriptions(d, "categories").alias("categories"),
        _descriptions(d, "genres").alias("genre"),
        value(d, "$.header_image", "string", text).alias("header_image"),
        F.when(~priced, zero).otherwise(value(d, "$.price_overview.initial", "bigint", zero)).alias("price"),
        F.when(priced, F.try_variant_get(d, "$.price_overview.currency", "string")).alias("currency"),
        *[F.try_variant_get(d, f"$.platforms.{p}", "boolean").alias(p) for p in ("windows", "linux", "mac")],
        F.try_variant_get(d, "$.metacritic.score", "bigint").alias("metacritic"),
        value(d, "$.recommendations.total", "bigint", zero).alias("recommendations"),
    )


def payload_rejects(df: DataFrame, payload: str, id_col: str) -> DataFrame:
    """The games passed by: ``appid`` and ``reason``."""
    return classified(df, payload, id_col).where("reason IS NOT NULL").select("appid", "reason")
