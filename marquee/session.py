"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every job assumes: AQE re-plans joins/partition counts at runtime and
# splits skewed sort-merge partitions; ANSI casts raise like the reference's
# strict casts; UTC keeps timestamp_ntz comparisons engine-neutral.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "marquee",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoints go to the shared folder named by ``spark.checkpoint.dir``;
    where none is named, to a folder of the warehouse, which executors share too."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        sc.setCheckpointDir(configured or f"{warehouse.rstrip('/')}/_checkpoints")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root for written intermediate tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "tables", f"{name}-{os.getpid()}-{next(_counter)}")


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Into how many partitions ``read_table(..., spread=True)`` deals a table; unset: as the
# files are split. For tables stored as one row group, whose scan is one task.
SPREAD = "spark.marquee.spreadPartitions"


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    n = spark.conf.get(SPREAD, None) if spread else None
    return df.repartition(int(n)) if n else df


# A key table of this many rows and bytes stays well inside a broadcast.
MAX_BROADCAST_KEYS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def _width(c, kind: T.DataType):
    """Bytes of a value: those of texts and binaries, 8 of a number, and of a list or an
    object the sum over what it holds."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(c)
    if isinstance(kind, T.ArrayType):
        return F.aggregate(c, F.lit(0).cast("bigint"),
                           lambda n, x: n + F.coalesce(_width(x, kind.elementType), F.lit(0)))
    if isinstance(kind, T.MapType):
        return (_width(F.map_keys(c), T.ArrayType(kind.keyType))
                + _width(F.map_values(c), T.ArrayType(kind.valueType)))
    if isinstance(kind, T.StructType):
        return sum((F.coalesce(_width(c.getField(f.name), f.dataType), F.lit(0)) for f in kind.fields), F.lit(0))
    if isinstance(kind, T.VariantType):
        return F.octet_length(c.cast("string"))
    return F.lit(8)


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of values, by one aggregation: every task sends one partial
    count and sum."""
    size = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        size = size + F.coalesce(_width(F.col(f"`{f.name}`"), f.dataType), F.lit(0))
    n, b = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return n, b or 0


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_KEYS,
                      max_bytes: int = MAX_BROADCAST_BYTES, otherwise: str | None = "merge"):
    """Broadcast ``df`` only after counting that it holds at most ``max_rows`` rows and
    ``max_bytes`` bytes.

    A larger side is pinned to a sort-merge join (``otherwise``; None returns None,
    for a caller with a way of its own), so a low size estimate of the *other* side
    (after an aggregate or a generator) can never make that side the broadcast one."""
    n, size = measured(df)
    if n <= max_rows and size <= max_bytes:
        return F.broadcast(df)
    return df.hint(otherwise) if otherwise else None


def evaluate_once(df: DataFrame) -> DataFrame:
    """Keep the expressions computed so far from being re-evaluated by later
    filters.

    Catalyst pushes a filter below a projection by substituting the projected
    expressions into the predicate, so a parse that is filtered on afterwards
    runs once in the filter and again in the projection. A predicate on a
    generator's output cannot move below the generator: exploding a one-element
    array of the row is a no-op that pins the parse to one evaluation per row.
    Every column goes into the fence, so project to the needed columns first
    (column pruning does not reach through it)."""
    cols = df.columns
    packed = F.explode(F.array(F.struct(*[F.col(f"`{c}`") for c in cols]))).alias("_row")
    return df.select(packed).select(*[F.col(f"_row.`{c}`").alias(c) for c in cols])
