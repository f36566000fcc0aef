"""W2 across loads: names get ids from reserved ranges, so loads that run at the same time
never hand out one id twice.

An id belongs to a block of ``block`` ids; a load claims whole blocks by exclusive
creation of a file and numbers its new names inside them (ids have gaps, as
auto-increment ids do after a refused insert). Loads do not see each other's names
before they commit, so a name may get an id from each of two loads: the smallest one is
the name's id, and ``aliases`` leads from the others to it, for rows that carry them.

    <root>/claims/7          block 7: ids 7 * block + 1 .. 8 * block
    <root>/ids/load=<n>/     the ids that load n gave, there once it has committed
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..small_files import Folder
from .keys import collated, surrogate_key


class IdLedger:
    def __init__(self, spark: SparkSession, root: str, block: int = 1 << 20, collation: str | None = None):
        self.spark, self.root, self.block, self.collation = spark, root.rstrip("/"), block, collation
        self._folder = Folder(spark, root)

    def handed_out(self) -> DataFrame:
        """Every committed (``id``, ``name``, ``load``)."""
        loads = [n for n in self._folder.names("ids") if n.startswith("load=")]
        schema = "id bigint, name string, load bigint"
        if not loads:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/ids").parquet(
            *[f"{self.root}/ids/{n}" for n in loads])

    def _grouped(self) -> DataFrame:
        """Per name its first id, and the spelling that got it: an aggregate, so a name
        that many loads met costs one row a task."""
        return self.handed_out().groupBy(collated("name", self.collation).alias("_k")).agg(
            F.min(F.struct("id", F.col("name").cast("string").alias("name"))).alias("first"))

    def dimension(self) -> DataFrame:
        """``id`` and ``name``, one row a name."""
        return self._grouped().select("first.id", "first.name")

    def aliases(self) -> DataFrame:
        """``id`` -> ``name_id`` for ids that another load's smaller id stands for."""
        first = self._grouped().select("_k", F.col("first.id").alias("name_id"))
        own = self.handed_out().select("id", collated("name", self.collation).alias("_k"))
        return own.join(first, "_k").where("id <> name_id").select("id", "name_id")

    def begin(self, names: DataFrame, name_col: str) -> Load:
        """A load of ``names``: those that no committed load has named get new ids."""
        return Load(self, names, name_col)


class Load:
    """Ids of one load: its own until ``commit`` makes them the ledger's."""

    def __init__(self, ledger: IdLedger, names: DataFrame, name_col: str):
        self.ledger = ledger
        given = names.select(F.col(name_col).cast("string").alias("name")).where("name IS NOT NULL")
        given = given.groupBy(collated("name", ledger.collation).alias("_k")).agg(F.min("name").alias("name"))
        known = ledger._grouped().select("_k", F.col("first.id").alias("id"))
        met = materialize(given.join(known, "_k", "left").select("id", "name"))
        fresh = surrogate_key(met.where("id IS NULL").select("name"), "name", "_rn")
        n = fresh.agg(F.max("_rn")).first()[0] or 0
        size = ledger.block
        # one claim a block: as many small files as the new names fill blocks
        blocks = [ledger._folder.claim("claims") for _ in range(-(-n // size))]
        start = F.element_at(F.array(*[F.lit(b * size).cast("bigint") for b in blocks] or [F.lit(0).cast("bigint")]),
                             (F.floor((F.col("_rn") - 1) / size) + 1).cast("int"))
        self.new = materialize(fresh.select((start + (F.col("_rn") - 1) % size + 1).cast("bigint").alias("id"), "name"))
        self.known = met.where("id IS NOT NULL")

    def ids(self) -> DataFrame:
        """``id`` and ``name`` of every name of this load."""
        return self.known.unionByName(self.new)

    def commit(self) -> int:
        """Make the new ids the ledger's; a folder appears with all of them or not at all."""
        folder = self.ledger._folder
        number = folder.claim("loads")
        staged = f"{self.ledger.root}/_staging/{number}"
        self.new.write.mode("overwrite").parquet(staged)
        folder.move(f"_staging/{number}", f"ids/load={number}")
        return number
