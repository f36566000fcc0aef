"""Create-or-replace of a whole set of tables (K1, K2): versioned publishing.

A build writes its tables into a version folder of its own and becomes visible by one
small file, its manifest, written when every table is there and the checks have passed.
Readers take the newest manifest: they see all tables of one build or all of another,
never a mixture, and a build that fails leaves the version before as it was. A version
number is claimed by exclusive creation, so two builds never share a folder.

    with Publication(spark, root) as build:
        build.write("dim_date", dates)
        build.check(lambda tables: ...)      # raise to refuse the build
    published(spark, root, "dim_date")

    root/_claims/3            a build owns version 3
    root/v3/<table>/*.parquet
    root/_manifests/3.json    version 3 is complete: tables, paths, schemas, rows
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..small_files import Folder, numbers


def versions(spark: SparkSession, root: str) -> list[int]:
    """The complete versions, oldest first."""
    return numbers(Folder(spark, root).names("_manifests"), ".json")


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """What a version holds (the newest one by default)."""
    known = versions(spark, root)
    if not known or (version is not None and version not in known):
        raise LookupError(f"{root} has no version {'' if version is None else version}")
    path = f"{root.rstrip('/')}/_manifests/{known[-1] if version is None else version}.json"
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table of a version, with the schema it was published with: no footer is read to
    find it."""
    entry = manifest(spark, root, version)["tables"][name]
    return spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{root.rstrip('/')}/{entry['path']}")


class Publication:
    """One build; see the module's description. Tables it does not write are taken over
    from the version before (``replace_all`` drops them instead)."""

    def __init__(self, spark: SparkSession, root: str, replace_all: bool = False):
        self.spark, self.root, self.replace_all = spark, root.rstrip("/"), replace_all
        self._folder = Folder(spark, root)
        self._checks: list[Callable[[dict[str, DataFrame]], object]] = []
        self.tables: dict[str, dict] = {}
        self.version = self._claimed()

    def _claimed(self) -> int:
        return self._folder.claim("_claims", first=1)

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None,
              sort_by: list[str] | None = None) -> DataFrame:
        """Write a table of this build; returns it read back, for the models after it."""
        path = f"v{self.version}/{name}"
        out = (df.sortWithinPartitions(*sort_by) if sort_by else df).write.mode("errorifexists")
        (out.partitionBy(*partition_by) if partition_by else out).parquet(f"{self.root}/{path}")
        # partition columns come last in the files' schema
        last = partition_by or []
        schema = T.StructType([*[f for f in df.schema if f.name not in last], *[df.schema[c] for c in last]])
        back = self.spark.read.schema(schema).parquet(f"{self.root}/{path}")
        self.tables[name] = {"path": path, "schema": schema.jsonValue(), "rows": back.count()}
        return back

    def check(self, test: Callable[[dict[str, DataFrame]], object]) -> None:
        """A test of the build's tables, run before it becomes visible; it raises to
        refuse the build."""
        self._checks.append(test)

    def table(self, name: str) -> DataFrame:
        entry = self.tables[name]
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{self.root}/{entry['path']}")

    def commit(self) -> int:
        known = versions(self.spark, self.root)
        if known and not self.replace_all:
            self.tables = {**manifest(self.spark, self.root)["tables"], **self.tables}
        for test in self._checks:
            test({name: self.table(name) for name in self.tables})
        text = json.dumps({"version": self.version, "tables": self.tables}, indent=1)
        self._folder.publish(f"_manifests/{self.version}.json", text)
        return self.version

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self.commit()


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Drop all but the newest ``keep`` versions: their manifests first, then the folders
    that no remaining manifest names, those of failed builds that are older too."""
    folder, known = Folder(spark, root), versions(spark, root)
    if keep < 1:
        raise ValueError("the newest version is never dropped")
    gone = known[:-keep]
    for v in gone:
        folder.delete(f"_manifests/{v}.json")
    used = {t["path"] for v in known[-keep:] for t in manifest(spark, root, v)["tables"].values()}
    oldest = min(known[-keep:], default=0)
    for v in numbers([n[1:] for n in folder.names("") if n.startswith("v")]):
        if v < oldest:
            for name in folder.names(f"v{v}"):
                if f"v{v}/{name}" not in used:
                    folder.delete(f"v{v}/{name}")
    return gone
