"""Quality gate: the 31 declared checks pass on a built warehouse and fail on
broken inputs."""

import pytest
from pyspark.sql import functions as F

from marquee.operators import quality
from marquee.plans import driver, marts
from marquee.sources.sinks import table_writer
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    stg_c = driver.stg_catalogue(spark, SF_SMALL)
    stg_m = driver.stg_metrics(spark, SF_SMALL)
    return marts.build_warehouse(stg_c, stg_m, write=table_writer(spark, root))


def test_declared_checks_pass(warehouse):
    checks = quality.warehouse_checks(warehouse)
    assert len(checks) == 31
    rows = quality.run_checks(checks)
    assert all(n == 0 for *_, n in rows)


def test_one_pass_counts_agree_with_the_failing_rows(spark, warehouse):
    """failure_counts on broken tables against the rows each check lists."""
    t = dict(warehouse.tables())
    t["fct"] = t["fct"].unionByName(t["fct"].limit(3).withColumns({
        "game_key": F.lit(10**9).cast("bigint"), "date_key": F.lit(None).cast("int")}))
    t["dim_games"] = t["dim_games"].unionByName(t["dim_games"].limit(2))
    got = {tuple(r)[:3]: r.n_failing for r in quality.failure_counts(t).collect()}
    assert len(got) == 31
    for model, table, kind, col, parent in quality.DECLARED_CHECKS:
        failing = {"not_null": lambda: quality.check_not_null(t[table], col),
                   "unique": lambda: quality.check_unique(t[table], col),
                   "relationships": lambda: quality.check_relationship(t[table], col, t[parent], col)}[kind]()
        assert got[model, kind, col] == failing.count(), (model, kind, col)
    assert sum(got.values()) >= 3 + 3 + 2
    with pytest.raises(quality.QualityError):
        quality.gate(t)
    assert len(quality.gate(warehouse)) == 31


def test_broken_fact_fails_relationship(spark, warehouse):
    orphan = warehouse.fct.limit(1).withColumn("game_key", F.lit(10**9).cast("bigint"))
    broken = quality.check_relationship(warehouse.fct.unionByName(orphan), "game_key",
                                        warehouse.dim_games, "game_key")
    assert broken.count() == 1


def test_null_and_duplicate_keys_fail(spark, warehouse):
    dup = warehouse.dim_games.unionByName(warehouse.dim_games.limit(1))
    assert quality.check_unique(dup, "game_key").count() == 1
    nul = warehouse.dim_date.unionByName(
        warehouse.dim_date.limit(1).withColumn("date_key", F.lit(None).cast("int")))
    assert quality.check_not_null(nul, "date_key").count() == 1
    with pytest.raises(quality.QualityError):
        quality.run_checks([quality.Check("dim_games", "unique", "game_key",
                                          quality.check_unique(dup, "game_key"))])
