"""All registered queries over the driver tables, with their DuckDB oracle SQL."""

from __future__ import annotations

from . import driver, driver_dirty, driver_io, driver_ops, driver_pages, driver_store


def queries():
    out = {}
    out.update(driver.QUERIES)
    out.update(driver_ops.Q)
    out.update(driver_io.Q)
    out.update(driver_pages.Q)
    out.update(driver_dirty.Q)
    out.update(driver_store.Q)
    return out


def oracle_sql():
    out = {}
    out.update(driver.ORACLE)
    out.update(driver_ops.SQL)
    out.update(driver_io.SQL)
    out.update(driver_pages.SQL)
    out.update(driver_dirty.SQL)
    out.update(driver_store.SQL)
    return out
