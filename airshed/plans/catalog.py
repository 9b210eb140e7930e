"""The query catalog: name -> DataFrame builder, and name -> DuckDB oracle SQL."""

from __future__ import annotations

import functools

from airshed.plans import oracle
from airshed.plans import queries as Q


def _in_utc(fn):
    """Feed timestamps are UTC text; the plans are resolved against a UTC session zone.

    Time-zone-aware expressions capture the zone when the DataFrame is analysed (eagerly,
    while it is built), so pinning it here makes every result independent of the caller's
    session default.
    """
    @functools.wraps(fn)
    def build(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    return build


def queries():
    return {name: _in_utc(fn) for name, fn in Q.QUERIES.items()}


def oracle_sql():
    return oracle.oracle_sql()
