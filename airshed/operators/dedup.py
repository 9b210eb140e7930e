"""Deduplication and latest-per-key (DDP1-DDP4, WIN1-WIN2) as partial aggregates.

Both operators are ``groupBy(key).agg(min_by / max_by(struct))``: Spark runs a partial
aggregate before the shuffle, so a hot key (say one entity holding a third of all rows, or
thousands of copies of one record) is collapsed inside each map task and reaches the
reducer as at most one row per task.  A ``row_number()`` window would instead ship every
copy to one task and sort it there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order_by`` tuple.

    By default the tuple is every non-key column in schema order (nulls first), which makes
    the choice independent of file and partition order: equal tuples are equal rows.
    """
    others = [c for c in df.columns if c not in keys]
    value = F.struct(*others)
    if order_by is None:
        picked = F.min(value)
    else:
        picked = F.min_by(value, F.struct(*order_by))
    return (df.groupBy(*keys).agg(picked.alias("_keep"))
              .select(*keys, "_keep.*").select(*df.columns))


def latest_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
              cols: Sequence[str]) -> DataFrame:
    """Per ``keys`` the ``cols`` of the row with the largest ``order_by`` tuple."""
    return (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*cols), F.struct(*order_by)).alias("_last"))
              .select(*keys, "_last.*"))


def first_in_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """DDP2: keep the first row per key in arrival order (``order_by`` ascending)."""
    return keep_first(df, keys, order_by)


def horizon_list(horizons) -> "F.Column":
    """DDP4: distinct, non-negative, ascending horizon list of an array column."""
    h = F.col(horizons) if isinstance(horizons, str) else horizons
    return F.array_sort(F.array_distinct(F.filter(h, lambda x: x >= 0)))
