"""As-of left join: each left row gets the latest right row at or before its time.

Spark has no native as-of join. A plain ``partitionBy(key)`` window over the union of both sides would put
a hot entity (a third of all rows) into one task, so the work is split by (key, time bucket):

1. a bucket table, one row per key and bucket, made by a partial aggregate: the bucket's last right row and
   whether it has left rows. Carried forward over a key's earlier buckets (as many as the data's time
   span has, however many rows a key has), it says with which right row a bucket begins;
2. that carry row joins the left and right rows of its bucket, ahead of them. One exchange by (key,
   bucket) and one sort bring them in order of time, right rows first on ties; the last right row so far,
   carried or not, is the match. No join and no second pass over the rows is needed.

Only step 2 moves the left rows; the bucket table reads their keys and times. A bucket holds what its key
has in that time; choose ``bucket`` so that the hottest key's rows in it fit a task (they may spill). Left
rows without a key or time match nothing; they are dealt over partitions of their own by a hash. The
result is exact: a match any number of buckets back is found. Work and shuffle are linear in the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 4096  # groups over which left rows without key or time are dealt


def asof_left_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str,
                   right_ts: str, right_cols: Sequence[str], bucket: str = "minute") -> DataFrame:
    """Left rows keep all columns; ``right_cols`` of the matched right row are appended.

    ``left_ts`` / ``right_ts`` are timestamp columns; rows with a null time or key never match.
    ``bucket`` is a ``date_trunc`` unit. Of right rows at one time the largest (by
    ``right_cols``) counts.
    """
    keys = list(by)
    known = lambda ts: reduce(and_, [F.col(c).isNotNull() for c in [*keys, ts]])
    trunc = lambda c: F.unix_seconds(F.date_trunc(bucket, c))
    rrow = F.struct(*right_cols)
    rtype = right.select(rrow.alias("x")).schema["x"].dataType
    none = lambda kind: F.lit(None).cast(kind)
    right = right.where(known(right_ts))

    # 1. the bucket table and what each bucket with left rows begins with
    def buckets(df: DataFrame, ts: str, last: Column, has_left: bool) -> DataFrame:
        return df.select(*keys, trunc(F.col(ts)).alias("_b"), last.alias("_last"),
                         F.lit(has_left).alias("_has"))
    last = F.struct(F.col(right_ts).alias("t"), rrow.alias("r"))
    last_type = right.select(last.alias("x")).schema["x"].dataType
    table = (buckets(right, right_ts, last, False)
             .unionByName(buckets(left.where(known(left_ts)), left_ts, none(last_type), True))
             .groupBy(*keys, "_b").agg(F.max("_last").alias("_last"), F.max("_has").alias("_has")))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (table.withColumn("_r", F.last("_last", ignorenulls=True).over(earlier)["r"])
             .where("_has and _r is not null").select(*keys, "_b", "_r"))

    # 2. carry, right and left rows of a bucket in one sorted partition
    absent = ~known(left_ts)
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(SPREAD))
    # the left columns keep their names: renames make Catalyst's constraints multiply
    def at(ts: Column, side: int) -> Column:
        return F.struct(ts.alias("t"), F.lit(side).alias("side")).alias("_at")
    empty = [none(f.dataType).alias(f.name) for f in left.schema if f.name not in keys]
    rows = (left.select("*", F.when(absent, spread).otherwise(trunc(F.col(left_ts))).alias("_b"),
                        absent.alias("_absent"), at(F.col(left_ts), 2), none(rtype).alias("_r"))
            .unionByName(right.select(*keys, *empty, trunc(F.col(right_ts)).alias("_b"),
                                      F.lit(False).alias("_absent"), at(F.col(right_ts), 1), rrow.alias("_r")))
            .unionByName(carry.select(*keys, *empty, "_b", F.lit(False).alias("_absent"),
                                      at(none(left.schema[left_ts].dataType), 0), "_r")))
    so_far = (Window.partitionBy(*keys, "_absent", "_b").orderBy("_at", "_r")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    match = F.last("_r", ignorenulls=True).over(so_far)
    return (rows.withColumn("_m", match).where("_at.side = 2")
            .select(*left.columns, *[F.col("_m")[c].alias(c) for c in right_cols]))
