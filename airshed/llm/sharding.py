"""Sharding by a keyed permutation of the global row numbers.

Rows are numbered 0..n-1 in an order that depends on their values alone (hash bucket, then the
values). A Feistel network over [0, a) x [0, b), the smallest near-square grid that holds n
numbers, permutes the grid; numbers that land at n or above walk on along their cycle until they
fall below n. So row number -> position is a bijection of [0, n), and ``shard = position %
n_shards``, ``slot = position // n_shards`` can be computed, and inverted, without any table.
Shard sizes differ by at most one and slots have no gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 6  # even, so that the two halves end where they began
WALK = 64  # steps of the cycle walk; at most sqrt(n) of a*b numbers lie outside, see walk()


def _mix(key: Column, value: Column) -> Column:
    """60 bits of md5("key:value"), the round function; any language can compute it."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(":"), value.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def grid(n: Column) -> tuple[Column, Column]:
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("long")
    return a, F.floor((n + a - 1) / a).cast("long")


def feistel(x: Column, a: Column, b: Column, seed: int) -> Column:
    """One pass of the network over [0, a*b)."""
    start = F.struct(F.floor(x / b).cast("long").alias("l"), (x % b).alias("r"),
                     a.alias("m"), b.alias("k"))

    def turn(s: Column, key: Column) -> Column:
        return F.struct(s["r"].alias("l"), F.pmod(s["l"] + _mix(key, s["r"]), s["m"]).alias("r"),
                        s["k"].alias("m"), s["m"].alias("k"))

    keys = F.array(*[F.lit(seed * ROUNDS + i) for i in range(ROUNDS)])
    return F.aggregate(keys, start, turn, lambda s: s["l"] * b + s["r"])


def feistel_back(y: Column, a: Column, b: Column, seed: int) -> Column:
    """The inverse of :func:`feistel`."""
    start = F.struct(F.floor(y / b).cast("long").alias("l"), (y % b).alias("r"),
                     a.alias("m"), b.alias("k"))

    def turn(s: Column, key: Column) -> Column:
        return F.struct(F.pmod(s["r"] - F.pmod(_mix(key, s["l"]), s["k"]), s["k"]).alias("l"),
                        s["l"].alias("r"), s["k"].alias("m"), s["m"].alias("k"))

    keys = F.array(*[F.lit(seed * ROUNDS + i) for i in reversed(range(ROUNDS))])
    return F.aggregate(keys, start, turn, lambda s: s["l"] * b + s["r"])


def _walk(x: Column, n: Column, step) -> Column:
    """Walks the cycle of ``x`` until it is below n. Fewer than sqrt(n)+1 grid numbers lie outside,
    so up to n = 4096 no walk can exceed WALK steps, and beyond that one does with odds under
    64 ** -64. A longer walk fails the query; it never gives a wrong position."""
    y = F.aggregate(F.sequence(F.lit(2), F.lit(WALK + 1)), step(x),
                    lambda acc, _: F.when(acc < n, acc).otherwise(step(acc)))
    return F.when(y < n, y).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def permute(x: Column, n: Column, seed: int) -> Column:
    """Row number -> position, a bijection of [0, n)."""
    a, b = grid(n)
    return _walk(x, n, lambda v: feistel(v, a, b, seed))


def unpermute(y: Column, n: Column, seed: int) -> Column:
    """Position (slot * n_shards + shard) -> row number."""
    a, b = grid(n)
    return _walk(y, n, lambda v: feistel_back(v, a, b, seed))


def number_rows(df: DataFrame, buckets: int = 4096) -> DataFrame:
    """Adds ``_row``, a gapless global row number from 0, and ``_n``, the number of rows.

    The order is (bucket of the md5 of all values, values), whatever the partitioning. Equal
    rows are counted before the shuffle and spread again at the end, so copies, however many,
    cost one row per map task. Only ``buckets`` bucket totals are ever in one place.
    """
    cols = df.columns
    key = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x1e"))
                                      for c in cols]))
    rows = (df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count("*").alias("_copies"))
            .withColumn("_bucket", F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
                        % F.lit(buckets)))
    every = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (rows.groupBy("_bucket").agg(F.sum("_copies").alias("_sum"))
              .select("_bucket", F.coalesce(F.sum("_sum").over(every), F.lit(0)).alias("_offset"),
                      F.sum("_sum").over(Window.partitionBy()).alias("_n")))
    inside = (Window.partitionBy("_bucket").orderBy(*[F.col(f"`{c}`") for c in cols])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("_end", F.sum("_copies").over(inside))
            .join(F.broadcast(totals), "_bucket")  # at most `buckets` rows
            .withColumn("_first", F.col("_offset") + F.col("_end") - F.col("_copies"))
            .withColumn("_row", F.explode(F.sequence("_first",
                                                     F.col("_first") + F.col("_copies") - 1)))
            .select(*[F.col(f"`{c}`") for c in cols], "_row", "_n"))


def shard_rows(df: DataFrame, n_shards: int, seed: int = 1, buckets: int = 4096) -> DataFrame:
    """``df`` with ``shard`` (0..n_shards-1) and ``slot`` (gapless from 0).

    All columns of ``df`` together order the rows, so pass the narrow columns that identify a
    row. Nulls in any column are values like others; equal rows get positions of their own; an
    empty table gives an empty table. Columns named shard or slot are replaced.
    """
    df = df.drop("shard", "slot")
    at = permute(F.col("_row"), F.col("_n"), seed)
    return (number_rows(df, buckets).withColumn("_at", at)
            .withColumn("shard", (F.col("_at") % n_shards).cast("int"))
            .withColumn("slot", F.floor(F.col("_at") / n_shards).cast("long"))
            .drop("_row", "_n", "_at"))


def shard_documents(docs: DataFrame, n_shards: int = 8, seed: int = 1) -> DataFrame:
    """Shards of ``documents``: doc_id, size (UTF-8 bytes plus 1; a null text has none),
    text_crc32 (unsigned; 0 for a null text), law (``rows``: shard sizes differ by at most one),
    shard, slot, grown_shard (null under this law)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return (shard_rows(rows, n_shards, seed)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))

