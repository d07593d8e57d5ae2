"""Joins and rankings that stay distributed whatever the key distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# A side is broadcast only when a count has shown it to have at most this many (narrow) rows.
BROADCAST_ROWS = 2_000_000
# Hash-prefix buckets of the distributed ranking: three hex digits.
RANK_DIGITS = 3


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a narrow side for broadcast when its counted size is within the bound; otherwise leave the join to Spark."""
    return F.broadcast(df) if df.count() <= max_rows else df


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Semi-join to a key list: broadcast within the size bound, else a shuffled join whose hot keys AQE splits."""
    return df.join(broadcast_if_small(keys.select(*on), max_rows), list(on), "left_semi")


def stable_hash(*parts: Column | str, seed: int | str = "") -> Column:
    """md5 text over the parts: the same on every run, whatever the partitioning."""
    cols = [p if isinstance(p, Column) else F.col(p) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))


def smallest_per_group(df: DataFrame, group: Sequence[str], order: str, k: int, salt_digits: int = 2) -> DataFrame:
    """The ``k`` rows with the smallest hash per group.

    Ranked first inside (group, hash suffix), where the map side already drops all but k rows, then over the survivors
    (at most 256 * k per group), so no task sees a whole group.
    """
    salt = F.right(F.col(order), F.lit(salt_digits))
    local = Window.partitionBy(*group, "_salt").orderBy(order)
    final = Window.partitionBy(*group).orderBy(order)
    return (
        df.withColumn("_salt", salt)
        .withColumn("_rank", F.row_number().over(local)).where(F.col("_rank") <= k)
        .withColumn("_rank", F.row_number().over(final)).where(F.col("_rank") <= k)
        .drop("_salt", "_rank")
    )


def with_hash_rank(df: DataFrame, order: str, rank: str = "rank") -> DataFrame:
    """Exact 1-based rank over the whole table in hash order, without a single-task sort.

    Rows are ranked inside hash-prefix buckets; the bucket offsets are a running sum over at most 16**3 rows, which is
    also what bounds the broadcast.
    """
    prefix = F.substring(order, 1, RANK_DIGITS)
    sizes = df.groupBy(prefix.alias("_bucket")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy(order)
    return (
        df.withColumn("_bucket", prefix)
        .withColumn("_inside", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(rank, F.col("_offset") + F.col("_inside"))
        .drop("_bucket", "_inside", "_offset")
    )
