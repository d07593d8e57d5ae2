"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from gotera.llm.common import fresh, quoted, shuffle_width, stored

ROWS_PER_BUCKET = 100_000


def interleave(df: DataFrame, n_shards: int, stratum: str = "source", key: Sequence[str] = ("doc_id",), seed: int = 0,
               rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Every row with ``shard`` (0 to n_shards - 1) and ``slot`` (its gapless place in the shard, from 0).

    Rows are shuffled inside their stratum by a seeded hash of the key and ranked; rank r of n gets the fractional rank
    (2r - 1) / 2n. Sorting all rows by it interleaves the strata in proportion, and equal cuts of that order give shards
    whose row counts differ by at most one and whose mixture is that of the whole table, to within one row per stratum.

    Both rankings are made inside buckets (of the hash, then of the fractional rank) whose number follows the table and
    the session's shuffle width, plus bucket offsets; a stratum with a third of all rows is spread over all buckets.
    Only the columns of ``df`` travel, so project to what the shards need to name the rows.

    Null strata are one stratum of their own. Null keys are ordinary keys; repeated rows get places of their own, ties
    are broken by the whole row, so only fully equal rows can swap. Empty tables give empty shards. Columns of ``df``
    named shard or slot are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    layer, mixed, row, cell, place, size, before, frac, span, total = fresh(
        [*df.columns, "shard", "slot"], "layer", "mixed", "row", "cell", "place", "size", "before", "frac", "span", "total")
    rows = df.count()
    cells = max(-(-rows // rows_per_bucket), shuffle_width(df.sparkSession))
    hashed = F.md5(F.concat_ws("|", F.lit(str(seed)), *[quoted(k).cast("string") for k in key]))
    # the first 32 bits of the hash, scaled to the buckets: in hash order
    bucket = F.expr(f"conv(substring(`{mixed}`, 1, 8), 16, 10)").cast("bigint") * F.lit(cells)
    based = (
        df.select(*[quoted(c) for c in kept],
                  F.coalesce(F.concat(F.lit("="), quoted(stratum).cast("string")), F.lit("")).alias(layer),
                  hashed.alias(mixed), F.xxhash64(*[quoted(c) for c in kept]).alias(row))
        .withColumn(cell, F.shiftright(bucket, 32))
    )
    whole = Window.partitionBy(layer)
    sizes = (
        based.groupBy(layer, cell).agg(F.count("*").alias(size))
        .withColumn(before, F.coalesce(F.sum(size).over(
            whole.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn(total, F.sum(size).over(whole)).drop(size)
    )
    inside = Window.partitionBy(layer, cell).orderBy(mixed, *[quoted(k) for k in key], row)
    double_rank = F.lit(2) * (quoted(before) + quoted(place)) - 1
    ranked = stored(
        based.withColumn(place, F.row_number().over(inside)).join(sizes, [layer, cell])
        .withColumn(frac, double_rank / (F.lit(2.0) * quoted(total)))
        .withColumn(span, F.floor(quoted(frac) * F.lit(cells)))
        .drop(cell, place, before, total), "interleave")
    offsets = (
        ranked.groupBy(span).agg(F.count("*").alias(size))
        .withColumn(before, F.coalesce(F.sum(size).over(
            Window.orderBy(span).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop(size)
    )
    order = Window.partitionBy(span).orderBy(frac, layer, mixed, *[quoted(k) for k in key], row)
    # one row per bucket, a hundred-thousandth of the table: the bound of the broadcast
    placed = ranked.withColumn(place, F.row_number().over(order)).join(F.broadcast(offsets), span)
    at = quoted(before) + quoted(place) - 1
    return (
        placed.withColumn(place, at)
        .withColumn("shard", F.expr(f"(`{place}` * {n_shards}L) div {max(rows, 1)}L").cast("int"))
        .withColumn("slot", quoted(place) - F.expr(f"(shard * {rows}L + {n_shards - 1}L) div {n_shards}L"))
        .select(*[quoted(c) for c in kept], "shard", "slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside each file."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
