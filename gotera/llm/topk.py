"""Exact top-k search by inner product of whole-number vectors: distributed histogram selection."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gotera.llm.common import mapped, quoted, shuffle_width, stored
from gotera.operators.skew import broadcast_if_small

#: Components of the queries that a cell holds (32 MB of doubles), and of the vectors that stream past them: parts are of
#: the lesser size while they are fewer than the session's shuffle partitions, and of the greater size at most.
QUERY_COMPONENTS = 1 << 22
LEAST_PART, LARGEST_PART = 1 << 18, 1 << 24
#: Scores that are looked at in one piece, and found rows that are held before they are reduced, whatever a batch holds.
SCORES = PENDING = 1 << 18
BINS = 1_024
#: A query is refined no further when at most this many rows reach the bin that holds its k-th value.
FEW = 64
EXACT = 2.0**53
LONG = 2**63
CELL = ["dim", "deal", "part"]
RANGE = ["low", "high", "width", "need"]


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held in doubles, exact: in doubles where no sum can pass 2**53, else in Python's
    integers, clamped to the range of a long."""
    if queries.shape[1] * np.abs(queries).max(initial=0.0) * np.abs(data).max(initial=0.0) < EXACT:
        return (queries @ data.T).astype(np.int64)
    left, right = ([[int(x) for x in row] for row in side.tolist()] for side in (queries, data))
    return np.array([[min(max(sum(map(int.__mul__, a, b)), -LONG), LONG - 1) for b in right] for a in left], np.int64)


class Queries:
    """The queries of a cell: row number, whole-number vector, and the range of scores that is looked at."""

    def __init__(self, held: list[tuple]):
        self.row, self.vectors, self.low, self.high, self.width, self.need = (np.concatenate(c) for c in zip(*held))

    def scores(self, data: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first query, first vector, scores) of blocks of the queries against blocks of ``data``."""
        for i in range(0, len(self.row), 1_024):
            mine = self.vectors[i:i + 1_024]
            wide = max(1, SCORES // len(mine))
            for j in range(0, len(data), wide):
                yield i, j, products(mine, data[j:j + wide])


def cells(batches, scale: int) -> Iterator[tuple[Queries, tuple | None]]:
    """Streams rows sorted by cell, queries before vectors: a cell's queries with each run of its vectors (row, vec_id,
    unnamed, data), and with None where the cell ends."""
    name, held, queries = None, [], None
    for batch in batches:
        if not len(batch):
            continue
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        keys = np.stack([columns[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in [*CELL, "side"]])
        row, vec_id, unnamed, low, high, width, need = (
            columns[c].to_numpy(zero_copy_only=False) for c in ("row", "vec_id", "unnamed", *RANGE))
        start = 0
        for end in (np.flatnonzero(np.r_[(keys[:, 1:] != keys[:, :-1]).any(axis=0), True]) + 1).tolist():
            here = tuple(keys[:-1, start].tolist())
            if here != name:
                if queries:
                    yield queries, None
                name, held, queries = here, [], None
            flat = columns["vector"].slice(start, end - start).flatten().to_numpy(zero_copy_only=False)
            # products over the largest double count as the largest double
            with np.errstate(over="ignore"):
                data = np.nan_to_num(np.floor(flat.astype(np.float64) * scale)).reshape(end - start, here[0])
            if keys[-1, start] == 0:
                held.append((row[start:end], data, *(c[start:end] for c in (low, high, width, need))))
            elif held or queries:
                if not queries:
                    queries, held = Queries(held), []
                yield queries, (row[start:end], vec_id[start:end], unnamed[start:end], data)
            start = end
    if queries:
        yield queries, None


def upper_bins(query: np.ndarray, at: np.ndarray, n: np.ndarray, need: np.ndarray):
    """Counts summed by (query, bin), and of each query only the bins from the top until they hold what it needs.

    What lies lower cannot hold the wanted value: the cell alone has enough above it.
    """
    code, where = np.unique(query * BINS + at, return_inverse=True)
    total = np.bincount(where, weights=n, minlength=len(code)).astype(np.int64)
    query, at = code // BINS, code % BINS
    ends = np.flatnonzero(np.r_[query[1:] != query[:-1], True]) if len(query) else np.zeros(0, np.int64)
    reached = np.cumsum(total)
    above = np.repeat(reached[ends], np.diff(np.r_[-1, ends])) - reached
    kept = above < need[query]
    return query[kept], at[kept], total[kept]


def counted_so_far(held: list[tuple], queries: Queries, floor: np.ndarray) -> tuple:
    """The held counts summed up and cut to upper bins; ``floor`` rises where a query's bins hold what it needs."""
    query, at, n = upper_bins(*(np.concatenate(c) for c in zip(*held)), queries.need)
    full = np.bincount(query, weights=n, minlength=len(floor)) >= queries.need
    lowest = np.full(len(floor), BINS, np.int64)
    np.minimum.at(lowest, query, at)
    floor[full] = queries.low[full] + queries.width[full] * lowest[full]
    return query, at, n


def histogram(scale: int):
    """(query, bin, n): per cell and query, how many scores lie in each bin of the query's range, its upper bins only.

    Counts are summed up as soon as ``PENDING`` are held, also amid the vectors of one batch.
    """
    def run(batches):
        held: list[tuple] = []
        size, owner, floor = 0, None, None
        for queries, vectors in cells(batches, scale):
            if queries is not owner:
                owner, held, size = queries, [], 0
                floor = queries.low.copy()
            if vectors is None:
                if held:
                    query, at, n = counted_so_far(held, queries, floor)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(queries.row[query]), pa.array(at), pa.array(n)], names=["query", "bin", "n"])
                    held = []
                continue
            for i, j, score in queries.scores(vectors[3]):
                mine = slice(i, i + len(score))
                query, column = np.nonzero((score >= floor[mine, None]) & (score <= queries.high[mine, None]))
                own = queries.row[query + i] == vectors[0][column + j]
                query, found = query[~own] + i, score[query[~own], column[~own]]
                if len(query):
                    at = (found - queries.low[query]).view(np.uint64) // queries.width[query].view(np.uint64)
                    held.append((query, at.astype(np.int64), np.ones(len(query), np.int64)))
                    size += len(query)
                if size > PENDING:
                    held, size = [counted_so_far(held, queries, floor)], 0

    return run


def best(found: list[tuple], keep: int) -> tuple:
    """Of (query, score, unnamed, vec_id, row) the ``keep`` best of each query: largest score, then smallest id."""
    query, score, unnamed, vec_id, row = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((row, vec_id, unnamed, ~score, query))
    query = query[order]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    order = order[rank < keep]
    return query[rank < keep], score[order], unnamed[order], vec_id[order], row[order]


def best_so_far(found: list[tuple], keep: int, floor: np.ndarray) -> tuple:
    """The ``keep`` best of the found rows; ``floor`` rises to the last of them where a query has as many."""
    kept = best(found, keep)
    full = np.flatnonzero(np.bincount(kept[0], minlength=len(floor)) >= keep)
    last = np.searchsorted(kept[0], full, side="right") - 1
    floor[full] = np.maximum(floor[full], kept[1][last])
    return kept


def reaching(scale: int, keep: int):
    """(query, score, unnamed, vec_id, row): per cell and query, the best ``keep`` of the rows that reach its bound."""
    def run(batches):
        found: list[tuple] = []
        size, owner, floor = 0, None, None
        for queries, vectors in cells(batches, scale):
            if queries is not owner:
                owner, found, size, floor = queries, [], 0, queries.low.copy()
            if vectors is None:
                if found:
                    kept = best_so_far(found, keep, floor)
                    yield pa.RecordBatch.from_arrays([pa.array(queries.row[kept[0]]), *map(pa.array, kept[1:])],
                                                     names=["query", "score", "unnamed", "vec_id", "row"])
                    found = []
                continue
            for i, j, score in queries.scores(vectors[3]):
                query, column = np.nonzero(score >= floor[i:i + len(score), None])
                own = queries.row[query + i] == vectors[0][column + j]
                query, column = query[~own], column[~own]
                if len(query):
                    found.append((query + i, score[query, column], *(vectors[c][column + j] for c in (2, 1, 0))))
                    size += len(query)
                if size > PENDING:
                    found, size = [best_so_far(found, keep, floor)], 0

    return run


def met(rows: DataFrame, queries: DataFrame, sizes: DataFrame) -> DataFrame:
    """Cells of queries and vectors of one length: every block of queries meets every part of the vectors once."""
    spark = rows.sparkSession
    width = shuffle_width(spark)
    asked = queries.groupBy("dim").agg(F.count("*").alias("asked"))
    deals = F.ceil(F.col("asked") * F.greatest("dim", F.lit(1)) / QUERY_COMPONENTS).cast("int")
    volume = F.col("n") * F.greatest("dim", F.lit(1))
    parts = F.greatest(F.ceil(volume / LARGEST_PART), F.least(F.lit(width), F.ceil(volume / LEAST_PART))).cast("int")
    grid = stored(sizes.join(asked, "dim").select("dim", deals.alias("deals"), parts.alias("parts")), "grid")
    total = grid.agg(F.sum(F.col("deals") * F.col("parts"))).first()[0] or 1
    own = lambda n: F.array(F.pmod(F.xxhash64("row"), n.cast("bigint")).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    nothing = F.lit(0).cast("bigint")
    shape = [*CELL, "side", "row", "vec_id", "unnamed", "vector", *RANGE]
    small = broadcast_if_small(grid)
    asking = queries.join(small, "dim").withColumn("part", F.explode(every(F.col("parts")))).withColumns(
        {"deal": own(F.col("deals"))[0], "side": F.lit(0)})
    lying = rows.join(small, "dim").withColumn("deal", F.explode(every(F.col("deals")))).withColumns(
        {"part": own(F.col("parts"))[0], "side": F.lit(1), **dict.fromkeys(RANGE, nothing)})
    both = asking.select(*shape).unionByName(lying.select(*shape))
    return both.repartition(max(1, min(int(total), 16 * width)), *CELL).sortWithinPartitions(*CELL, "side")


def refined(state: DataFrame, counted: DataFrame) -> DataFrame:
    """The state with each query's range narrowed to the bin that holds its k-th value.

    Where fewer rows than needed are left, the range stays and the query is done: all of it is wanted.
    """
    down = Window.partitionBy("query").orderBy(F.desc("bin"))
    bins = counted.groupBy("query", "bin").agg(F.sum("n").alias("n")).withColumn(
        "above", F.sum("n").over(down) - F.col("n")).withColumnRenamed("query", "row")
    chosen = bins.join(state.select("row", "need"), "row").where("above < need and above + n >= need").drop("need")
    joined = state.join(chosen, "row", "left")
    found = F.col("bin").isNotNull()
    left = F.col("need") - F.col("above")
    low = F.col("low").cast("decimal(38,0)") + F.col("bin").cast("decimal(18,0)") * F.col("width")
    high = F.least(low + F.col("width") - 1, F.col("high").cast("decimal(38,0)"))
    return joined.select(
        "row", F.when(found, low.cast("bigint")).otherwise(F.col("low")).alias("low"),
        F.when(found, high.cast("bigint")).otherwise(F.col("high")).alias("high"),
        F.when(found, F.ceil(F.col("width") / BINS).cast("bigint")).otherwise(F.col("width")).alias("width"),
        F.when(found, left).otherwise(F.col("need")).alias("need"),
        (~found | (F.col("width") == 1) | (F.col("k") - left + F.col("n") <= FEW)).alias("done"), "k")


def search(df: DataFrame, query_of: Callable[[Column], Column], k: int = 5, vec_id: str = "vec_id",
           vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id ``query_of`` selects, the ``k`` largest inner products over
    all rows but itself, of vectors whose components are floor(scale * x); equal scores by the smaller id.

    1. Every query's scores against all rows are counted in 1,024 bins of its range (at first plus and minus the product
       of its norm and the largest). The counts of all cells are added up, and the bin that holds the k-th largest score
       becomes the query's new range, until that bin is a single score or at most 64 rows reach it. A cell reports a
       query's upper bins only, which hold k rows, so what is shuffled follows queries times cells.
    2. The rows that reach the located bound are filtered out of all scores, at most k a query and cell, and ranked by
       score, then id.

    Scores are computed anew in every pass, in cells that hold a bounded block of queries and stream a part of the
    vectors past it; nothing grows with the number of rows but the number of cells. Rows are dealt to cells by hash of
    their number, so neither repeated ids nor equal vectors make a cell large.

    Vectors that are null or hold null or non-finite components take no part. Vectors of different lengths never meet;
    zero vectors are vectors like others. Rows that repeat an id are rows of their own (each asks, and each can be found by
    the other); rows with a null id ask nothing and are found last among equals. Scores outside the range of a long are
    clamped to it. An empty table gives no rows.
    """
    kind = df.select(quoted(vector)).schema[0].dataType
    plain = "array<float>" if kind == T.ArrayType(T.FloatType(), kind.containsNull) else "array<double>"
    inf = F.lit(float("inf"))
    usable = df.select(quoted(vec_id).cast("bigint").alias("given"), quoted(vector).cast(plain).alias("vector")).where(
        F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < inf)))
    # floor(y) lies within one of y
    size = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (F.abs(x.cast("double") * scale) + 1) ** 2)
    rows = stored(usable.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce("given", F.lit(0)).alias("vec_id"),
        F.col("given").isNull().cast("int").alias("unnamed"), query_of(F.col("given")).alias("asks"),
        F.size("vector").alias("dim"), F.sqrt(size).alias("norm"), "vector"), "vectors")
    sizes = stored(rows.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("largest")), "sizes")
    asking = rows.where("asks")
    reach = F.least(F.col("norm") * F.col("largest") * (1 + 1e-9) + 1, F.lit(9.2e18))
    clamped = reach >= 9.2e18
    state = stored(asking.join(broadcast_if_small(sizes), "dim").select(
        "row", F.when(clamped, F.lit(-LONG)).otherwise(-F.ceil(reach)).cast("bigint").alias("low"),
        F.lit(LONG - 1).alias("high"), F.when(clamped, F.lit(2 * LONG // BINS)).otherwise(
            F.ceil(reach / (BINS // 2)) + 1).cast("bigint").alias("width"), F.lit(k).cast("bigint").alias("need"),
        F.lit(False).alias("done"), F.lit(k).alias("k")), "state")
    named = asking.select("row", "dim", "vec_id", "unnamed", "vector")
    finished = state.limit(0)
    while not state.isEmpty():
        asked = named.join(state.select("row", *RANGE), "row")
        counted = mapped(met(rows, asked, sizes), histogram(scale), "query bigint, bin bigint, n bigint")
        state = stored(refined(state, counted), "state")
        finished = finished.unionByName(state.where("done"))
        state = state.where("not done")
    asked = named.join(finished.select("row", *RANGE), "row")
    found = mapped(met(rows, asked, sizes), reaching(scale, k), "query bigint, score bigint, unnamed int, vec_id bigint, row bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "unnamed", "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = asking.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.join(ids, "query").select(
        "query_id", "rank", F.when(F.col("unnamed") == 0, F.col("vec_id")).alias("vec_id"), "score")
