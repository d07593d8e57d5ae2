"""Approximate nearest neighbours by multiprobe p-stable hashing."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gotera.llm.common import mapped, quoted, stored
from gotera.operators.skew import broadcast_if_small

TABLES = 6
WIDTH = 1.2
SEED = 7
INDEX_PER_CELL = 4_096
QUERIES_PER_CELL = 1_024
PENDING = 1_000_000
BAND_STEP = 0x9E3779B97F4A7C15
CELL = ["tab", "bucket", "part", "deal"]


def hashes_for(rows: int) -> int:
    """Hash functions per table: a quarter of the doublings of the table, so buckets stay fine enough as it grows."""
    return round(math.log2(rows) / 4) if rows > 1 else 0


def probes_for(hashes: int) -> int:
    return max(1, 2 ** (hashes + 1) - 2)


def probing_order(place: np.ndarray, count: int) -> list[tuple[tuple[int, int], ...]]:
    """The ``count`` sets of (hash, -1 or +1) moves most likely to hold a neighbour, best first, the empty set leading.

    ``place`` is where the query lies in its slot of each hash (0 to 1). A move's score is its squared distance to the
    slot crossed into; sets are made in the order of their sums by shifting and extending the last element.
    """
    moves = sorted([(p * p, i, -1) for i, p in enumerate(place)] + [((1 - p) ** 2, i, 1) for i, p in enumerate(place)])
    cost = [m[0] for m in moves]
    out, heap = [()], [(cost[0], (0,))] if moves else []
    while heap and len(out) < count:
        total, chosen = heapq.heappop(heap)
        if len({moves[c][1] for c in chosen}) == len(chosen):
            out.append(tuple(moves[c][1:] for c in chosen))
        last = chosen[-1]
        if last + 1 < len(moves):
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return out


def projections(size: int, hashes: int, tables: int, width: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Gaussian directions, offsets and odd mixing factors of each table; the last direction is for the added component."""
    rng = np.random.default_rng([SEED, size])
    for _ in range(tables):
        yield (rng.normal(size=(size + 1, hashes)), rng.uniform(0, width, hashes),
               rng.integers(-2**62, 2**62, hashes, dtype=np.int64) * 2 + 1)


def hashed(vectors: DataFrame, bands: dict[int, list[tuple[int, float, int]]], tables: int, width: float,
           with_vectors: bool = True) -> DataFrame:
    """A row per table (and, for queries, per probed bucket) of (kind, vid, least, vector, band).

    Largest inner products become nearest points: indexed vectors are scaled by the largest norm of their band and get
    the component that puts them on the unit sphere, queries are scaled to it. ``bands`` lists (band, largest norm, hash
    functions) by length of vector; each band has its own buckets, and queries probe those of every band of their length.
    """
    def run(batches):
        for batch in batches:
            kind, band = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 4))
            rows = [np.asarray(v) for v in batch.column(3).to_numpy(zero_copy_only=False)]
            out = []
            for size in {len(r) for r in rows}:
                every = np.array([i for i, r in enumerate(rows) if len(r) == size])
                for number, largest, hashes in bands.get(size, []):
                    at = every[(kind[every] == 1) | (band[every] == number)]
                    if not len(at):
                        continue
                    data = np.stack([rows[i] for i in at]).astype(np.float64)
                    norm = np.linalg.norm(data, axis=1)
                    scale = np.where(kind[at] == 1, norm, largest)
                    unit = data / scale[:, None]
                    added = np.where(kind[at] == 1, 0.0, np.sqrt(np.maximum(0.0, 1 - (unit * unit).sum(axis=1))))
                    points = np.concatenate([unit, added[:, None]], axis=1)
                    probes, mark = probes_for(hashes), size + number * BAND_STEP
                    for tab, (a, b, odd) in enumerate(projections(size, hashes, tables if hashes else 1, width)):
                        placed = (points @ a + b) / width
                        slots = np.floor(placed).astype(np.int64)
                        keys = (slots * odd).sum(axis=1)
                        for j, i in enumerate(at):
                            moves = probing_order(placed[j] - slots[j], probes) if kind[i] == 1 else [()]
                            for moved in moves:
                                shift = mark + sum((int(odd[h]) * step for h, step in moved), 0)
                                out.append((i, tab, (int(keys[j]) + shift + 2**63) % 2**64 - 2**63))
            for start in range(0, len(out), 20_000):
                part = out[start:start + 20_000]
                take = np.array([p[0] for p in part])
                chosen = batch.take(pa.array(take))
                values = chosen.column(3) if with_vectors else pa.nulls(len(part), batch.schema.field(3).type)
                yield pa.RecordBatch.from_arrays(
                    [chosen.column(0), chosen.column(1), chosen.column(2), values,
                     pa.array([p[1] for p in part], pa.int32()), pa.array([p[2] for p in part], pa.int64())],
                    names=["kind", "vid", "least", "vector", "tab", "bucket"])

    number = vectors.schema["vector"].dataType.simpleString()
    return mapped(vectors, run, f"kind int, vid bigint, least bigint, vector {number}, tab int, bucket bigint")


def best_of(held: list[np.ndarray], keep: int) -> np.ndarray:
    """(query, vid, least, score) rows without repeats, the ``keep`` best of each query by score, then smallest id."""
    rows = np.concatenate(held)
    rows = rows[np.lexsort((rows["vid"], rows["least"], -rows["score"], rows["query"]))]
    same = np.zeros(len(rows), bool)
    same[1:] = (rows["query"][1:] == rows["query"][:-1]) & (rows["vid"][1:] == rows["vid"][:-1])
    rows = rows[~same]
    starts = np.flatnonzero(np.r_[True, rows["query"][1:] != rows["query"][:-1]]) if len(rows) else np.zeros(0, int)
    rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
    return rows[rank < keep]


FOUND = np.dtype([("query", np.int64), ("vid", np.int64), ("least", np.int64), ("score", np.float64)])


PACKED = "query bigint, vid array<bigint>, least array<bigint>, score array<double>"


def packed(rows: np.ndarray) -> pa.RecordBatch:
    """A row per query with its best vectors as lists; ``rows`` are in query order."""
    starts = np.flatnonzero(np.r_[True, rows["query"][1:] != rows["query"][:-1]]) if len(rows) else np.zeros(0, int)
    ends = pa.array(np.r_[starts, len(rows)].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows["query"][starts]), *[pa.ListArray.from_arrays(ends, pa.array(rows[n])) for n in ("vid", "least", "score")]],
        names=list(FOUND.names))


def merge_lists(keep: int):
    """The best of each query over the lists of several tasks; rows come in query order, and one query is held at a time
    with those of its batch."""
    def run(batches):
        held = np.zeros(0, FOUND)
        for batch in batches:
            if not len(batch):
                continue
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            rows = np.empty(int(sizes.sum()), FOUND)
            rows["query"] = np.repeat(batch.column(0).to_numpy(), sizes)
            for i, n in enumerate(("vid", "least", "score"), 1):
                rows[n] = batch.column(i).flatten().to_numpy()
            held = best_of([held, rows], keep)
            open_query = held["query"] == batch.column(0)[-1].as_py()
            yield unpacked(held[~open_query])
            held = held[open_query]
        yield unpacked(held)

    return run


def unpacked(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[n]) for n in FOUND.names], names=list(FOUND.names))


def near_in_cell(queries: np.ndarray, asked: np.ndarray, data: np.ndarray, vid: np.ndarray, least: np.ndarray,
                 keep: int) -> np.ndarray:
    """Every query's best vectors of one cell; scores are summed component by component, the same for any block."""
    rough = queries @ data.T
    if data.shape[0] > keep:
        slack = 1e-12 * queries.shape[1] * np.abs(queries).max() * np.abs(data).max()
        floor = np.partition(rough, data.shape[0] - keep, axis=1)[:, data.shape[0] - keep] - slack
        row, col = np.nonzero(rough >= floor[:, None])
    else:
        row, col = (g.ravel() for g in np.indices(rough.shape))
    score = np.zeros(len(row))
    for j in range(queries.shape[1]):
        score += queries[row, j] * data[col, j]
    out = np.empty(len(row), FOUND)
    out["query"], out["vid"], out["least"], out["score"] = asked[row], vid[col], least[col], score
    return best_of([out], keep)


def search_cells(keep: int):
    """Streams rows sorted by cell, queries before vectors, and emits a row per query: its best over the task's cells.

    What is held is one cell's queries, one Arrow batch, and at most ``PENDING`` found rows.
    """
    def run(batches):
        cell, asked, queries, held, size = None, None, None, [], 0
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        for batch in batches:
            if not len(batch):
                continue
            named = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            keys = np.stack([named[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in [*CELL, "turn"]])
            vid, least = (named[c].to_numpy(zero_copy_only=False) for c in ("vid", "least"))
            vectors = named["vector"]
            ends = np.flatnonzero(np.r_[(keys[:, 1:] != keys[:, :-1]).any(axis=0), True]) + 1
            start = 0
            for end in ends:
                here, is_query = tuple(keys[:-1, start]), keys[-1, start] == 0
                if here != cell:
                    cell, parts, queries = here, [], None
                flat = vectors.slice(start, end - start).flatten().to_numpy(zero_copy_only=False)
                data = flat.reshape(end - start, -1).astype(np.float64)
                if is_query:
                    parts.append((vid[start:end], data))
                elif parts:
                    if queries is None:
                        asked, queries = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                    found = near_in_cell(queries, asked, data, vid[start:end], least[start:end], keep)
                    held.append(found)
                    size += len(found)
                    if size > PENDING:
                        held = [best_of(held, keep)]
                        size = len(held[0])
                        if size > PENDING // 2:
                            yield packed(held[0])
                            held, size = [], 0
                start = end
        if held:
            yield packed(best_of(held, keep))

    return run


def dealt(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows with the cell they meet in: a bucket, or for a large bucket one of its blocks of vectors times queries."""
    many = stored(counts.where((F.col("n_index") > INDEX_PER_CELL) | (F.col("n_query") > QUERIES_PER_CELL)).select(
        "tab", "bucket", F.ceil(F.col("n_index") / INDEX_PER_CELL).cast("int").alias("parts"),
        F.ceil(F.col("n_query") / QUERIES_PER_CELL).cast("int").alias("deals")), "large-buckets")
    one = F.lit(1)
    sized = rows.join(broadcast_if_small(many), ["tab", "bucket"], "left").withColumns(
        {"parts": F.greatest(F.coalesce("parts", one), one), "deals": F.greatest(F.coalesce("deals", one), one)})
    own = lambda n: F.array(F.pmod(F.xxhash64("vid"), n.cast("bigint")).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    query = F.col("kind") == 1
    return (
        sized.withColumn("part", F.explode(F.when(query, every(F.col("parts"))).otherwise(own(F.col("parts")))))
        .withColumn("deal", F.explode(F.when(query, own(F.col("deals"))).otherwise(every(F.col("deals")))))
        .select(*CELL, (1 - F.col("kind")).alias("turn"), "vid", "least", "vector")
    )


def candidates(index: DataFrame, queries: DataFrame, bands: dict[int, list[tuple[int, float, int]]], tables: int,
               width: float, keep: int) -> DataFrame:
    """(query, vid, least, score): for each query its best distinct vectors among the buckets it probes."""
    shape = ["kind", "vid", "least", "vector", "band"]
    both = index.select(F.lit(0).alias("kind"), "vid", "least", "vector", "band").unionByName(
        queries.select(F.lit(1).alias("kind"), "vid", F.lit(0).cast("bigint").alias("least"), "vector",
                       F.lit(0).alias("band"))).select(*shape)
    counts = hashed(both, bands, tables, width, with_vectors=False).groupBy("tab", "bucket").agg(
        F.count(F.when(F.col("kind") == 0, 1)).alias("n_index"), F.count(F.when(F.col("kind") == 1, 1)).alias("n_query"))
    cells = dealt(hashed(both, bands, tables, width), counts)
    met = mapped(cells.repartition(*CELL).sortWithinPartitions(*CELL, "turn"), search_cells(keep), PACKED)
    return mapped(met.repartition("query").sortWithinPartitions("query"), merge_lists(keep),
                  "query bigint, vid bigint, least bigint, score double")


def nearest(df: DataFrame, query_of, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", tables: int = TABLES,
            width: float = WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for every row that ``query_of`` (a
    condition on the id column) selects, over all rows but the query's own; nearest first, ties to the smaller id.

    All distinct vectors are indexed, by bands of norms (factors of two about the powers of two), so a few long vectors do
    not press the others together; small bands have coarse buckets. Each table concatenates p-stable hashes; a query looks into its own bucket and the
    buckets next to it in the order of their estimated chance, in every table and band, and what the tables give is merged and
    scored exactly in double precision on the original vectors. Queries that found fewer than ``k``
    others while there are more look at all of them.

    Equal vectors are one index entry with its k + 1 smallest ids, which is all that a result can hold, so a vector that a
    third of the rows share costs no more than another. Buckets over 4,096 vectors or 1,024 queries are dealt to cells
    (blocks of vectors times blocks of queries); nothing is left out. Rows with a null id, and vectors that are null,
    empty, zero or hold null or non-finite components take no part. Vectors of different lengths never meet. Rows that
    repeat an id are rows of their own, but an id asks once for each distinct vector.
    """
    given = df.select(quoted(vector)).schema[0].dataType
    kind = "array<float>" if given.simpleString() == "array<float>" else "array<double>"
    usable = df.select(quoted(vec_id).cast("bigint").alias("vec_id"), quoted(vector).cast(kind).alias("vector")).where(
        "vec_id is not null and vector is not null and size(vector) > 0 and "
        "forall(vector, x -> x is not null and not isnan(x) and abs(cast(x as double)) < cast('inf' as double)) and "
        "exists(vector, x -> x <> 0)")
    keep = k + 1
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    first = Window.partitionBy("vector").orderBy("vec_id")
    index = stored(
        usable.withColumn("n", F.row_number().over(first)).where(F.col("n") <= keep)
        .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.xxhash64("vector").alias("vid"), F.element_at("ids", 1).alias("least"), "ids", "vector", norm.alias("norm"))
        .withColumn("band", F.round(F.log2("norm")).cast("int")), "vectors")
    asking = usable.where(query_of(F.col("vec_id"))).select("vec_id", F.xxhash64("vector").alias("vid"), "vector").distinct()
    queries = asking.groupBy("vid").agg(F.first("vector").alias("vector"))
    count = index.count()
    bands: dict[int, list[tuple[int, float, int]]] = {}
    for r in index.groupBy(F.size("vector").alias("size"), "band").agg(
            F.count("*").alias("n"), F.max("norm").alias("largest")).collect():
        bands.setdefault(r["size"], []).append((r["band"], r["largest"], hashes_for(r["n"])))
    found = stored(candidates(index, queries, bands, tables, width, keep), "found")
    enough = found.groupBy("query").count().where(F.col("count") >= min(keep, count)).select(F.col("query").alias("vid"))
    lacking = stored(queries.join(enough, "vid", "left_anti"), "lacking")
    if any(hashes for held in bands.values() for _, _, hashes in held) and not lacking.isEmpty():
        coarse = {size: [(band, largest, 0) for band, largest, _ in held] for size, held in bands.items()}
        whole = candidates(index, lacking, coarse, 1, width, keep)
        found = found.join(lacking.select(F.col("vid").alias("query")), "query", "left_anti").unionByName(whole)
    spread = found.join(index.select("vid", "ids"), "vid").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = (
        spread.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
        .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("near"))
    )
    answers = asking.select(F.col("vec_id").alias("query_id"), F.col("vid").alias("query")).join(lists, "query")
    own = F.array_position(F.transform("near", lambda n: n["vec_id"]), F.col("query_id"))
    others = F.filter("near", lambda n, i: (own == 0) | (i != own.cast("int") - 1))
    return answers.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "n")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"),
        F.col("n.score").alias("score"))
