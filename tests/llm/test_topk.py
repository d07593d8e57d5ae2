import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gotera.llm import topk

LONG = 2**63


def truth(rows, k, every):
    usable = [(n, i, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows)
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in usable:
        if i is not None and i % every == 0:
            near = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -LONG), LONG - 1), j is None, j or 0)
                          for m, j, w in usable if m != n and len(w) == len(v))
            out += [(i, rank, None if unnamed else j, -s) for rank, (s, unnamed, j) in enumerate(near[:k], 1)]
    return sorted(map(repr, out))


def found(spark, rows, k, every, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({"rank": F.lit("x"), "row": F.lit(1), "low": F.lit(2)})
    return sorted(repr(tuple(r)) for r in topk.search(df, lambda v: v % every == 0, k).collect())


def vectors(n=400, dim=6):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, [0.5] * dim) for i in range(200)]  # a third are copies
    rows += [(2_000, [0.0] * dim), (2_050, [0.0] * dim), (50, [1.0] * dim), (50, [0.5] * dim), (None, [0.5] * dim), (None, [9.0] * dim)]
    rows += [(3_000, None), (3_050, [None] * dim), (3_100, [float("nan")] * dim), (3_150, [float("inf")] * dim), (3_200, []), (3_250, []),
             (3_300, [1.0, 2.0]), (3_350, [-1.0, 0.001])]
    return rows


def test_matches_brute_force(spark):
    rows = vectors()
    assert found(spark, rows, 5, 50) == truth(rows, 5, 50)


def test_many_passes_and_cells(spark, monkeypatch):
    """Few bins, small cells and small buffers: several passes, ties over many cells, the same result."""
    for name, value in (("BINS", 4), ("FEW", 0), ("QUERY_COMPONENTS", 18), ("LEAST_PART", 300), ("LARGEST_PART", 300), ("SCORES", 64),
                        ("PENDING", 50)):
        monkeypatch.setattr(topk, name, value)
    rows = vectors(150)
    assert found(spark, rows, 7, 50) == truth(rows, 7, 50)


def test_k_beyond_the_table(spark):
    rows = [(0, [1.0, 2.0]), (50, [2.0, -1.0]), (3, [0.5, 0.5])]
    assert found(spark, rows, 5, 50) == truth(rows, 5, 50)
    assert found(spark, rows[:1], 5, 50) == [] and found(spark, [], 5, 50) == []


def test_sums_beyond_doubles_and_longs(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * 10.0**rng.choice([1, 6, 9, 14, 40, 300]) for _ in range(3)]) for i in range(40)]
    rows += [(100, [2.0**26, 1.0, 0.0]), (101, [2.0**26, 1.0 + 2**-8, 0.0]), (102, [2.0**26, 1.0, 0.0])]
    assert found(spark, rows, 4, 2) == truth(rows, 4, 2)


def test_float_vectors_keep_their_values(spark):
    rows = [(i, [math.sin(i * 7.0 + j) for j in range(8)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert found(spark, exact, 5, 50, "float") == truth(exact, 5, 50)


def test_a_large_batch_is_reduced_on_its_way():
    """Many queries over one large batch of vectors: what a task holds follows the pending bound, not their product."""
    rng = np.random.default_rng(4)
    vectors, k = rng.integers(-50, 50, (12_000, 4)) / 256.0, 5
    n, asked = len(vectors), 1_500
    scores = np.rint((vectors[:asked] * 256) @ (vectors.T * 256)).astype(np.int64)
    scores[np.arange(asked), np.arange(asked)] = -LONG
    kth = np.sort(scores, axis=1)[:, -k]
    low, width = -2 * 50 * 50 * 4, 2 * 2 * 50 * 50 * 4 // topk.BINS + 1

    def batch(rows, side):
        whole = lambda value: pa.array([value] * rows, pa.int64())
        columns = {c: whole(v) for c, v in (("dim", 4), ("deal", 0), ("part", 0), ("side", side))}
        columns |= {"row": pa.array(range(rows)), "vec_id": pa.array(range(rows)), "unnamed": whole(0),
                    "vector": pa.array(list(vectors[:rows]), pa.list_(pa.float64()))}
        return pa.RecordBatch.from_pydict(columns | {c: whole(v) for c, v in zip(topk.RANGE, (low, LONG - 1, width, k))})

    batches = [batch(asked, 0), batch(n, 1)]
    for work in (topk.histogram(256), topk.reaching(256, k)):
        tracemalloc.start()
        made = pa.Table.from_batches(list(work(batches)))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100e6, f"{peak / 1e6:.0f} MB"
        if "bin" in made.column_names:
            upper = made.to_pandas().sort_values(["query", "bin"], ascending=[True, False])
            upper["reached"] = upper.groupby("query")["n"].cumsum()
            located = upper[upper["reached"] >= k].groupby("query")["bin"].max()
            assert (located.to_numpy() == (kth - low) // width).all() and len(located) == asked
        else:
            got = made.to_pandas().sort_values(["query", "score"], ascending=[True, False]).groupby("query")["score"]
            assert (got.min().to_numpy() == kth).all() and (got.size() == k).all()
