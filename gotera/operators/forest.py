"""Importances of class-balanced random forests over features, a random column and shuffled copies of the features.

The forests of all runs grow together, one level in one pass. Rows travel as blocks of ranks with one byte per value, the
number of its bin; a block's counts per node, feature, bin and class are made by numpy, and Spark adds them up and finds
the splits per tree. What a task holds is a block and the counts of one level.

The rules are those of Spark's forests: quantile bins, Poisson(1) row counts per tree, a square root of the inputs tried per
node, Gini gain, importances normed per tree. Draws depend on run, tree and block, never on partitions.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from gotera.operators.durable import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 32_768
BINS = 32
# Probes of a feature's distribution: values with a share of a thousandth get a bin of their own where bins allow it.
PROBES = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4_000_000


def split_points(probes: Sequence[float], bins: int = BINS) -> list[float]:
    """Lower bounds of the bins after the first: every distinct value, or about equal shares if there are more than ``bins``."""
    values, counts = np.unique(np.asarray(probes, dtype=float), return_counts=True)
    bounds = values[1:]
    if len(values) > bins:
        stride = target = counts.sum() / bins
        kept, reached = [], counts[0]
        for i, count in enumerate(counts[1:]):
            before, reached = reached, reached + count
            if abs(before - target) < abs(reached - target):
                kept.append(i)
                target += stride
        bounds = bounds[kept]
    return [float(b) for b in bounds if math.isfinite(b)]


def binned(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, int]:
    """The features as bin numbers ``_bin_<i>``, and the number of bins of the widest one."""
    share = [i / PROBES for i in range(PROBES + 1)]
    bounds = [split_points(p) for p in df.approxQuantile(list(features), share, 0.5 / PROBES)]
    split = {f: b for f, b in zip(features, bounds) if b}
    numbers = {f: F.lit(0) for f in features}
    if split:
        numbers |= {f: F.col(f"_bucket_{i}") for i, f in enumerate(split)}
        df = Bucketizer(inputCols=list(split), outputCols=[f"_bucket_{i}" for i in range(len(split))],
                        splitsArray=[[-math.inf, *b, math.inf] for b in split.values()]).transform(df)
    return df.withColumns({f"_bin_{i}": numbers[f].cast("tinyint") for i, f in enumerate(features)}), max(map(len, bounds)) + 1


def blocks(ranked: DataFrame, features: int, target: str, rows: int) -> DataFrame:
    """``ranked`` rows (``_rank``, target, bins) packed: per block of places the labels, then each feature's bins."""
    place = F.pmod("_rank", F.lit(rows))
    names = ["_label", *[f"_bin_{i}" for i in range(features)]]
    placed = ranked.withColumn("_label", F.col(target).cast("tinyint")).select(
        F.floor(place / BLOCK_ROWS).cast("int").alias("block"), F.pmod(place, F.lit(BLOCK_ROWS)).cast("int").alias("place"), *names)

    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(table["place"].to_numpy())
        cells = b"".join(table[n].to_numpy()[order].astype(np.uint8).tobytes() for n in names)
        return pa.table({"block": table["block"].slice(0, 1), "cells": pa.array([cells], pa.binary())})

    return placed.groupBy("block").applyInArrow(pack, "block int, cells binary")


def with_shifted(packed: DataFrame, features: int, rows: int, shifts: Sequence[Sequence[int]]) -> DataFrame:
    """Per run and block the labels, the features and their shadows: feature i of the place ``shifts[run][i]`` before."""
    width = 1 + features

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, cells in zip(batch["block"].to_pylist(), batch["cells"].to_pylist()):
                lines = np.frombuffer(cells, np.uint8).reshape(width, -1)
                out = []
                for run, moved in enumerate(shifts):
                    for line, shift in enumerate([0] * width + list(moved)):
                        values = lines[line if line < width else line - features]
                        at, done = (block * BLOCK_ROWS + shift) % rows, 0
                        while done < len(values):
                            start = at % BLOCK_ROWS
                            some = min(BLOCK_ROWS - start, rows - at, len(values) - done)
                            out.append((run, at // BLOCK_ROWS, line, start, values[done:done + some].tobytes()))
                            at, done = (at + some) % rows, done + some
                names = ["run", "block", "line", "start", "cells"]
                types = [pa.int32()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def assemble(table: pa.Table) -> pa.Table:
        size = max(s + len(c) for s, c in zip(table["start"].to_pylist(), table["cells"].to_pylist()))
        made = np.empty((width + features, size), np.uint8)
        for line, start, cells in zip(*[table[c].to_pylist() for c in ("line", "start", "cells")]):
            made[line, start:start + len(cells)] = np.frombuffer(cells, np.uint8)
        return pa.table({"run": table["run"].slice(0, 1), "block": table["block"].slice(0, 1),
                         "cells": pa.array([made.tobytes()], pa.binary())})

    moved = packed.mapInArrow(pieces, "run int, block int, line int, start int, cells binary")
    return moved.groupBy("run", "block").applyInArrow(assemble, "run int, block int, cells binary")


def poisson_counts() -> np.ndarray:
    """The Poisson(1) count of each of 65,536 equally likely draws."""
    below = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(below, (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


def inputs_tried(run: int, tree: int, level: int, nodes: int, inputs: int) -> np.ndarray:
    """Per node the inputs that its split may use: a square root of them, drawn anew for each node."""
    order = np.tile(np.arange(inputs), (nodes, 1))
    return np.random.default_rng([run, tree, level, nodes]).permuted(order, axis=1)[:, :math.ceil(math.sqrt(inputs))]


def reach(codes: np.ndarray, drawn: np.ndarray, levels) -> tuple[np.ndarray, np.ndarray]:
    """The drawn rows that reach an open node of the next level, and that node; rows in leaves are dropped.

    A code is twice the bin plus the label, so codes beyond ``2 * cut + 1`` lie right of a cut.
    """
    (feature, cut, child), *deeper = levels
    right = codes[feature[0]] > cut[0]
    wanted = drawn > 0
    if child.min() < 0:
        wanted &= right if child[1] >= 0 else ~right
    at = np.flatnonzero(wanted)
    node = child.take(right.take(at).view(np.uint8))
    flat, size = codes.ravel(), codes.shape[1]
    for feature, cut, child in deeper:
        right = flat.take((feature * size).take(node) + at) > cut.take(node)
        node = child.take(2 * node + right)
        if child.min() < 0:
            alive = np.flatnonzero(node >= 0)
            at, node = at.take(alive), node.take(alive)
    return at, node


def node_counts(codes: np.ndarray, drawn: np.ndarray, levels, tried: np.ndarray, bins: int) -> np.ndarray:
    """Counts of the drawn rows per open node, tried input, bin and class."""
    nodes, many = tried.shape
    if levels:
        at, node = reach(codes, drawn, levels)
        often, base, flat = drawn.take(at).astype(float), node * (2 * bins), codes.ravel()
        starts = tried * codes.shape[1]
        made = [np.bincount(base + flat.take(starts[:, j].take(node) + at), often, 2 * bins * nodes) for j in range(many)]
    else:
        often = drawn.astype(float)
        made = [np.bincount(codes[i], often, 2 * bins) for i in tried[0]]
    return np.stack([m.reshape(nodes, bins, 2) for m in made], axis=1)


def best_splits(counts: np.ndarray, weights: Sequence[float], tried: np.ndarray) -> dict[str, list]:
    """The split of each node by Gini gain; ``counts`` are per node, tried input, bin and class. Without a gain: feature -1."""
    left = np.cumsum(counts, axis=2)[:, :, :-1]
    right = counts.sum(axis=2, keepdims=True) - left

    def weight_and_impurity(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weighed = part * np.asarray(weights)
        total = weighed.sum(axis=-1)
        return total, 1 - ((weighed / np.maximum(total, 1e-300)[..., None]) ** 2).sum(axis=-1)

    whole, impurity = weight_and_impurity(counts.sum(axis=2)[:, 0])
    (of_left, left_impurity), (of_right, right_impurity) = weight_and_impurity(left), weight_and_impurity(right)
    scale = np.maximum(whole, 1e-300)[:, None, None]
    gain = impurity[:, None, None] - (of_left * left_impurity + of_right * right_impurity) / scale
    gain = np.where((left.sum(axis=-1) > 0) & (right.sum(axis=-1) > 0), gain, -1.0)
    place = gain.reshape(len(gain), -1).argmax(axis=1)
    node, (which, cut) = np.arange(len(gain)), np.unravel_index(place, gain.shape[1:])
    found = gain[node, which, cut]
    return {
        "feature": np.where(found > 0, tried[node, which], -1).tolist(), "cut": cut.tolist(), "gain": (found * whole).tolist(),
        "left": (left_impurity[node, which, cut] > 1e-12).tolist(), "right": (right_impurity[node, which, cut] > 1e-12).tolist()}


def importances(
    tables: DataFrame, features: int, bins: int, weights: Sequence[float], runs: int, trees: int, depth: int
) -> np.ndarray:
    """Per run the importance of the features, the random column and the shadows, of blocks made by ``with_shifted``."""
    inputs, bins = 2 * features + 1, max(bins, BINS)
    grown = {(run, tree): [] for run in range(runs) for tree in range(trees)}
    nodes = dict.fromkeys(grown, 1)
    gains = np.zeros((runs, trees, inputs))
    for level in range(depth if bins > 1 else 0):
        tried = {key: inputs_tried(*key, level, m, inputs) for key, m in nodes.items()}

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, copies = {}, poisson_counts()
            for batch in batches:
                for run, block, cells in zip(*[batch[c].to_pylist() for c in ("run", "block", "cells")]):
                    lines = np.frombuffer(cells, np.uint8).reshape(inputs, -1)
                    size = lines.shape[1]
                    noise = np.random.default_rng([run, block]).integers(0, BINS, (1, size), dtype=np.uint8)
                    codes = 2 * np.concatenate([lines[1:1 + features], noise, lines[1 + features:]]) + lines[0]
                    for tree in range(trees):
                        if (run, tree) in tried:
                            draws = np.random.default_rng([run, tree, block]).integers(0, 65_536, size, dtype=np.uint16)
                            made = node_counts(codes, copies.take(draws), grown[run, tree], tried[run, tree], bins)
                            sums[run, tree] = sums[run, tree] + made if (run, tree) in sums else made
            for (run, tree), made in sums.items():
                yield pa.RecordBatch.from_pydict({
                    "run": pa.array([run], pa.int32()), "tree": pa.array([tree], pa.int32()), "counts": [made.astype(np.int64).tobytes()]})

        def split(table: pa.Table) -> pa.Table:
            run, tree = table["run"][0].as_py(), table["tree"][0].as_py()
            total = sum(np.frombuffer(c, np.int64) for c in table["counts"].to_pylist())
            best = best_splits(total.reshape(*tried[run, tree].shape, bins, 2), weights, tried[run, tree])
            return pa.table({"run": pa.array([run], pa.int32()), "tree": pa.array([tree], pa.int32())} | {
                name: pa.array([values], pa.list_(kind)) for (name, values), kind in zip(
                    best.items(), [pa.int32(), pa.int32(), pa.float64(), pa.bool_(), pa.bool_()])})

        summed = tables.mapInArrow(count, "run int, tree int, counts binary").groupBy("run", "tree").applyInArrow(
            split, "run int, tree int, feature array<int>, cut array<int>, gain array<double>, left array<boolean>, "
                   "right array<boolean>")
        nodes = {}
        for r in summed.collect():
            key, child, opened = (r["run"], r["tree"]), [], 0
            for feature, gain, *impure in zip(r["feature"], r["gain"], r["left"], r["right"]):
                if feature >= 0:
                    gains[*key, feature] += gain
                for side in impure:
                    goes_on = side and feature >= 0 and level + 1 < depth
                    child.append(opened if goes_on else -1)
                    opened += goes_on
            grown[key].append((
                np.maximum(r["feature"], 0), (2 * np.asarray(r["cut"]) + 1).astype(np.uint8), np.asarray(child)))
            if opened:
                nodes[key] = opened
        if not nodes:
            break
    of_trees = gains / np.maximum(gains.sum(axis=2, keepdims=True), 1e-300)
    summed = of_trees.sum(axis=1)
    return summed / np.maximum(summed.sum(axis=1, keepdims=True), 1e-300)


def importances_beside_shadows(
    ranked: DataFrame, features: Sequence[str], target: str, sizes: tuple[int, int], weights: Sequence[float],
    shifts: Sequence[Sequence[int]], trees: int, depth: int,
) -> np.ndarray:
    """``importances`` of whole ``ranked`` rows (``_rank`` from 1, a 0/1 target, features without missing values)."""
    conf = ranked.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    numbered, bins = binned(ranked, features)
    packed = blocks(numbered, len(features), target, sum(sizes))
    tables = settle(with_shifted(packed, len(features), sum(sizes), shifts))
    return importances(tables, len(features), bins, weights, len(shifts), trees, depth)
