"""Merkle manifest of a dataset: a tree per group, a tree over their roots, and proofs that a recursive query climbs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from gotera.llm.common import fresh, quoted, run_folder, stored
from gotera.operators.skew import broadcast_if_small

#: Binary levels that one stored level of node rows spans.
SPAN = 10
#: Node rows are broadcast to the climbing leaves up to this many bytes; beyond it the join is shuffled.
BROADCAST_BYTES = 64_000_000
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
TOP = -1
DIGESTS = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field_text(value: Column) -> Column:
    """A field's unambiguous text: ``-`` for null, else its UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return sha(F.concat(*[field_text(f) for f in fields]))


def placed(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Every row with ``out``, its place (from 0) in its group by ``order``, nulls first; no group is one task.

    Rows are range-partitioned by group and order (and by where they were read, so that equal rows are spread too) and
    written with their partition's number; a row's place is its rank inside its partition plus the sizes of the group's
    earlier partitions, of which there are at most as many as partitions and groups together.
    """
    part, spread, size, before = fresh([*df.columns, out], "part", "spread", "size", "before")
    keys = [quoted(c) for c in (*group, *order)]
    cut = stored(
        df.withColumn(spread, F.monotonically_increasing_id()).repartitionByRange(*keys, F.col(spread))
        .withColumn(part, F.spark_partition_id()), "placed")
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(part, *group).agg(F.count("*").alias(size)).withColumn(
        before, F.coalesce(F.sum(size).over(earlier), F.lit(0))).drop(size)
    same = cut[part] == sizes[part]
    for name in group:
        same = same & cut[name].eqNullSafe(sizes[name])
    inside = Window.partitionBy(part, *group).orderBy(*order, spread)
    numbered = cut.withColumn(out, F.row_number().over(inside) - 1)
    chosen = [numbered[c] for c in df.columns]
    return numbered.join(broadcast_if_small(sizes), same).select(*chosen, (numbered[out] + sizes[before]).alias(out))


def levels_of(digests: Column, n: Column, span: int) -> Column:
    """The ``span`` levels above a block's hex digests, lowest first: pairs are hashed together, an odd last one alone,
    while the whole level (``n`` nodes at the bottom) has more than one node."""
    def up(level: Column) -> Column:
        pair = lambda i: sha(F.concat(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit(""))))
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")), pair)

    def add(levels: Column, j: Column) -> Column:
        last = F.element_at(levels, -1)
        return F.concat(levels, F.array(F.when(n > F.call_function("shiftleft", F.lit(1).cast("bigint"), j), up(last)).otherwise(last)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(span - 1)), F.array(digests), add)


def steps_of(levels: Column, place: Column, n: Column, span: int) -> Column:
    """A node's way up through ``levels``: at each its sibling (null for an odd last node) and whether that is left."""
    def step(j: int) -> Column:
        at = F.shiftright(place, j)
        return F.when(n > 2**j, F.struct(
            F.unhex(F.get(F.get(levels, F.lit(j)), at.bitwiseXOR(1))).alias("sibling"), (at % 2 == 1).alias("left")))

    return F.array_compact(F.array(*[step(j) for j in range(span)]))


def fold(digest: Column, steps: Column) -> Column:
    """The hex digest at the end of ``steps``, from the hex digest of their first node."""
    def one(acc: Column, s: Column) -> Column:
        sibling = F.coalesce(hexed(s["sibling"]), F.lit(""))
        return sha(F.when(s["left"], F.concat(sibling, acc)).otherwise(F.concat(acc, sibling)))

    return F.aggregate(steps, digest, one)


def siblings(steps: Column) -> Column:
    """The digests of ``steps`` behind one another (binary)."""
    return F.aggregate(steps, F.unhex(F.lit("")), lambda acc, s: F.concat(acc, F.coalesce(s["sibling"], F.unhex(F.lit("")))))


def node_rows(nodes: DataFrame, level: int, span: int) -> DataFrame:
    """Node rows of one stored level, from its nodes (tree, n, rank, pos, digest and what they carry).

    A row names its parent (tree, level, pos) one stored level up: in its own tree, from a tree's root the leaf of the top
    tree that has the tree's rank, from the top's root nothing. ``up`` is the parent's digest, on the block's first row.
    """
    block = F.shiftright("pos", span)
    content = F.struct("pos", *[c for c in nodes.columns if c not in ("tree", "n", "rank", "pos")])
    blocks = nodes.groupBy("tree", block.alias("block")).agg(
        F.first("n").alias("n"), F.first("rank").alias("rank"), F.array_sort(F.collect_list(content)).alias("held"))
    risen = blocks.withColumn("levels", levels_of(F.transform("held", lambda h: hexed(h["digest"])), F.col("n"), span))
    # a block's levels stay in its row: its nodes leave it with their own steps only
    each = risen.select("tree", "n", "rank", "block", F.explode(F.transform("held", lambda h, i: F.struct(
        h.alias("node"), steps_of(F.col("levels"), i, F.col("n"), span).alias("steps"),
        F.when(i == 0, F.unhex(F.get(F.element_at("levels", -1), F.lit(0)))).alias("up")))).alias("e"))
    inner, top = F.col("n") > 2**span, F.col("tree") == TOP
    return each.select(
        "tree", F.lit(level).alias("level"), "e.node.*", "n", "rank", "e.steps",
        F.when(inner, F.col("tree")).when(~top, F.lit(TOP).cast("bigint")).alias("parent_tree"),
        F.when(inner, F.lit(level + 1)).when(~top, F.lit(0)).alias("parent_level"),
        F.when(inner, F.col("block")).when(~top, F.col("rank")).alias("parent_pos"), "e.up")


def climb_up(rows: DataFrame, n: int, folder: str, span: int) -> list[DataFrame]:
    """Stored levels above the lowest, ``rows``, whose largest tree has ``n`` nodes; each is read back from ``folder``."""
    out, level = [], 0
    while n > 2**span:
        n, level = -(-n // 2**span), level + 1
        risen = rows.where("up is not null and parent_tree = tree").select(
            "tree", F.ceil(F.col("n") / 2**span).cast("bigint").alias("n"), "rank", F.col("parent_pos").alias("pos"),
            F.col("up").alias("digest"))
        node_rows(risen, level, span).write.parquet(f"{folder}/{level}")
        rows = rows.sparkSession.read.parquet(f"{folder}/{level}")
        out.append(rows)
    return out


@dataclass
class Manifest:
    """A built tree: its leaf rows, its higher node rows, the root of every group and the root of all."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str


def tops(levels: Sequence[DataFrame]) -> DataFrame:
    """(rank, tree, subroot) of every tree whose root one of ``levels`` reaches."""
    found = [rows.where("up is not null and (parent_tree is null or parent_tree <> tree)").select(
        "tree", "rank", F.col("up").alias("digest")) for rows in levels]
    whole = found[0]
    for other in found[1:]:
        whole = whole.unionByName(other)
    return whole


def build(leaves: DataFrame, group: str, order: str, digest: str, span: int = SPAN) -> Manifest | None:
    """The manifest over ``leaves`` (distinct from each other or not): a binary tree per ``group`` over its rows in the
    order of ``order`` and digest, and a tree over the groups' roots in the order of the group (nulls first, bytewise).

    Levels are stored as node rows, one stored level for ``span`` binary ones: at most ceil(bits / span) + 1 jobs over a
    table that each time is 2**span times smaller. No group is one task: rows are placed by range partitions, hashed in
    blocks of 2**span. None for an empty table.
    """
    pos, = fresh(leaves.columns, "pos")
    spot = stored(placed(leaves, [group], [order, digest], pos), "leaves")
    sizes = spot.groupBy(group).agg(F.count("*").alias("n"))
    trees = stored(placed(sizes.withColumnRenamed(group, "name"), [], ["name"], "tree"), "trees")
    facts = trees.agg(F.max("n"), F.count("*")).first()
    if not facts[1]:
        return None
    folder = run_folder(leaves.sparkSession, "merkle")
    named = broadcast_if_small(trees)
    carried = [c for c in leaves.columns if c not in (group, digest)]
    based = spot.join(named, spot[group].eqNullSafe(named["name"])).select(
        "tree", "n", F.col("tree").alias("rank"), quoted(pos).alias("pos"), quoted(digest).alias("digest"), *carried)
    node_rows(based, 0, span).write.parquet(f"{folder}/leaves")
    bottom = leaves.sparkSession.read.parquet(f"{folder}/leaves")
    higher = climb_up(bottom, facts[0], f"{folder}/group", span)
    subroots = tops([bottom, *higher])
    summit = subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(facts[1]).cast("bigint").alias("n"),
                             F.lit(None).cast("bigint").alias("rank"), F.col("rank").alias("pos"), "digest")
    node_rows(summit, 0, span).write.parquet(f"{folder}/top")
    first = leaves.sparkSession.read.parquet(f"{folder}/top")
    upper = [first, *climb_up(first, facts[1], f"{folder}/summit", span)]
    root = tops(upper[-1:]).select(hexed(F.col("digest"))).first()[0]
    nodes = upper[0]
    for rows in [*higher, *upper[1:]]:
        nodes = nodes.unionByName(rows.select(*nodes.columns))
    return Manifest(bottom, nodes, subroots.select("tree", hexed(F.col("digest")).alias("subroot")), root)


def climbed(manifest: Manifest, start: Column, carried: Sequence[str], span: int = SPAN) -> DataFrame:
    """Every leaf with ``folded`` and ``proof``: a recursive query takes each leaf from its node row to the root's.

    A leaf starts from ``start`` (a hex digest: its own, or that of tampered content), and each step up folds the
    siblings of a node row into it and appends them to the proof. The higher node rows are a 2**span-th of the leaves;
    they are broadcast where their size is within the bound, else joined by a shuffle whose hot nodes AQE splits.
    """
    spark = manifest.leaves.sparkSession
    views = [f"merkle_{kind}_{uuid.uuid4().hex}" for kind in ("leaf", "node")]
    manifest.leaves.select(
        *[quoted(c) for c in carried], F.col("tree").alias("own_tree"), F.unhex(fold(start, F.col("steps"))).alias("folded"),
        siblings(F.col("steps")).alias("proof"), "parent_tree", "parent_level", "parent_pos").createOrReplaceTempView(views[0])
    manifest.nodes.select("tree", "level", "pos", "steps", "parent_tree", "parent_level", "parent_pos").createOrReplaceTempView(
        views[1])
    bytes_a_row = 40 * span + 60
    hint = "/*+ BROADCAST(n) */" if manifest.nodes.count() * bytes_a_row <= BROADCAST_BYTES else ""
    kept = "".join(f"`{c}`, " for c in carried)
    passed = "".join(f"c.`{c}`, " for c in carried)
    folding = ("aggregate(n.steps, lower(hex(c.folded)), (acc, s) -> sha2(if(s.left, "
               "concat(coalesce(lower(hex(s.sibling)), ''), acc), concat(acc, coalesce(lower(hex(s.sibling)), ''))), 256))")
    limit = spark.conf.get(ROW_LIMIT)
    try:
        spark.conf.set(ROW_LIMIT, "-1")
        found = spark.sql(f"""
            WITH RECURSIVE climb AS (
              SELECT {kept} own_tree, folded, proof, parent_tree AS tree, parent_level AS level, parent_pos AS pos
              FROM {views[0]}
              UNION ALL
              SELECT {hint} {passed} c.own_tree, unhex({folding}),
                aggregate(n.steps, c.proof, (acc, s) -> concat(acc, coalesce(s.sibling, unhex('')))),
                n.parent_tree, n.parent_level, n.parent_pos
              FROM climb c JOIN {views[1]} n ON c.tree = n.tree AND c.level = n.level AND c.pos = n.pos
            )
            SELECT {kept} own_tree, folded, proof FROM climb WHERE tree IS NULL""")
        return stored(found, "climbed")
    finally:
        spark.conf.set(ROW_LIMIT, limit)
        for view in views:
            spark.catalog.dropTempView(view)


def prove(df: DataFrame, fields: Sequence[str], changed: dict[str, Column], tampered: Column, key: str = "doc_id",
          group: str = "lang", span: int = SPAN) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    A row's leaf hashes its ``fields``; ``changed`` gives other values for some of them, with which the rows where
    ``tampered`` holds are folded up again against the siblings of the untampered tree. ``proof_sha256`` hashes the
    siblings from the leaf to the root (that of no siblings where a row is alone). Leaves of a group stand by key, then
    digest; null keys come first, null groups are a group of their own, and equal rows are leaves of their own with
    proofs of their own. Null fields differ from empty ones. A null in ``tampered`` means untampered. An empty table gives
    no rows. Texts are read once and never shuffled; only digests and keys are.
    """
    cols = [quoted(f) for f in fields]
    other = [changed.get(f, quoted(f)) for f in fields]
    hashes = df.select(
        quoted(key).alias("given_key"), quoted(group).alias("given_group"), F.unhex(leaf_digest(cols)).alias("digest"),
        F.when(tampered, F.unhex(leaf_digest(other))).alias("bent"))
    manifest = build(stored(hashes, "digests"), "given_group", "given_key", "digest", span)
    if manifest is None:
        none = F.lit(None).cast("string")
        return df.limit(0).select(quoted(key).alias(key), *[none.alias(n) for n in DIGESTS], F.lit(None).cast("boolean").alias("verified"))
    start = hexed(F.coalesce("bent", "digest"))
    found = climbed(manifest, start, ["given_key", "digest"], span).withColumnRenamed("own_tree", "tree")
    return found.join(broadcast_if_small(manifest.subroots), "tree").select(
        F.col("given_key").alias(key), hexed(F.col("digest")).alias("leaf"), "subroot", F.lit(manifest.root).alias("root"),
        sha(hexed(F.col("proof"))).alias("proof_sha256"), hexed(F.col("folded")).alias("folded_root"),
        (hexed(F.col("folded")) == F.lit(manifest.root)).alias("verified"))
