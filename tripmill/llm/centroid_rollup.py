"""Sums over the subtrees of a forest by centroid decomposition."""

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm._common import materialised

#: Components of at most so many nodes are settled by one task, or of this share of all nodes if that is more. So there are
#: never more larger components than the share allows, and a row for each of them may be broadcast.
LOCAL_NODES = 50_000
LARGER_COMPONENTS = 50_000

#: Nodes of one chain that meet at one key when their ancestor is looked up.
STRIP = 1024


def settle(parent: np.ndarray, size: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Subtree sums of ``own`` (value, node) in a forest given by each node's parent, -1 for tops; parents come first.

    ``size`` is a weight of each subtree, that of its nodes added up. Each round takes the centroid out of every component: the deepest
    node that has over half the component's weight below it or in itself. The nodes with over half of it are just the
    path from there to the top, so the total at and below the centroid is added along them, and their weight gets less by as much.
    """
    node = np.arange(len(parent))
    parent, size = parent.copy(), size.copy()
    more, total = np.zeros_like(own), np.zeros_like(own)
    open_ = np.ones(len(parent), bool)
    top = _tops(parent, node)
    while open_.any():
        path = open_ & (2 * size > size[top])
        centroid = np.full(len(node), -1)
        np.maximum.at(centroid, top[path], node[path])
        mine = centroid[top]
        is_centroid = open_ & (mine == node)
        parent[open_ & (parent == mine)] = -1
        split = _tops(parent, node)
        below = open_ & ((split != top) | is_centroid)
        sums = np.zeros_like(own)
        for part, values in zip(sums, own, strict=True):
            np.add.at(part, top[below], values[below])
        total[:, is_centroid] = (sums[:, top] + more)[:, is_centroid]
        above = path & ~is_centroid
        more[:, above] += sums[:, top[above]]
        size[above] -= size[mine[above]]
        open_ &= ~is_centroid
        parent[is_centroid] = -1
        top = _tops(parent, node)
    return total


def _tops(parent: np.ndarray, node: np.ndarray) -> np.ndarray:
    up = np.where(parent < 0, node, parent)
    while True:
        higher = up[up]
        if np.array_equal(higher, up):
            return up
        up = higher


def _settled(rows: pa.Table, values: Sequence[str]) -> pa.RecordBatch:
    component = rows["top"].combine_chunks().dictionary_encode().indices.to_numpy()
    parent = pc.fill_null(pc.index_in(rows["parent"], value_set=rows["key"].combine_chunks()), -1).to_numpy().astype(np.int64)
    # What lies above a component's top may be a neighbour here.
    parent[(parent >= 0) & (component[parent] != component)] = -1
    own = np.array([rows[f"own_{v}"].to_numpy() for v in values], np.int64)
    total = settle(parent, rows["size"].to_numpy(), own)
    total += np.array([rows[f"more_{v}"].to_numpy() for v in values], np.int64)
    return pa.RecordBatch.from_arrays([rows["key"].combine_chunks(), *map(pa.array, total)], ["key", *values])


def _settle_small(values: Sequence[str], at_a_time: int):
    """Whole components, one after the other, as many at a time as make a fair batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, last = 0, None
        for batch in batches:
            tops = batch.column("top")
            if not len(batch):
                continue
            if count >= at_a_time and (last != tops[0].as_py() or last != tops[-1].as_py()):
                # The component that may go on in this batch ends at its first row of another one.
                other = pc.index(pc.equal(tops, last), False).as_py()
                yield _settled(pa.Table.from_batches([*held, batch.slice(0, other)]), values)
                held, count, batch = [], 0, batch.slice(other)
            held.append(batch)
            count += len(batch)
            last = tops[-1].as_py()
        if held:
            yield _settled(pa.Table.from_batches(held), values)

    return run


def centroid_rollup(
    nodes: DataFrame,
    places: DataFrame,
    values: Sequence[str],
    *,
    local_nodes: int = LOCAL_NODES,
    larger_components: int = LARGER_COMPONENTS,
) -> DataFrame:
    """``key`` and, for each of ``values``, the sum over the node's subtree, the node included.

    ``nodes`` has ``key, parent, top`` (its tree's top), ``depth`` (0 for tops), ``weight`` and the values, all whole numbers. ``weight``
    is a weight of the node's subtree: that of its nodes, each over 0, added up. Each node has a ``line`` that leads from the
    top through it, and ``places`` has the nodes of all lines: ``line, depth, key, parent``.

    A component of more than ``local_nodes`` nodes is split by whole Spark jobs, one round for all such components: its centroid
    goes out of it, what is below falls apart into a component for each child, and the total at and below the centroid is added along the
    path from it to the component's top. After each round no component has more than half its weight, so rounds grow with
    the logarithm of the weight only, also for a chain of a third of all nodes. Smaller components are settled the same way within
    tasks. No more than ``larger_components`` components are split in a round, so a row for each may be broadcast. Empty nodes give an
    empty result.
    """
    whole = [F.col(c).cast("long").alias(f"own_{c}") for c in values]
    none = [F.lit(0).cast("long").alias(f"more_{c}") for c in values]
    state = materialised(
        nodes.select("key", "parent", "top", "line", "depth", F.col("weight").cast("long").alias("size"), *whole, *none), "rollup-nodes"
    )
    limit = max(local_nodes, state.count() // larger_components)
    settled, small = [], []
    while True:
        components = state.groupBy("top").agg(F.max("size").alias("whole"), F.count(F.lit(1)).alias("n"))
        large = materialised(components.where(F.col("n") > limit).select("top", "whole"), "rollup-large")
        small.append(state.join(F.broadcast(large), "top", "left_anti"))
        if large.isEmpty():
            break
        state, centroids = _split(state.join(F.broadcast(large), "top"), places, values)
        settled.append(centroids)
    rest = reduce(DataFrame.unionByName, small).repartition("top").sortWithinPartitions("top", "depth")
    schema = ", ".join(["key string", *[f"{v} bigint" for v in values]])
    local = rest.drop("line").mapInArrow(_settle_small(values, local_nodes), schema)
    return reduce(DataFrame.unionByName, settled, local)


def _split(state: DataFrame, places: DataFrame, values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Take the centroid out of every component: the nodes that stay, in their new components, and the centroids with their sums."""
    on_path = F.col("size") * 2 > F.col("whole")
    deepest = F.max_by(F.struct("key", "depth", "size"), "depth").alias("c")
    centroids = materialised(state.where(on_path).groupBy("top").agg(deepest).select("top", "c"), "rollup-centroids")
    state = state.join(F.broadcast(centroids), "top").withColumn("strip", F.floor(F.col("depth") / STRIP))
    # Nodes of one line below the centroid's depth share the line's node just below it: whether that is the centroid's child
    # says whether they are below it, and which component they are in now.
    lines = state.where(F.col("depth") > F.col("c.depth")).select(
        "line", "strip", "top", F.col("c.key").alias("_key"), (F.col("c.depth") + 1).alias("_depth")
    )
    at = places.select(F.col("line").alias("_line"), F.col("depth").alias("_at"), F.col("key").alias("branch"), F.col("parent").alias("_parent"))
    branches = (
        lines.distinct()
        .join(at, (F.col("line") == F.col("_line")) & (F.col("_depth") == F.col("_at")) & (F.col("_key") == F.col("_parent")))
        .select("line", "strip", "top", "branch")
    )
    state = state.join(branches, ["line", "strip", "top"], "left")
    is_centroid = F.col("key") == F.col("c.key")
    # Above the centroid a line has no branch yet.
    below = F.when(F.col("depth") > F.col("c.depth"), F.col("branch"))
    state = materialised(state.withColumn("branch", below), "rollup-split")
    totals = state.where(is_centroid | F.col("branch").isNotNull()).groupBy("top").agg(
        *[F.sum(f"own_{v}").alias(f"sum_{v}") for v in values]
    )
    state = state.join(F.broadcast(materialised(totals, "rollup-sums")), "top")
    above = on_path & ~is_centroid
    added = {f"more_{v}": F.col(f"more_{v}") + F.when(above, F.col(f"sum_{v}")).otherwise(0) for v in values}
    done = state.where(is_centroid).select("key", *[(F.col(f"sum_{v}") + F.col(f"more_{v}")).alias(v) for v in values])
    left = (
        state.where(~is_centroid)
        .withColumns(added)
        .withColumn("size", F.col("size") - F.when(above, F.col("c.size")).otherwise(0))
        .withColumn("top", F.coalesce("branch", "top"))
    )
    kept = ["key", "parent", "top", "line", "depth", "size", *[f"{p}_{v}" for p in ("own", "more") for v in values]]
    return left.select(*kept), done
