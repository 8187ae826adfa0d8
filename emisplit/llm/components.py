"""Connected components of an edge table by alternating large and small stars.

Before edges are shuffled each task contracts its own: of the edges it holds only a star per local
component is left. That removes what is there twice, keeps what is connected, and shortens paths, so few rounds follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emisplit.llm.common import forget, stored

#: Edges that a task contracts at once.
_MOST = 1 << 21


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for every node that is not that itself."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        if (low == root[x]).all() and (low == root[y]).all():
            break
        # Roots of both ends move to the smaller one, and every node to its root's root.
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while not (root[root] == root).all():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        a, b = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c) for c in contracted(a, b)], names=["a", "b"])

    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")))
        size += batch.num_rows
        if size >= _MOST:
            yield flush()
            size = 0
    if held:
        yield flush()


def contract(edges: DataFrame) -> DataFrame:
    """Edges ``a`` > ``b`` that connect what ``edges`` connect, those of each task contracted."""
    return edges.select("a", "b").mapInArrow(_contracted, "a long, b long")


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Link neighbours of each node to the smallest one around it.

    The large star moves the larger neighbours of a node, the small star the
    smaller ones and the node itself. Minima are combined before the shuffle; the neighbours of one
    node meet in one task, less those that a task has contracted.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    near = both.where("v < u") if small else both.where("v > u")
    moved = near.join(low, "u").select(F.col("v").alias("x"), F.col("low").alias("y"))
    if small:
        moved = moved.unionByName(low.select(F.col("u").alias("x"), F.col("low").alias("y")))
    moved = moved.where("x != y")
    # What several tasks would say again goes before they contract: each gives no more edges than it has.
    return contract(moved.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())


def _is_forest(edges: DataFrame) -> bool:
    """Whether every edge leads from a leaf to the root of its star."""
    end = lambda name, leaf: F.struct(F.col(name).alias("x"), F.lit(leaf).alias("leaf"))
    ends = edges.distinct().select(F.explode(F.array(end("a", 1), end("b", 0))).alias("e"))
    ends = ends.groupBy("e.x").agg(F.sum("e.leaf").alias("up"), F.min("e.leaf").alias("low"))
    return ends.where("up > 1 or (up = 1 and low = 0)").isEmpty()


def nearest_roots(edges: DataFrame) -> DataFrame:
    """``node, root`` after one step along the edges and one from there: nodes with one root are connected.

    Connected nodes may still have different roots; it takes two shuffles where components take many.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("root")))
    low = stored(both.groupBy("node").agg(F.min("root").alias("low")).select("node", F.least("node", "low").alias("root")), "roots")
    above = low.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return low.join(above, "root", "left").select("node", F.least("root", "next").alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that has an edge; ``root`` is the smallest node of its component.

    ``edges`` has long columns ``a`` and ``b``. Every round is written to the
    shared folder; rounds end when only stars are left, after about the
    logarithm of the longest path of contracted edges. Loops and repeated edges don't matter.
    """
    now = stored(contract(edges.where("a != b")).distinct(), "edges")
    while not _is_forest(now):
        after = stored(_star(_star(now, small=False), small=True), "edges")
        forget(now)
        now = after
    rows = now.distinct()
    roots = rows.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return rows.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
