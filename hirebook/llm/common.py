"""Helpers shared by the operators: scratch tables and connected components."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirebook.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared scratch folder and read it back.

    Cuts the lineage: what follows survives lost executors without computing
    ``df`` again, and several readers share one computation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lean(run):
    """``run`` for ``mapInArrow``, giving back what a partition's batches held.

    Spark keeps its Python workers from stage to stage, and neither Arrow nor
    the C library returns freed memory on its own; a stage after this one would
    stand on it.
    """
    def partition(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)
    return partition


def without(rows: DataFrame, gone: DataFrame, keys: list[str], most: int = 200_000) -> DataFrame:
    """``rows`` without those whose ``keys`` are in ``gone``, a small stored
    table: broadcast up to ``most`` of its rows, else joined by key."""
    return rows.join(F.broadcast(gone) if gone.count() <= most else gone, keys, "left_anti")


def connected_components(edges: DataFrame, max_rounds: int = 80) -> DataFrame:
    """Smallest reachable node of every node of an edge table.

    ``edges``: two columns of one orderable type, in any order, repeats and
    loops allowed.  Returns (node, component) for every node that has an edge
    to another node; nodes without one are absent (they are their own
    component).  Rows with a null end are no edges.

    Alternating large-star / small-star rounds: each is two joins on a node
    and sums that combine before the shuffle; a hub's neighbours are never
    gathered in one row.  The edge set of each round is a scratch table.
    """
    left, right = edges.columns
    a, b = F.col(left), F.col(right)
    e = materialise(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = _signature(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(lowest.select("u", F.col("m").alias("v"))))
        e = materialise(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .where("u != v").distinct(), "edges")
        now = _signature(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select("v").distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(roots.select(F.col("v").alias("node"), F.col("v").alias("component"))))


def _signature(e: DataFrame) -> tuple:
    """Count and order-free hash of an edge set (equal sets, equal values)."""
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def spanning_forest(n: int, near) -> tuple[list[int], list[int]]:
    """Index pairs that connect what the links among ``n`` points connect;
    ``near(i)`` gives the points that link with i.

    The first point gathers a tree; every point that isn't in the tree by then
    is asked for its links too, so any linked pair has an end that was asked or
    both ends in the tree.  In a dense group this is near linear.
    """
    a, b = [], []
    label, todo = np.arange(n), np.ones(n, bool)
    left = np.arange(min(n, 1))
    while len(left):
        i = int(left[0])
        todo[i] = False
        ends = near(i)
        _, first = np.unique(label[ends], return_index=True)
        for j in ends[first].tolist():
            if label[j] != label[i]:
                a.append(i)
                b.append(j)
                label[label == label[j]] = label[i]
        left = np.nonzero(todo & (label != label[0]))[0]
    return a, b
