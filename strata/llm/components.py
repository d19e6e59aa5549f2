"""Connected components of an edge list.

Each round, tasks of at most about LOCAL edges contract what they hold to stars
around the smallest node of each piece; alternating star steps then replace a
node's neighbours by the smallest of them across tasks.  An edge list that one
task holds is done after its contraction.  The star steps are joins and partial
aggregates, so a node with very many neighbours is pre-aggregated map-side and
its join partition is split by AQE.  Every round is written to the checkpoint
folder.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import column, saved

LOCAL = 200_000          # edges that a task contracts in memory


def _toward_smallest(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Link every neighbour (larger ones, or all at most the node itself) to the
    smallest neighbour."""
    if both_ways:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        near = near.where("v > u")
    else:
        near = edges
        best = near.groupBy("u").agg(F.min("v").alias("m"))
    linked = near.join(best, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not both_ways:
        linked = linked.union(best.select("u", F.col("m").alias("v")))
    return linked.where("u <> v").distinct()


def _contracted(edges: DataFrame, tasks: int) -> DataFrame:
    """(u, v): every node of a task's edges linked to the smallest of its piece."""
    def rows(batches):
        root: dict = {}

        def find(x):
            top = x
            while (up := root.get(top, top)) != top:
                top = up
            while x != top:
                root[x], x = top, root.get(x, x)
            return top

        for b in batches:
            for u, v in zip(column(b, "u").to_pylist(), column(b, "v").to_pylist()):
                a, z = find(u), find(v)
                low, high = (a, z) if a < z else (z, a)
                root[high] = low
                root.setdefault(low, low)
        pairs = [(x, find(x)) for x in root]
        pairs = [p for p in pairs if p[0] != p[1]]
        for i in range(0, len(pairs), 100_000):
            part = pairs[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in part], kind), pa.array([p[1] for p in part], kind)], ["u", "v"])

    kind = pa.string() if dict(edges.dtypes)["u"] == "string" else pa.int64()
    return edges.coalesce(tasks).mapInArrow(rows, edges.schema)


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an
    edge.  Null ends and self-links are ignored; no edges give no rows."""
    e = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"), F.col(u).isNull() | F.col(v).isNull())
    e = saved(e.toDF("u", "v", "none").where("u <> v and not none").select("u", "v").distinct())
    n, before = e.count(), None
    while True:
        tasks = max(1, math.ceil(n / LOCAL))
        e = _contracted(e, tasks)
        if tasks == 1:
            e = saved(e)
            break
        large = _toward_smallest(e, True)
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        e = saved(_toward_smallest(large, False))
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, n = now, now[0]
    smallest = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(smallest)
