"""Joins of points with intervals, as equi joins.

An interval of integers is cut into aligned blocks whose lengths are powers of
two: at most two per level, so about twice the logarithm of its width, however
wide it is.  A point lies in one aligned block per level, so it probes one key for
each level that occurs, and an (interval, point) pair meets at exactly one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LEVELS = 62              # of blocks of non-negative 64-bit integers


def dyadic_cover(start: Column, end: Column) -> Column:
    """array<struct<level, block>>: the blocks that make up [start, end], none for
    a null or empty interval.  Block b of level j holds b*2^j .. (b+1)*2^j - 1."""
    def at(level: Column) -> Column:
        j = level.cast("int")
        low = F.call_function("shiftright", start - 1, j) + 1         # first block that begins in the interval
        high = F.call_function("shiftright", end + 1, j)              # first block that ends after it
        one = F.lit(1).cast("long")
        left, right = low.bitwiseAND(one) == 1, high.bitwiseAND(one) == 1
        block = lambda b: F.struct(level.cast("int").alias("level"), b.cast("long").alias("block"))
        first = F.when(left & (low < high), block(low))
        last = F.when(right & (low + F.when(left, 1).otherwise(0) < high), block(high - 1))
        return F.array(first, last)

    cover = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at))
    return F.when(start <= end, F.filter(cover, lambda b: b.isNotNull()))


def interval_join(points: DataFrame, ranges: DataFrame, point: str, start: str = "start", end: str = "end",
                  how: str = "inner") -> DataFrame:
    """Points with all intervals [start, end] that hold them; ``how="left"`` keeps
    points in none.  Bounds and points are non-negative longs; intervals may
    overlap, repeat and be of any width.  Nulls and empty intervals match nothing.

    The levels that occur (at most LEVELS + 1) are gathered first, so points probe
    no others; a column of the ranges must not have a point column's name."""
    cover = ranges.withColumn("_b", F.explode(dyadic_cover(F.col(start).cast("long"), F.col(end).cast("long"))))
    levels = sorted(r[0] for r in cover.select("_b.level").distinct().collect())
    p = F.col(point).cast("long")
    probes = F.array(*[F.struct(F.lit(j).cast("int").alias("level"), F.shiftright(p, j).alias("block")) for j in levels]) \
        if levels else F.array().cast("array<struct<level:int,block:bigint>>")
    probing = points.where(F.col(point).isNotNull()).withColumn("_b", F.explode(probes))
    found = probing.select("*", "_b.level", "_b.block").drop("_b").withColumnsRenamed({"level": "_level", "block": "_block"}).join(
        cover.select("*", F.col("_b.level").alias("_level"), F.col("_b.block").alias("_block")).drop("_b"), ["_level", "_block"])
    found = found.select(*points.columns, *ranges.columns)
    if how != "left":
        return found
    none = points.join(found.select(point).distinct(), point, "left_anti").select(*points.columns)
    return found.unionByName(none, allowMissingColumns=True)
