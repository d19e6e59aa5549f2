"""Uniform shuffle into shards of exact size.

How many rows each input partition sends to each shard is drawn exactly: the
row of a communication matrix is multivariate hypergeometric in what the shards
still have room for.  Rows are permuted in their partition, dealt by the drawn
counts, and permuted again in their shard.  The matrix is drawn in two levels
(blocks of partitions on the driver, partitions of a block in a task), so the
driver sees one row per BLOCK partitions and no data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from strata.llm.common import saved

BLOCK = 256              # partitions whose counts one task draws
CELL_ROWS = 100_000      # rows that one sort of the second permutation holds


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n draws without replacement from good + bad."""
    if n == 0 or good == 0 or bad == 0:
        return n if bad == 0 else 0
    if good + bad < 900_000_000:
        return int(rng.hypergeometric(good, bad, n))
    # beyond numpy's range: invert the distribution over +-12 deviations
    p = good / (good + bad)
    mean, dev = n * p, (n * p * (1 - p)) ** 0.5
    k = np.arange(max(0, n - bad, int(mean - 12 * dev - 2)), min(n, good, int(mean + 12 * dev + 2)), dtype=np.float64)
    step = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate(([0.0], np.cumsum(step)))
    mass = np.cumsum(np.exp(logs - logs.max()))
    return int((k[0] if len(k) else min(n, good)) + np.searchsorted(mass, rng.random() * mass[-1]))


def draw_counts(room: list[int], rows: list[int], seed: list[int]) -> np.ndarray:
    """Counts (rows, shards): row i sums to rows[i], and no column exceeds its
    room; with all rows given the columns sum to ``room`` exactly."""
    rng = np.random.default_rng(seed)
    left, out = [int(x) for x in room], np.zeros((len(rows), len(room)), np.int64)
    for i, n in enumerate(rows):
        after, n = sum(left), int(n)
        for j, space in enumerate(left):
            after -= space
            out[i, j] = k = hypergeometric(rng, space, after, n)
            left[j] -= k
            n -= k
    return out


def uniform_shards(df: DataFrame, n_shards: int, seed: int = 0) -> DataFrame:
    """All rows and columns plus ``shard`` (0 .. n_shards - 1) and ``slot``
    (gapless from 0 in each shard); a uniformly random arrangement in which
    shard sizes differ by one row at most.

    Nulls, repeated rows and any text are ordinary rows: only their place in the
    input counts, never their values, so no value can make a partition hot.  An
    empty table gives no rows.  Columns named shard or slot are replaced.
    The same files, partitions and seed give the same arrangement.
    """
    own = [c for c in df.columns if c not in ("shard", "slot")]
    # the place of a row is written once; everything after it reads those files
    placed = saved(df.select(F.struct(*own).alias("row"), F.spark_partition_id().cast("long").alias("part"),
                             F.monotonically_increasing_id().alias("place")))
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    counts = saved(counts.withColumn("block", F.floor(F.col("part") / BLOCK)))
    blocks = sorted((r.block, r.rows) for r in counts.groupBy("block").agg(F.sum("rows").alias("rows")).collect())
    total = sum(n for _, n in blocks)
    sizes = [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
    matrix = draw_counts(sizes, [n for _, n in blocks], [seed])
    room = df.sparkSession.createDataFrame(
        [(int(b), [int(x) for x in row]) for (b, _), row in zip(blocks, matrix)], "block long, room array<long>")

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        drawn = draw_counts(pdf["room"].iloc[0], pdf["rows"].tolist(), [seed, int(pdf["block"].iloc[0]) + 1])
        return pd.DataFrame({"part": pdf["part"], "upto": list(np.cumsum(drawn, axis=1))})

    upto = counts.join(room, "block").groupBy("block").applyInPandas(deal, "part long, upto array<long>")
    first = W.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("deal"), "place"), "place")
    dealt = (placed.withColumn("rank", F.row_number().over(first)).join(upto, "part")
             .withColumn("shard", F.size(F.filter("upto", lambda x: x < F.col("rank")))))
    # second permutation: a random key, sorted in cells of its value range
    cells = max(1, -(-max(sizes) // CELL_ROWS))
    key = F.xxhash64(F.lit(seed), F.lit("slot"), "place")
    dealt = (dealt.withColumn("key", key)
             .withColumn("cell", F.floor((F.shiftrightunsigned("key", 1) / F.lit(float(2 ** 63))) * cells)))
    # cells cut the same order that the keys have, read as unsigned numbers
    order = F.shiftrightunsigned("key", 1)
    inside = W.partitionBy("shard", "cell").orderBy(order, "key", "place")
    filled = dealt.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    start = filled.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return (dealt.withColumn("at", F.row_number().over(inside) - 1).join(start, ["shard", "cell"])
            .select("row.*", "shard", (F.col("start") + F.col("at")).cast("long").alias("slot")))
