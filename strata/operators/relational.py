"""Relational building blocks.

Thin, parameterised wrappers over the DataFrame API.  They exist so that the
pattern operators state intent (``dedupe`` with a mandatory total order, a
broadcast only behind a measured size, a union by name) in one place.  Scans in
order (sequences, ranks) are in ``ordered``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.columns import col_
from strata.operators.ordered import keyed_sequence, ranks as global_rank  # noqa: F401


def _cols(cs) -> list[Column]:
    if cs is None:
        return []
    if isinstance(cs, (str, Column)):
        cs = [cs]
    return [col_(c) for c in cs]


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
           descending: bool = False) -> DataFrame:
    """keep one row per key.

    With no ``order`` the rows of a key are exact duplicates or interchangeable
    and ``dropDuplicates`` is used.  With an ``order`` the row that is first in
    that order (last if ``descending``) wins; ties are broken by all remaining
    columns, so the pick is deterministic.  Both forms are hash aggregates with
    a map-side partial step, so a key that holds a third of all rows is
    collapsed before the shuffle -- never a window over the whole key.
    """
    if not order:
        return df.dropDuplicates(list(keys))
    rest = [c for c in df.columns if c not in set(order) | set(keys)]
    # the least (greatest) value of the order is the row itself, apart from its key
    pick = (F.max if descending else F.min)(F.struct(*[F.col(c) for c in [*order, *rest]]))
    own = set(keys) - set(order)
    return df.groupBy(*keys).agg(pick.alias("_w")).select(*[F.col(c) if c in own else F.col(f"_w.{c}").alias(c) for c in df.columns])


def parts_for(df: DataFrame, rows: int = 500_000) -> int:
    """Partitions that hold about ``rows`` rows of ``df`` each, at least as many as
    tasks run at once; counting reads ``df`` once, of parquet mostly the footers."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def dedupe_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DISTINCT over a projection (hash aggregate, partial map side)."""
    return df.select(*cols).distinct()


def join(left: DataFrame, right: DataFrame, on, how: str = "inner",
         residual: Column | None = None) -> DataFrame:
    """Equi join plus optional residual predicate.  The planner
    picks the physical join; AQE turns it into a broadcast join at runtime only
    when the measured shuffle output of one side is small."""
    if residual is not None:
        if isinstance(on, (list, tuple)) and on and isinstance(on[0], str):
            cond = None
            for k in on:
                e = left[k] == right[k]
                cond = e if cond is None else cond & e
            on = cond
        on = on & residual
    return left.join(right, on, how)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows as text, by one aggregate: what a broadcast would hold,
    up to a small factor."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.agg(F.coalesce(F.sum(F.octet_length(row)), F.lit(0))).first()[0] if df.columns else 0


def sized_join(left: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int = 64 << 20) -> DataFrame:
    """An explicit broadcast of ``small`` if its measured bytes are within the
    budget, else a sort-merge join; the rows are the same.  ``small`` should be
    projected to what the join needs; measuring reads it once."""
    if measured_bytes(small) <= max_bytes:
        return left.join(F.broadcast(small), on, how)
    return left.hint("merge").join(small.hint("merge"), on, how)


def union_all(*dfs: DataFrame, label: str | None = None,
              labels: Sequence[str] | None = None) -> DataFrame:
    """UNION ALL by column name, optionally tagging each branch."""
    out = None
    for i, d in enumerate(dfs):
        if label is not None:
            d = d.withColumn(label, F.lit(labels[i] if labels else str(i)))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """L2: ``ORDER BY ... LIMIT k``; Spark plans TakeOrderedAndProject, i.e.
    a per-partition top-k followed by a k-row merge (no global sort)."""
    return df.orderBy(*order).limit(k)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Aggregate once, use several times, release.  MEMORY_AND_DISK so a
    large aggregate spills instead of being recomputed; lost blocks are
    recomputed from lineage if an executor dies."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
