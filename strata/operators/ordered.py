"""Scans of sorted tables: what a row needs from the rows before it, without
putting a key's rows into one task.

A table is range-partitioned and sorted by (keys, order) once and checkpointed,
so every pass reads the same partitions.  A pass over the sorted partitions is
vectorised (Arrow batches, numpy) and narrow: the sorted rows are never shuffled
again.  What crosses a partition border is one small row per partition (its first
and last key and totals), gathered on the driver and handed back to the tasks.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from strata.session import ensure_checkpoint_dir


def in_ranges(df: DataFrame, order: Sequence[Column], n: int | None = None) -> DataFrame:
    """The rows in the given order over range partitions, checkpointed."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(n, *order) if n else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).checkpoint(eager=True)


def codes(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """True where a row's values of the columns differ from the row before; nulls
    (and NaNs) are values."""
    new = np.zeros(batch.num_rows, bool)
    for c in names:
        index = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= index[1:] != index[:-1]
    return new


def values(batch: pa.RecordBatch, names: Sequence[str], at: int) -> tuple:
    return tuple(batch.column(c)[at].as_py() for c in names)


def same(x: tuple | None, y: tuple | None) -> bool:
    """Equal keys; NaN equals NaN, as in Spark's grouping."""
    return x is not None and y is not None and all(a == b or (a != a and b != b) for a, b in zip(x, y))


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    col = batch.column(name)
    whole = pa.types.is_integer(col.type) or pa.types.is_boolean(col.type)
    return col.cast(pa.int64() if whole else pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)


def keyed_sequence(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   name: str = "seq", running: str | Sequence[str] | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` -- and optionally
    running ``SUM``s in the same order -- without putting all rows of a key into
    one task.  One shuffle, the range sort: numbers and sums are taken while a
    sorted partition is read, on top of the totals that its first key already has
    in earlier partitions.  Nulls add nothing.  Output: the input columns plus
    ``name`` (1-based) and ``<running>_cum``."""
    keys, runs = list(keys), [running] if isinstance(running, str) else list(running or [])
    s = in_ranges(df, [*[F.col(k) for k in keys], *order])
    kinds = {r: DoubleType() if s.schema[r].dataType.typeName() in ("double", "float", "decimal") else LongType() for r in runs}

    def totals(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [np.ones(batch.num_rows, np.int64), *[_numbers(batch, r) for r in runs]]

    def ends(batches) -> Iterator[dict]:
        """First and last key, and the totals of the last key's rows here."""
        first = last = sums = None
        for b in batches:
            first = first or values(b, keys, 0)
            at = int(np.flatnonzero(codes(b, keys))[-1:].sum())          # 0: one key
            part = [t[at:].sum().item() for t in totals(b)]
            key = values(b, keys, at)
            sums = [x + y for x, y in zip(sums, part)] if at == 0 and same(key, last) else part
            last = key
        if last is not None:
            yield {"first": first, "last": last, "sums": sums}

    zeros = [0] * (1 + len(runs))
    before, key, carry = {}, None, zeros
    for part, e in sorted(_per_partition(s.select(*keys, *runs), ends).items()):
        before[part] = carry if same(e["first"], key) else zeros
        carry = [x + y for x, y in zip(e["sums"], before[part])] if same(e["first"], e["last"]) else e["sums"]
        key = e["last"]
    held = s.sparkSession.sparkContext.broadcast(before)

    def number(batches):
        carry, key = held.value.get(TaskContext.get().partitionId(), zeros), None
        for b in batches:
            if not b.num_rows:
                continue
            if key is not None and not same(values(b, keys, 0), key):
                carry = zeros
            new = codes(b, keys)
            group, start = np.cumsum(new), np.flatnonzero(new)
            out = []
            for already, t in zip(carry, totals(b)):
                total = np.cumsum(t)
                out.append(total + np.concatenate(([already], -total[start - 1])).astype(total.dtype)[group])
            carry, key = [x[-1].item() for x in out], values(b, keys, b.num_rows - 1)
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, out)],
                                             [*b.schema.names, name, *[f"{r}_cum" for r in runs]])

    schema = StructType([*s.schema.fields, StructField(name, LongType()), *[StructField(f"{r}_cum", kinds[r]) for r in runs]])
    return s.mapInArrow(number, schema)


def _per_partition(df: DataFrame, ends: Callable) -> dict[int, dict]:
    """What ``ends`` yields for each partition that has rows, by partition."""
    def rows(batches):
        found = list(ends(b for b in batches if b.num_rows))
        if found:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "found": [pickle.dumps(found[0])]})

    return {r["part"]: pickle.loads(bytes(r["found"])) for r in df.mapInArrow(rows, "part long, found binary").collect()}


def next_event(events: DataFrame, keys: Sequence[str], time: str, take: Sequence[str]) -> DataFrame:
    """Each row with the first later row of its keys: ``next_<time>`` and
    ``next_<take>``, null where there is none.

    Later means a greater ``time``; of several rows at that time the one that is
    first by ``take`` counts.  Rows are read in falling order, so the next event is
    always one that was read before: the first row of the time group just read.
    Over a partition's border go its last time group and the one before that."""
    by = [*keys, time]
    wanted = [time, *take]
    s = in_ranges(events, [*[F.col(k) for k in keys], F.col(time).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in take]])

    def ends(batches):
        """First and last time group, the last row, and the row before the last
        group (None if the partition is one group)."""
        first = last_row = before = None
        for b in batches:
            first = first or values(b, by, 0)
            if last_row is not None and not same(values(b, by, 0), last_row[0]):
                before = last_row
            start = np.flatnonzero(codes(b, by))
            if len(start):
                before = (values(b, by, int(start[-1]) - 1), values(b, wanted, int(start[-1]) - 1))
            last_row = (values(b, by, b.num_rows - 1), values(b, wanted, b.num_rows - 1))
        if first is not None:
            yield {"first": first, "last": last_row, "before": before}

    held, last, before = {}, None, None
    for part, e in sorted(_per_partition(s.select(*dict.fromkeys([*by, *take])), ends).items()):
        held[part] = (last, before)
        if e["before"] is not None:
            before = e["before"]
        elif last is not None and not same(e["first"], last[0]):
            before = last
        last = e["last"]
    state = s.sparkSession.sparkContext.broadcast(held)
    schema = StructType([*s.schema.fields, *[StructField(f"next_{c}", s.schema[c].dataType) for c in wanted]])

    def rows(batches):
        # last: the last row read; before: the last row of the time group before its own
        last, before = state.value.get(TaskContext.get().partitionId(), (None, None))
        for b in batches:
            if not b.num_rows:
                continue
            new = codes(b, by)
            new[0] = last is None or not same(values(b, by, 0), last[0])
            start = np.flatnonzero(new)
            # candidates: the two carried rows, then the rows of this batch
            pool = {c: pa.concat_arrays([pa.array([r and dict(zip([*by, *wanted], [*r[0], *r[1]]))[c] for r in (before, last)],
                                                  b.schema.field(c).type), b.column(c)]) for c in dict.fromkeys([*by, *wanted])}
            group = np.cumsum(new) - 1                     # -1: still in the group of ``last``
            at = np.where(group < 0, 0, np.append(start, 0)[group] + 1)
            ok = pool[time].is_valid().to_numpy(zero_copy_only=False)[2:]
            ok &= ~((at == 0) & (before is None)) & ~((at == 1) & (last is None))
            for k in keys:
                code = pool[k].dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                ok &= code[at] == code[2:]
            found = [pool[c].take(pa.array(at, mask=~ok)) for c in wanted]
            if len(start):
                before = last if start[-1] == 0 else (values(b, by, int(start[-1]) - 1), values(b, wanted, int(start[-1]) - 1))
            last = (values(b, by, b.num_rows - 1), values(b, wanted, b.num_rows - 1))
            yield pa.RecordBatch.from_arrays([*b.columns, *found], [*b.schema.names, *[f"next_{c}" for c in wanted]])

    return s.mapInArrow(rows, schema)


def ranks(df: DataFrame, order: Sequence[tuple[str, str]], name: str = "rank") -> DataFrame:
    """``RANK() OVER (ORDER BY ...)``.  ``order``: (column, direction) with
    direction like ``desc nulls last``.

    Equal rows are counted first, map side, so half of all rows tied are one
    counted value.  Ranks are prefix sums over the sorted distinct values.  A value
    that holds more than a partition's share of the rows takes its rank from a
    broadcast table -- at most as many values as there are partitions --, the
    others through a shuffled join in which no value is heavier than that share."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    names = [c for c, _ in order]
    directions = {"asc": Column.asc_nulls_first, "desc": Column.desc_nulls_last, "asc nulls first": Column.asc_nulls_first,
                  "asc nulls last": Column.asc_nulls_last, "desc nulls first": Column.desc_nulls_first,
                  "desc nulls last": Column.desc_nulls_last}
    by = [directions[d.lower()](F.col(c)) for c, d in order]
    counts = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    ranked = _before(in_ranges(counts, by), "_n", "_before")
    ranked = ranked.select(*[F.col(c).alias(f"_v_{c}") for c in names], "_n", (F.col("_before") + 1).cast("int").alias(name))
    share = max(1, df.agg(F.count(F.lit(1))).first()[0] // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    equal = None
    for c in names:
        e = F.col(c).eqNullSafe(F.col(f"_v_{c}"))
        equal = e if equal is None else equal & e
    heavy, light = ranked.where(F.col("_n") > share), ranked.where(F.col("_n") <= share)
    columns = [*df.columns, name]
    tied = df.join(F.broadcast(heavy), equal).select(*columns)
    rest = df.join(F.broadcast(heavy), equal, "left_anti").join(light, equal).select(*columns)
    return tied.union(rest)


def _before(s: DataFrame, of: str, name: str) -> DataFrame:
    """The sum of a column over all earlier rows of a table from ``in_ranges``."""
    def ends(batches):
        total = sum(int(_numbers(b, of).sum()) for b in batches)
        yield {"total": total}

    start, so_far = {}, 0
    for part, e in sorted(_per_partition(s.select(of), ends).items()):
        start[part] = so_far
        so_far += e["total"]
    held = s.sparkSession.sparkContext.broadcast(start)

    def rows(batches):
        carry = held.value.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            n = _numbers(b, of)
            total = np.cumsum(n) + carry
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(total - n)], [*b.schema.names, name])
            carry = int(total[-1]) if len(total) else carry

    return s.mapInArrow(rows, StructType([*s.schema.fields, StructField(name, LongType())]))
