"""L5 (with S11, L3, L4, S15): sort layouts of one table, compared by what a
reader can skip.

Three orders: as it comes (spread by hash), sorted by one column, and along a
Z-order curve of two columns.  The comparison reads the row-group statistics in
the footers of the written files, in tasks, a file at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ZBITS = 6                # of each column in the Z-order key


def _cell(c: Column, bounds: Sequence[float], low: int = 0) -> Column:
    """How many of the sorted bounds are at most ``c``, as a search tree."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(c < F.lit(bounds[mid]), _cell(c, bounds[:mid], low)).otherwise(_cell(c, bounds[mid + 1:], low + mid + 1))


def with_zorder(df: DataFrame, columns: Sequence[str], name: str = "z", bits: int = ZBITS) -> DataFrame:
    """``df`` plus a key of the columns' quantile numbers with their bits
    interleaved: rows that are near in all columns get near keys.  Columns are
    numbers; nulls are in the first cell.  The quantiles are one aggregate of at
    most 2^bits - 1 bounds a column."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    cells = [f"_cell{i}" for i in range(len(columns))]
    out = df.withColumns({cell: F.when(F.col(c).isNull(), 0).otherwise(_cell(F.col(c).cast("double"), sorted(set(found[i] or []))))
                          for i, (cell, c) in enumerate(zip(cells, columns))})
    key = F.lit(0).cast("long")
    for i, cell in enumerate(cells):
        for b in range(bits):
            bit = F.shiftright(cell, b).bitwiseAND(F.lit(1)).cast("long")
            key = key + F.shiftleft(bit, b * len(columns) + i)
    return out.withColumn(name, key).drop(*cells)


def write_layout(df: DataFrame, path: str, order: Sequence[Column], n: int, row_group_bytes: int = 128 << 20) -> None:
    """The rows over ``n`` range partitions in the given order, a file each."""
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
       .write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path))


def row_groups(spark: SparkSession, paths: dict[str, str], columns: Sequence[str]) -> DataFrame:
    """layout, file, row_group, num_rows, column, low, high (as doubles), bytes:
    one row per row group and column.  A task holds one file at a time."""
    import pyarrow.parquet as pq

    schema = pa.schema([("layout", pa.string()), ("file", pa.string()), ("row_group", pa.int64()), ("num_rows", pa.int64()),
                        ("column", pa.string()), ("low", pa.float64()), ("high", pa.float64()), ("bytes", pa.int64())])

    def footers(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for layout, path, content in zip(*(b.column(c) for c in ("layout", "path", "content"))):
                meta = pq.read_metadata(pa.BufferReader(content.as_buffer()))
                rows = []
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for i in range(group.num_columns):
                        part = group.column(i)
                        if part.path_in_schema in columns:
                            s = part.statistics
                            known = s is not None and s.has_min_max
                            rows.append({"layout": layout.as_py(), "file": path.as_py(), "row_group": g, "num_rows": group.num_rows,
                                         "column": part.path_in_schema, "low": float(s.min) if known else None,
                                         "high": float(s.max) if known else None, "bytes": part.total_compressed_size})
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = None
    for layout, path in paths.items():
        some = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
                .select(F.lit(layout).alias("layout"), "path", "content"))
        files = some if files is None else files.union(some)
    return files.mapInArrow(footers, "layout string, file string, row_group long, num_rows long, column string, "
                                     "low double, high double, bytes long")


def read_share(groups: DataFrame, df: DataFrame, columns: Sequence[str], points: int = 16) -> DataFrame:
    """layout, column, num_rows, bytes, and ``share``: of all rows, those in row
    groups that a reader of one value cannot skip, on average over quantiles of
    the column.  A group without statistics is always read."""
    shares = [(i + 0.5) / points for i in range(points)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares) for c in columns]).first()
    wanted = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]),
                               F.array(*[F.array(*[F.lit(v) for v in (found[i] or [])]).cast("array<double>") for i in range(len(columns))]))
    read = F.when(F.col("low").isNull(), F.size(wanted[F.col("column")])).otherwise(
        F.size(F.filter(wanted[F.col("column")], lambda v: v.between(F.col("low"), F.col("high")))))
    return (groups.groupBy("layout", "column").agg(
        F.sum("num_rows").alias("num_rows"), F.sum("bytes").alias("bytes"),
        (F.sum(read * F.col("num_rows")) / F.sum(F.size(wanted[F.col("column")]) * F.col("num_rows"))).alias("share")))
