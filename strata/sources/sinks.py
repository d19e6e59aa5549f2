"""Writers and table maintenance.

Parquet has no in-place UPDATE; every maintenance operation computes the new
state as a DataFrame and writes it as a new version (or replaces whole
partitions), never reading and overwriting one path in the same job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """(re)create a managed table from a DataFrame (CTAS)."""
    df.write.mode(mode).format(fmt).saveAsTable(name)


def overwrite_into(df: DataFrame, name: str) -> None:
    """Replace the contents of an existing table, keeping its schema.
    ``insertInto`` matches columns by position, so columns are reordered by
    name to the table's order first."""
    cols = df.sparkSession.table(name).columns
    df.select(*cols).write.insertInto(name, overwrite=True)


def stamped(df: DataFrame, as_of=None, name: str = "loaded_at") -> DataFrame:
    """The load time as a column: ``as_of`` (a timestamp or its text), so a
    re-run writes the same rows; the clock only if none is given."""
    return df.withColumn(name, F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp"))


def append_snapshot(df: DataFrame, path: str, ds_col: str = "ds") -> None:
    """Write one snapshot date with dynamic partition overwrite: a re-run
    for the same date replaces that date's partition only (idempotent)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(ds_col).parquet(path))


def close_rows(target: DataFrame, changed_keys: DataFrame, keys: Sequence[str], end_col: str,
               end_value, flag_col: str | None = None) -> DataFrame:
    """Conditional UPDATE ... WHERE key IN (changed): rows of ``target``
    whose key is in ``changed_keys`` and that are open get ``end_value`` (and
    their flag cleared).  A left join on the keys plus a ``when`` rewrite."""
    ck = changed_keys.select(*keys).distinct().withColumn("_hit", F.lit(True))
    j = target.join(ck, list(keys), "left")
    j = j.withColumn("_hit", F.col("_hit").isNotNull() & F.col(end_col).isNull())
    out = j.withColumn(end_col, F.when(F.col("_hit"), F.lit(end_value)).otherwise(F.col(end_col)))
    if flag_col:
        out = out.withColumn(flag_col, F.when(F.col("_hit"), F.lit(False)).otherwise(F.col(flag_col)))
    return out.select(*target.columns)


def write_bucketed(df: DataFrame, name: str, buckets: int, col: str,
                   sort_cols: Sequence[str] | None = None, partition_cols: Sequence[str] = (),
                   path: str | None = None) -> None:
    """Bucketed (and sorted) table, managed or below ``path``; two tables
    bucketed the same way on the join key join without a shuffle (J11).  Rows are dealt to the
    buckets first, so a bucket is one file, not one per task."""
    w = df.repartition(buckets, col).write.mode("overwrite").format("parquet").bucketBy(buckets, col)
    if sort_cols:
        w = w.sortBy(*sort_cols)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str],
                      sort_within: Sequence[str] = (), n: int | None = None) -> None:
    """Partitioned parquet, optionally sorted inside files (better
    run-length/dictionary encoding).  Tasks take ranges of (partition value,
    sort columns), so a value with very many rows is spread over several tasks
    and files, and neighbouring sort values stay in one file."""
    d, by = df, [*cols, *sort_within]
    if not sort_within:
        by = [*cols, F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")])]
    if cols:
        d = d.repartitionByRange(n, *by) if n else d.repartitionByRange(*by)
    if sort_within:
        d = d.sortWithinPartitions(*cols, *sort_within)
    d.write.mode("overwrite").partitionBy(*cols).parquet(path)


def file_layout_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Total bytes and file count of each table folder, one labelled
    row per table (UNION ALL of the per-table summaries).  Lists the files;
    their content is pruned and never read."""
    out = None
    for label, path in paths.items():
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(path).select("path", "length"))
        s = files.agg(F.sum("length").alias("total_bytes"),
                      F.count(F.lit(1)).alias("num_files")).withColumn("table", F.lit(label))
        out = s if out is None else out.unionByName(s)
    return out.select("table", "total_bytes", "num_files")
