"""Keyed maintenance that rewrites only what a batch touches.

The table is parquet, partitioned by a hash bucket of its key.  A batch's keys
name the buckets it touches; only these are read, merged and replaced, by
dynamic partition overwrite; other files stay as they are.  The merged rows are
checkpointed before anything is replaced, so no job reads what it overwrites.
Applying a batch twice gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.operators import arrays
from strata.session import ensure_checkpoint_dir
from strata.sources.sinks import close_rows

BUCKET = "key_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class KeyedTable:
    """A table of unique ``keys`` in ``buckets`` partitions below ``path``; the
    number of buckets is the table's own and must stay the same."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, bucket_of(self.keys, self.buckets))

    def _write(self, df: DataFrame, mode: str) -> None:
        (df.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", mode)
           .partitionBy(BUCKET).parquet(self.path))

    def create(self, df: DataFrame) -> "KeyedTable":
        """The table anew, with the rows of ``df``."""
        self._write(self._bucketed(df), "static")
        return self

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def _apply(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        ensure_checkpoint_dir(self.spark)
        batch = self._bucketed(batch).checkpoint(eager=True)
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]      # at most ``buckets``
        if not touched:
            return
        table = self.spark.read.parquet(self.path)
        merged = merge(table.where(F.col(BUCKET).isin(touched)), batch.select(BUCKET, *[c for c in batch.columns if c != BUCKET]))
        self._write(merged.select(*table.columns).checkpoint(eager=True), "dynamic")

    def upsert(self, batch: DataFrame) -> None:
        """Rows of the batch replace those of equal key, or are added.  The
        batch has the table's columns, one row a key."""
        self._apply(batch, lambda t, b: arrays.upsert(t, b, [BUCKET, *self.keys]))

    def insert_ignore(self, batch: DataFrame) -> None:
        """Rows of the batch whose key is new are added."""
        self._apply(batch, lambda t, b: arrays.insert_ignore(t, b, [BUCKET, *self.keys]))

    def close(self, batch: DataFrame, end_col: str, end_value, flag_col: str | None = None) -> None:
        """Open rows whose key is in the batch are closed.  Here the keys need
        not be unique in the table: closed rows of a key stay beside its open one."""
        self._apply(batch.select(*self.keys), lambda t, b: close_rows(t, b, [BUCKET, *self.keys], end_col, end_value, flag_col))
