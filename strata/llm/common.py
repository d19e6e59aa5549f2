"""Small helpers shared by the operators."""

from __future__ import annotations

import gc
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

FILTER_BITS = 1 << 24    # of the filter that ``likely_in`` broadcasts: 2 MB, whatever the data


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a private one only where
    it is unset in a local session (tests)."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if not folder:
        if current:
            return current
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
    bare = folder.replace("file://", "").rstrip("/")
    if current is None or bare not in current:
        sc.setCheckpointDir(folder)
    return folder


def saved(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder: lost executors cost
    only a re-read, and later steps start from the files."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files that no table refers to any more.  It
    does so when the driver collects garbage, which a driver with little to do puts
    off while executors' disks fill; many steps later that is all of their shuffles."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def prepare(spark: SparkSession) -> None:
    """Session settings that every query of the subpackage runs with: UTC, and
    Arrow batches bounded in bytes, so long texts don't fill a worker.  What earlier
    queries of the session shuffled is released."""
    release(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    use_checkpoint_dir(spark)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_KEPT: dict = {}


def kept(key: str, make):
    """What ``make`` gives, remembered by the worker process until another key asks:
    workers serve stage after stage, so only one operator's cache may stay."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Gives back what an operator that ran in this worker before remembered."""
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    c = batch.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def null_as_empty(c: str = "text"):
    return F.coalesce(F.col(c), F.lit(""))


def first_by_hash(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """The k rows that are first by ``order``, whose first column is a 64-bit hash
    that spreads evenly.  Rows beyond a bound that about 2k rows are expected below
    are dropped where they are, so no task receives k rows of every partition; a
    bound that was too low is doubled."""
    n = df.count()
    share = min(1.0, (2 * k + 100) / n) if n else 1.0
    while share < 1:
        near = df.where(F.col(order[0]) < int((share - 0.5) * 2.0 ** 64))
        if near.count() >= k:
            return near.orderBy(*order).limit(k)
        share *= 2
    return df.orderBy(*order).limit(k)


def likely_in(wanted: DataFrame, key: str):
    """(column, keep): ``keep`` drops from an Arrow batch that has the column as
    ``__slot`` most rows whose key is not in ``wanted``, without a shuffle of the
    batch's table.  A bitmap of fixed size decides; a full bitmap keeps more of
    the others, and never loses a row."""
    slot = F.coalesce(F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)), F.lit(0)).alias("__slot")
    words = (wanted.where(F.col(key).isNotNull()).select(slot.alias("slot"))
             .groupBy(F.shiftright("slot", 5).cast("int").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 31 as int)))").alias("bits"))
             .collect())                       # at most FILTER_BITS / 32 rows
    bits = np.zeros(FILTER_BITS // 32, np.uint32)
    for w in words:
        bits[w.word] = w.bits
    held = wanted.sparkSession.sparkContext.broadcast(bits)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = column(batch, "__slot").to_numpy()
        return batch.filter(pa.array((held.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1))

    return slot, keep
