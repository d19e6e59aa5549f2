"""Stream sinks and query control."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from strata.operators.geo import geo_enrich
from strata.session import scratch_path


def to_json_messages(df: DataFrame) -> DataFrame:
    """One JSON ``value`` per row (the Kafka/JSON sink payload)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def start_query(df: DataFrame, name: str, sink: str = "memory", output_mode: str = "append",
                checkpoint: str | None = None, trigger: dict | None = None,
                options: dict | None = None, path: str | None = None):
    """Start a streaming query with a checkpoint under the shared
    checkpoint folder (so a restarted driver resumes exactly where it
    stopped) and a trigger (``{'processingTime': '10 seconds'}``,
    ``{'availableNow': True}``, ...)."""
    spark = df.sparkSession
    w = df.writeStream.outputMode(output_mode).queryName(name)
    w = w.option("checkpointLocation", checkpoint or scratch_path(spark, f"streams/{name}"))
    if sink == "kafka":
        w = w.format("kafka")
    else:
        w = w.format(sink)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path) if path else w.start()


def jdbc_writer(url: str, table: str, properties: dict | None = None) -> Callable:
    """A ``foreachBatch`` function that appends each micro-batch to a JDBC
    table, with its number as column ``batch_id``: a batch that is repeated
    after a failure can be told apart and kept once (``batch_once``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.format("jdbc").option("url", url).option("dbtable", table).mode("append")
        for k, v in (properties or {}).items():
            w = w.option(k, v)
        w.save()
    return write


def batch_once(written: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a table written by ``jdbc_writer``, a repeated batch's once."""
    return written.dropDuplicates([*keys, "batch_id"]).drop("batch_id")


def multi_sink(writers: dict[str, Callable[[DataFrame], DataFrame]], sink: Callable,
               finished: Callable | None = None) -> Callable:
    """One micro-batch feeds several aggregates.  ``writers`` maps a
    name to a batch transformation; ``sink(name, df, batch_id)`` stores each, and
    ``finished(spark, batch_id)`` records the batch after all of them.
    The batch is persisted once and released after all writes."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, fn in writers.items():
                sink(name, fn(batch), batch_id)
            if finished is not None:
                finished(batch.sparkSession, batch_id)
        finally:
            batch.unpersist()
    return run


class BatchFiles:
    """Outputs of ``multi_sink`` in which every micro-batch is there once.

    A sink's output of a batch is a folder of its own, replaced as a whole: a batch
    that is repeated after a failure overwrites what the first try left.  A batch
    counts for readers once it is recorded, which is done after its last sink, so
    all sinks show the same batches."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, name: str, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")

    def finished(self, spark, batch_id: int) -> None:
        spark.range(1).select(F.lit(True).alias("whole")).write.mode("overwrite").parquet(
            f"{self.path}/finished_batches/batch_id={batch_id}")

    def read(self, spark, name: str, schema: str) -> DataFrame:
        """The rows of a sink's recorded batches, with their ``batch_id``."""
        done = spark.read.schema("whole boolean, batch_id bigint").parquet(f"{self.path}/finished_batches")
        rows = spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{self.path}/{name}")
        return rows.join(done.select("batch_id").distinct(), "batch_id", "left_semi")


def enrich_stream(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """T5: stream-static join of events with the IP range table."""
    return geo_enrich(events, ranges)
