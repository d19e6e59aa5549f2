"""Stream sources (S12) and event-time handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

# The web event message layout and its time format.
WEB_EVENT_SCHEMA = StructType([StructField(n, StringType()) for n in
                               ["url", "referrer", "user_agent", "host", "ip", "headers",
                                "event_time"]])
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def read_event_stream(spark: SparkSession, schema: StructType = WEB_EVENT_SCHEMA,
                      source: str = "file", path: str | None = None,
                      options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON events as a streaming DataFrame.

    ``source='kafka'`` reads the ``value`` of a Kafka topic (options as for
    ``spark.readStream.format('kafka')``: kafka.bootstrap.servers, subscribe,
    startingOffsets='latest', ...) and parses it with ``from_json``; it needs
    the Kafka connector on the classpath.  ``source='file'`` reads new JSON
    files of a folder (used in tests; same parsing)."""
    if source == "kafka":
        r = spark.readStream.format("kafka")
        opts = {"startingOffsets": "latest", **(options or {})}
        for k, v in opts.items():
            r = r.option(k, v)
        raw = r.load()
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.json(path)


def parse_event_time(c, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Text -> TIMESTAMP (NULL when it does not parse)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp")


def with_event_time(df: DataFrame, col: str = "event_time", fmt: str | None = EVENT_TIME_FORMAT,
                    delay: str = "15 seconds", out: str = "event_timestamp") -> DataFrame:
    """Event-time column plus watermark.  Text is parsed with ``fmt``;
    a TIMESTAMP_NTZ column is cast to TIMESTAMP (watermarks need it).  Rows
    later than the watermark are dropped by the stateful operators that
    follow; ``LateRows`` counts them."""
    dtype = dict(df.dtypes).get(col)
    if dtype == "string" and fmt:
        ts = parse_event_time(col, fmt)
    else:
        ts = F.col(col).cast("timestamp")
    return df.withColumn(out, ts).withWatermark(out, delay)


class LateRows(StreamingQueryListener):
    """Rows that the watermark dropped, summed per query from every progress
    event (a query's own ``recentProgress`` forgets older batches).  Add it with
    ``spark.streams.addListener`` before the query starts."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        n = sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators)
        self.dropped[str(p.id)] = self.dropped.get(str(p.id), 0) + n

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query) -> int:
        return self.dropped.get(str(query.id), 0)
