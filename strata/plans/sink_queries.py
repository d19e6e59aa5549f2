"""Queries over readers and writers: what is written is read back and compared
with the tables it came from (S1-S5, S9, S11, S13, S15, X19, V1, T6, T7)."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from strata.functions import udf
from strata.plans.oracle_views import with_views
from strata.plans.registry import query
from strata.plans.report import LAST_DAY_SQL, last_day
from strata.plans.stream_queries import _EV_SQL
from strata.plans.table_queries import _event_stream, _fresh
from strata.sources import adapters as A, readers, sinks
from strata.streaming import sinks as stream_sinks, sources as stream_sources, windows


@query("s01_csv_round_trip", oracle="""
SELECT c_custkey, nullif(c_name, '') AS c_name, c_mktsegment, c_acctbal FROM customer
""")
def s01_csv_round_trip(t):
    """Customers written as CSV with a header and read with a schema."""
    path = _fresh(t, "csv")
    t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal").write.option("header", True).csv(path)
    return readers.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double")


@query("s03_create_and_replace", oracle=with_views("maps") + """
SELECT name, mapid, 2 AS version FROM maps
""")
def s03_create_and_replace(t):
    """A table created from a query, then replaced by name-matched rows, read by
    name and through a view (S2, S3, S4, S9)."""
    name = f"strata_maps_{uuid.uuid4().hex}"
    maps = A.maps(t).select("mapid", "name")
    sinks.write_table(maps.withColumn("version", F.lit(1)), name)
    sinks.overwrite_into(maps.select(F.lit(2).alias("version"), "name", "mapid"), name)
    readers.register_views(t.spark, {f"{name}_v": readers.read_table(t.spark, name)})
    return t.spark.sql(f"SELECT name, mapid, version FROM {name}_v")


@query("s05_snapshots", oracle=with_views("web_events") + """,
d AS (SELECT CAST(event_time AS DATE) AS ds, host, COUNT(*) AS hits FROM web_events GROUP BY ALL)
SELECT ds, host, hits, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at FROM d
WHERE ds > (SELECT MAX(ds) FROM d) - 3
""")
def s05_snapshots(t):
    """Three daily snapshots, each stamped with the time it stands for; the last
    day is loaded twice and is there once (S5, X19)."""
    path, end = _fresh(t, "snapshots"), last_day(t)
    daily = A.web_events(t).groupBy(F.to_date("event_time").alias("ds"), "host").agg(F.count(F.lit(1)).alias("hits"))
    daily = sinks.stamped(daily, "2024-02-01 00:00:00")
    for back in (2, 1, 0, 0):
        sinks.append_snapshot(daily.where(F.col("ds") == F.date_sub(F.lit(end).cast("date"), back)), path)
    return t.spark.read.parquet(path).select("ds", "host", "hits", F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"))


@query("s11_partitioned", oracle="""
SELECT l_returnflag, l_linestatus, COUNT(*) AS num_rows, COUNT(DISTINCT l_orderkey) AS num_orders FROM lineitem GROUP BY 1, 2
""")
def s11_partitioned(t):
    """Line items partitioned by two columns and sorted inside files, counted from
    the partitions that were written (S11, L3, L4)."""
    path = _fresh(t, "partitioned")
    sinks.write_partitioned(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"), path,
                            ["l_returnflag", "l_linestatus"], ["l_orderkey"])
    return t.spark.read.parquet(path).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("num_rows"), F.count_distinct("l_orderkey").alias("num_orders"))


@query("s13_json_messages", oracle=with_views("web_events") + """
SELECT '{"host":"' || host || '","url":"' || url || '","user_id":' || user_id || '}' AS value
FROM web_events WHERE user_id IS NOT NULL
""")
def s13_json_messages(t):
    """Web events as JSON messages."""
    e = A.web_events(t).where(F.col("user_id").isNotNull())
    return stream_sinks.to_json_messages(e.select("host", "url", "user_id"))


@query("s15_file_layout", oracle="""
SELECT 'coarse' AS "table", 2 AS num_files, true AS has_bytes UNION ALL SELECT 'fine', 8, true
""")
def s15_file_layout(t):
    """Files and bytes of two layouts of the orders, from listings."""
    paths = {"coarse": _fresh(t, "coarse"), "fine": _fresh(t, "fine")}
    for (label, path), n in zip(paths.items(), (2, 8)):
        t.orders.select("o_orderkey", "o_custkey").repartition(n, F.xxhash64("o_orderkey") % 1009).write.parquet(path)
    r = sinks.file_layout_report(t.spark, paths)
    return r.select("table", F.col("num_files").cast("int").alias("num_files"), (F.col("total_bytes") > 0).alias("has_bytes"))


@query("v01_functions", oracle=_EV_SQL + """
SELECT ip, COUNT(*) AS n, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
       + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS address,
       length(ip) - length(replace(ip, '1', '')) AS ones
FROM ev GROUP BY ip
""")
def v01_functions(t):
    """A SQL function and a pandas function, registered and used in SQL (V1)."""
    udf.register_builtin_functions(t.spark)

    def ones(ip: pd.Series) -> pd.Series:
        return ip.str.count("1").astype("int64")

    udf.register_pandas_function(t.spark, "ones_of", ones, "bigint")
    A.web_events_ip(t).groupBy("ip").agg(F.count(F.lit(1)).alias("n")).createOrReplaceTempView("strata_ips")
    return t.spark.sql("SELECT ip, n, ip_to_long(ip) AS address, ones_of(ip) AS ones FROM strata_ips")


@query("t02_streamed_hits", oracle=_EV_SQL + """
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS event_hour, host, COUNT(host) AS num_hits FROM ev GROUP BY 1, 2
""")
def t02_streamed_hits(t):
    """Tumbling hits per host of the event stream itself, read to its end: the
    complete result after the last batch (T1, T2, T7)."""

    class Streamed:
        events = _event_stream(t)

    out = stream_sinks.BatchFiles(_fresh(t, "hits"))
    hits = windows.tumbling_hits(stream_sources.with_event_time(A.web_stream_events(Streamed), "event_time"), "5 minutes", ["host"])
    write = stream_sinks.multi_sink({"hits": lambda b: b}, out.write, out.finished)
    q = (hits.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", _fresh(t, "hits-checkpoint"))
             .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = out.read(t.spark, "hits", "event_hour timestamp, host string, num_hits bigint")
    last = rows.agg(F.max("batch_id")).first()[0]
    return rows.where(F.col("batch_id") == last).select(F.col("event_hour").cast("timestamp_ntz").alias("event_hour"), "host", "num_hits")


@query("t06_late_rows", oracle=_EV_SQL + f"""
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS event_hour, host, COUNT(host) AS num_hits FROM ev
WHERE event_time >= {LAST_DAY_SQL} - 10 GROUP BY 1, 2
""")
def t06_late_rows(t):
    """Tumbling hits of a stream whose third batch is ten days late and more: its
    rows are behind the watermark and change nothing (T1, T6)."""
    end, src = last_day(t), _fresh(t, "late")
    day = lambda back: F.date_sub(F.lit(end).cast("date"), back).cast("timestamp_ntz")
    ts = F.col("ts")
    for part in ((ts >= day(10)) & (ts < day(5)), ts >= day(5), ts < day(10)):
        t.events.where(part).coalesce(1).write.mode("append").parquet(src)

    class Streamed:
        events = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(src)

    out = stream_sinks.BatchFiles(_fresh(t, "late-hits"))
    hits = windows.tumbling_hits(stream_sources.with_event_time(A.web_stream_events(Streamed), "event_time"), "5 minutes", ["host"])
    q = (hits.writeStream.outputMode("update").foreachBatch(stream_sinks.multi_sink({"hits": lambda b: b}, out.write, out.finished))
             .option("checkpointLocation", _fresh(t, "late-checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = out.read(t.spark, "hits", "event_hour timestamp, host string, num_hits bigint")
    return rows.groupBy(F.col("event_hour").cast("timestamp_ntz").alias("event_hour"), "host").agg(
        F.max_by("num_hits", "batch_id").alias("num_hits"))


@query("t07_resumed_stream", oracle="""
SELECT o_orderstatus AS status, COUNT(*) AS num_orders FROM orders GROUP BY 1
""")
def t07_resumed_stream(t):
    """A stream stopped after half of its files and started again from its
    checkpoint reads the rest only (T7)."""
    src, dest, ckpt = _fresh(t, "halves"), _fresh(t, "resumed"), _fresh(t, "resumed-checkpoint")
    half = t.orders.select("o_orderkey", "o_orderstatus")
    for part in (0, 1):
        half.where(F.pmod("o_orderkey", F.lit(2)) == part).write.mode("append").parquet(src)
        stream = t.spark.readStream.schema("o_orderkey bigint, o_orderstatus string").parquet(src)
        stream_sinks.start_query(stream, f"resumed_{uuid.uuid4().hex}", "parquet", checkpoint=ckpt,
                                 trigger={"availableNow": True}, path=dest).awaitTermination()
    return t.spark.read.parquet(dest).groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("num_orders"))
