"""Structured Streaming: file stream -> windows; complete mode equals batch;
JSON and JDBC sinks."""

import json
import os
import time

from pyspark.sql import functions as F

from strata.sources import adapters as A
from strata.sources.readers import Tables
from strata.streaming import sinks as K, sources as S, windows as W
from tests.conftest import SF_SMALL


def _write_stream_files(spark, tmp_path, n_files=4):
    ev = A.web_stream_events(Tables(spark, SF_SMALL))
    src = str(tmp_path / "in")
    ev.repartition(n_files).write.mode("overwrite").json(src)
    return ev, src


def _run(df, name, mode):
    q = K.start_query(df, name, sink="memory", output_mode=mode, trigger={"availableNow": True})
    q.awaitTermination()
    out = df.sparkSession.table(name)
    return q, out


def test_tumbling_complete_equals_batch(spark, tmp_path):
    ev, src = _write_stream_files(spark, tmp_path)
    stream = S.with_event_time(S.read_event_stream(spark, path=src), "event_time")
    q, got = _run(W.tumbling_hits(stream, "5 minutes", ["host"]), "tumble_c", "complete")
    batch = W.tumbling_hits(S.with_event_time(ev, "event_time"), "5 minutes", ["host"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_sessions_complete_equals_batch(spark, tmp_path):
    ev, src = _write_stream_files(spark, tmp_path)
    stream = S.with_event_time(S.read_event_stream(spark, path=src), "event_time")
    q, got = _run(W.sessionize(stream, "5 minutes", ["ip", "host"]), "sess_c", "complete")
    batch = W.sessionize(S.with_event_time(ev, "event_time"), "5 minutes", ["ip", "host"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_session_gap_boundaries(spark):
    rows = [("1.1.1.1", "h", f"2024-01-01T00:{m:02d}:{s:02d}.000Z") for m, s in
            [(0, 0), (4, 59), (9, 59), (15, 0)]]
    df = spark.createDataFrame(rows, "ip string, host string, event_time string")
    s = W.sessionize(S.with_event_time(df, "event_time"), "5 minutes", ["ip", "host"])
    counts = sorted(r.num_events for r in s.collect())
    # 4:59 and 5:00 gaps merge, 5:01 splits
    assert counts == [1, 3]


def test_append_mode_with_watermark_and_json_sink(spark, tmp_path):
    ev, src = _write_stream_files(spark, tmp_path, n_files=2)
    stream = S.with_event_time(S.read_event_stream(spark, path=src), "event_time")
    agg = W.tumbling_hits(stream, "5 minutes", ["host"])
    out = str(tmp_path / "json_out")
    q = K.start_query(K.to_json_messages(agg), "json_sink", sink="text", output_mode="append",
                      trigger={"availableNow": True}, path=out)
    q.awaitTermination()
    rows = spark.read.text(out).collect()
    assert rows and all("num_hits" in json.loads(r.value) for r in rows)


def test_jdbc_and_multi_sink(spark, tmp_path):
    ev, src = _write_stream_files(spark, tmp_path, n_files=2)
    url = "jdbc:derby:memory:strata;create=true"
    stream = S.with_event_time(S.read_event_stream(spark, path=src), "event_time")
    jdbc = K.jdbc_writer(url, "processed_events", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    store = {}

    def sink(name, df, batch_id):
        if name == "events":
            jdbc(df, batch_id)
        else:
            store[name] = store.get(name, 0) + df.count()

    fb = K.multi_sink({"events": lambda b: b.select("url", "host", "ip", "event_time"),
                       "by_host": lambda b: b.groupBy("host").count()}, sink)
    q = (stream.writeStream.foreachBatch(fb).trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    n = spark.read.format("jdbc").option("url", url).option("dbtable", "processed_events") \
        .option("driver", "org.apache.derby.jdbc.EmbeddedDriver").load().count()
    assert n == ev.count() and store["by_host"] > 0


def test_enrich_stream(spark, tmp_path):
    t = Tables(spark, SF_SMALL)
    ev, src = _write_stream_files(spark, tmp_path, n_files=2)
    stream = S.read_event_stream(spark, path=src)
    enriched = K.enrich_stream(stream, A.ip_ranges(t))
    q, got = _run(enriched.select("ip", "geodata"), "enriched", "append")
    rows = got.collect()
    assert len(rows) == ev.count()
    assert any(r.geodata != "{}" for r in rows)


def test_late_event_beyond_watermark_is_dropped(spark, tmp_path):
    src = tmp_path / "late"
    src.mkdir()
    on_time = [{"url": "/", "host": "h", "ip": "1.1.1.1",
                "event_time": f"2024-01-01T10:{m:02d}:00.000Z"} for m in range(0, 20, 2)]
    later = [{"url": "/", "host": "h", "ip": "1.1.1.1", "event_time": "2024-01-01T10:30:00.000Z"}]
    late = [{"url": "/", "host": "h", "ip": "1.1.1.1", "event_time": "2024-01-01T09:00:00.000Z"}]
    # Spark filters late input against the previous batch's watermark, so the
    # late row comes two batches after the data that moved the watermark.
    for i, rows in enumerate([on_time, later, late]):
        f = src / f"part-{i}.json"
        f.write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(f, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))   # on-time file first
    stream = S.with_event_time(S.read_event_stream(spark, path=str(src), max_files_per_trigger=1),
                               "event_time", delay="15 seconds")
    late_rows = S.LateRows()
    spark.streams.addListener(late_rows)
    q, got = _run(W.tumbling_hits(stream, "5 minutes", ["host"]), "late_append", "append")
    starts = {r.event_hour.hour for r in got.collect()}
    assert 9 not in starts
    for _ in range(50):               # listener events arrive after the batch
        if late_rows.of(q):
            break
        time.sleep(0.2)
    spark.streams.removeListener(late_rows)
    assert late_rows.of(q) == 1


def test_restart_from_checkpoint_processes_only_new_files(spark, tmp_path):
    src = tmp_path / "restart"
    src.mkdir()
    ck = str(tmp_path / "restart_ck")

    def write(i, minutes):
        rows = [{"url": "/", "host": "h", "ip": "1.1.1.1",
                 "event_time": f"2024-01-01T10:{m:02d}:00.000Z"} for m in minutes]
        f = src / f"part-{i}.json"
        f.write_text("\n".join(json.dumps(r) for r in rows))

    def run_once():
        stream = S.with_event_time(S.read_event_stream(spark, path=str(src)), "event_time")
        q = K.start_query(W.tumbling_hits(stream, "5 minutes", ["host"]), "restart_q",
                          output_mode="complete", checkpoint=ck, trigger={"availableNow": True})
        q.awaitTermination()
        return q, {r.event_hour.minute: r.num_hits for r in spark.table("restart_q").collect()}

    write(0, [0, 1, 2, 6])
    q1, first = run_once()
    write(1, [7, 12])                       # new data after a "crash"
    q2, second = run_once()
    assert first == {0: 3, 5: 1}
    assert second == {0: 3, 5: 2, 10: 1}    # state restored, old file not re-read
    assert sum(p.numInputRows for p in q2.recentProgress) == 2
