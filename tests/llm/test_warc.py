"""Framing, segments and archives: exact round trips and damage."""
import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strata.llm import warc as W

CAPTURE = "id long, uri string, payload binary, refers_to long"


def test_chunked_framing():
    for n in (0, 1, 10, 4096, 4097, 20000):
        data = bytes(random.Random(n).randrange(256) for _ in range(n))
        assert W.unchunked(W.chunked(data)) == data and W.decode(W._HTTP + W.chunked(data, 7)) == data
    assert W.unchunked(b"3;name=x\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab", b"zz\r\nab\r\n0\r\n\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"-1\r\n\r\n"):
        with pytest.raises(ValueError):
            W.unchunked(broken)
    assert W.decode(b"HTTP/1.1 200 OK\r\n\r\nplain") == b"plain" and W.decode(b"nothing") is None


def payloads():
    r = random.Random(2)
    return [b"", b"\r\n\r\n", b"WARC/1.1\r\n\r\n" * 5, bytes(range(256)) * 3, "é\U0001F600".encode() * 900,
            bytes(r.randrange(256) for _ in range(5000)), b"0\r\n\r\n" * 50]


def test_archives_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}", p, None) for i, p in enumerate(payloads())] + [(50, None, b"x", 3), (None, "u\r\nv", None, None), (1, "again", b"1", None)]
    path = f"file://{tmp_path}/a"
    W.write_archives(spark.createDataFrame(rows, CAPTURE).repartition(3), path, segment=300)
    records = W.read_records(spark, path)
    assert records.where("kind = 'continuation'").count() > 10
    back = W.reassembled(records).collect()
    assert len(back) == len(rows)
    got = sorted((r.record_id.split(":")[2], r.kind, r.digest, r.payload and bytes(r.payload)) for r in back if r.kind == "response")
    want = sorted((("null" if i is None else str(i)), "response", base64.b32encode(hashlib.sha1(p or b"").digest()).decode(), p or b"")
                  for i, _, p, ref in rows if ref is None)
    assert [(a, b, c, d or b"") for a, b, c, d in got] == want
    revisit = next(r for r in back if r.kind == "revisit")
    assert revisit.refers_to == "urn:capture:3" and revisit.payload is None


def test_missing_repeated_and_short_segments_have_no_payload(spark, tmp_path):
    rows = [(i, "u", b"%d" % i * 2000, None) for i in range(4)]
    path = f"file://{tmp_path}/b"
    W.write_archives(spark.createDataFrame(rows, CAPTURE), path, segment=500)
    r = W.read_records(spark, path)
    origin = F.coalesce("origin", "record_id")
    bad = (r.where(~(origin.contains("capture:0:") & (F.col("segment") == 2)))
           .unionByName(r.where(origin.contains("capture:1:") & (F.col("segment") == 2)))
           .withColumn("block", F.when(origin.contains("capture:2:") & (F.col("segment") == 3), F.lit(b"")).otherwise(F.col("block"))))
    got = {x.record_id.split(":")[2]: x.payload and bytes(x.payload) for x in W.reassembled(bad).collect()}
    assert got == {"0": None, "1": None, "2": None, "3": b"3" * 2000}


def test_base32_in_spark(spark):
    df = spark.createDataFrame([(bytearray(p),) for p in payloads()], "payload binary")
    for r in df.select("payload", W.base32_sha1(F.col("payload")).alias("d")).collect():
        assert r.d == W.digest(bytes(r.payload))


def test_largest_id_is_the_response(spark):
    rows = [(1, "a", b"x", None), (9, "b", b"x", None), (4, "c", b"x", None), (2, "d", b"", None), (7, "e", None, None),
            (3, "f", b"y", None), (None, "g", b"x", None), (9, "b", b"x", None)]
    got = sorted(((r.id, r.uri, r.refers_to) for r in W.duplicates(spark.createDataFrame(rows, CAPTURE).drop("refers_to")).collect()), key=str)
    assert got == sorted([(1, "a", 9), (9, "b", None), (4, "c", 9), (2, "d", 7), (7, "e", None), (3, "f", None), (None, "g", 9), (9, "b", None)], key=str)


def test_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}/c"
    W.write_archives(spark.createDataFrame([], CAPTURE), path)
    assert W.reassembled(W.read_records(spark, path)).count() == 0


def test_other_columns_and_a_shuffled_join(spark, monkeypatch):
    rows = [(1, "a", b"x", 5, "s"), (9, "b", b"x", 6, "t"), (3, "c", b"y", 7, "u")]
    df = spark.createDataFrame(rows, "id long, uri string, payload binary, largest int, same string")
    want = [(1, 5, "s", 9), (3, 7, "u", None), (9, 6, "t", None)]
    assert sorted(tuple(r) for r in W.duplicates(df).select("id", "largest", "same", "refers_to").collect()) == want
    monkeypatch.setattr(W, "TWINS", 0)
    assert sorted(tuple(r) for r in W.duplicates(df).select("id", "largest", "same", "refers_to").collect()) == want


def test_query_equals_its_sql(spark):
    import duckdb

    from scripts.oracle_check import digest
    from strata.llm.queries import ORACLE, QUERIES
    from tests.conftest import SF_SMALL
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS FROM read_parquet('{SF_SMALL}/pages.parquet')")
    got, want = QUERIES["op9_warc"](spark, SF_SMALL), con.execute(ORACLE["op9_warc"])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert digest(got.columns, [tuple(r) for r in got.collect()])[0] == digest(names, want.fetchall())[0]


def test_damage_is_told(spark, tmp_path):
    from strata.llm.queries import archived
    rows = [(1, "u", b"a" * 3000, None), (2, "u", b"b" * 3000, None), (3, "u", b"b" * 3000, 2), (4, "u", b"a" * 3000, 1), (5, "u", b"c" * 900, None)]
    path = f"file://{tmp_path}/d"
    W.write_archives(spark.createDataFrame(rows, CAPTURE), path, segment=500)
    r = W.read_records(spark, path)
    origin = F.coalesce("origin", "record_id")
    bad = r.where(~(origin.contains("capture:1:") & (F.coalesce("segment", F.lit(1)) == 2)))
    bad = bad.withColumn("digest", F.when(origin.contains("capture:5:") & F.col("origin").isNull(), "OTHER").otherwise(F.col("digest")))
    got = {x.page_id: (x.payload_bytes, x.payload_digest, x.damaged) for x in archived(W.reassembled(bad)).collect()}
    a, b, c = (W.digest(x) for x in (b"a" * 3000, b"b" * 3000, b"c" * 900))
    assert got == {1: (None, a, True), 2: (3000, b, False), 3: (3000, b, False), 4: (None, a, True), 5: (900, c, True)}
