"""Queries that write tables and read them back: keyed maintenance (S6-S8),
bucketed and plain joins (S10, J11, J12), layouts (L5), and streams that end when
they have read their input (T5, T8).  Their tables go below the shared folder,
under a new name per run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators.geo import geo_enrich, ip_to_long
from strata.operators.intervals import interval_join
from strata.operators.relational import sized_join
from strata.plans.oracle_views import with_views
from strata.plans.registry import query
from strata.plans.report import LAST_SEASON_SQL, last_season
from strata.plans.stream_queries import _EV_SQL
from strata.session import scratch_path
from strata.sources import adapters as A, layouts, sinks
from strata.sources.keyed_tables import KeyedTable
from strata.streaming import sinks as stream_sinks


def _fresh(t, name: str) -> str:
    return scratch_path(t.spark, f"tables/{name}-{uuid.uuid4().hex}")


# ------------------------------------------------------- keyed maintenance

_CUSTOMER_SQL = f"""
WITH o AS (SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS season,
                  CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
old AS (SELECT o_custkey AS customer, MAX(season) AS last_season, COUNT(*) AS num_orders, CAST(SUM(cents) AS BIGINT) AS cents
        FROM o WHERE season < {LAST_SEASON_SQL} GROUP BY 1),
new AS (SELECT o_custkey AS customer, MAX(season) AS last_season, COUNT(*) AS num_orders, CAST(SUM(cents) AS BIGINT) AS cents
        FROM o WHERE season = {LAST_SEASON_SQL} GROUP BY 1)
"""


def _customers(t, now: bool):
    """Orders per customer, of the last season or of those before it."""
    end = last_season(t)
    season = F.year("o_orderdate").cast("bigint")
    o = t.orders.select("o_custkey", season.alias("season"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    return (o.where(F.col("season") == end if now else F.col("season") < end).groupBy(F.col("o_custkey").alias("customer"))
             .agg(F.max("season").alias("last_season"), F.count(F.lit(1)).alias("num_orders"), F.sum("cents").alias("cents")))


def _customer_table(t, name: str) -> KeyedTable:
    return KeyedTable(t.spark, _fresh(t, name), ["customer"], 16).create(_customers(t, False))


@query("s07_upsert", oracle=_CUSTOMER_SQL + """
FROM new UNION ALL FROM old WHERE customer NOT IN (SELECT customer FROM new)
""")
def s07_upsert(t):
    """Last season's customers replace or join the table of earlier ones."""
    table = _customer_table(t, "upsert")
    table.upsert(_customers(t, True))
    return table.read()


@query("s06_insert_ignore", oracle=_CUSTOMER_SQL + """
FROM old UNION ALL FROM new WHERE customer NOT IN (SELECT customer FROM old)
""")
def s06_insert_ignore(t):
    """Only customers who are new last season are added."""
    table = _customer_table(t, "insert")
    table.insert_ignore(_customers(t, True))
    return table.read()


@query("s08_close_rows", oracle=_CUSTOMER_SQL + f"""
SELECT customer, last_season AS start_season,
       CASE WHEN customer IN (SELECT customer FROM new) THEN CAST({LAST_SEASON_SQL} - 1 AS BIGINT) END AS end_season,
       customer NOT IN (SELECT customer FROM new) AS is_open
FROM old
""")
def s08_close_rows(t):
    """Open rows of customers with orders last season are closed."""
    rows = _customers(t, False).select("customer", F.col("last_season").alias("start_season"),
                                       F.lit(None).cast("bigint").alias("end_season"), F.lit(True).alias("is_open"))
    table = KeyedTable(t.spark, _fresh(t, "close"), ["customer"], 16).create(rows)
    table.close(_customers(t, True), "end_season", last_season(t) - 1, "is_open")
    return table.read()


# ------------------------------------------------------- joins by layout

_ORDER_LINES_SQL = """
SELECT o_orderkey, MAX(o_orderpriority) AS priority, COUNT(*) AS num_lines, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
"""


def order_lines(orders, lines):
    """Lines per order.  Merge hints keep both sides' layout decisive: no broadcast."""
    joined = orders.hint("merge").join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey").agg(
        F.max("o_orderpriority").alias("priority"), F.count(F.lit(1)).alias("num_lines"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


def _order_sides(t):
    return t.orders.select("o_orderkey", "o_orderpriority"), t.lineitem.select("l_orderkey", "l_quantity")


def bucketed_sides(t, order_buckets: int = 16, line_buckets: int = 8):
    """Orders and lines as catalog tables, bucketed and sorted by order key; the
    finer table's buckets are read together, so counts need only divide (S10)."""
    t.spark.conf.set("spark.sql.bucketing.coalesceBucketsInJoin.enabled", "true")
    names = []
    for df, key, buckets in zip(_order_sides(t), ("o_orderkey", "l_orderkey"), (order_buckets, line_buckets)):
        name = f"strata_{key}_{uuid.uuid4().hex}"
        sinks.write_bucketed(df, name, buckets, key, [key], path=_fresh(t, name))
        names.append(name)
    return tuple(t.spark.table(n) for n in names)


@query("j11_bucketed_join", oracle=_ORDER_LINES_SQL)
def j11_bucketed_join(t):
    """Orders with their lines from tables of 16 and 8 buckets: no shuffle."""
    return order_lines(*bucketed_sides(t))


@query("j12_plain_join", oracle=_ORDER_LINES_SQL)
def j12_plain_join(t):
    """The same join from unbucketed files: both sides are shuffled."""
    return order_lines(*_order_sides(t))


@query("j10_broadcast_join", oracle=with_views("matches", "maps") + """
SELECT name, playlist_id, COUNT(*) AS num_matches FROM matches JOIN maps USING (mapid) GROUP BY name, playlist_id
""")
def j10_broadcast_join(t):
    """Matches per map name and playlist; the maps are broadcast if their measured
    bytes allow it (J10)."""
    joined = sized_join(A.matches(t).select("mapid", "playlist_id"), A.maps(t), "mapid")
    return joined.groupBy("name", "playlist_id").agg(F.count(F.lit(1)).alias("num_matches"))


def ranges_of_all_widths(t):
    """IP ranges: blocks of 256, ranges of odd width that overlap them, one range
    per country from its first block to its last, and the whole network."""
    blocks = A.ip_ranges(t).select(F.col("country").alias("label"), "ip_start", "ip_end")
    odd = blocks.select(F.concat("label", F.lit(" odd")).alias("label"), (F.col("ip_start") + 13).alias("ip_start"),
                        (F.col("ip_end") + 700).alias("ip_end"))
    wide = blocks.groupBy(F.concat("label", F.lit(" wide")).alias("label")).agg(
        F.min("ip_start").alias("ip_start"), F.max("ip_end").alias("ip_end"))
    net = blocks.groupBy(F.lit("network").alias("label")).agg(
        F.lit(A.IP_BASE).cast("bigint").alias("ip_start"), F.lit(A.IP_BASE + (1 << 24) - 1).cast("bigint").alias("ip_end"))
    return blocks.union(odd).union(wide).union(net)


@query("j05_interval_join", oracle=f"""
WITH ips AS (SELECT 167772160 + (user_id // 256 % 256) * 65536 + (user_id % 256) * 256
                    + CAST(json_extract_string(props, '$.k') AS INTEGER) % 256 AS ip, COUNT(*) AS n FROM events GROUP BY 1),
b AS (SELECT n_name AS label, 167772160 + c_custkey * 256 AS s, 167772160 + c_custkey * 256 + 255 AS e
      FROM customer JOIN nation ON c_nationkey = n_nationkey),
r AS (FROM b UNION ALL SELECT label || ' odd', s + 13, e + 700 FROM b
      UNION ALL SELECT label || ' wide', MIN(s), MAX(e) FROM b GROUP BY label
      UNION ALL SELECT 'network', 167772160, 167772160 + 16777215)
SELECT label, s AS ip_start, e AS ip_end, CAST(SUM(n) AS BIGINT) AS num_events, COUNT(*) AS num_addresses
FROM r JOIN ips ON ip BETWEEN s AND e GROUP BY ALL
""")
def j05_interval_join(t):
    """Events and addresses in every IP range, whatever its width."""
    ips = (A.web_events_ip(t).groupBy(ip_to_long("ip").alias("address")).agg(F.count(F.lit(1)).alias("n")))
    found = interval_join(ips, ranges_of_all_widths(t), "address", "ip_start", "ip_end")
    return found.groupBy("label", "ip_start", "ip_end").agg(F.sum("n").alias("num_events"), F.count(F.lit(1)).alias("num_addresses"))


# ------------------------------------------------------- layouts

LAYOUT_COLUMNS = ["l_partkey", "l_orderkey"]


def written_layouts(t, n: int = 16) -> dict[str, str]:
    """Line items as three tables of ``n`` files: spread, by part, along a Z curve."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    tie = F.xxhash64(*lines.columns)
    orders = {"spread": [tie], "by_part": [F.col("l_partkey"), tie], "z_order": [F.col("_z"), tie]}
    zed = layouts.with_zorder(lines, LAYOUT_COLUMNS, "_z")
    paths = {}
    for name, order in orders.items():
        paths[name] = _fresh(t, f"layout-{name}")
        layouts.write_layout(zed if name == "z_order" else lines, paths[name], order, n)
    return paths


@query("l05_layouts", oracle="""
SELECT layout, col AS "column", (SELECT COUNT(*) FROM lineitem) AS num_rows, skips
FROM (VALUES ('spread', 'l_partkey', false), ('spread', 'l_orderkey', false), ('by_part', 'l_partkey', true),
             ('by_part', 'l_orderkey', false), ('z_order', 'l_partkey', true), ('z_order', 'l_orderkey', true)) AS v(layout, col, skips)
""")
def l05_layouts(t):
    """Three layouts of the line items: rows, and whether a reader of one part or
    order skips at least half of them by row-group statistics (L5)."""
    groups = layouts.row_groups(t.spark, written_layouts(t), LAYOUT_COLUMNS)
    shares = layouts.read_share(groups, t.lineitem, LAYOUT_COLUMNS)
    return shares.select("layout", "column", "num_rows", (F.col("share") <= 0.5).alias("skips"))


# ------------------------------------------------------- streams to their end

def _event_stream(t):
    """The events table as a file stream.  A pattern, since the table may be one
    file and a stream's plain path must be a folder."""
    path = f"{t.sf_dir.rstrip('/')}/events.parque[t]"
    return t.spark.readStream.schema(t.events.schema).parquet(path)


class _Streamed:
    """``adapters`` over the stream in place of the events table."""

    def __init__(self, t):
        self.events = _event_stream(t)


def _run_to_end(df, t, name: str, write) -> None:
    q = (df.writeStream.foreachBatch(write).option("checkpointLocation", _fresh(t, f"{name}-checkpoint"))
           .trigger(availableNow=True).start())
    q.awaitTermination()


@query("t05_enriched_stream", oracle=_EV_SQL + """,
r AS (SELECT '10.' || CAST(c_custkey // 256 AS VARCHAR) || '.' || CAST(c_custkey % 256 AS VARCHAR) || '.' AS prefix, n_name
      FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey < 65536)
SELECT ev.host, r.n_name AS country, COUNT(*) AS num_events
FROM ev LEFT JOIN r ON starts_with(ev.ip, r.prefix) GROUP BY 1, 2
""")
def t05_enriched_stream(t):
    """Events streamed through the IP range table into files, counted per host and
    country (T5, T7, T8)."""
    out = stream_sinks.BatchFiles(_fresh(t, "enriched"))
    ranges = A.ip_ranges(t)
    writers = {"places": lambda b: b.groupBy("host", "country").agg(F.count(F.lit(1)).alias("num_events"))}
    stream = geo_enrich(A.web_events_ip(_Streamed(t)), ranges)
    _run_to_end(stream, t, "enriched", stream_sinks.multi_sink(writers, out.write, out.finished))
    rows = out.read(t.spark, "places", "host string, country string, num_events bigint")
    return rows.groupBy("host", "country").agg(F.sum("num_events").alias("num_events"))


@query("t08_two_sinks", oracle=_EV_SQL + """
SELECT 'host' AS sink, host AS key, COUNT(*) AS num_events FROM ev GROUP BY host
UNION ALL SELECT 'url', url, COUNT(*) FROM ev GROUP BY url
""")
def t08_two_sinks(t):
    """One stream, two aggregates per batch, each batch there once."""
    out = stream_sinks.BatchFiles(_fresh(t, "two-sinks"))
    count = lambda c: lambda b: b.groupBy(F.col(c).alias("key")).agg(F.count(F.lit(1)).alias("num_events"))
    _run_to_end(A.web_events_ip(_Streamed(t)), t, "two-sinks",
                stream_sinks.multi_sink({"host": count("host"), "url": count("url")}, out.write, out.finished))
    both = [out.read(t.spark, s, "key string, num_events bigint").groupBy("key").agg(F.sum("num_events").alias("num_events"))
            .select(F.lit(s).alias("sink"), "key", "num_events") for s in ("host", "url")]
    return both[0].union(both[1])
