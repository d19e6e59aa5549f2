"""strata: analytics-engineering patterns as Spark DataFrame operators.

Every operator is a pure ``DataFrame -> DataFrame`` function built on the
public PySpark API.  Sub-packages:

* ``sources``    readers, writers/sinks and the adapters that derive the
                 domain tables (events, devices, player seasons, films, ...)
                 from the driver's star-schema tables.
* ``functions``  Column -> Column helpers (tiers, bitmaps, array access, ...).
* ``operators``  the pattern operators (cumulative dimensions, SCD2, graph,
                 date lists, monthly arrays, growth accounting, OLAP, ...).
* ``plans``      the registered queries and their SQL oracles.
* ``streaming``  Structured Streaming sources, windows and sinks.
"""

__version__ = "0.1.0"
