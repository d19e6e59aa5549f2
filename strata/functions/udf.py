"""V1: user-defined functions.

Preferred form is a SQL function (``CREATE TEMPORARY FUNCTION ... RETURN``):
Catalyst inlines its body, so it stays inside whole-stage codegen.  A Python
callable is registered as a vectorised pandas UDF (Arrow batches), never as a
row-at-a-time UDF.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession, functions as F

from strata.operators.geo import IPV4


def register_sql_function(spark: SparkSession, name: str, params: str, returns: str,
                          body: str) -> None:
    """``register_sql_function(spark, 'ip_to_long', 'ip STRING', 'BIGINT', '...')``."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} "
              f"RETURN {body}")


def register_pandas_function(spark: SparkSession, name: str, fn: Callable, returns: str):
    """Register ``fn(pd.Series, ...) -> pd.Series`` as a pandas UDF usable from
    SQL and the DataFrame API; returns the UDF."""
    u = F.pandas_udf(fn, returns)
    spark.udf.register(name, u)
    return u


IP_TO_LONG_SQL = (f"CASE WHEN ip RLIKE '{IPV4}' THEN "
                  "CAST(split(ip, '[.]')[0] AS BIGINT) * 16777216 + "
                  "CAST(split(ip, '[.]')[1] AS BIGINT) * 65536 + "
                  "CAST(split(ip, '[.]')[2] AS BIGINT) * 256 + "
                  "CAST(split(ip, '[.]')[3] AS BIGINT) END")


def register_builtin_functions(spark: SparkSession) -> None:
    """The library's SQL functions (the IP helper of the enrichment job)."""
    register_sql_function(spark, "ip_to_long", "ip STRING", "BIGINT", IP_TO_LONG_SQL)
