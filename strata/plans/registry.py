"""Query registry: name -> Spark builder, name -> DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.session import ensure_checkpoint_dir
from strata.sources.readers import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def query(name: str, oracle: str | None = None, headline: bool = False):
    """Register ``fn(t: Tables) -> DataFrame`` as query ``name``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # date boundaries are UTC days, whatever session the caller built
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ensure_checkpoint_dir(spark)
            return fn(Tables(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


def r6(c, digits: int = 6):
    """Round a double output column for engine-independent comparison."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)
