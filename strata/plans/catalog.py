"""Imports every query module so the registry is complete."""

from strata.plans import registry
from strata.plans import (dim_queries, fact_queries, growth_queries,  # noqa: F401
                          job_queries, olap_queries, ordered_queries, primitive_queries,
                          sink_queries, stream_queries, table_queries)

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
HEADLINE = registry.HEADLINE
