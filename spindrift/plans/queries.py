"""All queries of the library, the optional operators' own aside."""

from spindrift.plans import engine_queries, graph_queries, text_queries  # noqa: F401
from spindrift.plans.catalog import FLAGSHIP, oracle_sql, queries

__all__ = ["FLAGSHIP", "oracle_sql", "queries"]
