"""The registered queries and their SQL counterparts."""

from tidestar.suite.oracles import oracle_sql
from tidestar.suite.registry import queries

__all__ = ["oracle_sql", "queries"]
