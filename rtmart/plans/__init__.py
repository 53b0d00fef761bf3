from rtmart.plans.registry import queries, flagship
from rtmart.plans.oracle import oracle_sql

__all__ = ["queries", "flagship", "oracle_sql"]
