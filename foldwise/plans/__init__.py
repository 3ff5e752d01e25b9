"""Query plans bound to the driver's tables, registered with their DuckDB oracle SQL."""

from foldwise.plans.registry import ORACLE, QUERIES, ROWS_ONLY, load_all  # noqa: F401
