"""Query catalogue: each registered query maps an operator onto the driver's tables and
carries, where SQL can express it, an independent DuckDB oracle."""
from airnet.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
from airnet.plans import queries as _queries  # noqa: F401  (registers everything)
from airnet.plans import csv_queries as _csv_queries  # noqa: F401
