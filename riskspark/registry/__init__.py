"""Registered queries over the given tables and the SQL each is checked with."""

from riskspark.registry.base import queries, oracle_sql  # noqa: F401
from riskspark.registry import (  # noqa: F401  (registration by import)
    enrichment,
    features,
    ingest,
    letters,
    operations,
    rules,
    views,
)
