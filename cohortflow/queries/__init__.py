"""Every operator as a query over the test tables."""

from cohortflow.queries import (  # noqa: F401  (importing a module registers its queries)
    genotypes,
    lab,
    metadata,
    planning,
    reads,
    reports,
    roundtrips,
    streams,
)
from cohortflow.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
