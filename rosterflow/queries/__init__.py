"""Every operator as a query over the driver tables."""

from rosterflow.queries import (  # noqa: F401  registration
    files,
    intake,
    reshape,
    scalars,
    standards,
    submissions,
    tables,
)
from rosterflow.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
