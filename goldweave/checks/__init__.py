"""Every operator as a query over plain order, event and document tables, with the SQL that
gives the same result."""

from goldweave.checks import incremental, items, loading, merging, reading  # noqa: F401
from goldweave.checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
