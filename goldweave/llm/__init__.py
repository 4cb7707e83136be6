"""Operators for training data, and their queries with the SQL they must agree with."""

from goldweave.llm.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
