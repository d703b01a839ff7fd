"""Registered queries: every operator over the given tables, with the SQL that must agree."""

from tidefold.queries import changes, control, documents, flows, naming, publishing  # noqa: F401
from tidefold.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
