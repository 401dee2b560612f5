"""All queries of the library, by name."""

from clinflow.queries import extracts, files, parsing, reports, routes  # noqa: F401
from clinflow.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
