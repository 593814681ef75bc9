"""The registered queries, each with the SQL that must give the same rows."""

from latebook.catalog import (  # noqa: F401  (importing registers the queries)
    classification, cleaning, columns, control, quality, streams, tables,
)
from latebook.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
