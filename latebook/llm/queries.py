"""Importing this module registers every query of the subpackage."""

from latebook.llm import (  # noqa: F401  (importing registers the queries)
    chat, context_tree, decontamination, licenses, lines, packing, phrases, quality, sharding,
    simhash, spelling, suffixes, toxicity,
)
from latebook.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
