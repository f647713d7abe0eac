"""Importing this module registers every query."""

from paperloom.plans import corpus_queries, entity_queries, float_queries, frontend_queries, markup, paper_queries, spanning  # noqa: F401
from paperloom.plans.registry import ORACLES, QUERIES  # noqa: F401
