"""Registered queries (one per operator of the inventory) and their oracles."""

from tessera.plans import bytepair, corpus, io, models, sampling, streams, vectors  # noqa: F401  (registration)
from tessera.plans.oracle import SQL
from tessera.plans.registry import QUERIES

__all__ = ["QUERIES", "SQL"]
