"""Registered queries: every operator on the given tables, with equivalent SQL."""

import importlib

from ledgerloom.catalogue.registry import ORACLES, QUERIES

MODULES = [
    "vault", "cleaning", "lookups", "resolution", "marts", "quality", "relational", "tables", "jobs",
]


def load_all():
    """Import the query modules, which fill the registry."""
    for name in MODULES:
        importlib.import_module(f"ledgerloom.catalogue.{name}")
    return QUERIES, ORACLES
