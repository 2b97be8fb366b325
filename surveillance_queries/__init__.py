"""The registered queries: each operator run over the given tables, with the SQL it must agree with."""

from . import cleaning, live, serving, storage, text, warehouse  # noqa: F401  (they fill the registry)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
