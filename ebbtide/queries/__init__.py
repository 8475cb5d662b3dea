"""Registered queries: every operator run over the driver's whole tables, with its SQL oracle."""

from ebbtide.queries import evaluating, modelling, preparing, profiling, tracking  # noqa: F401
from ebbtide.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
