"""Registered queries and their SQL."""

from __future__ import annotations

from .plans.oracles import ORACLES
from .plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
