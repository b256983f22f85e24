"""Registered queries and the SQL each is compared with."""

from __future__ import annotations

from . import files, models  # noqa: F401  register their queries
from .queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
