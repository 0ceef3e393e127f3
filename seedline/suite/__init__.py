"""Registered queries, each with the SQL that checks it where SQL can."""

from . import aggregates, composites, joining, models, rows, scalars, sources, windowing  # noqa: F401
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
