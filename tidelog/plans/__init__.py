"""All registered queries and their SQL."""

from . import queries, transitions
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "queries", "transitions"]
